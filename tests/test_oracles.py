"""Every registered query against DuckDB."""

import re

import pytest
from conftest import DATA, open_tables, ordered, rows_of

import __spark_entry__ as driver

# The queries of the llm subpackage have tests of their own.
QUERIES = {name: q for name, q in driver.queries().items() if not re.match(r"op\d+_|pipeline$", name)}
ORACLES = {name: text for name, text in driver.oracle_sql().items() if name in QUERIES}
SORTED = ["monthly_region_category", "revenue_trend", "top_customers_report"]

# Queries with a join to a dimension, or with a second pass over the orders.
JOINING = [
    "orders_bronze",
    "silver_left",
    "silver_inner",
    "order_rejects",
    "monthly_region_category",
    "customer_spend",
    "top_customers_10",
    "channel_mix",
    "net_revenue",
    "price_outliers",
    "salted_region_revenue",
    "top_categories_last_full",
    "layer_counts",
]


def compare(spark, name, folder):
    frame = QUERIES[name](spark, folder)
    expected = open_tables(folder).sql(ORACLES[name])
    assert sorted(frame.columns) == sorted(expected.columns)
    rows, wanted = rows_of(frame, expected.columns), expected.fetchall()
    assert wanted, "an empty result compares nothing"
    if name in SORTED:
        assert [row[:2] for row in rows] == [row[:2] for row in wanted]
    assert ordered(rows) == ordered(wanted)


@pytest.mark.parametrize("name", list(ORACLES))
def test_driver_tables(spark, name):
    compare(spark, name, f"{DATA}/sf0.01")


@pytest.mark.parametrize("name", list(ORACLES))
def test_orphans_nulls_hot_keys_and_copies(spark, hard_folder, name):
    compare(spark, name, hard_folder)


@pytest.mark.parametrize("name", JOINING)
def test_same_without_broadcasts(spark, hard_folder, settings, name):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    compare(spark, name, hard_folder)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    frame = QUERIES[name](spark, f"{DATA}/sf0.001")
    assert frame.count() > 0


def test_entry(spark):
    assert rows_of(driver.entry(spark))


def test_known_counts_with_thinned_dimensions(spark):
    from pyspark.sql import functions as F

    from tillroll.operators.quality import order_rejects
    from tillroll.operators.silver import enrich
    from tillroll.sources import sales_tables as sales

    folder = f"{DATA}/sf0.01"
    orders = sales.orders(spark, folder)
    customers = sales.customers(spark, folder).filter(F.col("customer_id") % 7 != 0)
    products = sales.products(spark, folder).filter(F.col("product_id") % 11 != 0)
    assert enrich(orders, customers, products).count() == 60_000
    assert enrich(orders, customers, products, how="inner").count() == 46_705
    rejects = dict(rows_of(order_rejects(orders, customers, products)))
    assert rejects["orphan_customer"] == 8_571
    assert rejects["orphan_product"] == 5_481
