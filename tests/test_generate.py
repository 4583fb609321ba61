from datetime import date, timedelta

from conftest import ordered, rows_of
from pyspark.sql import functions as F

from tillroll.functions.codes import region_of_country
from tillroll.functions.hashing import simulated_return
from tillroll.operators.gold import monthly_region_category
from tillroll.operators.silver import enrich
from tillroll.sources import generate

SEED = 42


def some_orders(spark, count=20_000, seed=SEED):
    ids = generate.sequence(spark, "order_number", count)
    return generate.orders(ids, 1000, 300, as_of="2024-06-30", seed=seed)


def test_customers(spark):
    frame = generate.customers(generate.sequence(spark, "customer_id", 2000), SEED)
    assert frame.count() == 2000
    low, high = rows_of(frame.agg(F.min("age"), F.max("age")))[0]
    assert (low, high) == (18, 75)
    assert {g for (g,) in rows_of(frame.select("gender").distinct())} == set(generate.GENDERS)
    assert frame.filter(F.col("region") != region_of_country(F.col("country"))).count() == 0
    assert {r for (r,) in rows_of(frame.select("region").distinct())} == {
        "North America", "Europe", "Asia", "Other",
    }


def test_products(spark):
    frame = generate.products(generate.sequence(spark, "product_id", 3000), SEED)
    for number, category, subcategory, name, price in rows_of(frame):
        assert subcategory in generate.SUBCATEGORIES[category]
        assert name == f"{category}-{subcategory}-{number:04d}"
        assert 5 <= price <= 1500 and round(price, 2) == price
    assert frame.select("category", "subcategory").distinct().count() == 20


def test_orders(spark):
    frame = some_orders(spark)
    facts = frame.agg(
        F.count_distinct("order_id"), F.min("quantity"), F.max("quantity"), F.min("customer_id"),
        F.max("customer_id"), F.min("product_id"), F.max("product_id"), F.count_distinct("channel"),
        F.min(F.to_date("order_ts")), F.max(F.to_date("order_ts")), F.count_distinct(F.to_date("order_ts")),
    )
    last = date(2024, 6, 30)
    assert rows_of(facts) == [(20_000, 1, 5, 1, 1000, 1, 300, 3, last - timedelta(240), last, 241)]
    pairs = frame.select("customer_id", "product_id").distinct().count()
    assert pairs > 19_000


def test_same_rows_on_any_partitioning(spark):
    ids = generate.sequence(spark, "order_number", 5000)
    few = generate.orders(ids.coalesce(2), 1000, 300, as_of="2024-06-30", seed=SEED)
    many = generate.orders(ids.repartition(13), 1000, 300, as_of="2024-06-30", seed=SEED)
    assert ordered(rows_of(few)) == ordered(rows_of(many))
    other_seed = generate.orders(ids, 1000, 300, as_of="2024-06-30", seed=7)
    assert ordered(rows_of(few)) != ordered(rows_of(other_seed))


def test_returns_are_about_the_asked_share(spark):
    flags = some_orders(spark).select(simulated_return(5, SEED, F.col("order_id")).alias("r"))
    assert 0.04 < rows_of(flags.agg(F.avg("r")))[0][0] < 0.06


def test_generated_star_runs_through_to_gold(spark):
    customers = generate.customers(generate.sequence(spark, "customer_id", 1000), SEED)
    products = generate.products(generate.sequence(spark, "product_id", 300), SEED)
    monthly = monthly_region_category(enrich(some_orders(spark), customers, products, how="inner"))
    assert rows_of(monthly.agg(F.count_distinct("yyyymm"), F.count_distinct("category")))[0] == (8, 5)
