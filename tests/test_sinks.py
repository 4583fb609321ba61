import os

import pytest
from conftest import DATA, ordered, rows_of
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tillroll import schemas
from tillroll.operators import gold
from tillroll.plans.layers import Layers, build_layers, layers_of, register_views, write_layers
from tillroll.sinks.scratch import materialise, scratch, scratch_path
from tillroll.sinks.tables import (
    append_bronze,
    count_rows,
    rebuild_months,
    reused,
    sample,
    write_bucketed,
    write_gold,
    write_silver,
)
from tillroll.sources.star import read_customers, read_orders, read_products, read_silver

ROW = "SELECT 'a' AS order_id, {month} AS yyyymm, {region} AS region, {amount}D AS total_amount"


def silver_rows(spark, *rows):
    return spark.sql(
        " UNION ALL ".join(ROW.format(month=m, region=r, amount=a) for m, r, a in rows)
    )


def test_months_stay_strings_and_null_regions_stay_null(spark, tmp_path):
    silver = silver_rows(spark, ("'202406'", "'Europe'", 1), ("'202406'", "CAST(NULL AS STRING)", 2))
    path = str(tmp_path / "silver")
    write_silver(silver, path)
    assert os.path.isdir(f"{path}/yyyymm=202406/region=Europe")
    back = read_silver(spark, path, silver.schema)
    assert ordered(rows_of(back, silver.columns)) == ordered(rows_of(silver))
    assert back.filter((F.col("yyyymm") == "202406") & F.col("region").isNull()).count() == 1


def read_months(spark, path, schema):
    return ordered(rows_of(read_silver(spark, path, schema), ["yyyymm", "region", "total_amount"]))


def test_one_month_is_replaced_and_the_others_survive(spark, tmp_path):
    path = str(tmp_path / "silver")
    both = silver_rows(spark, ("'202405'", "'Europe'", 1), ("'202406'", "'Europe'", 2))
    write_silver(both, path)
    rebuild_months(silver_rows(spark, ("'202406'", "'Europe'", 9), ("'202407'", "'Asia'", 7)), path, ["202406"])
    assert read_months(spark, path, both.schema) == [("202405", "Europe", 1.0), ("202406", "Europe", 9.0)]
    write_silver(silver_rows(spark, ("'202406'", "'Europe'", 3)), path)
    assert read_months(spark, path, both.schema) == [("202406", "Europe", 3.0)]


def test_a_moved_order_leaves_its_region(spark, tmp_path):
    path = str(tmp_path / "silver")
    before = silver_rows(spark, ("'202406'", "'Europe'", 1), ("'202406'", "NULL", 2))
    write_silver(before, path)
    rebuild_months(silver_rows(spark, ("'202406'", "'Asia'", 1), ("'202406'", "NULL", 2)), path, ["202406"])
    assert read_months(spark, path, before.schema) == [("202406", None, 2.0), ("202406", "Asia", 1.0)]


def test_an_emptied_month_is_empty(spark, tmp_path):
    path = str(tmp_path / "silver")
    both = silver_rows(spark, ("'202405'", "'Europe'", 1), ("'202406'", "'Europe'", 2))
    write_silver(both, path)
    rebuild_months(both.filter("yyyymm = '202405'"), path, ["202405", "202406"])
    assert read_months(spark, path, both.schema) == [("202405", "Europe", 1.0)]
    with pytest.raises(ValueError):
        rebuild_months(both, path, ["../x"])


def test_few_files_per_folder(spark, tmp_path, hard_folder):
    path = str(tmp_path / "silver")
    write_silver(driver.silver_left(spark, hard_folder), path)
    counts = [
        len([f for f in files if f.endswith(".parquet")])
        for folder, _, files in os.walk(path)
        if "region=" in folder
    ]
    assert counts and max(counts) == 1


def test_gold_in_a_number_of_files(spark, tmp_path):
    path = str(tmp_path / "gold")
    write_gold(spark.range(0, 1000, 1, 8), path, files=2)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 2
    write_gold(spark.range(10), path)
    assert spark.read.parquet(path).count() == 10


def test_dry_run_writes_nothing(spark, tmp_path):
    sources = driver.sales
    folder = f"{DATA}/sf0.001"
    silver = driver.silver_left(spark, folder)
    before = set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) if os.path.isdir(spark.conf.get("spark.checkpoint.dir")) else set()
    layers = build_layers(
        sources.orders(spark, folder).select(driver.BRONZE_COLUMNS),
        sources.customers(spark, folder),
        sources.products(spark, folder),
    )
    base = str(tmp_path / "out")
    targets = write_layers(layers, base)
    assert [os.path.basename(t) for t in targets] == [
        "silver_orders", "gold_monthly_region_category", "gold_top_customers", "gold_moving_rev",
    ]
    assert not os.path.exists(base)
    after = set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) if os.path.isdir(spark.conf.get("spark.checkpoint.dir")) else set()
    assert after == before
    assert write_layers(layers, base, dry_run=False) == targets
    assert all(os.path.isdir(target) for target in targets)
    back = read_silver(spark, f"{base}/silver_orders", silver.schema)
    assert len(silver.columns) == 15
    assert ordered(rows_of(back, silver.columns)) == ordered(rows_of(silver))


def test_views(spark):
    layers = layers_of(driver.silver_left(spark, f"{DATA}/sf0.001"))
    register_views(layers)
    assert isinstance(layers, Layers)
    for name in ["orders_silver", *layers.gold()]:
        assert spark.table(name).columns


def test_reused_is_released(spark):
    frame = spark.range(10)
    with reused(frame) as kept:
        assert kept.is_cached
        assert rows_of(count_rows({"a": kept, "b": kept.limit(3)})) == [("a", 10), ("b", 3)]
    assert not frame.is_cached


def test_sample(spark):
    assert sample(spark.range(100), 5).count() == 5


def test_append_only_adds(spark, tmp_path):
    path = str(tmp_path / "bronze")
    orders = clean_orders(spark)
    append_bronze(orders, path)
    append_bronze(orders, path)
    assert read_orders(spark, path).count() == 2 * orders.count()


def clean_orders(spark):
    from tillroll.sources import generate

    return generate.orders(
        generate.sequence(spark, "order_number", 50), 10, 10, as_of="2024-06-30", seed=1
    )


def test_star_readers_declare_types(spark, tmp_path):
    spark.sql(
        "SELECT 1 AS customer_id, 'a' AS customer_name, 20 AS age, 'Other' AS gender, 'x' AS country, 'y' AS region"
    ).write.parquet(str(tmp_path / "c"))
    spark.sql(
        "SELECT 1 AS product_id, 'a' AS category, 'b' AS subcategory, 'c' AS product_name, 2.5D AS base_price"
    ).write.parquet(str(tmp_path / "p"))
    customers = read_customers(spark, str(tmp_path / "c"))
    assert customers.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.DIM_CUSTOMERS]
    assert rows_of(customers) == [(1, "a", 20, "Other", "x", "y")], "keys stored as INT are read as BIGINT"
    products = read_products(spark, str(tmp_path / "p"))
    assert rows_of(products) == [(1, "a", "b", "c", 2.5)]


def test_gold_schemas(spark, hard_folder):
    layers = layers_of(driver.silver_left(spark, hard_folder))
    declared = {
        "gold_monthly_region_category": schemas.GOLD_MONTHLY_REGION_CATEGORY,
        "gold_top_customers": schemas.GOLD_TOP_CUSTOMERS,
        "gold_moving_rev": schemas.GOLD_MOVING_REV,
    }
    for name, frame in layers.gold().items():
        columns = [f"{n} {t.upper()}" for n, t in frame.dtypes]
        assert ", ".join(columns) == declared[name]


def test_bucketed_totals_and_joins_do_not_shuffle(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    spend = spark.range(1000).selectExpr("id % 100 AS customer_id", "CAST(id AS DOUBLE) AS total_amount")
    write_bucketed(spend, "bucketed_lines", 4)
    write_bucketed(spend.select("customer_id").distinct(), "bucketed_customers", 4)
    joined = spark.table("bucketed_lines").join(spark.table("bucketed_customers"), "customer_id")
    totals = joined.groupBy("customer_id").agg(F.sum("total_amount").alias("total_spent"))
    assert "Exchange" not in totals._jdf.queryExecution().executedPlan().toString()
    assert totals.count() == 100
    spark.sql("DROP TABLE bucketed_lines")
    spark.sql("DROP TABLE bucketed_customers")


def test_scratch_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(shared) and first != second
    frame = materialise(spark.range(5), "five")
    assert frame.count() == 5 and frame.inputFiles()[0].startswith(f"file://{shared}")


def test_scratch_leaves_nothing_behind(spark, tmp_path):
    folder = str(tmp_path / "own")
    with scratch(spark, folder) as path:
        frame = materialise(spark.range(5), "five", path)
        assert frame.count() == 5 and frame.inputFiles()[0].startswith(f"file://{folder}")
    assert os.listdir(folder) == []
    with pytest.raises(ZeroDivisionError), scratch(spark, folder) as path:
        materialise(spark.range(5), "five", path)
        raise ZeroDivisionError
    assert os.listdir(folder) == []


class Elsewhere:
    """A session that names no shared folder."""

    class conf:
        @staticmethod
        def get(name, default=None):
            return {"spark.master": "local[8]"}.get(name, default)


def test_no_scratch_without_a_named_folder():
    with pytest.raises(RuntimeError):
        scratch_path(Elsewhere, "x")
    assert scratch_path(Elsewhere, "x", "/shared").startswith("/shared/")


def test_rebuilt_silver_equals_silver(spark, hard_folder, tmp_path):
    silver = driver.silver_left(spark, hard_folder)
    bronze_path, silver_path = str(tmp_path / "bronze"), str(tmp_path / "silver")
    bronze = driver.sales.orders(spark, hard_folder).select(driver.BRONZE_COLUMNS)
    append_bronze(bronze, bronze_path)
    rebuilt = driver.enrich(
        read_orders(spark, bronze_path, bronze.schema),
        driver.sales.customers(spark, hard_folder),
        driver.sales.products(spark, hard_folder),
    )
    write_silver(rebuilt, silver_path)
    back = read_silver(spark, silver_path, silver.schema)
    assert ordered(rows_of(back, silver.columns)) == ordered(rows_of(silver))
    assert gold.latest_month(back).count() == 1
