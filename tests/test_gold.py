"""Edge cases and properties of silver and gold, on small hand-made frames."""

from datetime import date, datetime

import pytest
from conftest import DATA, ordered, rows_of
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tillroll.operators import gold
from tillroll.operators.outliers import price_outliers
from tillroll.operators.quality import cast_failures, duplicate_keys, order_rejects, split_orders
from tillroll.operators.silver import clean, enrich, redistribute
from tillroll.operators.skew import salted_revenue
from tillroll.plans import reports
from tillroll.schemas import ORDERS_BRONZE

SPEND = "region STRING, customer_id INT, total_spent DOUBLE"
MONTHLY = "yyyymm STRING, revenue DOUBLE"


def test_enrich_left_and_inner(spark):
    moment = datetime(2024, 6, 30, 23, 59, 59)
    orders = spark.createDataFrame(
        [
            ("a", moment, 1, 1, 2, "Online"),
            ("b", moment, 9, 1, 3, "Store"),
            ("c", moment, 1, 9, 4, "Store"),
            ("d", moment, None, None, 5, "Store"),
        ],
        ORDERS_BRONZE,
    )
    customers = spark.createDataFrame([(1, "Europe", "France")], "customer_id INT, region STRING, country STRING")
    products = spark.createDataFrame(
        [(1, "Toys", "Car", 9.99)], "product_id INT, category STRING, subcategory STRING, base_price DOUBLE"
    )
    left = enrich(orders, customers, products)
    assert left.columns[:6] == orders.columns
    assert ordered(rows_of(left, ["order_id", "region", "category", "total_amount", "yyyymm"])) == [
        ("a", "Europe", "Toys", 19.98, "202406"),
        ("b", None, "Toys", 29.97, "202406"),
        ("c", "Europe", None, None, "202406"),
        ("d", None, None, None, "202406"),
    ]
    inner = enrich(orders, customers, products, how="inner")
    assert rows_of(inner, ["order_id", "order_date"]) == [("a", date(2024, 6, 30))]
    monthly = gold.monthly_region_category(left)
    assert ordered(rows_of(monthly)) == ordered(
        [
            ("202406", "Europe", "Toys", 19.98, 2),
            ("202406", None, "Toys", 29.97, 3),
            ("202406", "Europe", None, None, 4),
            ("202406", None, None, None, 5),
        ]
    )


def test_customer_spend_is_the_same_either_way(spark, hard_folder):
    silver = driver.silver_left(spark, hard_folder)
    assert ordered(rows_of(gold.customer_spend(silver))) == ordered(
        rows_of(driver.customer_spend(spark, hard_folder))
    )


def test_ties_at_the_last_rank_are_all_kept(spark):
    spend = spark.createDataFrame(
        [("E", 1, 30.0), ("E", 2, 20.0), ("E", 3, 20.0), ("E", 4, 10.0), ("A", 5, 1.0), (None, 6, 5.0)], SPEND
    )
    assert ordered(rows_of(gold.top_customers(spend, 2))) == ordered(
        [("E", 1, 30.0, 1), ("E", 2, 20.0, 2), ("E", 3, 20.0, 2), ("A", 5, 1.0, 1), (None, 6, 5.0, 1)]
    )


def test_null_spend_is_ranked_last(spark):
    spend = spark.createDataFrame([("E", 1, 3.0), ("E", 2, None), ("E", 3, None)], SPEND)
    assert ordered(rows_of(gold.top_customers(spend, 5))) == ordered(
        [("E", 1, 3.0, 1), ("E", 2, None, 2), ("E", 3, None, 2)]
    )


@pytest.mark.parametrize("n", [1, 3, 10])
def test_ranks_match_one_window_over_everything(spark, n):
    from pyspark.sql import Window

    spend = spark.range(5000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'Other' ELSE concat('r', id % 4) END AS region",
        "CAST(id AS INT) AS customer_id",
        "CASE WHEN id % 3 = 0 THEN 77.0D ELSE CAST(id * 37 % 101 AS DOUBLE) END AS total_spent",
    )
    window = Window.partitionBy("region").orderBy(F.desc("total_spent"))
    plain = spend.withColumn("rank", F.dense_rank().over(window)).filter(F.col("rank") <= n)
    assert ordered(rows_of(gold.top_customers(spend, n))) == ordered(rows_of(plain))


def test_ranks_have_no_gaps(spark):
    top = rows_of(driver.top_customers(10)(spark, f"{DATA}/sf0.001"))
    for region in {row[0] for row in top}:
        ranks = {row[3] for row in top if row[0] == region}
        assert ranks == set(range(1, len(ranks) + 1))


def test_missing_month_by_rows_and_by_calendar(spark):
    monthly = spark.createDataFrame([("202401", 1.0), ("202402", 2.0), ("202404", 9.0)], MONTHLY)
    by_rows = ordered(rows_of(gold.moving_average(monthly)))
    assert by_rows == [("202401", 1.0, 1.0), ("202402", 2.0, 1.5), ("202404", 9.0, 4.0)]
    by_calendar = ordered(rows_of(gold.moving_average(monthly, calendar=True)))
    assert by_calendar == [("202401", 1.0, 1.0), ("202402", 2.0, 1.5), ("202404", 9.0, 5.5)]


def test_moving_average_warms_up_and_skips_nulls(spark):
    assert rows_of(gold.moving_average(spark.createDataFrame([("202401", 4.0)], MONTHLY))) == [
        ("202401", 4.0, 4.0)
    ]
    monthly = spark.createDataFrame([("202401", 4.0), ("202402", None)], MONTHLY)
    assert ordered(rows_of(gold.moving_average(monthly)))[1] == ("202402", None, 4.0)


def star(spark, sales):
    """Orders of one piece each, one product per category, one customer."""
    rows = [(f"o{i}", datetime(*day), 1, product, 1, "Store") for i, (day, product) in enumerate(sales)]
    products = sorted({product for _, product in sales})
    return (
        spark.createDataFrame(rows, ORDERS_BRONZE),
        spark.createDataFrame([(1, "E")], "customer_id BIGINT, region STRING"),
        spark.createDataFrame(
            [(p, f"c{p}", 1.0 if p < 10 else float(p)) for p in products],
            "product_id BIGINT, category STRING, base_price DOUBLE",
        ),
    )


@pytest.mark.parametrize("last_day, full", [(1, "c17"), (29, "c17"), (30, "c15")])
def test_last_full_month(spark, last_day, full):
    tables = star(spark, [((2024, 5, 20), 17), ((2024, 6, last_day, 23, 59, 59), 15)])
    assert rows_of(reports.top_categories(*tables, month="last_full")) == [("E", full, float(full[1:]))]
    assert rows_of(reports.top_categories(*tables)) == [("E", "c15", 15.0)]


def test_months_of_reports_without_full_months_or_orders(spark):
    tables = star(spark, [((2024, 6, 3), 15)])
    assert reports.report_month(tables[0], "last_full") is None
    assert rows_of(reports.top_categories(*tables, month="last_full")) == []
    none = tables[0].limit(0)
    assert reports.report_month(none) is None
    assert rows_of(reports.top_categories(none, *tables[1:])) == []
    with pytest.raises(ValueError):
        reports.report_month(none, "first")


def test_five_categories_and_ties_by_name(spark):
    tables = star(spark, [((2024, 6, 30), product) for product in range(7)])
    assert rows_of(reports.top_categories(*tables)) == [("E", f"c{i}", 1.0) for i in range(5)]


def test_reports_touch_no_view(spark):
    spark.sql("SELECT 1 AS kept").createOrReplaceTempView("gold_moving_rev")
    frame = spark.sql("SELECT '202401' AS yyyymm, 1.0D AS revenue, 1.0D AS rev_ma_3m")
    assert rows_of(reports.run(reports.REVENUE_TREND, gold_moving_rev=frame)) == [("202401", 1.0, 1.0)]
    assert spark.table("gold_moving_rev").columns == ["kept"]
    spark.catalog.dropTempView("gold_moving_rev")


def test_channel_mix_of_a_zero_month(spark):
    silver = spark.createDataFrame(
        [("202401", "Online", 0.0), ("202402", "Online", 1.0), ("202402", "Store", 3.0)],
        "yyyymm STRING, channel STRING, total_amount DOUBLE",
    )
    assert ordered(rows_of(gold.channel_mix(silver))) == [
        ("202401", "Online", 0.0, None),
        ("202402", "Online", 1.0, 25.0),
        ("202402", "Store", 3.0, 75.0),
    ]


def test_channel_shares_add_up(spark):
    mix = gold.channel_mix(driver.priced_lines(spark, f"{DATA}/sf0.001"))
    for _, share in rows_of(mix.groupBy("yyyymm").agg(F.sum("pct"))):
        assert share == pytest.approx(100)


def test_net_revenue(spark):
    silver = spark.createDataFrame(
        [("202401", "E", 10.0, 0), ("202401", "E", 2.5, 1), ("202401", "E", None, 1), ("202402", "A", 1.0, 0)],
        "yyyymm STRING, region STRING, total_amount DOUBLE, is_return INT",
    )
    assert ordered(rows_of(gold.net_revenue(silver))) == [
        ("202401", "E", 12.5, 2.5, 10.0, pytest.approx(2 / 3)),
        ("202402", "A", 1.0, 0.0, 1.0, 0.0),
    ]


def test_constant_prices_and_single_sales_are_no_outliers(spark):
    rows = [(1, 963.7)] * 30 + [(2, 5.0)] + [(3, 10.0 + i % 2) for i in range(40)] + [(3, 99.0), (None, 5.0)]
    orders = spark.createDataFrame(rows, "product_id INT, sold_price DOUBLE")
    assert rows_of(price_outliers(orders), ["product_id", "sold_price"]) == [(3, 99.0)]


def test_salted_totals_equal_plain_totals(spark, hard_folder):
    silver = driver.lines_by_region(spark, hard_folder)
    keys = ["region", "category"]
    plain = silver.groupBy(keys).agg(
        F.sum(F.col("total_amount").cast("decimal(18,2)")).cast("double").alias("revenue"),
        F.sum("quantity").alias("units"),
    )
    for salts in (1, 5, 16):
        assert ordered(rows_of(salted_revenue(silver, keys, ["customer_id", "product_id"], salts))) == ordered(rows_of(plain))


def test_salted_totals_of_any_size(spark):
    silver = spark.createDataFrame(
        [("E", 8e16, 1, i) for i in range(20)] + [("A", float("nan"), 1, 0), ("N", None, 1, 0)]
        + [("C", 0.004, 1, i) for i in range(1000)],
        "region STRING, total_amount DOUBLE, quantity INT, line INT",
    )
    totals = {row[0]: row[1] for row in rows_of(salted_revenue(silver, ["region"], ["line"]))}
    assert totals["E"] == 1.6e18 and totals["C"] == 4.0
    assert totals["A"] != totals["A"]
    assert totals["N"] is None


def test_monthly_gold_adds_up_to_silver(spark, hard_folder):
    silver = driver.lines_by_region(spark, hard_folder)
    whole = rows_of(silver.agg(F.sum(F.col("total_amount").cast("decimal(18,2)")), F.sum("quantity")))
    monthly = gold.monthly_region_category(silver)
    parts = rows_of(monthly.agg(F.sum(F.col("revenue").cast("decimal(18,2)")), F.sum("units")))
    assert whole == parts


def test_redistribute_keeps_rows(spark, hard_folder):
    silver = driver.lines_by_region(spark, hard_folder)
    fixed = redistribute(silver, 8)
    assert fixed.rdd.getNumPartitions() == 8
    folders = fixed.select("yyyymm", "region", F.spark_partition_id().alias("p")).distinct()
    assert folders.count() == folders.select("yyyymm", "region").distinct().count()
    assert ordered(rows_of(redistribute(silver))) == ordered(rows_of(silver))


RAW = [
    ("ORD-1", "2024-06-30 23:59:59", "1", "1", "2", "Online"),
    ("ORD-2", "yesterday", "x", "1", "0", "Online"),
    ("ORD-3", "2024-06-30 00:00:00", "7", None, "-1", "Online"),
    (None, "2024-06-30 00:00:00", "1", "9", "2.5", "Online"),
]


def test_clean_and_rejects(spark):
    raw = spark.createDataFrame(RAW, ", ".join(f"{c} STRING" for c in driver.BRONZE_COLUMNS))
    orders = clean(raw, ORDERS_BRONZE)
    assert orders.schema.simpleString() == (
        "struct<order_id:string,order_ts:timestamp,customer_id:bigint,product_id:bigint,quantity:int,channel:string>"
    )
    customers = spark.createDataFrame([(1,)], "customer_id INT")
    products = spark.createDataFrame([(1,)], "product_id INT")
    rejects = dict(rows_of(order_rejects(orders, customers, products)))
    assert rejects == {
        "null_order_id": 1,
        "null_order_ts": 1,
        "null_customer_id": 1,
        "null_product_id": 1,
        "null_quantity": 1,
        "non_positive_quantity": 2,
        "orphan_customer": 1,
        "orphan_product": 1,
    }
    failures = dict(rows_of(cast_failures(raw, ORDERS_BRONZE)))
    assert failures == {
        "order_id": 0, "order_ts": 1, "customer_id": 1, "product_id": 0, "quantity": 1, "channel": 0,
    }


def test_orders_are_split_by_the_rules(spark):
    raw = spark.createDataFrame(RAW, ", ".join(f"{c} STRING" for c in driver.BRONZE_COLUMNS))
    orders = clean(raw, ORDERS_BRONZE)
    customers = spark.createDataFrame([(1,)], "customer_id BIGINT")
    products = spark.createDataFrame([(1,)], "product_id BIGINT")
    accepted, rejected = split_orders(orders, customers, products)
    assert rows_of(accepted, ["order_id"]) == [("ORD-1",)] and accepted.columns == orders.columns
    broken = dict(rows_of(rejected, ["order_id", "rules"]))
    assert broken["ORD-2"] == ["non_positive_quantity", "null_customer_id", "null_order_ts"]
    assert broken["ORD-3"] == ["non_positive_quantity", "null_product_id", "orphan_customer"]
    assert broken[None] == ["null_order_id", "null_quantity", "orphan_product"]


def test_duplicate_keys_are_found(spark):
    customers = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "customer_id BIGINT")
    assert rows_of(duplicate_keys(customers, "customer_id")) == [(2, 2)]


def test_an_inner_join_needs_both_dimensions(spark):
    orders = spark.createDataFrame([], ORDERS_BRONZE)
    with pytest.raises(ValueError):
        enrich(orders, how="inner")


def test_null_customers_keep_their_rank(spark):
    spend = spark.createDataFrame([("E", None, 5.0), ("E", 1, 5.0), ("E", 2, 1.0)], SPEND)
    assert ordered(rows_of(gold.top_customers(spend, 1))) == [("E", None, 5.0, 1), ("E", 1, 5.0, 1)]
