from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tillroll.functions.calendar import month_index, month_key, order_date
from tillroll.functions.codes import order_code, product_label, region_of_country
from tillroll.functions.money import money_sum


def single(frame, column):
    return [row[0] for row in frame.select(column).collect()]


def test_region_of_country(spark):
    expected = {
        "United States of America": "North America",
        "United States Minor Outlying Islands": "North America",
        "Canada": "North America",
        "France": "Europe",
        "france": "Other",
        "Japan": "Asia",
        "Brazil": "Other",
        None: "Other",
    }
    frame = spark.createDataFrame([(c,) for c in expected], "country STRING")
    assert single(frame, region_of_country(F.col("country"))) == list(expected.values())


def test_order_code_pads_and_never_cuts(spark):
    frame = spark.createDataFrame([(1,), (999_999_999,), (1_234_567_890,)], "n BIGINT")
    assert single(frame, order_code(F.col("n"))) == [
        "ORD-000000001",
        "ORD-999999999",
        "ORD-1234567890",
    ]


def test_product_label(spark):
    frame = spark.createDataFrame([("Toys", "Car", 7), ("Toys", "Car", 12345)], "c STRING, s STRING, n INT")
    label = product_label(F.col("c"), F.col("s"), F.col("n"))
    assert single(frame, label) == ["Toys-Car-0007", "Toys-Car-12345"]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_calendar_at_the_edges_of_a_month(spark, kind):
    moments = [
        datetime(2024, 6, 30, 23, 59, 59),
        datetime(2024, 7, 1),
        datetime(2023, 12, 31, 23, 59, 59),
        datetime(1, 1, 1),
    ]
    frame = spark.createDataFrame([(str(m),) for m in moments], "text STRING")
    ts = F.lpad("text", 19, "0").cast(kind)
    assert single(frame, order_date(ts)) == [m.date() for m in moments]
    assert single(frame, month_key(ts)) == ["202406", "202407", "202312", "000101"]
    assert single(frame, month_key(ts)) == single(frame, F.date_format(ts, "yyyyMM"))


def test_null_timestamp_has_no_month(spark):
    frame = spark.sql("SELECT CAST(NULL AS TIMESTAMP) AS ts")
    assert single(frame, month_key(F.col("ts"))) == [None]


def test_month_index_is_consecutive_over_new_year(spark):
    frame = spark.createDataFrame([("202312",), ("202401",)], "m STRING")
    december, january = single(frame, month_index(F.col("m")))
    assert january - december == 1


def total(spark, amounts):
    frame = spark.createDataFrame([(a,) for a in amounts], "amount DOUBLE")
    return rows_of(frame.agg(money_sum(F.col("amount")).alias("total")))[0][0]


def test_money_is_exact_where_floats_are_not(spark):
    assert 0.1 + 0.2 + 0.3 != 0.6
    assert total(spark, [0.1, 0.2, 0.3]) == 0.6


def test_money_skips_nulls_and_keeps_all_null_groups_null(spark):
    assert total(spark, [1.25, None]) == 1.25
    assert total(spark, [None, None]) is None
    assert total(spark, []) is None


def test_money_keeps_what_is_below_a_cent(spark):
    assert total(spark, [0.004] * 1000) == 4.0
    assert total(spark, [0.045] * 1000) == 45.0
    assert total(spark, [0.000001] * 7) == 0.000007


def test_money_of_both_signs_and_of_any_size_is_exact(spark):
    amounts = [-0.5, -1234567.875, 16777216.0, -16777216.25, 33554431.999999, 9e15, -9e15, 5e17, -5e17, 0.004]
    wanted = float(sum(Decimal(repr(a)) for a in amounts))
    for order in (amounts, amounts[::-1], sorted(amounts)):
        frame = spark.createDataFrame([(a,) for a in order * 50], "amount DOUBLE")
        for parts in (1, 7):
            assert rows_of(frame.repartition(parts).agg(money_sum(F.col("amount")).alias("total")))[0][0] == 50 * wanted
    assert total(spark, [8e16, 8e16]) == 1.6e17
    assert total(spark, [-5.0, 5.0]) == 0.0


def test_amounts_out_of_range_are_added_as_floats(spark):
    assert total(spark, [1e300, 1.0]) == 1e300
    assert total(spark, [float("inf"), 1.0]) == float("inf")
    assert total(spark, [float("nan"), 1.0]) != total(spark, [float("nan"), 1.0])
    assert total(spark, [3e18, 0.004]) == 3e18


def test_order_date_is_a_date(spark):
    frame = spark.sql("SELECT TIMESTAMP '2024-06-30 23:59:59' AS ts")
    assert single(frame, order_date(F.col("ts"))) == [date(2024, 6, 30)]
