"""Joins with keys that hold a large share of the rows."""

import pytest
from conftest import ordered, rows_of
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tillroll.operators.skew import hot_key_join, hot_keys
from tillroll.sinks.scratch import materialise
from tillroll.sources import sales_tables as sales


def lines(spark, count=60_000):
    """A third of the rows on key 8, a third without a key, a twentieth on key 9."""
    return spark.range(count).selectExpr(
        "id AS line", "CASE WHEN id % 3 = 0 THEN 8 WHEN id % 3 = 1 THEN NULL WHEN id % 20 = 2 THEN 9 ELSE id END AS key"
    )


def test_hot_keys_are_found(spark):
    assert set(hot_keys(lines(spark), "key", 0.01)) == {8, 9}
    assert hot_keys(lines(spark), "key", 0.1) == [8]
    assert hot_keys(lines(spark).limit(0), "key") == []
    assert hot_keys(lines(spark).selectExpr("string(key) AS key"), "key", 0.1) == ["8"]
    with pytest.raises(ValueError):
        hot_keys(lines(spark), "key", 0)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("share", [0.01, 1.0])
def test_a_salted_join_is_the_plain_join(spark, how, share):
    facts = lines(spark, 3000)
    dimension = spark.range(0, 3000, 2).selectExpr("id AS key", "concat('n', id) AS name")
    dimension = dimension.unionAll(spark.sql("SELECT CAST(NULL AS BIGINT), 'none'"))
    got = hot_key_join(facts, dimension, "key", ["line"], how, share)
    wanted = facts.join(dimension, "key", how)
    assert got.columns == wanted.columns
    assert ordered(rows_of(got)) == ordered(rows_of(wanted))


def test_the_largest_task_is_bounded(spark, hard_folder, settings):
    """A customer has a third of the lines; the join is by shuffles that nothing splits afterwards."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="32"
    )
    facts = materialise(sales.orders(spark, hard_folder).select(driver.BRONZE_COLUMNS), "lines")
    countries = sales.customers(spark, hard_folder).select("customer_id", "country")

    def largest(frame):
        return frame.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    total = facts.count()
    assert largest(facts.join(countries, "customer_id", "left")) > total / 2
    # Three thousand copies of one line share their key and all else; only their places tell them apart.
    dealt = hot_key_join(facts, countries, "customer_id", [F.monotonically_increasing_id()])
    assert largest(dealt) < total / 6
    different = facts.distinct()
    assert largest(different.join(countries, "customer_id", "left")) > different.count() / 4
    salted = hot_key_join(different, countries, "customer_id", ["order_id", "product_id", "quantity"])
    assert largest(salted) < different.count() / 6
