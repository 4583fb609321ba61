"""What the physical plans must and must not contain."""

import re
import uuid

import pytest
from conftest import DATA, rows_of
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tillroll.functions.calendar import in_month
from tillroll.operators.gold import customer_spend, monthly_region_category
from tillroll.operators.lookup import (
    EXPANSION,
    MOST_BROADCAST,
    bytes_setting,
    lookup_bytes,
    lookup_join,
    lookup_strategy,
    source_bytes,
)
from tillroll.operators.silver import enrich, redistribute

FOLDER = f"{DATA}/sf0.001"

# The join of a shuffled lookup, by the partition size that the session advises.
SHUFFLED = [("ShuffledHashJoin", "100KB"), ("SortMergeJoin", "10KB")]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    """The plan after adaptive execution has run it."""
    execution = frame._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def test_small_dimensions_are_broadcast(spark):
    plan = plan_of(driver.silver_left(spark, FOLDER))
    assert plan.count("LeftOuter, BuildRight") == 2
    assert "SortMergeJoin" not in plan


def test_dimensions_beyond_the_limit_are_not(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="1b")
    plan = plan_of(driver.silver_left(spark, FOLDER))
    assert "Broadcast" not in plan
    assert plan.count("LeftOuter") == 2


def test_silver_alone_shuffles_nothing(spark):
    assert "hashpartitioning" not in plan_of(driver.silver_left(spark, FOLDER))


def test_columns_are_pruned_to_the_scan(spark):
    plan = driver.monthly_region_category(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    lineitem = next(line for line in scans if "l_orderkey" in line)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in lineitem
    assert not any("c_name" in line or "p_name" in line for line in scans)


def test_tables_without_customer_columns_do_not_join_customers(spark):
    for name in ("monthly_total", "channel_mix", "moving_avg_3m"):
        assert "c_custkey" not in plan_of(driver.queries()[name](spark, FOLDER))


def test_ranking_is_limited_before_the_shuffle(spark):
    plan = plan_of(driver.queries()["top_customers_10"](spark, FOLDER))
    assert plan.count("WindowGroupLimit") >= 2


def test_ranking_totals_the_lines_once(spark):
    plan = final_plan(driver.queries()["top_customers_10"](spark, FOLDER))
    assert plan.count("FileScan parquet [l_orderkey") == 1
    assert "collect_list" not in plan


@pytest.mark.parametrize("broadcasts", ["-1", "10MB"])
def test_a_tie_is_never_in_one_task(spark, settings, broadcasts):
    from tillroll.operators.gold import top_customers

    settings(spark__sql__autoBroadcastJoinThreshold=broadcasts, spark__sql__adaptive__coalescePartitions__enabled="false")
    tied = spark.range(1_000_000).selectExpr("'E' AS region", "id AS customer_id", "CAST(id % 20 = 7 AS DOUBLE) AS total_spent")
    top = top_customers(tied, 3)
    assert top.count() == 1_000_000
    largest = top.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 400_000
    # What goes to the ranks is one row per spend and task.
    assert top.filter("rank = 1").count() == 50_000


def test_one_folder_is_read_for_one_month_and_region(spark):
    plan = plan_of(driver.silver_roundtrip_pruned(spark, FOLDER))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(yyyymm" in scan
    assert "(region" in scan.split("PartitionFilters")[1].split("]")[0]


def test_filters_reach_the_parquet_reader(spark):
    plan = plan_of(driver.sales.orders(spark, FOLDER).filter(F.col("customer_id") == 3))
    assert "PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,3)" in plan


def test_rebalance_only_where_asked(spark):
    frame = spark.range(10).selectExpr("'202401' AS yyyymm", "'E' AS region")
    assert "REBALANCE" in plan_of(redistribute(frame)).upper()
    assert "REPARTITION_BY_NUM" in plan_of(redistribute(frame, 8))


PLANNED = [n for n in driver.queries() if not re.match(r".*roundtrip|op\d+_|pipeline$|layers_views|silver_month", n)]


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_in_any_plan(spark, name):
    plan = plan_of(driver.queries()[name](spark, FOLDER))
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("join, partition", SHUFFLED)
def test_a_hot_key_is_split_in_a_shuffled_lookup(spark, settings, join, partition):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes=partition,
    )
    facts = spark.range(0, 600_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 5000 END AS customer_id", "id AS quantity"
    )
    customers = spark.range(0, 5000, 1, 8).selectExpr("id AS customer_id", "concat('r', id % 4) AS region")
    joined = lookup_join(facts, {"customer_id": customers}, "left")
    plan = final_plan(joined.groupBy("region").agg(F.sum("quantity").alias("units")))
    assert f"{join}(skew=true)" in plan
    assert joined.filter(F.col("region").isNotNull()).count() == 600_000


@pytest.mark.parametrize("join, partition", SHUFFLED)
def test_hot_and_null_keys_are_split_in_both_star_joins(spark, settings, join, partition):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes=partition,
    )
    orders = spark.range(0, 900_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 3 = 1 THEN NULL ELSE id % 5000 END AS customer_id",
        "CASE WHEN id % 3 = 2 THEN 7 ELSE id % 3000 END AS product_id",
        "CAST(id % 5 + 1 AS INT) AS quantity",
        "timestamp_seconds(1600000000 + id * 100) AS order_ts",
    )
    customers = spark.range(0, 5000, 1, 8).selectExpr(
        "id AS customer_id", "concat('r', id % 4) AS region", "'x' AS country"
    )
    products = spark.range(0, 3000, 1, 8).selectExpr(
        "id AS product_id", "concat('c', id % 4) AS category", "'s' AS subcategory", "2.5D AS base_price"
    )
    monthly = monthly_region_category(enrich(orders, customers, products))
    plan = final_plan(monthly)
    assert plan.count(f"{join}(skew=true)") == 2
    assert rows_of(monthly.agg(F.sum("units")))[0][0] == 2_700_000


def test_rebuilding_a_month_filters_the_scan(spark):
    bronze = driver.sales.orders(spark, FOLDER).filter(in_month(F.col("order_ts"), "199712"))
    plan = plan_of(bronze)
    assert "GreaterThanOrEqual(o_orderdate,1997-12-01T00:00)" in plan
    assert "LessThan(o_orderdate,1998-01-01T00:00)" in plan
    months = driver.with_calendar(bronze).select("yyyymm").distinct()
    assert rows_of(months) == [("199712",)]


def test_measured_size_is_never_below_the_text(spark):
    frame = spark.range(1000).selectExpr("id", "repeat('x', 100) AS text", "CAST(NULL AS STRING) AS nothing")
    assert 1000 * 100 < lookup_bytes(frame) < 1000 * 250
    assert lookup_bytes(frame.filter("id < 0")) == 0


def jobs_of(spark, run):
    """Jobs that building something starts."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    run()
    found = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("others", "others")
    return len(found)


def test_small_dimensions_need_no_job(spark):
    assert jobs_of(spark, lambda: driver.lines_by_region(spark, FOLDER)) == 0


def test_a_size_is_measured_once(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="100")
    assert jobs_of(spark, lambda: lookup_strategy(driver.sales.products(spark, FOLDER).filter("product_id > 1"))) > 0
    assert jobs_of(spark, lambda: lookup_strategy(driver.sales.products(spark, FOLDER).filter("product_id > 1"))) == 0


def test_forced_broadcasts_are_bounded(spark, settings):
    # A measured gigabyte is shuffled even where the session's threshold would allow eight times as much.
    lookup = spark.range(1 << 25).selectExpr("id AS k", "id AS a", "id AS b")
    settings(spark__sql__autoBroadcastJoinThreshold="200m")
    assert lookup_bytes(lookup) > MOST_BROADCAST
    assert lookup_strategy(lookup) != "broadcast"


def test_salted_totals_read_no_other_column(spark):
    plan = plan_of(driver.queries()["salted_region_revenue"](spark, FOLDER))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert not any(c in line for line in scans for c in ("l_extendedprice", "l_returnflag", "o_orderdate"))


def test_a_report_reads_one_month(spark):
    plan = plan_of(driver.queries()["top_categories_last_full"](spark, FOLDER))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "o_orderdate" in line)
    assert "GreaterThanOrEqual(o_orderdate" in scan and "LessThan(o_orderdate" in scan


@pytest.mark.parametrize("join, partition", SHUFFLED)
def test_a_hot_customer_is_split_in_the_spend_of_tagged_lines(spark, settings, join, partition):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes=partition,
    )
    lines = spark.range(0, 900_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 5000 END AS customer_id", "id % 97 + 0.004D AS total_amount"
    )
    customers = spark.range(0, 5000, 1, 8).selectExpr("id AS customer_id", "concat('r', id % 4) AS region")
    spend = customer_spend(lookup_join(lines, {"customer_id": customers}, "left"))
    plan = final_plan(spend)
    assert f"{join}(skew=true)" in plan
    assert spend.count() == 5000
    plain = lines.filter("customer_id = 1").agg(F.sum(F.col("total_amount").cast("decimal(38,6)")).cast("double"))
    assert rows_of(spend.filter("customer_id = 1"), ["total_spent"]) == rows_of(plain)


def test_strategy_follows_the_measured_size(spark, settings):
    lookup = spark.range(1000).selectExpr("id AS k", "'x' AS name")
    size = lookup_bytes(lookup)
    threshold = -(-size // EXPANSION)
    assert source_bytes(lookup) > threshold, "the sources alone do not decide"
    settings(spark__sql__autoBroadcastJoinThreshold=str(threshold), spark__sql__shuffle__partitions="8")
    assert lookup_strategy(lookup) == "broadcast"
    settings(spark__sql__autoBroadcastJoinThreshold=str(threshold - 1))
    assert lookup_strategy(lookup) == "shuffle_hash"
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes=str(size // 8 - 1))
    assert lookup_strategy(lookup) is None


def test_size_units(spark, settings):
    for text, size in {"10MB": 10 << 20, "-1": -1, "5000": 5000, "1g": 1 << 30, "64k": 64 << 10}.items():
        settings(spark__sql__autoBroadcastJoinThreshold=text)
        assert bytes_setting(spark, "spark.sql.autoBroadcastJoinThreshold") == size


def test_lookup_without_a_measurable_size(spark):
    nested = spark.sql("SELECT 1 AS k, array(1) AS a")
    with pytest.raises(ValueError):
        lookup_join(spark.sql("SELECT 1 AS k"), {"k": nested})


def test_lookup_keeps_one_key_column(spark):
    joined = lookup_join(
        spark.sql("SELECT 1 AS k, 2 AS v"), {"k": spark.sql("SELECT 1 AS k, 'a' AS name")}, "inner"
    )
    assert rows_of(joined, ["k", "v", "name"]) == [(1, 2, "a")]


def scan_metrics(frame, name):
    """A metric of each file scan of the frame, after it has run."""
    plan = frame._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    found, left = [], [plan]
    while left:
        node = left.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            left.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            left.append(node.plan())
        elif node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply(name).value())
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return found


def test_folders_are_pruned_while_the_query_runs(spark):
    frame = driver.fourth_quarters(spark, FOLDER)
    assert "dynamicpruning" in plan_of(frame)
    path = next(file for file in frame.inputFiles() if "silver_orders" in file).split("/yyyymm=")[0]
    stored = spark.read.parquet(path)
    folders = len({file.rsplit("/", 1)[0] for file in stored.inputFiles()})
    months = stored.select("yyyymm").distinct().count()
    fourth = stored.filter("CAST(yyyymm AS INT) % 100 > 9")
    read = max(scan_metrics(frame, "numFiles"))
    assert read == len({row[0] for row in rows_of(fourth.select(F.input_file_name().alias("f")).distinct())})
    assert read < len(stored.inputFiles()) / 3 and folders > months > 12


def test_lines_of_other_customers_are_dropped_before_the_shuffle(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="0",
        spark__sql__optimizer__runtime__bloomFilter__creationSideThreshold="100MB",
    )
    lines = spark.read.parquet(f"{FOLDER}/orders.parquet").select("o_orderkey", "o_custkey")
    some = spark.read.parquet(f"{FOLDER}/customer.parquet").filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    plan = plan_of(lines.join(some, F.col("o_custkey") == F.col("c_custkey")))
    assert "might_contain" in plan


def test_a_lookup_reads_few_row_groups(spark, tmp_path):
    from tillroll.sinks.tables import write_clustered

    rows = spark.range(400_000).selectExpr("concat('ORD-', lpad(id * 7919 % 400000, 9, '0')) AS order_id", "id")
    path = str(tmp_path / "clustered")
    write_clustered(rows.filter("id % 2 = 0"), path, "order_id", 4, 1 << 18)
    stored = spark.read.parquet(path)
    there = stored.agg(F.max("order_id")).first()[0]
    found = stored.filter(F.col("order_id") == there)
    assert found.count() == 1
    assert max(scan_metrics(found, "numOutputRows")) < 200_000 / 10
    # Inside the range of the keys, but held by none: the Bloom filter knows.
    absent = rows.filter("id % 2 = 1").agg(F.min("order_id")).first()[0]
    assert absent < there
    assert max(scan_metrics(stored.filter(F.col("order_id") == absent), "numOutputRows")) == 0
