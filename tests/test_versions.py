"""Tables that change in one step, and what is kept up to date from them."""

import os

import pytest
from conftest import DATA, ordered, rows_of
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tillroll.operators import gold
from tillroll.plans import incremental
from tillroll.plans.upsert import newest, upsert
from tillroll.sinks import versions

SCHEMA = (
    "order_id STRING, order_ts TIMESTAMP_NTZ, customer_id BIGINT, category STRING, quantity INT, total_amount DOUBLE, "
    "sent_at TIMESTAMP_NTZ, yyyymm STRING, region STRING"
)
SILVER = """
SELECT order_id, order_ts, customer_id, category, quantity, total_amount, sent_at, date_format(order_ts, 'yyyyMM') AS yyyymm, region
FROM VALUES {} AS t(order_id, day, customer_id, category, quantity, total_amount, sent, region)
LATERAL VIEW explode(array(CAST(day AS TIMESTAMP_NTZ))) AS order_ts
LATERAL VIEW explode(array(CAST(sent AS TIMESTAMP_NTZ))) AS sent_at
"""


def silver_of(spark, *rows):
    """Rows of (order_id, day, region, quantity, day sent)."""
    literal = lambda value: "CAST(NULL AS STRING)" if value is None else f"'{value}'"
    values = ", ".join(
        f"({literal(order)}, {literal(day)}, 1L, 'c', {quantity}, {quantity}D, {literal(sent)}, {literal(region)})"
        for order, day, region, quantity, sent in rows
    )
    frame = spark.sql(SILVER.format(values))
    return frame.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], SCHEMA).schema])


def stored(spark, path, version=None, columns=("order_id", "yyyymm", "region", "quantity")):
    return ordered(rows_of(versions.read(spark, path, SCHEMA, version), list(columns)))


def failing(frame):
    """The frame, whose rows of quantity 13 cannot be computed."""
    broken = F.when(F.col("quantity") == 13, F.raise_error(F.lit("lost"))).otherwise(F.col("total_amount"))
    return frame.withColumn("total_amount", broken.cast("double"))


TWO_MONTHS = [
    ("a", "2024-05-01", "Europe", 1, "2024-05-01"),
    ("b", "2024-06-01", "Europe", 2, "2024-06-01"),
    ("c", "2024-06-02", None, 3, "2024-06-02"),
]


def test_a_failed_write_leaves_the_old_month(spark, tmp_path):
    path = str(tmp_path / "silver")
    versions.replace(silver_of(spark, *TWO_MONTHS), path)
    before = stored(spark, path)
    reader = versions.read(spark, path, SCHEMA)
    broken = silver_of(spark, *[(str(i), "2024-06-03", "Asia", 13 if i == 40 else 5, None) for i in range(50)])
    with pytest.raises(Exception, match="lost"):
        versions.replace(failing(broken), path, ["202406"])
    assert versions.current(spark, path) == 1
    assert stored(spark, path) == before
    versions.replace(silver_of(spark, ("d", "2024-06-03", "Asia", 5, None)), path, ["202406"])
    # A reader that began before keeps its files, a new one sees the new month.
    assert ordered(rows_of(reader, ["order_id"])) == [("a",), ("b",), ("c",)]
    assert stored(spark, path) == [("a", "202405", "Europe", 1), ("d", "202406", "Asia", 5)]
    assert stored(spark, path, 1) == before


def test_parts_that_are_replaced_emptied_or_null(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = [*TWO_MONTHS, ("n", None, "Europe", 4, None)]
    assert versions.replace(silver_of(spark, *rows), path) == 1
    assert stored(spark, path)[0] == ("a", "202405", "Europe", 1)
    assert ("n", None, "Europe", 4) in stored(spark, path)
    late = silver_of(spark, ("m", None, "Asia", 6, None), ("x", "2024-07-01", "Asia", 7, None))
    assert versions.replace(late, path, [None, "202405"]) == 2
    assert stored(spark, path) == ordered(
        [("b", "202406", "Europe", 2), ("c", "202406", None, 3), ("m", None, "Asia", 6)]
    )
    nothing = silver_of(spark, *TWO_MONTHS).limit(0)
    assert versions.replace(nothing, path, ["202406"]) == 3
    assert stored(spark, path) == [("m", None, "Asia", 6)]
    assert versions.replace(nothing, path) == 4
    assert stored(spark, path) == [] and stored(spark, path, 0) == []
    with pytest.raises(ValueError, match="no name"):
        versions.replace(nothing, path, ["2024/06"])


def test_the_second_of_two_writers_is_told(spark, tmp_path):
    path = str(tmp_path / "silver")
    first = silver_of(spark, *TWO_MONTHS)
    versions.replace(first, path)
    seen = versions.current(spark, path)
    versions.replace(silver_of(spark, ("d", "2024-06-03", "Asia", 5, None)), path, ["202406"])
    with pytest.raises(versions.Conflict):
        versions.replace(first, path, ["202405"], expected=seen)
    assert stored(spark, path) == [("a", "202405", "Europe", 1), ("d", "202406", "Asia", 5)]
    assert not [name for name in os.listdir(f"{path}/versions") if name.startswith(".") and not name.endswith(".crc")]


def test_months_and_regions_still_prune_folders(spark, tmp_path):
    path = str(tmp_path / "silver")
    versions.replace(silver_of(spark, *TWO_MONTHS), path)
    versions.replace(silver_of(spark, ("d", "2024-07-03", "Asia", 5, None)), path, ["202407"])
    table = versions.read(spark, path, SCHEMA)
    assert len(table.inputFiles()) == 4
    plan = table.filter("yyyymm = '202406' AND region = 'Europe'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(yyyymm" in plan and "(region" in plan
    only = versions.read(spark, path, SCHEMA, parts=["202407"])
    assert len(only.inputFiles()) == 1 and "yyyymm=202407" in only.inputFiles()[0]


def test_a_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "bronze")
    rows = silver_of(spark, *TWO_MONTHS)
    assert versions.append_batch(rows, path, "monday")
    assert not versions.append_batch(rows, path, "monday")
    assert versions.append_batch(rows.filter("quantity = 1"), path, "tuesday")
    assert len(stored(spark, path)) == 4
    # A batch without rows has been seen too; its name cannot come again with others.
    assert versions.append_batch(rows.limit(0), path, "wednesday")
    assert not versions.append_batch(rows, path, "wednesday")
    with pytest.raises(Exception, match="lost"):
        versions.append_batch(failing(silver_of(spark, ("z", "2024-06-01", "Asia", 13, None))), path, "thursday")
    assert versions.append_batch(rows.filter("quantity = 2"), path, "thursday")
    assert len(stored(spark, path)) == 5


def test_batches_of_two_writers_both_count(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "bronze")
    rows = silver_of(spark, *TWO_MONTHS)
    write, between = versions._write, []

    def slow(frame, *rest):
        folder = write(frame, *rest)
        if not between:  # another writer commits while this one's rows are being written
            between.append(True)
            assert versions.append_batch(rows.filter("quantity = 1"), path, "other")
        return folder

    monkeypatch.setattr(versions, "_write", slow)
    assert versions.append_batch(rows.filter("quantity = 2"), path, "mine")
    assert [row[0] for row in stored(spark, path)] == ["a", "b"]
    assert versions.current(spark, path) == 2


def test_the_same_batch_of_two_writers_counts_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "bronze")
    rows = silver_of(spark, *TWO_MONTHS)
    write, between = versions._write, []

    def slow(frame, *rest):
        folder = write(frame, *rest)
        if not between:
            between.append(True)
            assert versions.append_batch(rows, path, "mine")
        return folder

    monkeypatch.setattr(versions, "_write", slow)
    assert not versions.append_batch(rows, path, "mine")
    assert len(stored(spark, path)) == 3


def test_vacuum_keeps_what_is_named_or_young(spark, tmp_path):
    path = str(tmp_path / "silver")
    versions.replace(silver_of(spark, *TWO_MONTHS), path)
    for quantity in (5, 6, 7):
        versions.replace(silver_of(spark, ("d", "2024-06-03", "Asia", quantity, None)), path, ["202406"])
    assert versions.vacuum(spark, path, keep=1, idle_hours=24) == []
    assert len(os.listdir(f"{path}/data")) == 4
    assert len(versions.vacuum(spark, path, keep=1, idle_hours=0)) == 2
    assert stored(spark, path) == [("a", "202405", "Europe", 1), ("d", "202406", "Asia", 7)]
    assert versions.current(spark, path) == 4


def test_newest_rows_of_a_key(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES ('a', 1, 1), ('a', 2, 2), ('a', 2, 3), ('b', NULL, 4), ('c', NULL, 5), ('c', 0, 6),"
        " (NULL, 1, 7), (NULL, 2, 8) AS t(order_id, sent_at, place)"
    )
    kept = ordered(rows_of(newest(rows, ["order_id"], ["sent_at"]), ["place"]))
    assert kept == [(2,), (3,), (4,), (6,), (7,), (8,)]


def test_upsert_touches_just_the_months_concerned(spark, tmp_path):
    path = str(tmp_path / "silver")
    table = [
        *TWO_MONTHS,
        ("d", "2024-07-01", "Asia", 4, "2024-07-01"),
        ("d", "2024-07-01", "Asia", 5, "2024-07-01"),  # two lines of one order
        ("e", "2024-08-01", "Asia", 6, "2024-08-01"),
        (None, "2024-08-01", "Asia", 7, "2024-08-01"),
        ("f", "2024-09-01", "Asia", 8, "2024-09-01"),
    ]
    versions.replace(silver_of(spark, *table), path)
    before = dict(versions.folders(spark, path))
    changes = silver_of(
        spark,
        ("d", "2024-07-02", "Asia", 40, "2024-07-03"),  # a correction: both lines go
        ("e", "2024-10-01", "Europe", 60, "2024-08-02"),  # moved to a month that was not there
        ("f", "2024-09-01", "Asia", 80, "2024-08-01"),  # older than what is stored
        ("g", "2024-07-05", "Asia", 1, "2024-07-05"),
        ("g", "2024-07-05", "Asia", 2, "2024-07-06"),  # sent twice in one batch
        (None, "2024-07-05", "Asia", 9, None),
    )
    months = upsert(changes, path, SCHEMA)
    assert months == ["202407", "202408", "202409", "202410"]
    after = [
        *[(order, day[:4] + day[5:7], region, quantity) for order, day, region, quantity, _ in TWO_MONTHS],
        ("d", "202407", "Asia", 40), ("g", "202407", "Asia", 2), (None, "202407", "Asia", 9),
        (None, "202408", "Asia", 7), ("f", "202409", "Asia", 8), ("e", "202410", "Europe", 60),
    ]
    assert stored(spark, path) == ordered(after)
    now = dict(versions.folders(spark, path))
    assert {month for month in before if before[month] != now.get(month)} == {"202407", "202408", "202409"}
    # The same changes again: only the order without an id, which nothing identifies, is there twice.
    upsert(changes, path, SCHEMA)
    assert stored(spark, path) == ordered([*after, (None, "202407", "Asia", 9)])
    assert upsert(changes.limit(0), path, SCHEMA) == []


def test_upsert_into_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "silver")
    upsert(silver_of(spark, *TWO_MONTHS), path, SCHEMA)
    assert [row[0] for row in stored(spark, path)] == ["a", "b", "c"]


def test_gold_reads_just_the_changed_months(spark, tmp_path, monkeypatch):
    folder = f"{DATA}/sf0.001"
    silver = driver.silver_left(spark, folder).filter("yyyymm LIKE '1997%'")
    path, base = str(tmp_path / "silver"), str(tmp_path / "gold")
    versions.replace(silver, path)
    assert incremental.stale_months(spark, path, f"{base}/sales")
    first = incremental.refresh(spark, path, base, silver.schema)
    assert len(first["sales"]) == len(first["spend"]) == 12
    assert incremental.refresh(spark, path, base, silver.schema) == {"sales": [], "spend": []}

    month = first["sales"][3]
    changed = silver.filter(F.col("yyyymm") == month).withColumn("total_amount", F.col("total_amount") * 2)
    versions.replace(changed, path, [month])
    read = []
    totals = incremental.partial_totals

    def watched(frame, by):
        read.extend(frame.inputFiles())
        return totals(frame, by)

    monkeypatch.setattr(incremental, "partial_totals", watched)
    assert incremental.refresh(spark, path, base, silver.schema) == {"sales": [month], "spend": [month]}
    assert read and all(f"yyyymm={month}" in file for file in read)

    whole = versions.read(spark, path, silver.schema)
    pairs = [
        (incremental.monthly_region_category(spark, base), gold.monthly_region_category(whole)),
        (incremental.monthly_total(spark, base), gold.monthly_total(whole)),
        (incremental.customer_spend(spark, base), gold.customer_spend(whole)),
    ]
    for kept, made in pairs:
        assert ordered(rows_of(kept, made.columns)) == ordered(rows_of(made))


def test_a_month_that_goes_leaves_gold(spark, tmp_path):
    path, base = str(tmp_path / "silver"), str(tmp_path / "gold")
    versions.replace(silver_of(spark, *TWO_MONTHS, ("n", None, "Europe", 4, None)), path)
    incremental.refresh(spark, path, base, SCHEMA)
    versions.replace(silver_of(spark, *TWO_MONTHS).limit(0), path, ["202406", None])
    assert incremental.refresh(spark, path, base, SCHEMA)["sales"] == [None, "202406"]
    assert rows_of(incremental.monthly_total(spark, base)) == [("202405", 1.0)]


def test_the_manifest_answers_without_data(spark, tmp_path):
    path = str(tmp_path / "silver")
    versions.replace(silver_of(spark, *TWO_MONTHS, ("n", None, "Europe", 4, None)), path)
    latest, counted = incremental.latest_month(spark, path), incremental.layer_rows(spark, path)
    for frame in (latest, counted):
        assert all("/versions/" in file for file in frame.inputFiles())
    assert rows_of(latest) == [("202406",)] and rows_of(counted) == [(4,)]
    assert rows_of(incremental.latest_month(spark, str(tmp_path / "none"))) == [(None,)]
    assert rows_of(incremental.layer_rows(spark, str(tmp_path / "none"))) == [(0,)]
