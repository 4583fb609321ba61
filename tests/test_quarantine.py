"""Rows that do not parse, from quarantine to bronze."""

import pytest
from conftest import ordered, rows_of
from pyspark.sql import functions as F

from tillroll.plans import quarantine
from tillroll.sinks import versions

SCHEMA = "order_id STRING, quantity INT, price DOUBLE, day DATE"
RAW = [
    ("a", "1", "2.5", "2024-05-01"),
    ("b", "many", "2.5", "2024-05-01"),
    ("c", "99999999999", "cheap", "2024-05-01"),
    ("d", None, None, None),
    ("e", "2", "1", "soon"),
    ("b", "many", "2.5", "2024-05-01"),  # the same row twice
    (None, "", "1e3", "2024-05-01"),
]


def raw(spark):
    return spark.createDataFrame(RAW, "order_id STRING, quantity STRING, price STRING, day STRING").withColumn("failures", F.lit("clash"))


def test_every_row_is_in_one_of_the_two(spark):
    fine, broken = quarantine.split_raw(raw(spark), SCHEMA)
    assert [row[0] for row in ordered(rows_of(fine))] == ["a", "d"]
    kept = broken.drop("failures")
    rest = [row for row in RAW if row[0] not in ("a", "d")]
    assert ordered(rows_of(kept)) == ordered(rest), "raw values stay as they came"
    found = ordered(rows_of(quarantine.listed_failures(broken, "order_id")))
    assert found == ordered(
        [
            ("b", "quantity", "many", "not a int"), ("b", "quantity", "many", "not a int"),
            ("c", "quantity", "99999999999", "beyond int"), ("c", "price", "cheap", "not a double"),
            ("e", "day", "soon", "not a date"), (None, "quantity", "", "not a int"),
        ]
    )


def test_replay_moves_what_parses_now(spark, tmp_path, monkeypatch):
    bronze, held = str(tmp_path / "bronze"), str(tmp_path / "held")
    for _ in range(2):  # a batch that is sent again adds nothing
        quarantine.ingest(raw(spark), SCHEMA, bronze, held, "monday")
    names = lambda: sorted(row[0] or "" for row in rows_of(versions.read(spark, bronze, SCHEMA), ["order_id"]))
    assert names() == ["a", "d"]
    repairs = {"quantity": F.when(F.col("quantity") == "many", "100").otherwise(F.col("quantity"))}

    # A replay that dies between the two tables is repeated without doubling rows.
    with monkeypatch.context() as patch:
        patch.setattr(versions, "replace", lambda *args, **kwargs: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            quarantine.replay(spark, SCHEMA, bronze, held, repairs)
    assert names() == ["a", "b", "b", "d"]
    assert quarantine.replay(spark, SCHEMA, bronze, held, repairs) == 2
    assert names() == ["a", "b", "b", "d"]
    left = versions.read(spark, held, quarantine.quarantine_schema(SCHEMA))
    assert sorted(row[0] or "" for row in rows_of(left, ["order_id"])) == ["", "c", "e"]

    assert quarantine.replay(spark, SCHEMA, bronze, held, {"day": F.lit("2024-05-02"), "quantity": F.lit("1")}) == 2
    assert names() == ["", "a", "b", "b", "d", "e"]
    assert quarantine.replay(spark, SCHEMA, bronze, held, {}) == 0
    quarantine.ingest(raw(spark).limit(0), SCHEMA, bronze, held, "tuesday")
    assert len(names()) == 6


def test_reasons_are_told_without_a_cast_of_every_text_and_in_one_computation(spark, tmp_path):
    values = ["1e400", "NaN", " -Infinity ", "inf", "0x1p3", "7d", "+.5e-2f", "1.", "12x", "e5", "nan x", "", "many", "９", "\x001\n"]
    rows = [(str(i), value) for i, value in enumerate(values)]
    frame = spark.createDataFrame(rows, "order_id STRING, quantity STRING")
    cast = {row["order_id"]: row["n"] for row in frame.selectExpr("order_id", "try_cast(quantity AS DOUBLE) AS n").collect()}
    _, broken = quarantine.split_raw(frame, "order_id STRING, quantity INT")
    found = {row["order_id"]: row["reason"] for row in quarantine.listed_failures(broken, "order_id").collect()}
    numbers = {key for key, n in cast.items() if n is not None and n == n}
    assert {key for key, reason in found.items() if reason == "beyond int"} == numbers & set(found)

    # Raw rows are computed once for both tables.
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = frame.mapInArrow(count, frame.schema)
    quarantine.ingest(counted, "order_id STRING, quantity INT", str(tmp_path / "bronze"), str(tmp_path / "held"), "monday")
    assert seen.value == len(values)
