"""Running totals over sequences of any length."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.money import PLACES, cut_money, join_money
from tillroll.sinks.scratch import materialise

_PARTS = [f"amount_{place}" for place in PLACES]


def running_total(rows: DataFrame, amount: str, order: Sequence[str], slices: int | None = None) -> DataFrame:
    """``rows`` with ``running_total``, the exact total of ``amount`` up to and with each row in ascending ``order``.

    A window over everything would bring all rows to one task. Here the rows are cut into ranges of ``order``, stored
    once; each range is totalled by itself, and what all ranges before it total is carried in as a constant. The driver
    sees one row per range. NULL amounts are skipped, and the total is NULL until there is an amount. Rows that are equal
    in ``order`` are taken one after the other in any order; give enough columns to tell rows of different amounts
    apart. They share a range, so equal rows must fit a task.
    """
    spark = rows.sparkSession
    count = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.select("*", *cut_money(F.col(amount), "amount")).repartitionByRange(count, *order)
    stored = materialise(ranged.withColumn("slice", F.spark_partition_id()), "ranges")

    totals = stored.groupBy("slice").agg(*[F.sum(part).alias(part) for part in _PARTS]).collect()
    carried = []
    so_far: list[int | float | None] = [None] * len(_PARTS)
    for row in sorted(totals, key=lambda row: row["slice"]):
        carried.append((row["slice"], *so_far))
        so_far = [_plus(a, row[part]) for a, part in zip(so_far, _PARTS)]
    fields = ", ".join(f"carried_{place} {'DOUBLE' if place == 'beyond' else 'BIGINT'}" for place in PLACES)
    before = spark.createDataFrame(carried, f"slice INT, {fields}")

    within = Window.partitionBy("slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = stored.withColumns({part: F.sum(part).over(within) for part in _PARTS})
    # One row a range: never more than there are partitions.
    joined = running.join(F.broadcast(before), "slice")
    both = {}
    for place in PLACES:
        own, carry = F.col(f"amount_{place}"), F.col(f"carried_{place}")
        both[f"amount_{place}"] = F.coalesce(own + carry, own, carry)
    return joined.withColumns(both).withColumn("running_total", join_money("amount")).select(*rows.columns, "running_total")


def _plus(a: int | float | None, b: int | float | None) -> int | float | None:
    return b if a is None else a if b is None else a + b
