"""Late and corrected orders: keyed upserts where the last write wins."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sinks import versions
from tillroll.sinks.scratch import materialise


def newest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows of each key with the highest ``order``, all of them where several have it; NULL is lowest.

    Rows with a NULL in their key are no correction of each other and all stay. The highest order is found per key with
    sums in every task first, and joined, so a key with very many rows is not brought together.
    """
    keyed = F.lit(True)
    for key in keys:
        keyed = keyed & F.col(key).isNotNull()
    highest = F.max(F.struct(*order)).alias("highest")
    tops = rows.filter(keyed).groupBy(*keys).agg(highest)
    won = rows.filter(keyed).join(tops, list(keys)).filter(F.struct(*order).eqNullSafe(F.col("highest")))
    return won.select(rows.columns).unionAll(rows.filter(~keyed))


def upsert(
    changes: DataFrame,
    path: str,
    schema: T.StructType | str,
    keys: Sequence[str] = ("order_id",),
    sent: str = "sent_at",
) -> list[str | None]:
    """Puts ``changes`` into a table of ``sinks.versions``, partitioned by month and region, and returns the months that
    were written anew; all others keep their files.

    A key's rows are those with its latest ``sent``, of the table's and the changes'; of equal ones the changes' rows
    count, so the same changes can come twice. An order may move to another month or region, and several rows may share
    a key (the lines of an order). Changes with a NULL key are added. NULL in ``sent`` is older than any time. The change
    is one step: readers see all of it or nothing, and a writer who came between makes it fail with ``Conflict``.
    """
    spark = changes.sparkSession
    base = versions.current(spark, path)
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    table = versions.read(spark, path, fields, base)
    columns = [field.name for field in fields]
    incoming = materialise(newest(changes.select(columns), keys, [sent]), "changes")
    ids = incoming.select(*keys).dropna().distinct()

    # Two narrow columns tell which months hold one of the keys.
    held = table.select(*keys, "yyyymm").join(ids, list(keys), "left_semi").select("yyyymm")
    months = [row["yyyymm"] for row in held.unionAll(incoming.select("yyyymm")).distinct().collect()]
    if not months:
        return []
    old = versions.read(spark, path, fields, base, parts=months)
    untouched = old.join(ids, list(keys), "left_anti").select(columns)
    contested = old.join(ids, list(keys), "left_semi").select(columns)
    rivals = contested.withColumn("incoming", F.lit(0)).unionAll(incoming.withColumn("incoming", F.lit(1)))
    won = newest(rivals, keys, [sent, "incoming"]).drop("incoming")
    versions.replace(untouched.unionAll(won), path, months, expected=base)
    return sorted(months, key=lambda month: month or "")
