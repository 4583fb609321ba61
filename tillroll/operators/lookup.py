"""Star joins whose strategy is decided by a known or measured size."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Spark compares its broadcast threshold with the compressed size of files. The
# size measured here is that of the hash table in memory, several times as much.
EXPANSION = 8

#: No measured lookup beyond this is broadcast, whatever the session's threshold.
MOST_BROADCAST = 1 << 30

_MEASURED: dict[tuple[str, int], int] = {}
_REMEMBERED = 256

UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def bytes_setting(spark: SparkSession, name: str) -> int:
    """A size setting of the session in bytes."""
    text = spark.conf.get(name).strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)b?", text).groups()
    return int(number) * UNITS[unit]


def _row_bytes(schema: T.StructType) -> str:
    """Upper bound of what a row takes in a broadcast hash table: a row header
    and a table slot, eight bytes a column, and the padded text."""
    fixed = 24
    texts = ""
    for field in schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            fixed += 16
            texts += f" + coalesce(octet_length(`{field.name}`), 0)"
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            raise ValueError(f"column {field.name} has no measurable size; project it away")
        else:
            fixed += 24 if isinstance(field.dataType, T.DecimalType) else 8
    return f"CAST({fixed} AS BIGINT){texts}"


def source_bytes(lookup: DataFrame) -> int:
    """What Spark knows, without a job, of the size of all that ``lookup`` is read from."""
    leaves = lookup._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def lookup_bytes(lookup: DataFrame) -> int:
    """Size of the frame as a broadcast, from one small aggregation job."""
    rows = lookup.selectExpr(f"sum({_row_bytes(lookup.schema)}) AS bytes").collect()
    return rows[0]["bytes"] or 0


def remembered_bytes(lookup: DataFrame) -> int:
    """``lookup_bytes``, measured once for a plan in a session."""
    key = (lookup.sparkSession.sparkContext.applicationId, lookup.semanticHash())
    if key not in _MEASURED:
        if len(_MEASURED) >= _REMEMBERED:
            _MEASURED.clear()
        _MEASURED[key] = lookup_bytes(lookup)
    return _MEASURED[key]


def lookup_strategy(lookup: DataFrame) -> str | None:
    """How to join ``lookup``, from its size and the session's limits.

    A lookup holds one row per key, so one whose sources are together below the
    broadcast threshold is small, and ``broadcast`` without a job. Otherwise it is
    measured: ``broadcast`` up to the threshold times what data grows by when it is
    read into memory (never if the threshold is -1, nor beyond ``MOST_BROADCAST``);
    ``shuffle_hash`` while the hash tables of its shuffle partitions stay below the
    advised partition size, which spares sorting the facts; beyond that no hint,
    so that Spark merges sorted partitions, which can spill.
    """
    spark = lookup.sparkSession
    threshold = bytes_setting(spark, "spark.sql.autoBroadcastJoinThreshold")
    limit = min(threshold * EXPANSION, MOST_BROADCAST)
    _row_bytes(lookup.schema)  # a nested column has no size, and is refused here
    if source_bytes(lookup) <= min(threshold, MOST_BROADCAST):
        return "broadcast"
    size = remembered_bytes(lookup)
    if size <= limit:
        return "broadcast"
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    advised = bytes_setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    return "shuffle_hash" if size <= advised * partitions else None


def lookup_join(facts: DataFrame, lookups: dict[str, DataFrame], how: str = "left") -> DataFrame:
    """Join each lookup to ``facts`` on its key column; one key column comes out.

    A lookup holds one row per key. A small one is broadcast, a larger one is
    joined by a shuffle on its key, where adaptive execution splits the partition
    of a hot or NULL key. The shuffled joins come first, while the fact rows are
    narrow.
    """
    strategies = {key: lookup_strategy(lookup) for key, lookup in lookups.items()}
    joined = facts
    for key in sorted(lookups, key=lambda key: strategies[key] == "broadcast"):
        hint = strategies[key]
        joined = joined.join(lookups[key].hint(hint) if hint else lookups[key], key, how)
    return joined
