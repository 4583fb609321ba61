"""Rows that do not parse, kept with the reason until they are repaired."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.silver import clean
from tillroll.sinks import versions

FAILURES = "ARRAY<STRUCT<column: STRING, value: STRING, reason: STRING>>"
#: What a cast to DOUBLE can read. It throws and catches an exception for each other value, which takes far longer.
_NUMBER = (
    r"(?i)^[\x00-\x20]*[+-]?(nan|inf(inity)?|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?[fd]?"
    r"|0x[0-9a-f]*\.?[0-9a-f]*p[+-]?[0-9]+[fd]?)[\x00-\x20]*$"
)


def _broken(field: T.StructField) -> Column:
    """Whether a value of ``field`` does not parse; never NULL."""
    return F.col(field.name).isNotNull() & F.col(field.name).try_cast(field.dataType).isNull()


def _failure(field: T.StructField) -> Column:
    """Why a value of ``field`` does not parse, in an array that is empty if it does."""
    value = F.col(field.name)
    kind = field.dataType.simpleString()
    reason = F.lit(f"not a {kind}")
    if isinstance(field.dataType, (T.IntegralType, T.DecimalType)):
        # A whole number that the type has no room for is another fault than text.
        number = F.when(value.cast("string").rlike(_NUMBER), value.try_cast("double"))
        reason = F.when(number.isNotNull() & ~F.isnan(number), f"beyond {kind}").otherwise(reason)
    found = F.struct(F.lit(field.name).alias("column"), value.cast("string").alias("value"), reason.alias("reason"))
    return F.when(_broken(field), F.array(found).cast(FAILURES)).otherwise(F.array().cast(FAILURES))


def split_raw(raw: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``raw`` all of whose values parse, as ``schema`` declares them; and the others as they came, with
    ``failures``, the column, raw value and reason of each value that does not. Every row is in one of the two. Missing
    values are no failures."""
    fields = T.StructType.fromDDL(schema)
    named = raw.select([F.col(field.name) for field in fields])
    # Reasons are looked for in broken rows alone; a filter on their number would be evaluated for all, below a join too.
    broken = F.lit(False)
    for field in fields:
        broken = broken | _broken(field)
    failures = F.concat(*[_failure(field) for field in fields])
    return clean(named.filter(~broken), schema), named.filter(broken).withColumn("failures", failures)


def listed_failures(quarantined: DataFrame, key: str) -> DataFrame:
    """One row per value that did not parse: ``key``, ``column``, ``value``, ``reason``."""
    return quarantined.select(key, F.inline("failures"))


def ingest(raw: DataFrame, schema: str, bronze: str, quarantine: str, batch: str) -> None:
    """Adds a named batch of raw rows to bronze and to the quarantine, both tables of ``sinks.versions``.

    Running it again after a failure, or by mistake, adds nothing twice.
    """
    # Both tables are written from one computation of the raw rows.
    kept = raw.select([F.col(field.name) for field in T.StructType.fromDDL(schema)]).persist()
    try:
        cleaned, broken = split_raw(kept, schema)
        versions.append_batch(broken, quarantine, batch, time_column=None)
        versions.append_batch(cleaned, bronze, batch, time_column=None)
    finally:
        kept.unpersist()


def quarantine_schema(schema: str) -> T.StructType:
    fields = T.StructType.fromDDL(schema)
    kept = [T.StructField(field.name, T.StringType()) for field in fields]
    return T.StructType([*kept, T.StructField("failures", T.DataType.fromDDL(FAILURES))])


def replay(spark: SparkSession, schema: str, bronze: str, quarantine: str, repairs: Mapping[str, Column]) -> int:
    """Applies ``repairs`` (a column's new raw value, over the raw columns) to all quarantined rows and moves those that
    parse now to bronze; the others stay, with what is wrong with them now. Returns the number of rows moved.

    The rows are moved under a name that tells the quarantine's version, so a replay that died between the two tables
    moves nothing twice when it runs again.
    """
    version = versions.current(spark, quarantine)
    held = versions.read(spark, quarantine, quarantine_schema(schema), version)
    cleaned, broken = split_raw(held.drop("failures").withColumns(dict(repairs)), schema)
    versions.append_batch(cleaned, bronze, f"replay of version {version}", time_column=None)
    versions.replace(broken, quarantine, None, partitions=(), time_column=None, expected=version)
    moved = versions.manifest(spark, bronze).filter(F.col("batch") == f"replay of version {version}")
    return moved.agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]
