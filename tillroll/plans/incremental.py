"""Gold tables kept up to date from the months of silver that have changed.

What is stored are partial totals per month, the summands of ``functions.money``, in tables of ``sinks.versions``. Each
month of them names the silver folders it was computed from. A refresh compares those names with silver's manifest, two
small tables, and totals just the months that differ; gold itself is merged from the partial totals.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.calendar import month_key
from tillroll.functions.money import merged_money, partial_money
from tillroll.sinks import versions

#: The partial tables and the columns that they total by.
PARTIALS = {
    "sales": ["yyyymm", "region", "category"],
    "spend": ["yyyymm", "region", "customer_id"],
}
_MONEY = "amount_high BIGINT, amount_units BIGINT, amount_millionths BIGINT, amount_beyond DOUBLE, units BIGINT"
SCHEMAS = {
    "sales": f"yyyymm STRING, region STRING, category STRING, {_MONEY}",
    "spend": f"yyyymm STRING, region STRING, customer_id BIGINT, {_MONEY}",
}


def partial_totals(silver: DataFrame, by: list[str]) -> DataFrame:
    return silver.groupBy(*by).agg(
        *partial_money(F.col("total_amount"), "amount"), F.sum("quantity").cast("bigint").alias("units")
    )


def _origins(pairs: list[tuple[str | None, str]]) -> dict[str | None, str]:
    out: dict[str | None, str] = {}
    for part, text in pairs:
        out[part] = f"{out[part]},{text}" if part in out else text
    return out


def stale_months(spark: SparkSession, silver_path: str, partial_path: str, version: int | None = None) -> list[str | None]:
    """Months whose folders in silver are not those that the partial totals come from."""
    now = _origins(versions.folders(spark, silver_path, version))
    rows = versions.manifest(spark, partial_path).select("part", "origin").collect()
    then = {row["part"]: row["origin"] for row in rows}
    return sorted((m for m in now.keys() | then.keys() if now.get(m) != then.get(m)), key=lambda m: m or "")


def refresh(
    spark: SparkSession, silver_path: str, gold_path: str, schema: T.StructType | str
) -> dict[str, list[str | None]]:
    """Brings the partial totals below ``gold_path`` up to silver's latest version; the months made anew, per table.

    Silver is read at one version. A refresh that dies changes nothing or one whole table, and the next one goes on.
    """
    version = versions.current(spark, silver_path)
    done = {}
    for name, by in PARTIALS.items():
        path = f"{gold_path}/{name}"
        expected = versions.current(spark, path)
        months = stale_months(spark, silver_path, path, version)
        done[name] = months
        if months:
            silver = versions.read(spark, silver_path, schema, version, parts=months)
            origins = _origins(versions.folders(spark, silver_path, version, parts=months))
            versions.replace(
                partial_totals(silver, by), path, months, partitions=("yyyymm",), time_column=None,
                origins=origins, expected=expected,
            )
    return done


def _stored(spark: SparkSession, gold_path: str, name: str) -> DataFrame:
    return versions.read(spark, f"{gold_path}/{name}", SCHEMAS[name])


def monthly_region_category(spark: SparkSession, gold_path: str) -> DataFrame:
    """As ``gold.monthly_region_category``, from one stored row per month, region and category."""
    return (
        _stored(spark, gold_path, "sales")
        .groupBy("yyyymm", "region", "category")
        .agg(merged_money("amount").alias("revenue"), F.sum("units").alias("units"))
    )


def monthly_total(spark: SparkSession, gold_path: str) -> DataFrame:
    """As ``gold.monthly_total``."""
    return _stored(spark, gold_path, "sales").groupBy("yyyymm").agg(merged_money("amount").alias("revenue"))


def customer_spend(spark: SparkSession, gold_path: str) -> DataFrame:
    """As ``gold.customer_spend``, from one stored row per month and customer."""
    return (
        _stored(spark, gold_path, "spend")
        .groupBy("region", "customer_id")
        .agg(merged_money("amount").alias("total_spent"))
    )


def latest_month(spark: SparkSession, silver_path: str) -> DataFrame:
    """As ``gold.latest_month``, from silver's manifest: no file of the table is opened."""
    last = versions.manifest(spark, silver_path).agg(F.max("last_ts").alias("ts"))
    return last.select(month_key(F.col("ts")).alias("yyyymm"))


def layer_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a table of ``sinks.versions``, by its manifest."""
    rows = versions.manifest(spark, path).agg(F.sum("row_count").alias("row_count"))
    return rows.select(F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"))
