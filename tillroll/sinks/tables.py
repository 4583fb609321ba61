"""Parquet tables: bronze by append, silver by month and region, gold plain."""

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.silver import redistribute

SILVER_PARTITIONS = ("yyyymm", "region")


def append_bronze(orders: DataFrame, path: str) -> None:
    orders.write.mode("append").parquet(path)


def write_silver(silver: DataFrame, path: str, partitions: int | None = None) -> None:
    """Replace silver, one folder per month and region.

    Rows are brought together by folder first, so each folder gets few files.
    """
    (
        redistribute(silver, partitions, SILVER_PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*SILVER_PARTITIONS)
        .parquet(path)
    )


def rebuild_months(silver: DataFrame, path: str, months: Sequence[str]) -> None:
    """Replace whole months of a table that ``write_silver`` wrote; all others stay.

    Each month's folder is replaced with all regions in it, so an order that has
    moved to another region leaves none behind, and a region or month without
    rows in ``silver`` is empty afterwards. Rows of other months are not written.
    """
    for month in months:
        if not re.fullmatch(r"\d{6,}", month):
            raise ValueError(f"{month!r} is no month key")
        (
            redistribute(silver.filter(F.col("yyyymm") == month).drop("yyyymm"), keys=("region",))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("region")
            .parquet(f"{path}/yyyymm={month}")
        )


def write_gold(gold: DataFrame, path: str, files: int | None = None) -> None:
    """Replace a gold table, in at most ``files`` files if given."""
    frame = gold if files is None else gold.coalesce(files)
    frame.write.mode("overwrite").parquet(path)


def write_bucketed(frame: DataFrame, table: str, buckets: int, key: str = "customer_id") -> None:
    """Replace a catalog table bucketed and sorted by ``key``: joins and totals
    on the key between tables with equal bucket counts need no shuffle.

    Rows are hashed to the buckets' own partitioning first, one file a bucket.
    """
    (
        frame.repartition(buckets, F.col(key))
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )


def write_clustered(frame: DataFrame, path: str, key: str, files: int, row_group_bytes: int = 16 << 20) -> None:
    """Replace a table whose files hold ranges of ``key``, in order, with a Bloom filter on it.

    A reader that looks for some keys skips files and row groups by their least and greatest key, and those of the rest
    whose filter does not have one. Rows of one key lie together.
    """
    (
        frame.repartitionByRange(files, key)
        .sortWithinPartitions(key)
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("parquet.block.size", str(row_group_bytes))
        .parquet(path)
    )


def sample(frame: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows, in no particular order unless ``frame`` is sorted."""
    return frame.limit(rows)


@contextmanager
def reused(frame: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """``frame`` kept for several consumers and released at the end of the block.

    For frames that fit the executors; ``scratch.materialise`` is for the rest.
    """
    frame.persist(level)
    try:
        yield frame
    finally:
        frame.unpersist()


def count_rows(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named frame."""
    counted = None
    for name, frame in frames.items():
        count = frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("layer"), "row_count"
        )
        counted = count if counted is None else counted.unionAll(count)
    return counted
