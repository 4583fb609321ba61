"""Intermediate tables in a folder that all machines of a session share."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Names the folder where ``spark.checkpoint.dir`` is unset.
SETTING = "tillroll.scratch.dir"


def scratch_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A path not used before, below ``folder``, the session's ``spark.checkpoint.dir`` or its ``tillroll.scratch.dir``."""
    base = folder or spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SETTING, None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    return f"{base.rstrip('/')}/tillroll-{uuid.uuid4().hex}/{name}"


def materialise(frame: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``frame`` written once and read back.

    Consumers of the result share one computation, survive lost executors
    without repeating it, and let Spark see its true size. The table stays until
    the folder is cleared; ``scratch`` clears it by itself.
    """
    path = scratch_path(frame.sparkSession, name, folder)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, folder: str | None = None) -> Iterator[str]:
    """A folder for the intermediates of a block, removed at its end with all that is in it.

    For work that is complete within the block; a frame that is still to be
    computed must not read from it.
    """
    path = scratch_path(spark, "block", folder).rsplit("/", 1)[0]
    try:
        yield path
    finally:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
