"""Parquet tables that change in one step.

Files are never changed: each write goes to a folder of its own, and a small manifest lists the folders that make up the
table. A write becomes visible when its manifest is renamed to the next version's name. Readers see the version before or
the version after, a failed write leaves nothing that a reader sees, and of two writers who started from one version the
second is told so. The manifest also says what a part holds, so that some questions need no data.

    <path>/data/commit=<id>/yyyymm=202406/region=Europe/part-....parquet
    <path>/versions/<number>/part-....parquet

The file system must rename a folder in one step, as HDFS and local ones do.
"""

import re
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.silver import redistribute

#: One row per folder: the value of the first partition column, the batch that brought the rows, what they were computed
#: from, their number and their latest time.
MANIFEST = (
    "part STRING, folder STRING, batch STRING, origin STRING, row_count BIGINT, last_ts TIMESTAMP_NTZ"
)
PARTITIONS = ("yyyymm", "region")
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_ATTEMPTS = 10


class Conflict(RuntimeError):
    """Another writer has changed the table since this one read it."""


def _hadoop(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return hadoop, target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names in a folder and when they last changed, in milliseconds."""
    _, target, files = _hadoop(spark, path)
    if not files.exists(target):
        return []
    return [(status.getPath().getName(), status.getModificationTime()) for status in files.listStatus(target)]


def current(spark: SparkSession, path: str) -> int:
    """The number of the latest version, 0 for a table that has none."""
    return max((int(name) for name, _ in _names(spark, f"{path}/versions") if name.isdigit()), default=0)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """What the table consists of, one row per folder."""
    number = current(spark, path) if version is None else version
    if not number:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{path}/versions/{number}")


def in_parts(column: Column, parts: Iterable[str | None]) -> Column:
    """Whether ``column`` is one of ``parts``, which may have None for NULL."""
    values = list(parts)
    known = F.coalesce(column.isin([value for value in values if value is not None]), F.lit(False))
    return known | column.isNull() if None in values else known


def _commit(spark: SparkSession, path: str, base: int, rows: DataFrame) -> int:
    """Makes ``rows`` the manifest of version ``base + 1``, in one rename."""
    draft, final = f"{path}/versions/.{uuid.uuid4().hex}", f"{path}/versions/{base + 1}"
    rows.coalesce(1).write.parquet(draft)
    hadoop, target, files = _hadoop(spark, final)
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        # Unlike FileSystem.rename, this refuses a target that is there.
        context.rename(hadoop.Path(draft), target, no_options)
    except Exception as error:
        files.delete(hadoop.Path(draft), True)
        if "FileAlreadyExistsException" in str(error) or files.exists(target):
            raise Conflict(f"{path} has a version {base + 1} by now") from error
        raise
    return base + 1


def _write(frame: DataFrame, path: str, partitions: Sequence[str]) -> str:
    """Writes to a folder of its own and returns its name."""
    folder = f"commit={uuid.uuid4().hex}"
    shaped = redistribute(frame, keys=partitions) if partitions else frame
    shaped.write.partitionBy(*partitions).parquet(f"{path}/data/{folder}")
    return folder


def _listed(
    spark: SparkSession,
    path: str,
    folder: str,
    written: T.StructType,
    partitions: Sequence[str],
    time_column: str | None,
    batch: str | None,
    origins: Mapping[str | None, str],
) -> DataFrame:
    """Manifest rows of a folder that was just written, from its footers and one column."""
    fields = [T.StructField(partitions[0], T.StringType())] if partitions else []
    fields += [written[time_column]] if time_column else []
    nothing = T.StructField("nothing", T.StringType())
    stored = spark.read.schema(T.StructType(fields or [nothing])).parquet(f"{path}/data/{folder}")
    part = F.col(partitions[0]) if partitions else F.lit(None).cast("string")
    last = F.max(time_column) if time_column else F.lit(None)
    counted = stored.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("row_count"), last.cast("timestamp_ntz").alias("last_ts")
    )
    place = F.lit(folder)
    if partitions:
        value = F.coalesce("part", F.lit(_NULL_FOLDER))
        place = F.concat(F.lit(f"{folder}/{partitions[0]}="), value)
    origin = F.lit(None).cast("string")
    for value, text in origins.items():
        origin = F.when(in_parts(F.col("part"), [value]), text).otherwise(origin)
    return counted.select(
        "part",
        place.alias("folder"),
        F.lit(batch).cast("string").alias("batch"),
        origin.alias("origin"),
        "row_count",
        "last_ts",
    )


def replace(
    frame: DataFrame,
    path: str,
    parts: Iterable[str | None] | None = None,
    partitions: Sequence[str] = PARTITIONS,
    time_column: str | None = "order_ts",
    origins: Mapping[str | None, str] | None = None,
    expected: int | None = None,
) -> int:
    """Replaces ``parts`` (values of the first of ``partitions``, months as a rule; None among them is NULL) by the rows
    that ``frame`` has for them, in one step; all other parts stay. Without ``parts`` the whole table is replaced.

    A part without rows is empty afterwards; rows of other parts are not written. ``expected`` is the version that
    ``frame`` was computed from, by default the current one; if another writer has come first, nothing changes and
    ``Conflict`` is raised. Returns the new version.
    """
    spark = frame.sparkSession
    base = current(spark, path) if expected is None else expected
    old = manifest(spark, path, base)
    if parts is not None:
        parts = list(parts)
        for part in parts:
            if part is not None and not re.fullmatch(r"[\w-]+", part):
                raise ValueError(f"{part!r} is no name of a folder")
        frame = frame.filter(in_parts(F.col(partitions[0]), parts))
    folder = _write(frame, path, partitions)
    new = _listed(spark, path, folder, frame.schema, partitions, time_column, None, origins or {})
    if parts is not None:
        new = old.filter(~in_parts(F.col("part"), parts)).unionByName(new)
    return _commit(spark, path, base, new)


def append_batch(
    frame: DataFrame, path: str, batch: str, partitions: Sequence[str] = (), time_column: str | None = "order_ts"
) -> bool:
    """Adds the rows of a named batch, once: a batch that the table has already changes nothing and gives False.

    So a job that died, or whose success was not noticed, can simply run again. Writers of different batches do not
    disturb each other: the rows are written once, and the manifest is renewed until no other writer comes between.
    """
    spark = frame.sparkSession
    folder = None
    for _ in range(_ATTEMPTS):
        base = current(spark, path)
        old = manifest(spark, path, base)
        if old.filter(F.col("batch") == batch).limit(1).count():
            return False
        if folder is None:
            folder = _write(frame, path, partitions)
            new = _listed(spark, path, folder, frame.schema, partitions, time_column, batch, {})
            # A batch without rows is in the ledger too.
            empty = spark.createDataFrame([(None, None, batch, None, 0, None)], MANIFEST)
            new = new if new.limit(1).count() else empty
        try:
            _commit(spark, path, base, old.unionByName(new))
            return True
        except Conflict:
            continue
    raise Conflict(f"{path} changed {_ATTEMPTS} times while a batch was added")


def folders(
    spark: SparkSession, path: str, version: int | None = None, parts: Iterable[str | None] | None = None
) -> list[tuple[str | None, str]]:
    """Parts and their folders, those of ``parts`` if given."""
    rows = manifest(spark, path, version).filter("folder IS NOT NULL")
    if parts is not None:
        rows = rows.filter(in_parts(F.col("part"), parts))
    return sorted(
        ((row["part"], row["folder"]) for row in rows.select("part", "folder").collect()),
        key=lambda pair: (pair[0] or "", pair[1]),
    )


def read(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    version: int | None = None,
    parts: Iterable[str | None] | None = None,
) -> DataFrame:
    """The table as of a version, by default the latest. Filters on partition columns select folders, as in any
    partitioned table; with ``parts`` only their folders are listed."""
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    places = [f"{path}/data/{folder}" for _, folder in folders(spark, path, version, parts)]
    if not places:
        return spark.createDataFrame([], fields)
    whole = T.StructType([*fields.fields, T.StructField("commit", T.StringType())])
    stored = spark.read.schema(whole).option("basePath", f"{path}/data").parquet(*places)
    return stored.select([f"`{field.name}`" for field in fields])


def vacuum(spark: SparkSession, path: str, keep: int = 2, idle_hours: float = 24.0) -> list[str]:
    """Deletes the manifests before the last ``keep`` and the folders that none of the rest names, unless they changed
    within ``idle_hours``: those may belong to a write that is under way. Returns the names of deleted folders."""
    numbers = sorted(int(name) for name, _ in _names(spark, f"{path}/versions") if name.isdigit())
    used = {folder.split("/")[0] for number in numbers[-keep:] for _, folder in folders(spark, path, number)}
    hadoop, _, files = _hadoop(spark, path)
    now = spark._jvm.java.lang.System.currentTimeMillis()
    for number in numbers[:-keep]:
        files.delete(hadoop.Path(f"{path}/versions/{number}"), True)
    idle = [
        name
        for name, changed in _names(spark, f"{path}/data")
        if name not in used and now - changed >= idle_hours * 3_600_000
    ]
    for name in idle:
        files.delete(hadoop.Path(f"{path}/data/{name}"), True)
    return sorted(idle)
