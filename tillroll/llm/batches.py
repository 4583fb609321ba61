"""Arrow batches as bytes, for operators that work inside a task."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

PIECE_BYTES = 1 << 21
#: Rows in an Arrow batch. Texts are long, and Spark's default of 10,000 rows is sized for narrow rows.
BATCH_ROWS = 1000


def with_small_batches(spark: SparkSession) -> SparkSession:
    """``spark`` with no more than ``BATCH_ROWS`` rows in the Arrow batches of whole texts, which bounds what executors
    hold outside their heap. A session that sets fewer keeps its setting."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return spark


def text_lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each text, 0 for NULL."""
    lengths = pc.fill_null(pc.binary_length(column), 0)
    return lengths.to_numpy(zero_copy_only=False).astype(np.int64)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, empty for NULL."""
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def pieces(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds about ``size`` bytes of text; a
    text is never cut, so a very long one is a piece of its own."""
    for batch in batches:
        lengths = text_lengths(batch.column(text))
        bounds = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            before = bounds[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(bounds, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def offsets_of(lengths) -> np.ndarray:
    """Start of each part and the end of the last, for parts laid end to end."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return offsets


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges ``starts[i] .. starts[i] + lengths[i]``, end to end."""
    if not len(starts):
        return np.zeros(0, np.int64)
    offsets = offsets_of(lengths)
    return np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
