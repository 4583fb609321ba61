"""Texts dealt to shards and packed: one compressed row for the texts of a shard in each piece of input."""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tillroll.llm.batches import offsets_of, pieces, text_lengths, texts_of

PACKED = "shard INT, ids ARRAY<BIGINT>, sizes BINARY, packed BINARY"
_PIECE = 16 << 20


def packed(rows: DataFrame, shard_of: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """Packs ``doc_id`` (BIGINT) and ``text``; ``shard_of`` gives the shard of each row of a batch."""

    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for piece in pieces(batches, size=_PIECE):
            texts, sizes = texts_of(piece.column("text")), text_lengths(piece.column("text"))
            shard = shard_of(piece)
            order = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.append(True, shard[order][1:] != shard[order][:-1]))
            blobs = [
                squeeze.compress(b"".join(texts[i] for i in own.tolist())) for own in np.split(order, cuts[1:])
            ]
            ids = piece.column("doc_id").cast(pa.int64()).take(pa.array(order))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard[order][cuts].astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.append(cuts, len(order)).astype(np.int32)), ids),
                    pa.array([own.tobytes() for own in np.split(sizes[order], cuts[1:])], pa.binary()),
                    pa.array(blobs, pa.binary()),
                ],
                names=["shard", "ids", "sizes", "packed"],
            )

    return rows.mapInArrow(pack, PACKED)


def unpacked(table: pa.Table) -> tuple[pa.Array, list[bytes]]:
    """The ids and texts of a shard."""
    ids, texts = [], []
    for row in table.select(["ids", "sizes", "packed"]).to_pylist():
        ids.extend(row["ids"])
        sizes = np.frombuffer(row["sizes"], np.int64)
        data = zstandard.ZstdDecompressor().decompress(row["packed"]) if sizes.any() else b""
        ends = offsets_of(sizes).tolist()
        texts.extend(data[a:b] for a, b in zip(ends, ends[1:]))
    return pa.array(ids, pa.int64()), texts


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values
