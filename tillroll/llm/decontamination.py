"""Benchmark decontamination by Wu-Manber search for many strings at once.

Texts are brought to a normal form, words in lower case with one space between them, so a window of benchmark words
is one string and a search for it is a search for bytes. The tables of a search are built once for a block of
benchmark items and sent to the tasks:

* a *shift table* says, for the hash of the last bytes under the cursor, how far the nearest test string can still
  be, and the cursor skips that far;
* where it cannot skip, *suffix-hash buckets* name the strings whose prefix ends in those bytes;
* a direct comparison of bytes and of both word boundaries confirms each occurrence.

A piece of text is scanned by many cursors at once, each in a stretch of its own, as numpy vectors.
"""

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import pieces, ranges, texts_of
from tillroll.sinks.scratch import materialise

WINDOW = 10
#: Benchmark words in one set of tables; a larger benchmark is searched in as many passes as it has such blocks.
BLOCK_WORDS = 2_000_000
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

_END = 10  # marks the end of a text in the normal form
_TABLE_BITS = 20
_STRETCH = 512
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX_2 = np.uint64(0xC2B2AE3D27D4EB4F)


def _normal_bytes() -> np.ndarray:
    table = np.full(256, 32, np.uint8)
    for byte in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
        table[byte] = byte
    for byte in range(0x41, 0x5B):
        table[byte] = byte + 32
    return table


_NORMAL = _normal_bytes()


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


@dataclass
class Normal:
    """Texts in normal form: their bytes, where words start, and the words before each text."""

    stream: np.ndarray
    word_starts: np.ndarray
    word_offsets: np.ndarray


def normalise(texts: list[bytes]) -> Normal:
    raw = np.frombuffer(b"\x00".join([b"", *texts, b""]), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths + 1)
    form = _NORMAL[raw]
    form[ends] = _END
    form[0] = _END
    word = (form != 32) & (form != _END)
    keep = form != 32
    keep[1:] |= word[:-1]
    stream = form[keep]
    word = word[keep]
    starts = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    text_ends = np.flatnonzero(stream == _END)
    return Normal(stream, starts, np.searchsorted(starts, text_ends))


class WuManber:
    """Tables for strings whose lengths lie in one class.

    All strings are matched by their first ``reach`` bytes, the length of the
    shortest, 250 at most; ``block`` of these at a time index the tables.
    """

    def __init__(self, strings: list[bytes], block: int):
        self.strings = strings
        self.block = block
        self.reach = min(250, *map(len, strings))
        if not block <= self.reach:
            raise ValueError("no string may be shorter than the block")
        prefixes = np.frombuffer(b"".join(s[: self.reach] for s in strings), np.uint8)
        prefixes = np.concatenate([np.zeros(8, np.uint8), prefixes])
        starts = 8 + self.reach * np.arange(len(strings))
        self.shift = np.full(1 << _TABLE_BITS, self.reach - block + 1, np.uint8)
        for end in range(block, self.reach + 1):
            np.minimum.at(self.shift, self._keys(_unaligned(prefixes), starts + end), self.reach - end)
        last = self._keys(_unaligned(prefixes), starts + self.reach)
        order = np.argsort(last, kind="stable")
        self.bucket_keys, first = np.unique(last[order], return_index=True)
        self.bucket_bounds = np.append(first, len(order))
        self.bucket_members = order

    def _keys(self, view: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Table index of the ``block`` bytes before each end."""
        low = view[ends - 8]
        if self.block < 8:
            low = low >> np.uint64(64 - 8 * self.block)
        key = low * _MIX
        if self.block == 16:
            key ^= view[ends - 16] * _MIX_2
        key ^= key >> np.uint64(29)
        key *= _MIX
        return (key >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def find(self, stream: np.ndarray, padded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of occurrences in ``stream`` and the string found at each.

        ``padded`` is the stream after 16 more bytes.
        """
        view = _unaligned(padded)
        size = len(stream)
        cursor = np.arange(self.reach, size + 1, _STRETCH)
        limit = np.minimum(cursor + _STRETCH, size + 1)
        stops, keys = [], []
        while len(cursor):
            key = self._keys(view, cursor + 16)
            step = self.shift[key]
            stop = step == 0
            if stop.any():
                stops.append(cursor[stop])
                keys.append(key[stop])
            cursor = cursor + np.maximum(step, 1)
            going = cursor < limit
            cursor, limit = cursor[going], limit[going]
        if not stops:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return self._confirm(stream, np.concatenate(stops), np.concatenate(keys))

    def _confirm(self, stream, stops, keys):
        bucket = np.minimum(np.searchsorted(self.bucket_keys, keys), len(self.bucket_keys) - 1)
        known = self.bucket_keys[bucket] == keys
        bucket, begins = bucket[known], stops[known] - self.reach
        sizes = self.bucket_bounds[bucket + 1] - self.bucket_bounds[bucket]
        members = self.bucket_members[ranges(self.bucket_bounds[bucket], sizes)]
        begins = np.repeat(begins, sizes)
        data = stream.tobytes()
        found = [
            data.startswith(self.strings[member], begin)
            for begin, member in zip(begins.tolist(), members.tolist())
        ]
        found = np.asarray(found, bool)
        return begins[found], members[found]


def _unaligned(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


class Searcher:
    """Finds the windows of a block of benchmark items in texts.

    ``windows``: the normal form of a window, its words, and the items that contain it.
    """

    def __init__(self, windows: dict[bytes, tuple[int, list[int]]]):
        self.windows = list(windows.items())
        self.matchers = []
        # Lengths are split into classes, so that one short item does not shorten everyone's shifts.
        for least, most, block in ((16, None, 16), (8, 16, 8), *((n, n + 1, n) for n in range(1, 8))):
            chosen = [
                i
                for i, (form, _) in enumerate(self.windows)
                if len(form) >= least and (most is None or len(form) < most)
            ]
            # The long class again by its lower quarter, for the same reason.
            for part in _by_length(chosen, self.windows) if least == 16 else [chosen]:
                if part:
                    self.matchers.append((WuManber([self.windows[i][0] for i in part], block), np.array(part)))

    def hits(self, normal: Normal) -> tuple[np.ndarray, np.ndarray]:
        """First word and window of each occurrence."""
        stream = normal.stream
        padded = np.concatenate([np.zeros(16, np.uint8), stream])
        begins, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for matcher, names in self.matchers:
            begin, member = matcher.find(stream, padded)
            begins.append(begin)
            found.append(names[member])
        begin, window = np.concatenate(begins), np.concatenate(found)
        lengths = np.array([len(form) for form, _ in self.windows], np.int64)
        after = stream[np.minimum(begin + lengths[window], len(stream) - 1)]
        before = stream[begin - 1]
        whole = ((before == 32) | (before == _END)) & ((after == 32) | (after == _END))
        begin, window = begin[whole], window[whole]
        return np.searchsorted(normal.word_starts, begin), window


def _by_length(chosen: list[int], windows) -> list[list[int]]:
    if not chosen:
        return []
    cut = int(np.quantile([min(len(windows[i][0]), 250) for i in chosen], 0.02))
    return [
        [i for i in chosen if len(windows[i][0]) < cut],
        [i for i in chosen if len(windows[i][0]) >= cut],
    ]


def windows_of(items: list[tuple[int, str]]) -> dict[bytes, tuple[int, list[int]]]:
    windows: dict[bytes, tuple[int, list[int]]] = {}
    for item, text in items:
        words = words_of((text or "").encode())
        for start in range(max(1, len(words) - WINDOW + 1) if words else 0):
            form = words[start : start + WINDOW]
            names = windows.setdefault(b" ".join(form), (len(form), []))[1]
            if not names or names[-1] != item:
                names.append(item)
    return windows


def item_blocks(benchmark: DataFrame, words: int = BLOCK_WORDS) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of about ``words`` words, one partition of the table at a time on the driver."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").filter("text IS NOT NULL").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += len(row["text"]) // 4 + 1
        if size >= words:
            yield block
            block, size = [], 0
    if block:
        yield block


HITS = (
    "doc_id BIGINT, n_words BIGINT, starts ARRAY<BIGINT>, stops ARRAY<BIGINT>, items ARRAY<BIGINT>, n_hit BIGINT"
)


def _search_block(documents: DataFrame, block, schema: str) -> DataFrame:
    kept = documents.sparkSession.sparkContext.broadcast(windows_of(block))
    made = []

    def search(batches):
        if not made:
            made.append(Searcher(kept.value))
        searcher = made[0]
        for piece in pieces(batches):
            normal = normalise(texts_of(piece.column("text")))
            first, window = searcher.hits(normal)
            yield _rows(piece.column("doc_id"), normal, first, window, searcher.windows)

    return documents.select("doc_id", "text").mapInArrow(search, schema)


def _rows(ids, normal: Normal, first, window, windows) -> pa.RecordBatch:
    bounds = normal.word_offsets
    sizes = np.array([size for _, (size, _) in windows], np.int64)
    texts = len(ids)
    starts, stops, items = ([[] for _ in range(texts)] for _ in range(3))
    order = np.argsort(first, kind="stable")
    doc_of = np.searchsorted(bounds[1:], first[order], side="right")
    for doc, begin, name in zip(doc_of.tolist(), first[order].tolist(), window[order].tolist()):
        begin -= int(bounds[doc])
        stop = begin + int(sizes[name])
        items[doc].extend(windows[name][1][1])
        if stops[doc] and begin <= stops[doc][-1]:
            stops[doc][-1] = max(stop, stops[doc][-1])
        else:
            starts[doc].append(begin)
            stops[doc].append(stop)
    hit = [sum(stop) - sum(start) for start, stop in zip(starts, stops)]
    big = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            ids.cast(pa.int64()),
            pa.array(np.diff(bounds), pa.int64()),
            pa.array(starts, big),
            pa.array(stops, big),
            pa.array([sorted(set(names)) for names in items], big),
            pa.array(hit, pa.int64()),
        ],
        names=["doc_id", "n_words", "starts", "stops", "items", "n_hit"],
    )


def contamination(documents: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Words of each document that lie in an occurrence of a benchmark window.

    Reads ``doc_id``, ``text`` and ``item_id``, ``text``. One row per document: ``n_words``, the hit stretches as
    ``starts`` and ``stops`` (word numbers, stops excluded), ``n_hit`` words in them and the ``items`` found.
    NULL and empty texts have no words; items without words find nothing; without items nothing is hit; ids may repeat
    or be NULL. With a benchmark of one block there is no shuffle. A larger one needs a pass for each block, and the hits
    of a document are merged by its place in a stored copy of the documents.
    """
    rows = documents.select("doc_id", "text")
    blocks = item_blocks(benchmark, block_words)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return _search_block(rows, first, HITS)
    stored = materialise(rows.withColumn("place", F.monotonically_increasing_id()), "numbered")
    searched = stored.select(F.col("place").alias("doc_id"), "text")
    found = [_search_block(searched, block, HITS) for block in chain([first, second], blocks)]
    together = found[0]
    for more in found[1:]:
        together = together.unionByName(more)
    stretches = "arrays_zip(starts, stops)"
    merged = together.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"),
        F.expr(f"array_sort(flatten(collect_list({stretches})))").alias("found"),
        F.expr("array_sort(array_distinct(flatten(collect_list(items))))").alias("items"),
    )
    # Sorted stretches are joined where they touch, as within one block.
    joined = """aggregate(found, CAST(array() AS ARRAY<STRUCT<starts: BIGINT, stops: BIGINT>>), (done, x) ->
        CASE WHEN size(done) > 0 AND x.starts <= element_at(done, -1).stops
             THEN concat(slice(done, 1, size(done) - 1), array(named_struct('starts', element_at(done, -1).starts,
                         'stops', greatest(element_at(done, -1).stops, x.stops))))
             ELSE concat(done, array(x)) END)"""
    merged = merged.withColumn("joined", F.expr(joined)).withColumnRenamed("doc_id", "place")
    return merged.join(stored.select("place", "doc_id"), "place").selectExpr(
        "CAST(doc_id AS BIGINT) AS doc_id",
        "n_words",
        "joined.starts AS starts",
        "joined.stops AS stops",
        "items",
        "aggregate(joined, 0L, (sum, x) -> sum + x.stops - x.starts) AS n_hit",
    )


def without_contaminated(
    documents: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``documents`` (all columns) without those in which a benchmark window occurs.

    Rows keep their order, and there is no shuffle however large the benchmark is: each of its blocks is one more
    filter on the way. NULL and empty texts stay.
    """
    for block in item_blocks(benchmark, block_words):
        documents = _drop_block(documents, block)
    return documents


def _drop_block(documents: DataFrame, block) -> DataFrame:
    kept = documents.sparkSession.sparkContext.broadcast(windows_of(block))
    made = []

    def drop(batches):
        if not made:
            made.append(Searcher(kept.value))
        for piece in pieces(batches):
            normal = normalise(texts_of(piece.column("text")))
            first, _ = made[0].hits(normal)
            clean = np.ones(piece.num_rows, bool)
            clean[np.searchsorted(normal.word_offsets[1:], first, side="right")] = False
            yield piece.filter(pa.array(clean))

    return documents.mapInArrow(drop, documents.schema)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``contamination``."""
    names = F.expr("array_join(array_sort(transform(items, x -> CAST(x AS STRING))), ',')")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def brute_force(documents: list[tuple[int, str]], items: list[tuple[int, str]]) -> list[tuple]:
    """The same rows as ``digest``, by trying every window at every word; for tests."""
    windows = windows_of(items)
    rows = []
    for doc, text in documents:
        words = words_of((text or "").encode())
        hit, names = set(), set()
        for form, (size, owners) in windows.items():
            wanted = form.split(b" ")
            for start in range(len(words) - size + 1):
                if words[start : start + size] == wanted:
                    hit.update(range(start, start + size))
                    names.update(owners)
        joined = ",".join(sorted(map(str, names)))
        rows.append(
            (doc, len(words), len(hit), len(names), hashlib.sha256(joined.encode()).hexdigest(), bool(hit))
        )
    return rows
