"""Exact removal of long strings that an earlier document has, by suffix arrays of shards.

A shard is a range of document ids, so whatever a lower shard holds comes first. Three passes over the shards, with two
exchanges of fixed-width numbers between them:

1. *Seeds.* Every string of ``LENGTH`` bytes is represented by the least hashed ``SEED``-byte string in it, so equal
   strings have equal seeds. Shards exchange their distinct seeds and learn which ones other shards have too. The text
   around seeds that only one document has cannot repeat and is left out from here on.
2. *Suffix arrays.* Each shard sorts the suffixes of its remaining text by Larsson-Sadakane refinement: groups of
   suffixes with equal prefixes are split by the ranks of what follows, doubling the prefix each time, until prefixes
   reach ``LENGTH``. Kasai's algorithm gives the common prefixes of neighbours, and runs of neighbours that share
   ``LENGTH`` bytes are one string with its first document in the shard.
3. *Merging.* Shards send the sorted fingerprints of their strings, split by hash over as many merging groups as there
   are shards. A group looks every string up by binary search among the merged ones and answers one bit, whether a
   lower shard has it. Each shard then knows for each of its strings whether an earlier document has it, and marks
   the bytes that such strings cover.

A string occurs once per shard in an exchange however often it repeats there, so no frequent string is a hot key.
Texts travel compressed and in one exchange. Exact copies of an earlier text are settled by their hash beforehand.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import ranges
from tillroll.llm.shards import distinct, packed, unpacked
from tillroll.llm.word_hashing import mix

LENGTH = 50
SEED = 24
#: Text of one shard, which bounds what a task holds.
SHARD_BYTES = 8 << 20
LEAST_SHARDS = 16
#: Bytes by which suffixes are sorted, the first doubling that reaches ``LENGTH``.
DEPTH = 64

_WINDOW = LENGTH - SEED + 1
_BLOCK = 1 << 15  # bytes hashed at a time, so that the numbers stay in the processor's cache
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _FACTOR)
_NO_DOC = np.iinfo(np.int64).max
_COPIES, _SEEDS, _BITS, _LOCAL = range(4)


def _doubled(data: np.ndarray, sizes: tuple[int, ...]) -> np.ndarray:
    """Hashes of the strings of ``sum(sizes)`` bytes from each position; ``sizes`` are falling powers of two."""
    size, level = 1, _BYTES[data]
    levels = {1: level}
    while size < max(sizes):
        level = level[:-size] * _FACTOR + level[size:]
        level ^= level >> np.uint64(32)
        size *= 2
        levels[size] = level
    count = len(data) - sum(sizes) + 1
    out, at = np.zeros(max(0, count), np.uint64), 0
    for size in sizes:
        out *= np.uint64(0xC2B2AE3D27D4EB4F)
        out += levels[size][at : at + count]
        out ^= out >> np.uint64(29)
        at += size
    return mix(out)


def _window_min(values: np.ndarray) -> np.ndarray:
    size, level = 1, values
    while 2 * size <= _WINDOW:
        level = np.minimum(level[:-size], level[size:])
        size *= 2
    rest = _WINDOW - size
    return np.minimum(level[: len(level) - rest], level[rest:]) if rest else level


def seed_runs(data: np.ndarray, ends: np.ndarray):
    """Runs of neighbouring strings with one seed: their first position, number, seed and text.

    ``data`` holds texts end to end, ``ends`` where each ends. Strings do not cross texts.
    """
    found = []
    starts = np.append(0, ends[:-1])
    begin = 0
    while begin < len(ends):
        stop = max(begin + 1, int(np.searchsorted(ends, starts[begin] + _BLOCK, side="right")))
        low, high = int(starts[begin]), int(ends[stop - 1])
        if high - low >= LENGTH:
            part = data[low:high]
            least = _window_min(_doubled(part, (16, 8)))
            size = np.zeros(len(least) + 1, np.int64)
            own_starts, own_ends = starts[begin:stop] - low, ends[begin:stop] - low - LENGTH + 1
            real = own_ends > own_starts
            np.add.at(size, own_starts[real], 1)
            np.add.at(size, own_ends[real], -1)
            valid = np.cumsum(size[:-1]) > 0
            change = valid.copy()
            change[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
            change[own_starts[real]] = True
            stops = np.flatnonzero(change | ~valid)
            first = np.flatnonzero(change)
            after = np.append(stops, len(least))[np.searchsorted(stops, first, side="right")]
            text = np.searchsorted(own_ends + LENGTH - 1, first, side="right") + begin
            found.append((first + low, after - first, least[first], text))
        begin = stop
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64), empty
    return tuple(np.concatenate(column) for column in zip(*found))


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Positions in order of the ``DEPTH`` bytes from each on (zeros follow the data)."""
    size = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    keys = np.ndarray((size,), ">u8", padded, strides=(1,)).astype(np.uint64)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.ones(size + 1, bool)  # whether a group begins here
    first[1:-1] = keys[1:] != keys[:-1]
    rank = np.empty(size, np.int64)
    group = np.maximum.accumulate(np.where(first[:-1], np.arange(size), 0))
    rank[order] = group
    for step in (8, 16, DEPTH // 2):
        # Only groups that are not single yet are refined.
        unsorted = np.flatnonzero(~(first[:-1] & first[1:]))
        if not len(unsorted):
            break
        place = order[unsorted]
        follow = place + step
        second = np.where(follow < size, rank[np.minimum(follow, size - 1)] + 1, 0)
        pair = (rank[place].astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
        by_pair = np.argsort(pair)
        pair, place = pair[by_pair], place[by_pair]
        order[unsorted] = place
        begins = np.append(True, pair[1:] != pair[:-1])
        first[unsorted] = begins
        rank[place] = np.maximum.accumulate(np.where(begins, unsorted, 0))
    # Suffixes that still tie are put in order of position, which lets ``common_prefixes`` carry on.
    tied = np.flatnonzero(~(first[:-1] & first[1:]))
    place = order[tied]
    order[tied] = place[np.argsort((rank[place].astype(np.uint64) << np.uint64(32)) | place.astype(np.uint64))]
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Kasai: bytes that each suffix shares with the one before it in ``order``, ``DEPTH`` at most.

    The text is cut into stretches that are read side by side; in each, the common prefix shrinks by one byte at most
    from one position to the next. Suffixes that agree in ``DEPTH`` bytes are in no certain order, so after them that
    holds only if the suffix before has moved on by one as well.
    """
    size = len(data)
    place = np.empty(size, np.int64)
    place[order] = np.arange(size)
    before = np.empty(size, np.int64)  # the suffix before, -1 for the first
    before[order[1:]] = order[:-1]
    before[order[:1]] = -1
    padded = np.concatenate([data, np.zeros(DEPTH + 16, np.uint8)])
    words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    stretch = 512
    out = np.zeros(size, np.int64)
    at = np.arange(0, size, stretch)
    shared, last = np.zeros(len(at), np.int64), np.full(len(at), -1)
    for _ in range(min(stretch, size)):
        if at[-1] >= size:
            at, shared, last = at[:-1], shared[:-1], last[:-1]
        other = before[at]
        holds = (other >= 0) & ((shared < DEPTH) | (other == last + 1))
        shared, last = np.where(holds, np.maximum(shared - 1, 0), 0), other
        going = np.flatnonzero(other >= 0)
        while len(going):
            differ = words[at[going] + shared[going]] ^ words[other[going] + shared[going]]
            low = differ & (~differ + np.uint64(1))
            equal = np.where(differ == 0, 8, (np.frexp(low.astype(np.float64))[1] - 1) >> 3)
            shared[going] += equal
            going = going[(equal == 8) & (shared[going] < DEPTH)]
        # No match runs beyond the end of the text.
        shared = np.minimum(shared, np.minimum(DEPTH, size - np.maximum(at, other)))
        out[place[at]] = shared
        at = at + 1
    return out


class Shard:
    """Texts of one shard and the strings in them that may repeat."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], copies: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.texts = [texts[i] for i in order.tolist()]
        self.copy = np.isin(self.ids, copies)
        self.own = [b"" if copy else text for text, copy in zip(self.texts, self.copy.tolist())]
        self.ends = np.cumsum([len(text) for text in self.own], dtype=np.int64)
        self.data = np.frombuffer(b"".join(self.own), np.uint8)
        self.runs = seed_runs(self.data, self.ends)

    def seeds(self) -> np.ndarray:
        return distinct(self.runs[2])

    def choose(self, elsewhere: np.ndarray) -> None:
        """Keeps the strings whose seeds are ``elsewhere`` (sorted) or in two documents here."""
        first, count, seed, text = self.runs
        docs = self.ids[text]
        several = np.zeros(len(seed), bool)
        if len(seed):
            order = np.argsort(seed)
            begins = np.flatnonzero(np.append(True, seed[order][1:] != seed[order][:-1]))
            differ = np.maximum.reduceat(docs[order], begins) > np.minimum.reduceat(docs[order], begins)
            several[order] = np.repeat(differ, np.diff(np.append(begins, len(seed))))
        shared = _among(seed, elsewhere)
        kept = several | shared
        first, count, docs, shared = first[kept], count[kept], docs[kept], shared[kept]
        # Runs that follow each other make one region.
        joins = np.zeros(len(first), bool)
        joins[1:] = (first[1:] == first[:-1] + count[:-1]) & (docs[1:] == docs[:-1])
        heads = np.flatnonzero(~joins)
        tail = LENGTH - 1
        sizes = np.add.reduceat(count, heads) + tail if len(heads) else count
        self.region = self.data[ranges(first[heads], sizes)]
        real = np.ones(len(self.region), bool)
        real[ranges(np.cumsum(sizes) - tail, np.full(len(sizes), tail))] = False
        self.at = np.flatnonzero(real)  # place of each string in the region text, and in the shard
        self.where = ranges(first, count)
        self.doc = np.repeat(docs, count)
        # Only strings whose seeds are elsewhere are asked about.
        self.asked = np.repeat(shared, count)
        self.names = _doubled(self.region, (32, 16, 2))[self.at] if len(self.at) else np.zeros(0, np.uint64)
        self.keys = distinct(self.names[self.asked])

    def earlier_here(self) -> np.ndarray:
        """Whether a document before the string's own in this shard has the string, by the suffix array."""
        if not len(self.at):
            return np.zeros(0, bool)
        order = suffix_array(self.region)
        new = common_prefixes(self.region, order) < LENGTH
        new[0] = True
        doc = np.full(len(self.region), _NO_DOC)
        doc[self.at] = self.doc
        first = np.minimum.reduceat(doc[order], np.flatnonzero(new))
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        return first[group[self.at]] < self.doc

    def covered(self, earlier: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Whether each byte is covered, given ``earlier_here`` and the keys that a lower shard has (sorted)."""
        earlier = earlier | (self.asked & _among(self.names, lower))
        change = np.zeros(len(self.data) + 1, np.int32)
        start = self.where[earlier]
        np.add.at(change, start, 1)
        np.add.at(change, start + LENGTH, -1)
        return np.cumsum(change[:-1]) > 0


def _among(values: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    if not len(chosen):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(chosen, values), len(chosen) - 1)
    return chosen[at] == values


def _parts(values: np.ndarray, groups: int) -> list[np.ndarray]:
    """Sorted numbers dealt by hash; each part is sorted."""
    part = (mix(values) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(groups + 1))
    values = values[order]
    return [values[a:b] for a, b in zip(bounds, bounds[1:])]


def _answers(table: pa.Table, kind: int) -> list[dict]:
    return [row for row in table.to_pylist() if row["kind"] == kind]


def _shard(texts: pa.Table, side: pa.Table) -> Shard:
    ids, rows = unpacked(texts)
    copies = [np.frombuffer(row["blob"], np.int64) for row in _answers(side, _COPIES)]
    return Shard(ids.to_numpy(), rows, np.concatenate(copies) if copies else np.zeros(0, np.int64))


def _elsewhere(shard: Shard, side: pa.Table, groups: int) -> np.ndarray:
    """The shard's seeds (sorted) that another shard has, up to chance agreement of 32 bits."""
    answers = {row["part"]: np.frombuffer(row["blob"], np.uint32) for row in _answers(side, _SEEDS)}
    found = [
        own[_among(own.astype(np.uint32), answers[part])]
        for part, own in enumerate(_parts(shard.seeds(), groups))
        if len(own)
    ]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _low_bits(parts: list[np.ndarray]) -> list[np.ndarray]:
    """Seeds only select text, so 32 bits beside the part are enough; a chance agreement selects a little more."""
    return [np.sort(part.astype(np.uint32)) for part in parts]


_SENT = "part INT, shard INT, blob BINARY"
_SIDE = "shard INT, kind INT, part INT, blob BINARY"


def _sent(shard: int, parts: list[np.ndarray]) -> pa.Table:
    filled = [i for i, part in enumerate(parts) if len(part)]
    return pa.table(
        {
            "part": pa.array(filled, pa.int32()),
            "shard": pa.array([shard] * len(filled), pa.int32()),
            "blob": pa.array([parts[i].tobytes() for i in filled], pa.binary()),
        }
    )


def _side(shards, kind, part, blobs) -> pa.Table:
    return pa.table(
        {
            "shard": pa.array(shards, pa.int32()),
            "kind": pa.array([kind] * len(shards), pa.int32()),
            "part": pa.array([part] * len(shards), pa.int32()),
            "blob": pa.array(blobs, pa.binary()),
        }
    )


def _runs_of(table: pa.Table, kind) -> tuple[list[int], list[np.ndarray]]:
    rows = sorted(table.select(["shard", "blob"]).to_pylist(), key=lambda row: row["shard"])
    return [row["shard"] for row in rows], [np.frombuffer(row["blob"], kind) for row in rows]


def _repeated_seeds(table: pa.Table) -> pa.Table:
    """For each shard its seeds that another shard has too."""
    shards, runs = _runs_of(table, np.uint32)
    values = np.sort(np.concatenate(runs))
    values = distinct(values[1:][values[1:] == values[:-1]])
    return _side(shards, _SEEDS, table.column("part")[0].as_py(), [run[_among(run, values)].tobytes() for run in runs])


def _lower_bits(table: pa.Table) -> pa.Table:
    """For each shard, which of its strings a lower shard has. Negative parts carry a shard's own results through."""
    part = table.column("part")[0].as_py()
    if part < 0:
        return _side(table.column("shard").to_pylist(), _LOCAL, part, table.column("blob").to_pylist())
    shards, runs = _runs_of(table, np.uint64)
    merged = np.concatenate(runs)
    order = np.argsort(merged, kind="stable")  # lower shards first
    merged = merged[order]
    new = np.append(True, merged[1:] != merged[:-1])
    owner = np.repeat(shards, [len(run) for run in runs])[order][new]
    merged = merged[new]
    bits = [np.packbits(owner[np.searchsorted(merged, run)] < shard).tobytes() for shard, run in zip(shards, runs)]
    return _side(shards, _BITS, part, bits)


def shard_bounds(documents: DataFrame, shard_bytes: int) -> list[int]:
    """Upper ends of the id ranges of all shards but the last."""
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-total // shard_bytes))
    shares = [i / shards for i in range(1, shards)]
    bounds = documents.agg(F.percentile_approx("doc_id", shares, 20 * shards)).first()[0]
    return sorted(set(bounds or []))


def removed_spans(documents: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, the covered ``spans`` (array of byte ``start`` and ``stop``), and
    ``kept``, the remaining bytes.

    A byte is covered if it lies in a string of 50 bytes that also starts in a document with a smaller ``doc_id``.
    Reads ``doc_id`` and ``text``; NULL texts are empty. Rows with equal ids do not cover each other, and rows with NULL
    ``doc_id`` neither cover nor are covered.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = rows.filter("doc_id IS NOT NULL")
    bounds = np.array(shard_bounds(known, shard_bytes), np.int64)
    groups = len(bounds) + 1
    wide = f"doc_id BIGINT, n_bytes BIGINT, spans ARRAY<STRUCT<start: BIGINT, stop: BIGINT>>, kept BINARY"

    def shard_of(batch):
        return np.searchsorted(bounds, batch.column("doc_id").to_numpy(), side="left")

    def copy_blobs(batches):
        for batch in batches:
            ids, shard = batch.column("doc_id").to_numpy(), shard_of(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard.astype(np.int32)),
                    pa.array(np.full(len(ids), _COPIES, np.int32)),
                    pa.array(np.zeros(len(ids), np.int32)),
                    pa.array([number.tobytes() for number in ids], pa.binary()),
                ],
                names=["shard", "kind", "part", "blob"],
            )

    texts = packed(known, shard_of)
    hashed = known.select("doc_id", F.sha2("text", 256).alias("hash")).filter("hash IS NOT NULL")
    heads = hashed.groupBy("hash").agg(F.min("doc_id").alias("first"))
    copies = hashed.join(heads, "hash").filter("doc_id > first").select("doc_id").mapInArrow(copy_blobs, _SIDE)

    def ask_seeds(key, left, right):
        shard = key[0].as_py()
        return _sent(shard, _low_bits(_parts(_shard(left, right).seeds(), groups)))

    def ask_strings(key, left, right):
        shard, number = _shard(left, right), key[0].as_py()
        shard.choose(_elsewhere(shard, right, groups))
        local = _side([number], _LOCAL, -1 - number, [np.packbits(shard.earlier_here()).tobytes()])
        return pa.concat_tables([_sent(number, _parts(shard.keys, groups)), local.select(["part", "shard", "blob"])])

    def mark(key, left, right):
        shard = _shard(left, right)
        shard.choose(_elsewhere(shard, right, groups))
        local = np.frombuffer(_answers(right, _LOCAL)[0]["blob"], np.uint8)
        earlier = np.unpackbits(local, count=len(shard.at)).astype(bool)
        bits = {row["part"]: row["blob"] for row in _answers(right, _BITS)}
        lower = []
        for part, keys in enumerate(_parts(shard.keys, groups)):
            if len(keys):
                flags = np.unpackbits(np.frombuffer(bits[part], np.uint8), count=len(keys)).astype(bool)
                lower.append(keys[flags])
        covered = shard.covered(earlier, np.sort(np.concatenate(lower)) if lower else shard.keys[:0])
        return _marked(shard, covered)

    def asked(ask, side):
        return texts.groupBy("shard").cogroup(side.groupBy("shard")).applyInArrow(ask, _SENT)

    seeds = asked(ask_seeds, copies).groupBy("part").applyInArrow(lambda table: _repeated_seeds(table), _SIDE)
    side = copies.unionAll(seeds)
    bits = asked(ask_strings, side).groupBy("part").applyInArrow(lambda table: _lower_bits(table), _SIDE)
    marked = texts.groupBy("shard").cogroup(side.unionAll(bits).groupBy("shard")).applyInArrow(mark, wide)
    alone = rows.filter("doc_id IS NULL").select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.expr("CAST(array() AS ARRAY<STRUCT<start: BIGINT, stop: BIGINT>>)").alias("spans"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("kept"),
    )
    return marked.unionAll(alone)


def _marked(shard: Shard, covered: np.ndarray) -> pa.Table:
    sizes, spans, kept = [], [], []
    ends = shard.ends.tolist()
    for i, text in enumerate(shard.texts):
        sizes.append(len(text))
        if shard.copy[i]:
            whole = len(text) >= LENGTH
            spans.append([{"start": 0, "stop": len(text)}] if whole else [])
            kept.append(b"" if whole else text)
            continue
        own = covered[ends[i] - len(text) : ends[i]]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
        spans.append([{"start": a, "stop": b} for a, b in edges.reshape(-1, 2).tolist()])
        kept.append(np.frombuffer(text, np.uint8)[~own].tobytes() if len(edges) else text)
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    return pa.table(
        {
            "doc_id": pa.array(shard.ids),
            "n_bytes": pa.array(sizes, pa.int64()),
            "spans": pa.array(spans, span),
            "kept": pa.array(kept, pa.binary()),
        }
    )


def digest(spans: DataFrame) -> DataFrame:
    """The contract's columns from ``removed_spans``."""
    return spans.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def brute_force(documents: list[tuple[int, str | None]]) -> list[tuple]:
    """The same rows as ``digest``, by a dictionary of all strings; for tests."""
    first: dict[bytes, int] = {}
    texts = [(doc, (text or "").encode()) for doc, text in documents]
    for doc, text in texts:
        for i in range(len(text) - LENGTH + 1):
            string = text[i : i + LENGTH]
            first[string] = min(doc, first.get(string, doc))
    rows = []
    for doc, text in texts:
        covered = bytearray(len(text))
        for i in range(len(text) - LENGTH + 1):
            if first[text[i : i + LENGTH]] < doc:
                covered[i : i + LENGTH] = b"\x01" * LENGTH
        kept = bytes(b for b, c in zip(text, covered) if not c)
        runs = sum(1 for i, c in enumerate(covered) if c and not (i and covered[i - 1]))
        rows.append((doc, len(text), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return rows
