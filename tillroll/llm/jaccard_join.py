"""Similarity join of documents by the Jaccard similarity of their word shingles: a chosen-path join.

1. Documents with equal shingle sets are one set from here on. A set is embedded as a vector of minwise hashes, whose
   agreement estimates the similarity; vectors are small, and all of the search works on them.
2. Every run starts with all sets in one bucket. A bucket is split on sampled shared tokens: a (coordinate, value)
   pair is sampled by a hash of the bucket's path and the pair, so all sets that hold it choose the same child. A set
   goes to 1 / similarity children on average. Buckets of one set are dropped and small buckets are compared by brute
   force. Larger ones are split again, each ``REPEATS`` times over, so that a pair at the threshold is still together
   somewhere with a probability that does not sink with the number of splits. A bucket whose children would be
   more work than itself, such as one whose sets all resemble each other, is compared block by block at once, as is
   what is still large at the last level. Runs are repeated until the chance to have missed a pair, all splits included, is
   below ``1 - recall``.
3. Pairs whose vectors agree well enough link sets to candidate components, as stars and never as all pairs.
4. Within each component the exact similarity of all pairs is computed from the shingles, in blocks of bounded size.
   Only sums per set and spanning links leave a block.
"""

import math
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import pieces, ranges, texts_of
from tillroll.llm.components import components
from tillroll.llm.word_hashing import hashed_words, mix, windows
from tillroll.sinks.scratch import materialise

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.9999
COORDINATES = 64
#: Buckets up to this size are compared by brute force.
SMALL = 256
#: Sets in a block of a larger bucket that is compared whole.
LARGE_BLOCK = 512
LEVELS = 6
#: Splits of each large bucket.
REPEATS = 3
#: A row of the next level is shuffled and stored with its vector, which takes as long as comparing it with about this
#: many others. A bucket is split only where that is less work than to compare it whole.
ROW_WORK = 2048
#: Sets of a component in one block of the exact comparison.
BLOCK = 128

_VECTOR = 4 * COORDINATES


def shingles(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, an empty one has none."""
    words = hashed_words(texts)
    all_windows = windows(words.hashes, size)
    out = []
    for begin, end in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist()):
        if end - begin >= size:
            out.append(np.unique(all_windows[begin : end - size + 1]))
        elif end > begin:
            out.append(windows(words.hashes[begin:end], end - begin))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _seeds(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def vectors(sets: list[np.ndarray]) -> np.ndarray:
    """Minwise hashes of non-empty sets, one row each."""
    sizes = np.array([len(s) for s in sets], np.int64)
    starts = np.append(0, np.cumsum(sizes))[:-1]
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    low = np.concatenate(sets).astype(np.uint32)
    out = np.empty((len(sets), COORDINATES), np.uint32)
    seeds = _seeds(COORDINATES)
    for i in range(COORDINATES):
        # Two multiplications with different halves: a hash of 32 bits, which decides ties by itself.
        mixed = (values ^ np.uint32(seeds[i] >> np.uint64(32))) * np.uint32((int(seeds[i]) | 1) & 0xFFFFFFFF)
        mixed ^= mixed >> np.uint32(16)
        mixed = (mixed + low) * np.uint32(0x85EBCA6B + 2 * i)
        mixed ^= mixed >> np.uint32(13)
        mixed *= np.uint32(0xC2B2AE35)
        out[:, i] = np.minimum.reduceat(mixed, starts)
    return out


def sketches(documents: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id``, the fingerprint of its shingle set (NULL if empty), ``n_shingles`` and the vector."""

    def sketch(batches):
        for piece in pieces(batches):
            sets = shingles(texts_of(piece.column("text")), size)
            filled = [s for s in sets if len(s)]
            rows = iter(vectors(filled) if filled else [])
            fingerprints, blobs = [], []
            for own in sets:
                fingerprints.append(blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                blobs.append(next(rows).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id").cast(pa.int64()),
                    pa.array(fingerprints, pa.binary()),
                    pa.array([len(own) for own in sets], pa.int64()),
                    pa.array(blobs, pa.binary()),
                ],
                names=["doc_id", "fingerprint", "n_shingles", "vector"],
            )

    schema = "doc_id BIGINT, fingerprint BINARY, n_shingles BIGINT, vector BINARY"
    return documents.select("doc_id", "text").mapInArrow(sketch, schema)


def runs_for(recall: float, similarity: float, levels: int = LEVELS, repeats: int = REPEATS) -> int:
    """Runs after which a pair at the threshold has met in a compared bucket with probability ``recall``, if every
    bucket on its way is split until the last level."""
    shared = similarity * COORDINATES
    lost = 0.0
    for _ in range(levels - 1):
        lost = (1 - (1 - lost) / shared) ** (shared * repeats)
    missed = (1 - (1 - lost) / shared) ** shared
    return math.ceil(math.log(1 - recall) / math.log(missed))


def _children(rows: DataFrame, similarity: float, draws: list[int], split: bool) -> DataFrame:
    """Buckets of the next level: ``parent``, ``bucket`` and ``set_id``, for each of ``draws``. With ``split``, ``rows``
    have the ``bucket`` that is split; without, every draw starts a run, whose number is the parent."""
    limit = np.uint64(int(2**64 / (similarity * COORDINATES)))
    places = mix(np.arange(COORDINATES, dtype=np.uint64) + np.uint64(0x1000))

    def choose(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("set_id").to_numpy()
            table = np.frombuffer(b"".join(batch.column("vector").to_pylist()), np.uint32).reshape(-1, COORDINATES)
            tokens = mix(table.astype(np.uint64) + places)
            for draw in draws:
                start = mix(np.array([draw], np.uint64))
                parents = batch.column("bucket").to_numpy() if split else np.full(len(ids), draw, np.int64)
                path = mix(parents.view(np.uint64) ^ start) if split else start
                drawn = mix(tokens ^ path.reshape(-1, 1))
                row, column = np.nonzero(drawn < limit)
                bucket = mix(drawn[row, column] + np.uint64(1)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parents[row]), pa.array(bucket), pa.array(ids[row])], names=["parent", "bucket", "set_id"]
                )

    return rows.mapInArrow(choose, "parent BIGINT, bucket BIGINT, set_id BIGINT")


def _not_worth_splitting(children: DataFrame, parents: DataFrame) -> DataFrame:
    """The ``bucket`` of those ``parents`` (``bucket``, ``members``) whose ``children`` are no less work than they are
    themselves: comparisons, and rows to bring together."""
    sizes = children.groupBy("parent", "bucket").agg(F.count(F.lit(1)).cast("double").alias("held"))
    pairs = F.sum(F.col("held") * F.col("held")) / 2
    work = sizes.groupBy("parent").agg((pairs + ROW_WORK * F.sum("held")).alias("work"))
    met = parents.join(work.withColumnRenamed("parent", "bucket"), "bucket")
    return met.filter(F.col("work") >= F.col("members").cast("double") * F.col("members") / 2).select("bucket")


def _similar(a: np.ndarray, b: np.ndarray, sizes_a, sizes_b, similarity: float) -> np.ndarray:
    """Whether pairs of vectors may belong to sets above the threshold: agreement is less than 4.5 standard
    deviations below it, and the sizes allow it."""
    spread = math.sqrt(COORDINATES * similarity * (1 - similarity))
    least = COORDINATES * similarity - 4.5 * spread
    fits = np.minimum(sizes_a, sizes_b) >= similarity * np.maximum(sizes_a, sizes_b) - 1e-9
    return fits & ((a == b).sum(axis=-1) >= least)


def _stars(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of ``count`` nodes over the given links."""
    label = np.arange(count)
    while len(left):
        low = np.minimum(label[left], label[right])
        fresh = label.copy()
        np.minimum.at(fresh, left, low)
        np.minimum.at(fresh, right, low)
        fresh = fresh[fresh]
        if (fresh == label).all():
            break
        label = fresh
    return label


def _edge_batch(ids: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[label[moved]])], names=["a", "b"])


def _whole_groups(batches, key: str):
    """Tables of sorted batches, cut so that no value of ``key`` is in two of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1], side="left"))
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _compare_small(rows: DataFrame, similarity: float) -> DataFrame:
    """Links within buckets of at most ``SMALL`` sets, as stars."""

    def compare(batches):
        for table in _whole_groups(batches, "bucket"):
            buckets = table.column("bucket").to_numpy()
            ids = table.column("set_id").to_numpy()
            sizes = table.column("n_shingles").to_numpy()
            flat = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.uint32).reshape(-1, COORDINATES)
            ends = np.searchsorted(buckets, buckets, side="right")
            lefts, rights = [], []
            place = np.arange(len(ids))
            # All pairs of a bucket, at most SMALL * 128 of them at a time.
            for begin in range(0, len(ids), 128):
                own = place[begin : begin + 128]
                after = ends[own] - own - 1
                left, right = np.repeat(own, after), ranges(own + 1, after)
                good = _similar(flat[left], flat[right], sizes[left], sizes[right], similarity)
                lefts.append(left[good])
                rights.append(right[good])
            yield _edge_batch(ids, _stars(len(ids), np.concatenate(lefts), np.concatenate(rights)))

    arranged = rows.repartition("bucket").sortWithinPartitions("bucket", "set_id")
    return arranged.mapInArrow(compare, "a BIGINT, b BIGINT").distinct()


def _linked_within(flat: np.ndarray, sizes: np.ndarray, similarity: float) -> np.ndarray:
    """The first vector that each vector is linked to, over other links of the same block where need be."""
    lefts, rights = [], []
    for i in range(len(flat)):
        found = i + 1 + np.flatnonzero(_similar(flat[i], flat[i + 1 :], sizes[i], sizes[i + 1 :], similarity))
        lefts.append(np.full(len(found), i))
        rights.append(found)
    return _stars(len(flat), np.concatenate(lefts), np.concatenate(rights))


def _compare_large(rows: DataFrame, similarity: float) -> DataFrame:
    """Links within buckets of any size: blocks of their sets are packed into one row each, with the links inside, and
    every two blocks of a bucket meet in one row. What is linked inside a block is one there, so that a group in
    which all sets are similar makes a link a set and a link for two blocks."""
    packed_schema = "bucket BIGINT, block INT, blocks INT, ids BINARY, sizes BINARY, labels BINARY, vectors BINARY"

    def pack(batches):
        for table in _whole_groups(batches, "spot"):
            spots = table.column("spot").to_numpy()
            for begin in np.unique(spots, return_index=True)[1].tolist():
                part = table.slice(begin, int(np.searchsorted(spots, spots[begin], side="right")) - begin)
                first = part.select(["bucket", "block", "blocks"]).slice(0, 1).to_pylist()[0]
                sizes = part.column("n_shingles").to_numpy()
                vector = b"".join(part.column("vector").to_pylist())
                labels = _linked_within(np.frombuffer(vector, np.uint32).reshape(-1, COORDINATES), sizes, similarity)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([first["bucket"]]),
                        pa.array([first["block"]], pa.int32()),
                        pa.array([first["blocks"]], pa.int32()),
                        pa.array([part.column("set_id").to_numpy().tobytes()], pa.binary()),
                        pa.array([sizes.tobytes()], pa.binary()),
                        pa.array([labels.astype(np.int64).tobytes()], pa.binary()),
                        pa.array([vector], pa.binary()),
                    ],
                    names=["bucket", "block", "blocks", "ids", "sizes", "labels", "vectors"],
                )

    blocks = F.ceil(F.col("members") / LARGE_BLOCK).cast("int")
    spread = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("spot", F.xxhash64("bucket", "block"))
    packed = (
        spread.select("spot", "bucket", "block", "blocks", "set_id", "n_shingles", "vector")
        .repartition("spot")
        .sortWithinPartitions("spot")
        .mapInArrow(pack, packed_schema)
    )
    packed = materialise(packed, "packed_blocks")
    columns = ("ids", "sizes", "labels", "vectors")
    later = F.explode(F.expr("sequence(block + 1, blocks - 1)"))
    left = packed.filter("block + 1 < blocks").select("bucket", "block", *columns, later.alias("other"))
    right = packed.select("bucket", F.col("block").alias("other"), *[F.col(c).alias(f"other_{c}") for c in columns])

    def inside(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield _edge_batch(*(np.frombuffer(row[c], np.int64) for c in ("ids", "labels")))

    def compare(batches):
        for batch in batches:
            # A row holds two blocks of vectors; one at a time becomes Python objects.
            for place in range(batch.num_rows):
                row = batch.slice(place, 1).to_pylist()[0]
                ids, sizes, labels, other_ids, other_sizes, other_labels = (
                    np.frombuffer(row[f"{side}{c}"], np.int64) for side in ("", "other_") for c in columns[:3]
                )
                flat, other = (np.frombuffer(row[c], np.uint32).reshape(-1, COORDINATES) for c in ("vectors", "other_vectors"))
                lefts, rights = [], []
                for i in range(len(ids)):
                    found = other_labels[_similar(flat[i], other, sizes[i], other_sizes, similarity)]
                    lefts.append(np.full(len(found), labels[i]))
                    rights.append(len(ids) + found)
                both = np.concatenate([ids, other_ids])
                yield _edge_batch(both, _stars(len(both), np.concatenate(lefts), np.concatenate(rights)))

    met = left.join(right, ["bucket", "other"])
    within = packed.select("ids", "labels").mapInArrow(inside, "a BIGINT, b BIGINT")
    across = met.mapInArrow(compare, "a BIGINT, b BIGINT")
    return within.unionAll(across).filter("a <> b").distinct()


def candidate_links(sets: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """Links ``(a, b)`` that connect all sets whose vectors agree; stars within buckets.

    ``sets`` has ``set_id`` (unique), ``n_shingles`` and ``vector``.
    """
    runs = list(range(1, runs_for(recall, similarity) + 1))
    keys = _children(sets.select("set_id", "vector"), similarity, runs, split=False)
    links = []
    for level in range(1, LEVELS + 1):
        keys = materialise(keys.select("bucket", "set_id").distinct() if level > 1 else keys, f"paths-{level}")
        members = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
        live = keys.join(members, "bucket").join(sets, "set_id")
        live = materialise(live.select("bucket", "set_id", "members", "n_shingles", "vector"), f"buckets-{level}")
        links.append(_compare_small(live.filter(F.col("members") <= SMALL), similarity))
        large = live.filter(F.col("members") > SMALL)
        if large.isEmpty():
            break
        # Below this size the rows of the children alone are more work, however they fall.
        whole = F.lit(level == LEVELS) | (F.col("members") <= 2 * ROW_WORK * REPEATS / similarity)
        parents = members.filter((F.col("members") > SMALL) & ~whole)
        links.append(_compare_large(large.filter(whole), similarity))
        large = large.filter(~whole)
        if large.isEmpty():
            break
        children = _children(large.select("bucket", "set_id", "vector"), similarity, list(range(1, REPEATS + 1)), split=True)
        children = materialise(children, f"children-{level}")
        ended = materialise(_not_worth_splitting(children, parents), f"ended-{level}")
        links.append(_compare_large(large.join(ended, "bucket", "left_semi"), similarity))
        keys = children.join(ended.withColumnRenamed("bucket", "parent"), "parent", "left_anti")
    together = links[0]
    for more in links[1:]:
        together = together.unionAll(more)
    return together.distinct()


def _exact(ids, sets, copies, own: int | None, similarity: float):
    """Links of each set in copies of its partners, and the links themselves. With ``own``, only pairs across the
    first ``own`` sets and the others count."""
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    seen = np.bincount(column, minlength=len(tokens))
    shared = seen > 1
    rank = np.cumsum(shared) - 1
    kept = shared[column]
    row, column = row[kept], rank[column[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = 1 << 14
    for begin in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [begin, begin + width])
        dense = np.zeros((len(sets), width), np.float32)
        dense[row[a:b], column[a:b] - begin] = 1
        common += dense @ dense.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = common >= similarity * union - 1e-6
    np.fill_diagonal(linked, False)
    if own is not None:
        linked[:own, :own] = False
        linked[own:, own:] = False
    left, right = np.nonzero(np.triu(linked))
    return linked @ copies, _stars(len(ids), left, right)


def verified_links(
    documents: DataFrame, candidates: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE
) -> DataFrame:
    """Exact links within candidate components: ``set_id``, ``partners`` (documents linked to it) and ``b``, a set that
    it is connected to, for each block comparison with a link.

    ``candidates`` has ``set_id``, ``component`` and ``copies``; ``set_id`` is a ``doc_id`` of ``documents``.
    """
    counts = candidates.groupBy("component").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    chosen = candidates.join(counts, "component").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    chosen = chosen.withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    texts = documents.select(F.col("doc_id").alias("set_id"), "text").join(chosen, "set_id")

    def hashes(batches):
        for piece in pieces(batches):
            blobs = [s.tobytes() for s in shingles(texts_of(piece.column("text")), size)]
            kept = [piece.column(n) for n in ("set_id", "component", "copies", "block", "blocks")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(blobs, pa.binary())],
                names=["set_id", "component", "copies", "block", "blocks", "shingles"],
            )

    schema = "set_id BIGINT, component BIGINT, copies BIGINT, block INT, blocks INT, shingles BINARY"
    sets = texts.select("set_id", "component", "copies", "block", "blocks", "text").mapInArrow(hashes, schema)
    # Each block meets itself and every other block of its component.
    others = F.explode(F.expr("sequence(0, blocks - 1)"))
    meeting = sets.dropDuplicates(["set_id"]).withColumn("other", others).withColumn(
        "spot", F.xxhash64("component", F.least("block", "other"), F.greatest("block", "other"))
    )

    def compare(batches):
        for table in _whole_groups(batches, "spot"):
            spots = table.column("spot").to_numpy()
            ids, copies, block, other = (
                table.column(n).to_numpy() for n in ("set_id", "copies", "block", "other")
            )
            blobs = table.column("shingles").to_pylist()
            for begin in np.unique(spots, return_index=True)[1].tolist():
                end = int(np.searchsorted(spots, spots[begin], side="right"))
                low = min(block[begin], other[begin])
                own = None if block[begin] == other[begin] else int((block[begin:end] == low).sum())
                sets = [np.frombuffer(blob, np.uint64) for blob in blobs[begin:end]]
                partners, label = _exact(ids[begin:end], sets, copies[begin:end], own, similarity)
                found = np.flatnonzero(partners)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[begin:end][found]),
                        pa.array(partners[found]),
                        pa.array(ids[begin:end][label[found]]),
                    ],
                    names=["set_id", "partners", "b"],
                )

    arranged = (
        meeting.select("spot", "set_id", "copies", "block", "other", "shingles")
        .repartition("spot")
        .sortWithinPartitions("spot", "block", "set_id")
    )
    return arranged.mapInArrow(compare, "set_id BIGINT, partners BIGINT, b BIGINT")


def near_duplicates(
    documents: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE, recall: float = RECALL
) -> DataFrame:
    """One row per row of ``documents``: ``doc_id``, ``class_id`` and ``n_links``.

    ``n_links`` counts the other documents whose shingle sets have a Jaccard similarity of ``similarity`` or more,
    copies included; ``class_id`` is the smallest ``doc_id`` that can be reached over such links. Reads ``doc_id``,
    which must identify a text, and ``text``. A text of fewer than ``size`` words is one shingle. NULL and empty texts
    have no shingles and link to nothing, and a row with NULL ``doc_id`` has no class.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    own = materialise(sketches(rows, size), "sketches")
    filled = own.filter("fingerprint IS NOT NULL AND doc_id IS NOT NULL")
    classes = filled.groupBy("fingerprint").agg(F.min("doc_id").alias("set_id"), F.count(F.lit(1)).alias("copies"))
    classes = materialise(classes, "classes")
    heads = classes.select("set_id", "fingerprint", "copies")
    sets = filled.join(heads, "fingerprint").filter("doc_id = set_id").dropDuplicates(["set_id"])
    sets = materialise(sets.select("set_id", "copies", "n_shingles", "vector"), "sets")
    linked = components(candidate_links(sets.drop("copies"), similarity, recall))
    candidates = linked.withColumnRenamed("node", "set_id").join(sets.select("set_id", "copies"), "set_id")
    exact = materialise(verified_links(rows, candidates, similarity, size), "links")
    partners = exact.groupBy("set_id").agg(F.sum("partners").alias("partners"))
    reached = components(exact.select(F.col("set_id").alias("a"), "b")).withColumnRenamed("node", "set_id")
    result = classes.join(partners, "set_id", "left").join(reached, "set_id", "left")
    result = result.select(
        "fingerprint",
        F.coalesce("component", "set_id").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"),
    )
    return (
        own.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("fingerprint")).alias("fingerprint"))
        .join(result, "fingerprint", "left")
        .select(
            "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
        )
    )


def one_of_each(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``documents`` (all columns) without those that have a smaller ``doc_id`` in their class; one row per id.
    Rows with NULL ``doc_id`` stay."""
    heads = near_duplicates(documents, similarity).filter("doc_id = class_id").select("doc_id").distinct()
    kept = documents.join(heads, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionAll(documents.filter("doc_id IS NULL")).select(documents.columns)
