"""Passages that several documents share, also with changes in them, by collinear chaining.

1. *Seeds.* Of every ``WINDOW`` neighbouring k-mers of words the one with the least hash is a seed, so any run of
   ``K + WINDOW - 1`` words that two documents share holds a shared seed. Shards of documents (ranges of ids) send their
   distinct seeds with the first and last place of each to merging groups, which answer with the first place in the
   whole corpus, the seed's *anchor*, and the last place below the shard. Every later occurrence is matched to the anchor
   and to the document before its own that holds the seed, not to all others, so there are at most two matches for each
   occurrence, and a seed is one row per shard however frequent it is. The ``MIN_WORDS`` words from a seed on are
   exchanged in the same way: their first place matches all seeds within them, so a passage whose pieces occur in
   different earlier documents is matched to the first document that holds so much of it in one piece.
   Seeds in ``MANY`` documents or more have other earlier occurrences than these. All of them are compared by the
   ``AROUND`` words on either side, in blocks, and each occurrence is matched to those that no other surpasses, the
   first document of equal ones; occurrences in the same words are one class, matched to its first.
2. *Chains.* Matches of a document with one anchor document that follow each other on one diagonal are a run. Runs are
   chained: the best sequence that rises in both, where a run gains its words and a gap costs in proportion to its length
   in both documents. Prefix maxima in a Fenwick tree give the best predecessor of each run.
   With the place of a seed goes its *sign*, two bits of each word around it. Words whose bits differ are not equal, so a
   chain whose gaps and signs leave room for too few equal words can be no passage and ends here.
3. *Alignment.* The words of a chain's stretch in the anchor document are fetched from its shard, once for all chains
   that name the same stretch. Words between runs are aligned, the ends are extended while they agree, and passages
   that are long and alike enough remain, of those with few anchors in their chain only such as lie in no other.

Exact copies of an earlier text are found by their hash beforehand.
"""

import hashlib
from bisect import bisect_right
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import offsets_of, pieces, ranges, texts_of
from tillroll.llm.shards import packed, unpacked
from tillroll.llm.suffix_dedup import shard_bounds
from tillroll.llm.word_hashing import hashed_words, mix, windows, word_counts
from tillroll.sinks.scratch import materialise

K = 4
WINDOW = 8
#: Words of a gap that cost as much as one matched word gains, in both documents together.
GAP_WORDS = 20
#: A longer gap ends a passage.
MAX_GAP = 60
MIN_WORDS = 40
MIN_IDENTITY = 0.8
SHARD_BYTES = 8 << 20
#: With this many documents a seed has occurrences besides the first and the one before.
MANY = 4
#: Words on either side of a seed by which its occurrences are compared, and how many of both must be equal.
AROUND, ALIKE = 20, 16
#: Documents of a seed whose occurrences a task holds at a time, occurrences compared with all of them at a time.
BLOCK, TILE = 8192, 256
#: Seeds with so many occurrences are compared together, so many pairs at a time.
FEW, PAIRS = 64, 1 << 16

#: Words that a chain may gain at either end: a seed in the middle of a passage of the least length reaches both.
_EXTEND = MIN_WORDS // 2
_DROP = 5
#: A sign has so many bits of each word in as many numbers, of so many bytes each.
_PLANES, _SIGN = 2, -(-2 * _EXTEND // 8)
_LAST = np.uint64(np.iinfo(np.uint64).max)


class Words:
    """Hashed words of a shard's documents in order of id, without those that ``copies`` names."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], copies: np.ndarray):
        order = np.argsort(ids, kind="stable")
        order = order[~np.isin(ids[order], copies)]
        self.ids = ids[order]
        words = hashed_words([texts[i].lower() for i in order.tolist()])
        self.hashes, self.offsets = words.hashes, words.offsets
        #: The document of each word, by its number.
        self.text = np.repeat(np.arange(len(self.ids), dtype=np.int32), np.diff(self.offsets))

    @cached_property
    def grams(self) -> np.ndarray:
        """Hash of the k-mer from each word on, also of such as go beyond a document."""
        return windows(self.hashes, K)

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash and place of each seed."""
        if not len(self.grams):
            return self.grams, np.zeros(0, np.int64)
        inside = self.text[: len(self.grams)] == self.text[K - 1 :]
        values = np.where(inside, self.grams, _LAST)
        around = np.concatenate([np.full(WINDOW - 1, _LAST), values, np.full(WINDOW - 1, _LAST)])
        least = _sliding(around, np.minimum)
        # A k-mer is a seed if it is the least of any window around it.
        chosen = np.flatnonzero(inside & (_sliding(least, np.maximum) == values))
        return values[chosen], chosen

    def long_seeds(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``MIN_WORDS`` words from each seed's place on, where so many follow, and that place."""
        at = chosen[chosen + MIN_WORDS <= self.offsets[self.text[chosen] + 1]]
        values = np.full(len(at), MIN_WORDS, np.uint64)
        for i in [*range(0, MIN_WORDS - K, K), MIN_WORDS - K]:
            values = mix((values ^ self.grams[at + i]) + np.uint64(i))
        return values, at

    @cached_property
    def _planes(self) -> list[np.ndarray]:
        """A bit of each of ``_EXTEND`` words as one number, the first of them so many words before the first; for all planes."""
        out = []
        for plane in range(_PLANES):
            bits = np.zeros(len(self.hashes) + 2 * _EXTEND + K, np.uint32)
            bits[_EXTEND : _EXTEND + len(self.hashes)] = (self.hashes >> np.uint64(32 + plane)) & np.uint64(1)
            count, done, size = len(bits) - _EXTEND + 1, 0, 1
            sums = np.zeros(count, np.uint32)
            while size <= _EXTEND:
                if _EXTEND & size:
                    sums |= bits[done : done + count] << np.uint32(done)
                    done += size
                bits = bits[:-size] | (bits[size:] << np.uint32(size))
                size *= 2
            out.append(sums)
        return out

    def signs(self, at: np.ndarray) -> np.ndarray:
        """Bits of the ``_EXTEND`` words before and after the k-mer at each place; they may belong to other documents."""
        out = np.empty((len(at), _PLANES), np.uint64)
        for plane, bits in enumerate(self._planes):
            out[:, plane] = bits[at] | (bits[at + K + _EXTEND].astype(np.uint64) << np.uint64(_EXTEND))
        return out

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document and word number of places."""
        text = self.text[at]
        return self.ids[text], at - self.offsets[text]


def _sliding(values: np.ndarray, best) -> np.ndarray:
    size, level = 1, values
    while 2 * size <= WINDOW:
        level = best(level[:-size], level[size:])
        size *= 2
    rest = WINDOW - size
    return best(level[: len(level) - rest], level[rest:]) if rest else level


def best_chains(x: np.ndarray, y: np.ndarray, lengths: np.ndarray | None = None) -> list[list[int]]:
    """Disjoint chains of matches ``(x, y)``, best first; both coordinates rise along a chain.

    A match may be a run of seeds on one diagonal, whose last seed begins ``lengths`` words after its first; the next match
    of a chain begins after that. The score of a match is its words plus the best ``score - gap`` of the matches before it.
    Since the gap cost is a difference of coordinate sums, that best is a prefix maximum over ``y``.
    """
    count = len(x)
    lengths = np.zeros(count, np.int64) if lengths is None else lengths
    end_x, end_y = x + lengths, y + lengths
    ranks = np.unique(np.concatenate([y, end_y]), return_inverse=True)[1].tolist()
    totals, end_totals = ((x + y) / GAP_WORDS).tolist(), ((end_x + end_y) / GAP_WORDS).tolist()
    gains = (K + lengths).tolist()
    tree: list[tuple[float, int]] = [(-np.inf, -1)] * (max(ranks) + 2)
    scores, previous = [0.0] * count, [-1] * count
    # Beginnings ask before ends of the same place enter.
    events = np.lexsort((np.repeat([0, 1], count), np.concatenate([x, end_x])))
    for event in events.tolist():
        if event < count:
            node, best = ranks[event], (-np.inf, -1)  # ranks below this one
            while node:
                if tree[node] > best:
                    best = tree[node]
                node &= node - 1
            gain = best[0] - totals[event]
            scores[event] = gains[event] + max(0.0, gain)
            previous[event] = best[1] if gain > 0 else -1
        else:
            node, i = ranks[event] + 1, event - count
            entry = (scores[i] + end_totals[i], i)
            while node < len(tree):
                if entry > tree[node]:
                    tree[node] = entry
                node += node & -node
    used, chains = [False] * count, []
    for i in np.argsort(-np.array(scores), kind="stable").tolist():
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            if chain and max(x[chain[-1]] - end_x[i], y[chain[-1]] - end_y[i]) > MAX_GAP:
                chains.append(chain[::-1])
                chain = []
            chain.append(i)
            i = previous[i]
        if chain:
            chains.append(chain[::-1])
    return chains


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Words of the longest common subsequence of two short sequences."""
    if not len(a) or not len(b):
        return 0
    if len(a) == len(b) and (a == b).all():
        return len(a)
    row = np.zeros(len(b) + 1, np.int64)
    for word in a:
        fresh = row.copy()
        fresh[1:] = np.maximum(row[1:], row[:-1] + (b == word))
        row = np.maximum.accumulate(fresh)
    return int(row[-1])


def _extended(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How far two sequences go on alike, and the equal words on the way."""
    size = min(len(a), len(b))
    equal = a[:size] == b[:size]
    score = np.cumsum(np.where(equal, 1, -1))
    worst = np.flatnonzero(np.maximum.accumulate(np.maximum(score, 0)) - score >= _DROP)
    score = score[: worst[0]] if len(worst) else score
    if not len(score) or score.max() <= 0:
        return 0, 0
    far = int(score.argmax()) + 1
    return far, int(equal[:far].sum())


def align(
    own: np.ndarray, other: np.ndarray, x: np.ndarray, y: np.ndarray, sizes: np.ndarray
) -> tuple[int, int, int, int, int]:
    """Aligns two stretches along a chain of runs ``(x, y)`` of ``sizes`` words; the bounds in both and the matched words."""
    matched, end_x, end_y = 0, int(x[0]), int(y[0])
    for a, b, size in zip(x.tolist(), y.tolist(), sizes.tolist()):
        # Words of the run that an earlier one has covered already do not count again.
        skip = max(0, end_x - a, end_y - b)
        if skip >= size:
            continue
        matched += _common(own[end_x : a + skip], other[end_y : b + skip])
        end_x, end_y = a + size, b + size
        matched += int((own[a + skip : end_x] == other[b + skip : end_y]).sum())
    right, more = _extended(own[end_x:], other[end_y:])
    left, before = _extended(own[: int(x[0])][::-1], other[: int(y[0])][::-1])
    return int(x[0]) - left, end_x + right, int(y[0]) - left, end_y + right, matched + more + before


def _extended_all(own, at, other, ref_at, room, step) -> tuple[np.ndarray, np.ndarray]:
    """``_extended`` for many places of two arrays, forwards or backwards (``step``) by at most ``room`` words each."""
    places = np.arange(_EXTEND)
    inside = places < room[:, None]
    left = np.where(inside, at[:, None] + step * places, 0)
    right = np.where(inside, ref_at[:, None] + step * places, 0)
    equal = inside & (own[left] == other[right]) if len(own) and len(other) else np.zeros(inside.shape, bool)
    score = np.cumsum(np.where(equal, 1, -1), axis=1)
    dropped = np.maximum.accumulate(np.maximum(score, 0), axis=1) - score >= _DROP
    score[np.logical_or.accumulate(dropped, axis=1) | ~inside] = -1
    far = np.where(score.max(axis=1) > 0, score.argmax(axis=1) + 1, 0)
    return far, (equal & (places < far[:, None])).sum(axis=1)


def align_runs(words: pa.Array, ref_words: pa.Array, x: np.ndarray, y: np.ndarray, size: np.ndarray):
    """``align`` for many chains of a single run each: one array per number that it returns."""
    (own, begins), (other, ref_begins) = _numbers(words), _numbers(ref_words)
    low, ref_low = begins[:-1], ref_begins[:-1]
    inner, whose = ranges(low + x, size), np.repeat(np.arange(len(x)), size)
    equal = own[inner] == other[inner + (ref_low + y - low - x)[whose]]
    matched = np.bincount(whose[equal], minlength=len(x))
    end, ref_end = low + x + size, ref_low + y + size
    right, more = _extended_all(own, end, other, ref_end, np.minimum(begins[1:] - end, ref_begins[1:] - ref_end), 1)
    left, before = _extended_all(own, low + x - 1, other, ref_low + y - 1, np.minimum(x, y), -1)
    return x - left, x + size + right, y - left, y + size + right, matched + more + before


def _numbers(blobs: pa.Array, kind=np.uint32) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all blobs end to end, and where those of each begin."""
    data = np.frombuffer(b"".join(blobs.to_pylist()), kind)
    sizes = pc.binary_length(blobs).to_numpy(zero_copy_only=False)
    return data, offsets_of(sizes // np.dtype(kind).itemsize)


def _blobs(numbers: np.ndarray, counts: np.ndarray) -> pa.Array:
    """So many of the numbers as one blob each."""
    ends = offsets_of(counts * numbers.itemsize)
    kind, offsets = (pa.binary(), np.int32) if ends[-1] < 1 << 31 else (pa.large_binary(), np.int64)
    buffers = [None, pa.py_buffer(ends.astype(offsets)), pa.py_buffer(np.ascontiguousarray(numbers))]
    return pa.Array.from_buffers(kind, len(counts), buffers)


_SENT = (
    "part INT, shard INT, seeds BINARY, docs BINARY, places BINARY, mask BINARY, last_docs BINARY, last_places BINARY, numbers BINARY,"
    " signs BINARY, last_signs BINARY"
)
_SIDE = (
    "shard INT, kind INT, part INT, mask BINARY, docs BINARY, places BINARY, last_docs BINARY, last_places BINARY,"
    " often BINARY, numbers BINARY, signs BINARY, last_signs BINARY"
)
_LINKS = (
    "doc_id BIGINT, begin BIGINT, end BIGINT, ref_id BIGINT, ref_shard INT, ref_begin BIGINT, ref_end BIGINT,"
    " xs BINARY, ys BINARY, sizes BINARY, extra INT"
)
_CHAINS = f"{_LINKS}, words BINARY, seed BIGINT, number INT"
_MATCHES = "doc_id BIGINT, ref_id BIGINT, x BIGINT, y BIGINT"
_FETCHED = "ref_id BIGINT, ref_begin BIGINT, ref_end BIGINT, ref_words BINARY"
_HASHED = "doc_id BIGINT, hash BINARY, size BIGINT"
_COPIES, _ANCHORS = range(2)


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"BIGINT": pa.int64(), "INT": pa.int32(), "BINARY": pa.binary(), "DOUBLE": pa.float64()}
    fields = [field.strip().split(" ") for field in schema.split(",")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.table({name: pa.array(values, kinds[kind]) for (name, kind), values in zip(fields, columns)})


def _ordered(numbers: np.ndarray) -> np.ndarray:
    """Stable order of whole numbers from 0 to below 2^32."""
    tagged = np.sort((numbers.astype(np.uint64) << np.uint64(32)) | np.arange(len(numbers), dtype=np.uint64))
    return (tagged & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _ends(seeds: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct seeds, the first and the last place of each, and which of them each seed is."""
    order = np.argsort(seeds)
    if not len(seeds):
        return seeds, places, places, order
    new = np.append(True, seeds[order][1:] != seeds[order][:-1])
    first, sorted_places = np.flatnonzero(new), places[order]
    which = np.empty(len(seeds), np.int64)
    which[order] = np.cumsum(new) - 1
    return seeds[order[first]], np.minimum.reduceat(sorted_places, first), np.maximum.reduceat(sorted_places, first), which


def _documents(which: np.ndarray, docs: np.ndarray, count: int) -> np.ndarray:
    """In how many documents each of ``count`` keys is, of whose occurrences those of one key are in order of document."""
    order = _ordered(which)
    key, doc = which[order], docs[order]
    new = np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))[: len(key)]
    return np.bincount(key[new], minlength=count)


def _short(seeds: np.ndarray) -> np.ndarray:
    return seeds & np.uint64(1) == 0


def _all_seeds(words: Words) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes and places of seeds and, after so many of these, of long seeds; the last bit tells which."""
    seeds, places = words.seeds()
    values, at = words.long_seeds(places)
    hashes = np.concatenate([seeds & ~np.uint64(1), values | np.uint64(1)])
    return hashes, np.concatenate([places, at]), len(seeds)


def _sign_bytes(signs: np.ndarray) -> bytes:
    return np.ascontiguousarray(signs).view(np.uint8).reshape(-1, 8)[:, :_SIGN].tobytes()


def _signs_of(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // _SIGN, 8), np.uint8)
    out[:, :_SIGN] = np.frombuffer(data, np.uint8).reshape(-1, _SIGN)
    return out.view(np.uint64).reshape(-1, _PLANES)


def _fits(own: np.ndarray, other: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words at most are equal on either side of two seeds with these signs, of so many that there can be."""
    equal, every = np.bitwise_and.reduce(~(own ^ other), axis=1), np.uint64((1 << _EXTEND) - 1)
    before, after = (np.minimum(room, _EXTEND).astype(np.uint64) for room in (before, after))
    left = equal & every & (every << (np.uint64(_EXTEND) - before))
    right = (equal >> np.uint64(_EXTEND)) & ((np.uint64(1) << after) - np.uint64(1))
    return np.bitwise_count(left), np.bitwise_count(right)


def _parts(keys: np.ndarray, groups: int) -> list[np.ndarray]:
    order = _ordered(mix(keys) % np.uint64(groups))
    part = (mix(keys[order]) % np.uint64(groups)).astype(np.int64)
    return np.split(order, np.searchsorted(part, np.arange(1, groups)))


def _merge(table: pa.Table) -> pa.Table:
    """For each shard, which of its seeds a lower shard has, the first place of these and the last one below the shard;
    and which of them are in ``MANY`` documents of all shards, and in how many."""
    rows = sorted(table.to_pylist(), key=lambda row: row["shard"])
    seeds, docs = (np.concatenate([np.frombuffer(r[n], t) for r in rows]) for n, t in (("seeds", "u8"), ("docs", "i8")))
    places = np.concatenate([np.frombuffer(row["places"], np.int32) for row in rows])
    later = np.concatenate(
        [np.unpackbits(np.frombuffer(r["mask"], np.uint8), count=len(r["seeds"]) // 8).astype(bool) for r in rows]
    )
    last_docs, last_places, numbers = docs.copy(), places.copy(), np.ones(len(docs), np.int64)
    numbers[later] = np.concatenate([np.frombuffer(row["numbers"], np.int32) for row in rows])
    last_docs[later] = np.concatenate([np.frombuffer(row["last_docs"], np.int64) for row in rows])
    last_places[later] = np.concatenate([np.frombuffer(row["last_places"], np.int32) for row in rows])
    short, signs = _short(seeds), np.zeros((len(seeds), _PLANES), np.uint64)
    signs[short] = np.concatenate([_signs_of(row["signs"]) for row in rows])
    last_signs = signs.copy()
    last_signs[later & short] = np.concatenate([_signs_of(row["last_signs"]) for row in rows])
    order = np.argsort(seeds, kind="stable")  # lower shards first
    new = np.append(True, seeds[order][1:] != seeds[order][:-1])
    first, before = np.empty(len(seeds), np.int64), np.empty(len(seeds), np.int64)
    first[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    before[order] = np.append(order[:1], order[:-1])
    totals = np.empty(len(seeds), np.int32)
    totals[order] = np.add.reduceat(numbers[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    out, begin = [], 0
    for row in rows:
        end = begin + len(row["seeds"]) // 8
        own_totals = totals[begin:end]
        often = own_totals >= MANY
        own = first[begin:end]
        lower = own < begin
        last = before[begin:end][lower]
        blobs = [np.packbits(lower).tobytes(), docs[own[lower]].tobytes(), places[own[lower]].tobytes()]
        blobs += [last_docs[last].tobytes(), last_places[last].tobytes()]
        blobs += [np.packbits(often).tobytes(), own_totals[often].tobytes()]
        signed = lower & short[begin:end]
        blobs += [_sign_bytes(signs[own[signed]]), _sign_bytes(last_signs[before[begin:end][signed]])]
        out.append((row["shard"], _ANCHORS, row["part"], *blobs))
        begin = end
    return _table(_SIDE, out)


def _read(texts: pa.Table, side: pa.Table) -> Words:
    ids, rows = unpacked(texts)
    copies = [np.frombuffer(row["docs"], np.int64) for row in side.to_pylist() if row["kind"] == _COPIES]
    return Words(ids.to_numpy(), rows, np.concatenate(copies) if copies else np.zeros(0, np.int64))


def _before(keys: np.ndarray, own: tuple[np.ndarray, ...], below: tuple[np.ndarray, ...]) -> list[np.ndarray]:
    """Document, place and sign of each occurrence's key in the last document before its own that holds it. ``own`` has
    these of the occurrences, ``below`` of the keys."""
    order = _ordered(keys)
    key, doc = keys[order], own[0][order]
    new = np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])) if len(key) else np.zeros(0, bool)
    before = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0)) - 1
    here = (before >= 0) & (key[before] == key)
    out = []
    for inner, outer in zip(own, below):
        column = outer[keys]
        column[order[here]] = inner[order[before[here]]]
        out.append(column)
    return out


def _chain_shard(words: Words, side: pa.Table, groups: int, bounds: np.ndarray) -> pa.Table:
    seeds, places, short = _all_seeds(words)
    keys, firsts, _, at = _ends(seeds, places)
    anchors = *words.place(firsts), words.signs(firsts)
    # The last place below the shard, or else no other than the anchor.
    below = tuple(column.copy() for column in anchors)
    numbers = np.zeros(len(keys), np.int32)
    answers = {row["part"]: row for row in side.to_pylist() if row["kind"] == _ANCHORS}
    for part, own in enumerate(_parts(keys, groups)):
        if len(own):
            answer = answers[part]
            lower = own[np.unpackbits(np.frombuffer(answer["mask"], np.uint8), count=len(own)).astype(bool)]
            signed = lower[_short(keys[lower])]
            for (doc, place, sign), name in ((anchors, ""), (below, "last_")):
                doc[lower] = np.frombuffer(answer[f"{name}docs"], np.int64)
                place[lower] = np.frombuffer(answer[f"{name}places"], np.int32)
                sign[signed] = _signs_of(answer[f"{name}signs"])
            often = own[np.unpackbits(np.frombuffer(answer["often"], np.uint8), count=len(own)).astype(bool)]
            numbers[often] = np.frombuffer(answer["numbers"], np.int32)
    often = (seeds[:short], places[:short], numbers[at[:short]])
    doc, x = words.place(places)
    own = doc[:short], x[:short], words.signs(places[:short])
    after = words.offsets[words.text[places[:short]] + 1] - places[:short] - K
    matches = []
    for extra, partners in enumerate(([column[at[:short]] for column in anchors], _before(at[:short], own, below))):
        which = np.flatnonzero(own[0] != partners[0])
        ref, y, signs = (column[which] for column in partners)
        fits = _fits(own[2][which], signs, np.minimum(own[1][which], y), after[which])
        matches.append((which, ref, y, np.full(len(which), extra), *fits))
    # A long seed's place stands for those of all seeds within it.
    ref, y, _ = (column[at] for column in anchors)
    long = short + np.flatnonzero(doc[short:] != ref[short:])
    begins = np.searchsorted(places[:short], places[long])
    counts = np.searchsorted(places[:short], places[long] + MIN_WORDS - K, side="right") - begins
    inner, whose = ranges(begins, counts), np.repeat(long, counts)
    any_ = np.full(len(inner), _EXTEND, np.uint8)
    matches.append((inner, ref[whose], y[whose] + places[inner] - places[whose], np.ones(len(inner), np.int64), any_, any_))
    which, ref, y, extra, left, right = (np.concatenate(column) for column in zip(*matches))
    runs = _runs(doc[which], ref, x[which], y, places[which], extra, left, right)
    return pa.concat_tables([_chain_table(words, bounds, *runs), _occurrences(words, *often, runs)])


def _occurrences(words: Words, seeds: np.ndarray, places: np.ndarray, numbers: np.ndarray, runs: tuple) -> pa.Table:
    """Occurrences of seeds in ``MANY`` documents, with 16 bits of each word around them; 0 is beyond the text. Those in
    a run that has all these words need no other partner and are ``extra``, but may be one."""
    often = np.flatnonzero(numbers >= MANY)
    seeds, places, numbers = seeds[often], places[often], numbers[often]
    doc, x = words.place(places)
    low = places - x
    high = words.offsets[words.text[places] + 1]
    around = np.zeros((len(often), 2 * AROUND), np.uint16)
    for column, step in enumerate([*range(-AROUND, 0), *range(K, K + AROUND)]):
        inside = np.flatnonzero((places + step >= low) & (places + step < high))
        # 0 and 1 are no words.
        around[inside, column] = words.hashes[(places + step)[inside]] % np.uint64(65534) + np.uint64(2)
    begins, ends = runs[5] + runs[2], runs[5] + runs[2] + runs[4] + K
    by_begin = np.argsort(begins)
    reach = np.append(-1, np.maximum.accumulate(ends[by_begin]))
    reached = reach[np.searchsorted(begins[by_begin], np.maximum(low, places - AROUND), side="right")]
    covered = reached >= np.minimum(high, places + K + AROUND)
    # Of a document's occurrences in the same words the first will do.
    same = _folded(around)
    order = np.lexsort((x, same, doc, seeds))
    kept = np.append(True, (np.diff(seeds[order]) != 0) | (np.diff(doc[order]) != 0) | (np.diff(same[order]) != 0))
    order = order[kept[: len(order)]]
    columns = {
        "doc_id": doc[order],
        "begin": x[order],
        "extra": covered[order].astype(np.int32),
        "words": _blobs(around[order].reshape(-1), np.full(len(order), 2 * AROUND)),
        "seed": seeds[order].view(np.int64),
        "number": numbers[order],
    }
    return _filled(columns, len(order))


def _folded(around: np.ndarray) -> np.ndarray:
    """One number for the words around each occurrence."""
    out = np.zeros(len(around), np.uint64)
    for column in range(around.shape[1]):
        out = mix(out + around[:, column] + np.uint64(column + 1))
    return out


def _filled(columns: dict, count: int) -> pa.Table:
    """A table with all columns of ``_CHAINS``, NULL where there are none."""
    empty = _table(_CHAINS, [])
    found = {n: pa.array(columns[n]).cast(empty.schema.field(n).type) if n in columns else pa.nulls(count, empty.schema.field(n).type) for n in empty.column_names}
    return pa.table(found)


def _rivals(table: pa.Table) -> pa.Table:
    """Matches of the occurrences of some seeds, block by block, as the module's docstring tells."""
    names = ("seed", "doc_id", "begin", "extra", "low", "high", "blocks")
    seed, doc, x, covered, low, high, blocks = (table.column(name).to_numpy() for name in names)
    around = np.frombuffer(b"".join(table.column("words").to_pylist()), np.uint16).reshape(len(seed), 2 * AROUND)
    order = np.lexsort((x, doc, seed, high, low))
    seed, doc, x, covered, low, high, blocks, around = (
        column[order] for column in (seed, doc, x, covered, low, high, blocks, around)
    )
    places = np.arange(len(seed))
    cut = np.append(True, (np.diff(seed) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0))
    group = np.cumsum(cut) - 1
    # The first occurrence in the same words stands for all of them.
    same = _folded(around)
    order = np.lexsort((places, same, group))
    fresh = np.append(True, (np.diff(group[order]) != 0) | (np.diff(same[order]) != 0))
    first = np.empty(len(seed), np.int64)
    first[order] = order[np.maximum.accumulate(np.where(fresh, places, 0))]
    heads = np.flatnonzero(first == places)
    starts, stops = (np.searchsorted(group[heads], group[heads], side=side) for side in ("left", "right"))
    own, heads_doc, seeking = around[heads], doc[heads], covered[heads] == 0
    other = np.where(own == 0, np.uint16(1), own)
    found = []

    def keep(i, j, left, right):
        """Of the occurrences that each was compared with, those that no other surpasses on both sides."""
        alike = np.flatnonzero((left + right >= ALIKE) & (heads_doc[i] > heads_doc[j]))
        i, j, left, right = i[alike], j[alike], left[alike].astype(np.int64), right[alike].astype(np.int64)
        order = np.lexsort((j, -right, -left, i))
        value = i[order] * 64 + right[order]
        order = order[np.append(True, value[1:] > np.maximum.accumulate(value)[:-1])[: len(order)]]
        found.append((i[order], j[order]))

    few = np.flatnonzero(seeking & (stops - starts <= FEW) & (starts < np.arange(len(heads))))
    ends = np.cumsum(few - starts[few])
    for some in np.split(few, np.searchsorted(ends, np.arange(PAIRS, ends[-1] if len(ends) else 0, PAIRS))):
        i, j = np.repeat(some, some - starts[some]), ranges(starts[some], some - starts[some])
        equal = own[i] == other[j]
        keep(i, j, equal[:, :AROUND].sum(axis=1), equal[:, AROUND:].sum(axis=1))
    for start in np.flatnonzero((starts == np.arange(len(heads))) & (stops - starts > FEW)).tolist():
        seekers = start + np.flatnonzero(seeking[start : stops[start]])
        for begin in range(0, len(seekers), TILE):
            mine = seekers[begin : begin + TILE]
            all_before = slice(start, int(mine[-1]))
            left, right = (_equal(own[mine, side], other[all_before, side]) for side in (slice(0, AROUND), slice(AROUND, None)))
            limits = np.searchsorted(heads_doc[all_before], heads_doc[mine])
            row, column = _unsurpassed(left, right, limits)
            keep(mine[row], start + column, left[row, column], right[row, column])
    mine, theirs = (np.concatenate([pair[side] for pair in found] or [heads[:0]]) for side in (0, 1))
    still = np.flatnonzero(covered == 0)
    mine, theirs = np.append(heads[mine], still), np.append(heads[theirs], first[still])
    # The first place and the one before are matched already, as can be told where a seed has one block.
    begins = np.maximum.accumulate(np.where(cut, places, 0))
    before = np.maximum.accumulate(np.where(cut | np.append(True, np.diff(doc) != 0), places, 0)) - 1
    known = (blocks[mine] == 1) & ((theirs == begins[mine]) | (theirs == before[mine]))
    new = (doc[theirs] < doc[mine]) & ~known
    mine, theirs = mine[new], theirs[new]
    return pa.table({"doc_id": doc[mine], "ref_id": doc[theirs], "x": x[mine], "y": x[theirs]})


def _unsurpassed(left: np.ndarray, right: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns, below each row's limit, of pairs that are alike enough, without most of those that another pair
    of the row equals or surpasses on both sides."""
    total = left + right
    low = int(limits.min())
    total[:, low:][np.arange(low, total.shape[1]) >= limits[:, None]] = 0
    rows = np.flatnonzero(total.max(axis=1, initial=0) >= ALIKE)
    left, right, total = left[rows], right[rows], total[rows]
    open_, every = total >= ALIKE, np.arange(len(rows))
    for weights in ((1, 1), (64, 1), (1, 64)):
        if not len(rows):
            break
        value = left * np.uint16(weights[0]) + right * np.uint16(weights[1])
        best = np.where(open_, value, 0).argmax(axis=1)  # the first of equal ones
        below = (left <= left[every, best][:, None]) & (right <= right[every, best][:, None])
        open_ &= ~below
        open_[every, best] = True
    row, column = np.nonzero(open_)
    return rows[row], column


def _equal(mine: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Equal words of each two rows."""
    out = np.zeros((len(mine), len(other)), np.uint8)
    for a, b in zip(np.ascontiguousarray(mine.T), np.ascontiguousarray(other.T)):
        out += a[:, None] == b
    return out


def _rival_chains(table: pa.Table, bounds: np.ndarray) -> pa.Table:
    """Chains of the matches of some documents; their words are still to be fetched."""
    numbers = np.array([table.column(name).to_numpy() for name in ("doc_id", "ref_id", "x", "y")], np.int64)
    any_ = np.full(numbers.shape[1], _EXTEND, np.uint8)
    return _chain_table(None, bounds, *_runs(*numbers, numbers[2], np.ones(numbers.shape[1], np.int64), any_, any_)).select(
        [field.split(" ")[0] for field in _LINKS.split(", ")]
    )


def _runs(doc, ref, x, y, places, extra, left, right):
    """Matches, each counted once, that follow each other on one diagonal as one run: its document, anchor document, first
    place in both, the words from its first to its last seed, the place of its document's first word, its seeds and how
    many are extra, and how many words at most are equal before the first seed and after the last."""
    ranks, other_ranks = (np.unique(column, return_inverse=True)[1] for column in (doc, ref))
    pair = ranks * (len(ref) + 1) + other_ranks
    line = ((y - x + (1 << 31)).astype(np.uint64) << np.uint64(32)) | (x.astype(np.uint64) << np.uint64(1))
    order = np.lexsort((line | extra.astype(np.uint64), pair))
    pair, line = pair[order], line[order]
    fresh = np.append(True, (pair[1:] != pair[:-1]) | (line[1:] != line[:-1]))[: len(order)]
    order, pair, diagonal = order[fresh], pair[fresh], line[fresh] >> np.uint64(32)
    doc, ref, x, y, places, extra, left, right = (
        column[order] for column in (doc, ref, x, y, places, extra, left, right)
    )
    same = (pair[1:] == pair[:-1]) & (diagonal[1:] == diagonal[:-1]) & (x[1:] - x[:-1] <= WINDOW)
    first = np.flatnonzero(np.append(True, ~same)) if len(x) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(x)))
    extras = np.add.reduceat(extra, first) if len(first) else extra
    last = first + counts - 1
    order = np.lexsort((y[first], x[first], ref[first], doc[first]))
    columns = doc[first], ref[first], x[first], y[first], x[last] - x[first], places[first] - x[first], counts, extras
    return tuple(column[order] for column in (*columns, left[first], right[last]))


def _chain_table(words: Words | None, bounds: np.ndarray, doc, ref, x, y, lengths, base, seeds, extras, left, right) -> pa.Table:
    """The chains of each document's runs with each anchor document that may be passages; without ``words`` they may end
    beyond the text."""
    if not len(doc):
        return _table(_CHAINS, [])
    cuts = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (ref[1:] != ref[:-1])))
    ends = np.append(cuts[1:], len(doc))
    alone = cuts[ends - cuts == 1]
    # A passage of a single run has no other equal words than these.
    enough = lengths + K + left + right >= MIN_IDENTITY * MIN_WORDS
    members, counts = alone[enough[alone]].tolist(), [1] * int(enough[alone].sum())
    possible = enough.tolist()
    for a, b in zip(cuts[ends - cuts > 1].tolist(), ends[ends - cuts > 1].tolist()):
        for chain in best_chains(x[a:b], y[a:b], lengths[a:b]):
            if len(chain) > 1 or possible[a + chain[0]]:
                members.extend(a + i for i in chain)
                counts.append(len(chain))
    if not members:
        return _table(_CHAINS, [])
    members, counts = np.array(members, np.int64), np.array(counts, np.int64)
    kept = _may_be_passages(members, counts, x, y, lengths, left, right)
    members, counts = members[np.repeat(kept, counts)], counts[kept]
    if not len(members):
        return _table(_CHAINS, [])
    offsets = offsets_of(counts)
    head, tail = members[offsets[:-1]], members[offsets[1:] - 1]
    begin, end = np.maximum(0, x[head] - _EXTEND), x[tail] + lengths[tail] + K + _EXTEND
    ref_begin, ref_end = np.maximum(0, y[head] - _EXTEND), y[tail] + lengths[tail] + K + _EXTEND

    def each(numbers):
        return _blobs(numbers.astype(np.int32), counts)

    columns = {
        "doc_id": doc[head],
        "begin": begin,
        "end": end,
        "ref_id": ref[head],
        "ref_shard": np.searchsorted(bounds, ref[head], side="left").astype(np.int32),
        "ref_begin": ref_begin,
        "ref_end": ref_end,
        "xs": each(x[members] - np.repeat(begin, counts)),
        "ys": each(y[members] - np.repeat(ref_begin, counts)),
        "sizes": each(lengths[members] + K),
        "extra": (2 * np.add.reduceat(extras[members], offsets[:-1]) > np.add.reduceat(seeds[members], offsets[:-1])).astype(np.int32),
    }
    if words is not None:
        text = np.searchsorted(words.offsets, base[head], side="right") - 1
        size = np.minimum(words.offsets[text + 1] - base[head], end) - begin
        columns["words"] = _blobs(words.hashes[ranges(base[head] + begin, size)].astype(np.uint32), size)
    return _filled(columns, len(head))


def _may_be_passages(members, counts, x, y, lengths, left, right) -> np.ndarray:
    """Which chains can hold enough equal words: all of their runs, as many as fit between these, and those outside."""
    offsets = offsets_of(counts)
    first, last = members[offsets[:-1]], members[offsets[1:] - 1]
    x_ends, y_ends = x + lengths + K, y + lengths + K
    before = np.append(members[:1], members[:-1])
    gaps = np.minimum(x[members] - x_ends[before], y[members] - y_ends[before])
    gaps[offsets[:-1]] = 0
    inner = np.add.reduceat(lengths[members] + K + gaps, offsets[:-1])
    outer = left[first].astype(np.int64) + right[last]
    core = np.maximum(x_ends[last] - x[first], y_ends[last] - y[first])
    # Words outside that are equal are part of the passage's length as well.
    return (inner + outer >= MIN_IDENTITY * MIN_WORDS) & (inner + outer >= MIN_IDENTITY * (core + outer) - 1e-9)


PASSAGES = (
    "doc_id BIGINT, ref_id BIGINT, begin BIGINT, end BIGINT, ref_begin BIGINT, ref_end BIGINT, matched BIGINT,"
    " identity DOUBLE"
)
_NAMES = [field.split(" ")[0] for field in PASSAGES.split(", ")]


def shared_passages(documents: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Passages of at least ``MIN_WORDS`` words that a document shares with one of a smaller ``doc_id``.

    One row per passage: ``doc_id``, ``ref_id`` (a document in which its seeds occur first, or else one that holds more of
    the passage), word ranges in both (ends excluded), ``matched`` words and ``identity``, their share of the longer range,
    ``MIN_IDENTITY`` or more. Reads ``doc_id`` and ``text``; letters A to Z are compared in lower case. NULL and empty texts
    and rows with NULL ``doc_id`` take no part; rows with equal ids are one document's and not compared. Every document
    that shares ``MIN_WORDS + WINDOW - 1`` words or more verbatim with any earlier one gets a row for them; passages that
    are shorter or changed can be missed where no ``K`` words between two changes are a seed, or where changes crowd. Partners beyond these follow from their rows with the same ``ref_id``.
    """
    known = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    bounds = np.array(shard_bounds(known, shard_bytes), np.int64)
    groups = len(bounds) + 1

    def shard_of(batch):
        return np.searchsorted(bounds, batch.column("doc_id").to_numpy(), side="left")

    def copy_rows(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            rows = [(int(s), _COPIES, 0, None, i.tobytes(), *[None] * 7) for s, i in zip(shard_of(batch), ids)]
            yield from _table(_SIDE, rows).to_batches()

    def ask(key, left, right):
        if not left.num_rows:
            return _table(_SENT, [])
        words = _read(left, right)
        seeds, at, _ = _all_seeds(words)
        keys, firsts, lasts, which = _ends(seeds, at)
        docs, places = words.place(firsts)
        last_docs, last_places = words.place(lasts)
        several = np.flatnonzero((lasts != firsts)[which])
        numbers = _documents(which[several], words.place(at[several])[0], len(keys))
        out = []
        for part, own in enumerate(_parts(keys, groups)):
            if len(own):
                later = own[lasts[own] != firsts[own]]
                blobs = [keys[own].tobytes(), docs[own].tobytes(), places[own].astype(np.int32).tobytes()]
                blobs += [np.packbits(lasts[own] != firsts[own]).tobytes(), last_docs[later].tobytes()]
                blobs += [last_places[later].astype(np.int32).tobytes(), numbers[later].astype(np.int32).tobytes()]
                for ends, some in ((firsts, own), (lasts, later)):
                    blobs.append(_sign_bytes(words.signs(ends[some[_short(keys[some])]])))
                out.append((part, key[0].as_py(), *blobs))
        return _table(_SENT, out)

    def chain(key, left, right):
        return _chain_shard(_read(left, right), right, groups, bounds) if left.num_rows else _table(_CHAINS, [])

    def fetch(key, left, right):
        if not right.num_rows:
            return _table(_FETCHED, [])
        ids, texts = unpacked(left)
        ref, begin, end = (right.column(name).to_numpy() for name in ("ref_id", "ref_begin", "ref_end"))
        needed = set(ref.tolist())
        kept = [(i, text) for i, text in zip(ids.to_pylist(), texts) if i in needed]
        words = Words(np.array([i for i, _ in kept], np.int64), [text for _, text in kept], np.zeros(0, np.int64))
        text = np.searchsorted(words.ids, ref)
        low, high = words.offsets[text] + begin, np.minimum(words.offsets[text + 1], words.offsets[text] + end)
        stretch = words.hashes[ranges(low, high - low)].astype(np.uint32)
        return pa.table({"ref_id": ref, "ref_begin": begin, "ref_end": end, "ref_words": _blobs(stretch, high - low)})

    def own_shards(batches):
        for batch in batches:
            shard = pa.array(shard_of(batch).astype(np.int32))
            yield pa.RecordBatch.from_arrays([shard, *batch.columns], names=["ref_shard", "ref_id", *batch.schema.names[1:]])

    def align_rows(batches):
        for batch in batches:
            (x, begins), (y, _), (sizes, _) = (_numbers(batch.column(name), np.int32) for name in ("xs", "ys", "sizes"))
            found = np.zeros((5, batch.num_rows), np.int64)
            single = np.diff(begins) == 1
            one, at = batch.filter(pa.array(single)), begins[:-1][single]
            runs = (column[at].astype(np.int64) for column in (x, y, sizes))
            found[:, single] = align_runs(one.column("words"), one.column("ref_words"), *runs)
            for i in np.flatnonzero(~single).tolist():
                own, other = (np.frombuffer(batch.column(name)[i].as_py(), np.uint32) for name in ("words", "ref_words"))
                a, b = begins[i], begins[i + 1]
                found[:, i] = align(own, other, x[a:b], y[a:b], sizes[a:b])
            begin, end, ref_begin, ref_end, matched = found
            longer = np.maximum(end - begin, ref_end - ref_begin)
            good = np.flatnonzero((longer >= MIN_WORDS) & (matched >= MIN_IDENTITY * longer))
            own, other = (batch.column(name).to_numpy()[good] for name in ("begin", "ref_begin"))
            numbers = [begin[good] + own, end[good] + own, ref_begin[good] + other, ref_end[good] + other, matched[good]]
            rows = batch.take(pa.array(good))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("ref_id"),
                    *[pa.array(column) for column in numbers],
                    pa.array(matched[good] / longer[good]),
                    rows.column("extra"),
                ],
                names=[*_NAMES, "extra"],
            )

    def own_passages(batches):
        doc, begins, ends = None, [], []
        for batch in batches:
            taken = []
            for i, row in enumerate(batch.select(["doc_id", "begin", "end", "extra"]).to_pylist()):
                if row["doc_id"] != doc:
                    doc, begins, ends = row["doc_id"], [], []  # of passages that lie in no other, both rising
                at = bisect_right(begins, row["begin"])
                inside = at > 0 and ends[at - 1] >= row["end"]
                if not inside:
                    low = at - 1 if at and begins[at - 1] == row["begin"] else at
                    high = bisect_right(ends, row["end"], lo=low)
                    begins[low:high], ends[low:high] = [row["begin"]], [row["end"]]
                if not (inside and row["extra"]):
                    taken.append(i)
            yield batch.take(pa.array(taken, pa.int64())).drop_columns(["extra"])

    texts = packed(known, shard_of)
    hashed = materialise(known.filter("length(text) > 0").mapInArrow(_hashed, _HASHED), "hashes")
    heads = hashed.groupBy("hash").agg(F.min("doc_id").alias("ref_id"))
    copied = materialise(hashed.join(heads, "hash").filter("doc_id > ref_id").select("doc_id", "ref_id", "size"), "copies")
    copies = copied.select("doc_id").mapInArrow(copy_rows, _SIDE)

    def grouped(left, right, run, schema, key="shard"):
        return left.groupBy("shard").cogroup(right.groupBy(key)).applyInArrow(run, schema)

    anchors = grouped(texts, copies, ask, _SENT).groupBy("part").applyInArrow(lambda table: _merge(table), _SIDE)
    found = materialise(grouped(texts, copies.unionAll(anchors), chain, _CHAINS), "chains")
    columns = [field.split(" ")[0] for field in f"{_LINKS}, words".split(", ")]
    chains = found.filter("seed IS NULL").select(columns)
    # An occurrence goes to each pair of blocks that its own is in; a seed in few documents has one block.
    blocks = F.ceil(F.col("number") / F.lit(BLOCK)).cast("int")
    own, other = F.pmod(F.xxhash64("doc_id"), F.col("blocks")), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = found.filter("seed IS NOT NULL").withColumn("blocks", blocks)
    kept = ["seed", "doc_id", "begin", "extra", "words", "blocks"]
    dealt = dealt.select(*kept, own.cast("int").alias("own"), other.alias("other"))
    dealt = dealt.select(*kept, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    parted = dealt.withColumn("part", F.pmod(F.xxhash64("seed", "low", "high"), F.lit(groups)))
    matches = parted.groupBy("part").applyInArrow(lambda table: _rivals(table), _MATCHES)
    parted = matches.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(groups)))
    rivals = materialise(parted.groupBy("part").applyInArrow(lambda table: _rival_chains(table, bounds), _LINKS), "rivals")
    wanted = rivals.select("doc_id", F.col("begin").alias("ref_begin"), F.col("end").alias("ref_end")).distinct()
    wanted = wanted.mapInArrow(own_shards, "ref_shard INT, ref_id BIGINT, ref_begin BIGINT, ref_end BIGINT")
    own_words = grouped(texts, wanted, fetch, _FETCHED, "ref_shard").toDF("doc_id", "begin", "end", "words")
    chains = chains.unionByName(materialise(rivals.join(own_words, ["doc_id", "begin", "end"]).select(columns), "rival_words"))
    stretches = chains.select("ref_shard", "ref_id", "ref_begin", "ref_end").distinct()
    fetched = grouped(texts, stretches, fetch, _FETCHED, "ref_shard")
    aligned = chains.join(fetched, ["ref_id", "ref_begin", "ref_end"]).mapInArrow(align_rows, f"{PASSAGES}, extra INT")
    least = ["doc_id", "extra", F.expr("begin - end"), "ref_id", "begin", "ref_begin", "ref_end", "matched"]
    arranged = aligned.repartition("doc_id").sortWithinPartitions(*least)
    aligned = arranged.mapInArrow(own_passages, PASSAGES)
    whole = copied.filter(F.col("size") >= MIN_WORDS).select(
        "doc_id",
        "ref_id",
        F.lit(0).cast("long").alias("begin"),
        F.col("size").alias("end"),
        F.lit(0).cast("long").alias("ref_begin"),
        F.col("size").alias("ref_end"),
        F.col("size").alias("matched"),
        F.lit(1.0).alias("identity"),
    )
    return aligned.unionAll(whole)


def _hashed(batches):
    """Hash and number of words of whole texts."""
    for piece in pieces(batches):
        texts = texts_of(piece.column("text"))
        yield pa.RecordBatch.from_arrays(
            [
                piece.column("doc_id"),
                pa.array([hashlib.sha256(text).digest() for text in texts], pa.binary()),
                pa.array(word_counts(texts)),
            ],
            names=["doc_id", "hash", "size"],
        )
