"""Language-model scores by a weighted backoff automaton.

The model is a bigram model with Dirichlet smoothing, p(w | u) = (c(u w) + k p(w)) / (c(u) + k), over the unigram model
p(w) = (c(w) + 1/2) / (N + (V + 1) / 2). As an automaton it has a state for every word that can be a context, one for the
beginning of a text and one for no context. An arc carries the log-probability of a word that was seen after the
state's word; for all other words a failure arc with weight k / (c(u) + k) leads to the state of no context, which has an
arc for every word. A text is scored in one traversal from left to right that carries the state.

The model grows with the corpus, so no task holds all of it. Texts are dealt to shards; each shard counts the words
and bigrams of its training texts and sends the counts of all n-grams that its texts hold, one row for each pair of
shard and counting group. The groups add up and answer every shard with the totals of just its n-grams, from which it
compiles the part of the automaton that its texts can visit. A frequent word is one number per shard in this exchange.
"""

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import offsets_of
from tillroll.llm.language_id import fold
from tillroll.llm.shards import distinct, packed, unpacked
from tillroll.llm.word_hashing import hashed_words, mix

CONCENTRATION = 50.0
SHARD_BYTES = 8 << 20
LEAST_SHARDS = 16

_END, _BEGIN = (mix(np.array([number], np.uint64))[0] for number in (0xE0D, 0xB0B))
_WORDS, _PAIRS, _TOTALS = range(3)
_SENT = "part INT, shard INT, kind INT, keys BINARY, counts BINARY"
_SIDE = "shard INT, kind INT, part INT, counts BINARY, distinct BIGINT, total BIGINT"
_LOW = np.uint64((1 << 48) - 1)
#: Words of a traversal in memory at a time.
_AT_ONCE = 1 << 17


class Sequences:
    """Tokens of a shard's texts, each text with its end, and their predecessors."""

    def __init__(self, texts: list[bytes]):
        words = hashed_words([text.lower() for text in texts])
        sizes = np.diff(words.offsets)
        self.offsets = offsets_of(sizes + 1)
        last = self.offsets[1:] - 1
        inner = np.ones(self.offsets[-1], bool)
        inner[last] = False
        self.tokens = np.full(self.offsets[-1], _END, np.uint64)
        self.tokens[inner] = words.hashes
        self.before = np.append(_BEGIN, self.tokens[:-1]).astype(np.uint64)
        self.before[self.offsets[:-1]] = _BEGIN
        self.pairs = pair_keys(self.before, self.tokens)


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0x9E3779B97F4A7C15) ^ right)


def _parts(keys: np.ndarray, groups: int) -> list[np.ndarray]:
    """Places of sorted keys dealt to groups by hash, ascending within each by the bits that are sent."""
    part = (mix(keys ^ np.uint64(0x5BD1E995)) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return np.split(order, np.searchsorted(part[order], np.arange(1, groups)))


def _counted(sequences: Sequences, training: np.ndarray):
    """Kind, distinct keys and training counts of the words and of the bigrams."""
    weight = np.repeat(training, np.diff(sequences.offsets)).astype(np.float64)
    for kind, values in ((_WORDS, sequences.tokens), (_PAIRS, sequences.pairs)):
        keys, numbers = _numbered(values)
        counts = np.bincount(numbers, weight, len(keys)) if len(keys) else np.zeros(0)
        yield kind, keys, counts.astype(np.int64)


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and the number of each value among them."""
    order = np.argsort(values)
    ascending = values[order]
    new = np.append(True, ascending[1:] != ascending[:-1])[: len(values)]
    numbers = np.empty(len(values), np.int64)
    numbers[order] = np.cumsum(new) - 1
    return ascending[new], numbers


def _squeezed(values: np.ndarray) -> bytes:
    # Bytes of equal weight together: most counts are small.
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _unsqueezed(blob: bytes) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(flat.reshape(8, -1).T).view("<i8").reshape(-1)


def _key_blob(kind: int, keys: np.ndarray) -> bytes:
    """Words are sent by 64 bits, bigrams by 48 bits beside their group."""
    if kind == _WORDS:
        return keys.tobytes()
    return keys.astype(np.uint32).tobytes() + (keys >> np.uint64(32)).astype(np.uint16).tobytes()


def _keys(kind: int, blob: bytes) -> np.ndarray:
    if kind == _WORDS:
        return np.frombuffer(blob, np.uint64)
    count = len(blob) // 6
    low, high = np.frombuffer(blob, np.uint32, count), np.frombuffer(blob, np.uint16, count, 4 * count)
    return (high.astype(np.uint64) << np.uint64(32)) | low


def _merge(table: pa.Table) -> pa.Table:
    """Totals of one group of n-grams, for each shard that asked."""
    rows = table.to_pylist()
    part = rows[0]["part"]
    out = []
    for kind in (_WORDS, _PAIRS):
        asked = [row for row in rows if row["kind"] == kind]
        if not asked:
            continue
        keys = [_keys(kind, row["keys"]) for row in asked]
        counts = np.concatenate([_unsqueezed(row["counts"]) for row in asked])
        joined = np.concatenate(keys)
        names = distinct(joined)
        totals = np.bincount(np.searchsorted(names, joined), counts, len(names)).astype(np.int64)
        for row, own in zip(asked, keys):
            out.append((row["shard"], kind, part, _squeezed(totals[np.searchsorted(names, own)]), None, None))
        if kind == _WORDS:
            out.append((-1, _TOTALS, part, None, int((totals > 0).sum()), int(totals.sum())))
    columns = list(zip(*out))
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    names = [field.split(" ")[0] for field in _SIDE.split(", ")]
    return pa.table({name: pa.array(values, kind) for name, values, kind in zip(names, columns, kinds)})


class BackoffAutomaton:
    """The part of the model that some texts can visit.

    ``words`` (sorted hashes) have counts; ``pairs`` (sorted keys) have counts. State 0 is no context, state 1 + i the
    context of word i, and the last state the beginning of a text.
    """

    def __init__(self, words, word_counts, pairs, pair_counts, vocabulary: int, total: int, k: float = CONCENTRATION):
        self.words, self.k = words, k
        self.root = np.log10((word_counts + 0.5) / (total + 0.5 * (vocabulary + 1)))
        seen = pair_counts > 0
        self.pairs, self.pair_counts = pairs[seen], pair_counts[seen]
        end = np.searchsorted(words, _END)
        texts = word_counts[end] if end < len(words) and words[end] == _END else 0
        # What a context's failure arc costs; a word without count is no state of its own.
        context = np.concatenate([[0], word_counts, [texts]]).astype(np.float64)
        self.context = context
        self.failure = np.log10(k / (context + k))
        self.begin = len(words) + 1
        self.names = np.concatenate([[np.uint64(0)], words, [_BEGIN]]).astype(np.uint64)

    def arcs(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The arc from each state for a word, -1 where there is none."""
        if not len(self.pairs):
            return np.full(len(state), -1)
        key = pair_keys(self.names[state], self.words[word])
        arc = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((state > 0) & (self.pairs[arc] == key), arc, -1)

    def after(self, word: np.ndarray) -> np.ndarray:
        """The state that reading a word leads to."""
        return np.where(self.context[1 + word] > 0, 1 + word, 0)

    def step(self, state: np.ndarray, word: np.ndarray, arc: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Weight of reading a word (by number) in each state, and the state after it. ``arc`` as ``arcs`` gives it."""
        weight = self.root[word]
        arc = self.arcs(state, word) if arc is None else arc
        has = (state > 0) & (arc >= 0)
        out = np.where(state > 0, self.failure[state] + weight, weight)
        held = state[has]
        share = self.pair_counts[arc[has]] + self.k * 10 ** weight[has]
        out[has] = np.log10(share / (self.context[held] + self.k))
        return out, self.after(word)

    def traverse(self, words: np.ndarray, offsets: np.ndarray, arcs: np.ndarray | None = None) -> np.ndarray:
        """Log10 probability of each text, which has a word at least. The state in which a word is read is the one that
        the word before leads to from any state, so many words are read at a time."""
        weights = np.empty(len(words))
        state = np.int64(self.begin if self.context[self.begin] > 0 else 0)
        starts, carried = offsets[:-1], state
        for low in range(0, len(words), _AT_ONCE):
            own = words[low : low + _AT_ONCE]
            after = self.after(own)
            states = np.append(carried, after[:-1])
            begins = starts[np.searchsorted(starts, low) : np.searchsorted(starts, low + len(own))]
            states[begins - low] = state
            carried = after[-1]
            part = None if arcs is None else arcs[low : low + _AT_ONCE]
            weights[low : low + _AT_ONCE], _ = self.step(states, own, part)
        return np.add.reduceat(weights, starts) if len(starts) else np.zeros(0)


def scores(documents: DataFrame, training: Column, k: float = CONCENTRATION) -> DataFrame:
    """One row per document: ``doc_id``, ``training``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (log10
    probability under the unigram model) and ``score`` (under the automaton).

    Learns from the rows for which the column expression ``training`` holds and scores all. Reads ``doc_id``, ``text``
    and what ``training`` names. Letters A to Z are lower-cased, words are runs of bytes other than ASCII white space,
    and each text ends with one more token. NULL and empty texts have the end alone. Words are told apart by 64-bit
    hashes, bigrams by 48 bits within one of at least 16 groups.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(training, F.lit(False)).alias("training"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = int(max(LEAST_SHARDS, -(-total // SHARD_BYTES)))
    # Training and other texts of a shard are packed apart.
    dealt = rows.withColumn("shard", (F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)) * 2 + F.col("training").cast("int")).cast("int"))
    texts = packed(dealt.select("doc_id", "text", "shard"), lambda batch: batch.column("shard").to_numpy())
    texts = texts.selectExpr("shard DIV 2 AS place", "shard % 2 AS training", "ids", "sizes", "packed").withColumn(
        "place", F.col("place").cast("int")
    )

    def read(table: pa.Table):
        ids, own, flags = [], [], []
        for flag in (0, 1):
            part = table.filter(pa.array([x == flag for x in table.column("training").to_pylist()], pa.bool_()))
            names, some = unpacked(part)
            ids.extend(names.to_pylist())
            own.extend(some)
            flags.extend([bool(flag)] * len(some))
        return ids, np.array(flags, bool), Sequences(own)

    def ask(key, table):
        _, flags, sequences = read(table)
        out = []
        for kind, keys, counts in _counted(sequences, flags):
            for part, own in enumerate(_parts(keys, groups)):
                if len(own):
                    out.append((part, key[0].as_py(), kind, _key_blob(kind, keys[own]), _squeezed(counts[own])))
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        names = [field.split(" ")[0] for field in _SENT.split(", ")]
        columns = list(zip(*out)) or [[]] * len(names)
        return pa.table({name: pa.array(values, kind) for name, values, kind in zip(names, columns, kinds)})

    def score(key, left, right):
        ids, flags, sequences = read(left)
        answers = {(row["kind"], row["part"]): row for row in right.to_pylist()}
        found = []
        for kind, values in ((_WORDS, sequences.tokens), (_PAIRS, sequences.pairs)):
            keys, numbers = _numbered(values)
            counts = np.zeros(len(keys), np.int64)
            for part, own in enumerate(_parts(keys, groups)):
                if len(own):
                    counts[own] = _unsqueezed(answers[kind, part]["counts"])
            found.append((keys, counts, numbers))
        (words, word_counts, numbers), (pairs, pair_counts, arcs) = found
        arcs = np.where(pair_counts > 0, np.cumsum(pair_counts > 0) - 1, -1)[arcs]
        sums = answers[_TOTALS, 0]
        machine = BackoffAutomaton(words, word_counts, pairs, pair_counts, sums["distinct"], sums["total"], k)
        begins = sequences.offsets[:-1]
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "training": pa.array(flags),
                "n_tokens": pa.array(np.diff(sequences.offsets)),
                "n_known": pa.array(np.add.reduceat((word_counts[numbers] > 0).astype(np.int64), begins)),
                "train_tokens": pa.array([sums["total"]] * len(ids), pa.int64()),
                "base_score": pa.array(np.add.reduceat(machine.root[numbers], begins)),
                "score": pa.array(machine.traverse(numbers, sequences.offsets, arcs)),
            }
        )

    answers = texts.groupBy("place").applyInArrow(ask, _SENT).groupBy("part").applyInArrow(lambda table: _merge(table), _SIDE)
    totals = (
        answers.filter(F.col("kind") == _TOTALS)
        .agg(F.sum("distinct").alias("distinct"), F.sum("total").alias("total"))
        .select(
            F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("shard"),
            F.lit(_TOTALS).alias("kind"),
            F.lit(0).alias("part"),
            F.lit(None).cast("binary").alias("counts"),
            "distinct",
            "total",
        )
    )
    side = answers.filter(F.col("kind") != _TOTALS).unionAll(totals).withColumnRenamed("shard", "place")
    wide = (
        "doc_id BIGINT, training BOOLEAN, n_tokens BIGINT, n_known BIGINT, train_tokens BIGINT,"
        " base_score DOUBLE, score DOUBLE"
    )
    # Groups without texts have totals alone and give nothing.
    return texts.groupBy("place").cogroup(side.groupBy("place")).applyInArrow(
        lambda key, left, right: score(key, left, right) if left.num_rows else pa.schema(_arrow(wide)).empty_table(), wide
    )


def _arrow(schema: str):
    kinds = {"BIGINT": pa.int64(), "BOOLEAN": pa.bool_(), "DOUBLE": pa.float64()}
    return [(name, kinds[kind]) for name, kind in (field.strip().split(" ") for field in schema.split(","))]


def held_out_scores(documents: DataFrame) -> DataFrame:
    """Learns from four of five folds of ``documents`` and scores all of them."""
    held_out = fold("doc_id", 5) == 1
    found = scores(documents, ~held_out)
    return found.select("doc_id", (~F.col("training")).alias("held_out"), *found.columns[2:])


def brute_force(documents: list[tuple], k: float = CONCENTRATION) -> list[tuple]:
    """The same rows as ``held_out_scores`` by dictionaries; for tests."""
    import re
    import zlib
    from collections import Counter

    texts, words, pairs, contexts = [], Counter(), Counter(), Counter()
    for doc, text in documents:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        tokens = [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]
        held_out = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1
        texts.append((doc, held_out, tokens))
        if not held_out:
            words.update(tokens)
            pairs.update(zip(["", *tokens], tokens))
            contexts.update(["", *tokens[:-1]])
    total, vocabulary = sum(words.values()), len(words)
    rows = []
    for doc, held_out, tokens in texts:
        base = [(words[t] + 0.5) / (total + 0.5 * (vocabulary + 1)) for t in tokens]
        full = [
            (pairs[u, t] + k * p) / (contexts[u] + k) for u, t, p in zip(["", *tokens], tokens, base)
        ]
        known = sum(words[t] > 0 for t in tokens)
        logs = [sum(map(math.log10, values)) for values in (base, full)]
        rows.append((doc, held_out, len(tokens), known, total, *logs))
    return rows
