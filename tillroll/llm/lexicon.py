"""Byte-pair encoding and decoding with a minimal acyclic transducer of frequent words.

The most frequent words of the corpus are encoded once and compiled into a minimal acyclic automaton: equal suffixes
share states, and outputs on the transitions add up to a word's number, under which its ids are stored. The automaton
is a few flat arrays in a file that each worker maps into memory. Words of a batch walk it together, a byte at a
time; words that it does not hold are merged exactly, so the lexicon decides how fast a text is encoded, never how.
"""

import tempfile
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import byte_bpe
from tillroll.llm.batches import offsets_of, pieces, ranges
from tillroll.llm.splitting import Words, split
from tillroll.llm.token_counts import segments
from tillroll.sinks.scratch import materialise

#: Words in the lexicon at most. Bounds what is collected and broadcast, at about 60 bytes a word.
LEXICON_WORDS = 1 << 17
LONGEST = 48
_COUNTER_WORDS = 1 << 18
_REMEMBERED = 1 << 17
_ROWS = 256
_MIX = np.uint64(0x9E3779B97F4A7C15)


def minimal_automaton(words: list[bytes]) -> tuple[dict[tuple[int, int], tuple[int, int]], set[int]]:
    """Transitions ``(state, byte) -> (target, output)`` and final states for sorted distinct words.

    A word's number in the list is the sum of the outputs on its path. State 0 is the start.
    """
    children: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    path = [0]

    def settle(down_to: int, word: bytes) -> None:
        for level in range(len(path) - 1, down_to, -1):
            state, parent, byte = path[level], path[level - 1], word[level - 1]
            shape = (final[state], tuple(children[state].items()))
            children[parent][byte] = register.setdefault(shape, state)
        del path[down_to + 1 :]

    previous = b""
    for word in words:
        common = 0
        while common < min(len(word), len(previous)) and word[common] == previous[common]:
            common += 1
        settle(common, previous)
        for byte in word[common:]:
            children.append({})
            final.append(False)
            children[path[-1]][byte] = len(children) - 1
            path.append(len(children) - 1)
        final[path[-1]] = True
        previous = word
    settle(0, previous)

    reached: dict[int, int] = {}  # words that can be read from a state
    order, seen, stack = [], {0}, [0]
    while stack:  # depth first; a state is done after all that follow it
        state = stack[-1]
        fresh = [target for target in children[state].values() if target not in seen]
        if fresh:
            seen.update(fresh[:1])
            stack.append(fresh[0])
        else:
            order.append(stack.pop())
    for state in order:
        reached[state] = final[state] + sum(reached[target] for target in children[state].values())
    arcs = {}
    for state in order:
        before = int(final[state])
        for byte, target in sorted(children[state].items()):
            arcs[state, byte] = (target, before)
            before += reached[target]
    return arcs, {state for state in order if final[state]}


class Lexicon:
    """The automaton in one flat array: a header, an open-addressed table of transitions (key, target, output),
    final flags, and the ids of the words."""

    def __init__(self, flat: np.ndarray):
        slots, states, words, ids, self.longest = flat[:5].tolist()
        bounds = np.cumsum([5, slots, slots, slots, states, words + 1, ids])
        cut = [flat[a:b] for a, b in zip(bounds, bounds[1:])]
        self.keys, self.targets, self.outputs, self.final, self.id_offsets, self.ids = cut
        self.mask = slots - 1

    @staticmethod
    def flat(words: list[bytes], pairs: byte_bpe.BytePairs) -> np.ndarray:
        words = sorted(set(words) - {b""})
        arcs, final = minimal_automaton(words)
        names = {state: i for i, state in enumerate(sorted({0, *(t for t, _ in arcs.values())}))}
        keys = np.array([names[state] << 8 | byte for state, byte in arcs], np.int64)
        values = np.array([(names[target], output) for target, output in arcs.values()], np.int32).reshape(-1, 2)
        slots = 1 << max(4, int(np.ceil(np.log2(2 * len(keys) + 1))))
        table = np.full((3, slots), -1, np.int32)
        slot, waiting = _slot(keys, slots - 1), np.arange(len(keys))
        while len(waiting):
            free = table[0, slot[waiting]] < 0
            chosen, first = np.unique(slot[waiting][free], return_index=True)
            winners = waiting[free][first]
            table[:, chosen] = np.stack([keys[winners], values[winners, 0], values[winners, 1]])
            waiting = np.setdiff1d(waiting, winners)
            slot[waiting] = (slot[waiting] + 1) & (slots - 1)
        flags = np.zeros(len(names), np.int32)
        flags[[names[state] for state in final]] = 1
        ids = [pairs.merge(word) for word in words]
        flat_ids = [number for own in ids for number in own]
        head = [slots, len(names), len(words), len(flat_ids), max(map(len, words), default=0)]
        offsets = offsets_of([len(own) for own in ids])
        return np.concatenate([head, *table, flags, offsets, flat_ids]).astype(np.int32)

    def numbers(self, words: Words) -> np.ndarray:
        """Number of each word, -1 where the lexicon has it not."""
        out = np.full(len(words.starts), -1, np.int64)
        order = np.flatnonzero(words.lengths <= self.longest)
        order = order[np.argsort(-words.lengths[order], kind="stable")]
        starts, lengths = words.starts[order], words.lengths[order]
        # Lanes leave when their word has ended or has no transition.
        state, total = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for step in range(int(lengths[0]) if len(lengths) else 0):
            active = int(np.searchsorted(-lengths, -step, side="left"))
            if active < len(order):
                self._finish(out, order[active:], state[active:], total[active:])
                order, starts, lengths, state, total = (x[:active] for x in (order, starts, lengths, state, total))
            slot = self._find((state << 8) | words.data[starts + step])
            known = slot >= 0
            order, starts, lengths, slot = order[known], starts[known], lengths[known], slot[known]
            state = self.targets[slot].astype(np.int64)
            total = total[known] + self.outputs[slot]
        self._finish(out, order, state, total)
        return out

    def _finish(self, out, order, state, total):
        ended = self.final[state] == 1
        out[order[ended]] = total[ended]

    def _find(self, keys: np.ndarray) -> np.ndarray:
        slot = _slot(keys, self.mask)
        held = self.keys[slot]
        going = np.flatnonzero((held != keys) & (held >= 0))
        while len(going):
            slot[going] = (slot[going] + 1) & self.mask
            held = self.keys[slot[going]]
            going = going[(held != keys[going]) & (held >= 0)]
        return np.where(self.keys[slot] == keys, slot, -1)


def _slot(keys: np.ndarray, mask: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * _MIX) >> np.uint64(32)).astype(np.int64) & mask


def mapped(flat: bytes) -> Lexicon:
    """The lexicon over a memory-mapped file, which goes with the worker that made it."""
    file = tempfile.TemporaryFile()
    file.write(flat)
    file.flush()
    return Lexicon(np.memmap(file, np.int32, "r"))


def word_counts(documents: DataFrame) -> DataFrame:
    """``word`` (bytes) and ``rows``, its occurrences in all texts. Partitions add up their own words first."""

    def rows_of(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "rows"]
        )

    def count(batches):
        special = byte_bpe.load().special
        counts: dict[bytes, int] = {}
        for piece in pieces(batches):
            parts, _, _ = segments([text or "" for text in piece.column("text").to_pylist()], special)
            words = split(parts)
            for word, rows in _distinct(words):
                counts[word] = counts.get(word, 0) + rows
            if len(counts) > _COUNTER_WORDS:
                yield rows_of(counts)
                counts = {}
        if counts:
            yield rows_of(counts)

    parts = documents.select("text").mapInArrow(count, "word BINARY, rows BIGINT")
    return parts.groupBy("word").agg(F.sum("rows").alias("rows"))


def _distinct(words: Words):
    found: dict[bytes, int] = {}
    for word in words.texts():
        found[word] = found.get(word, 0) + 1
    return found.items()


def frequent_words(documents: DataFrame, limit: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent words, ``limit`` at most and as many as a cut between two frequencies gives."""
    short = word_counts(documents).filter((F.length("word") <= LONGEST) & (F.col("rows") > 1))
    counted = materialise(short.withColumn("level", F.floor(F.log2("rows") * 16)), "word_counts")
    # A few hundred levels; those from the top that fit the limit.
    levels = sorted(counted.groupBy("level").count().collect(), reverse=True)
    least, total = None, 0
    for level, words in levels:
        total += words
        if total > limit:
            break
        least = level
    if least is None:
        return []
    return [bytes(row["word"]) for row in counted.filter(F.col("level") >= least).select("word").collect()]


class Encoder:
    def __init__(self, lexicon: Lexicon, pairs: byte_bpe.BytePairs):
        self.lexicon, self.pairs = lexicon, pairs
        self.known: dict[bytes, list[int]] = {}

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the offsets of each text."""
        parts, owners, after = segments(texts, self.pairs.special)
        words = split(parts)
        numbers = self.lexicon.numbers(words)
        starts = np.zeros(len(numbers), np.int64)
        sizes = np.zeros(len(numbers), np.int64)
        held = numbers >= 0
        offsets = self.lexicon.id_offsets
        starts[held] = offsets[numbers[held]]
        sizes[held] = offsets[numbers[held] + 1] - offsets[numbers[held]]
        ids = [self.lexicon.ids]
        fill = len(self.lexicon.ids)
        place: dict[bytes, tuple[int, int]] = {}
        data = words.data.tobytes()
        unseen = np.flatnonzero(~held)
        spots = []
        for begin, size in zip(words.starts[unseen].tolist(), words.lengths[unseen].tolist()):
            word = data[begin : begin + size]
            at = place.get(word)
            if at is None:
                own = self._merged(word)
                at = place[word] = (fill, len(own))
                ids.append(own)
                fill += len(own)
            spots.append(at)
        if spots:
            starts[unseen], sizes[unseen] = np.array(spots, np.int64).T
        if (after >= 0).any():
            marks = np.flatnonzero(after >= 0)
            ids.append(after[marks])
            ends = words.text_offsets[marks + 1]
            starts = np.insert(starts, ends, fill + np.arange(len(marks)))
            sizes = np.insert(sizes, ends, 1)
            part_offsets = words.text_offsets + np.append(0, np.cumsum(after >= 0))
        else:
            part_offsets = words.text_offsets
        extra = np.fromiter((number for own in ids[1:] for number in own), np.int32)
        flat = np.concatenate([ids[0], extra])[ranges(starts, sizes)]
        by_part = offsets_of(sizes)[part_offsets]
        last = np.searchsorted(owners, np.arange(len(texts)), side="right")
        return flat, np.append(0, by_part[last])

    def _merged(self, word: bytes) -> list[int]:
        own = self.known.get(word)
        if own is None:
            own = self.pairs.merge(word)
            if len(self.known) >= _REMEMBERED:
                self.known.clear()
            if len(word) <= LONGEST:
                self.known[word] = own
        return own


def compile_lexicon(documents: DataFrame, path: str | None = None, limit: int = LEXICON_WORDS) -> np.ndarray:
    """The lexicon of a corpus (``text``) as one flat array; small enough to broadcast."""
    return Lexicon.flat(frequent_words(documents, limit), byte_bpe.load(path))


def _encoding(sent, path: str | None, kept: list[str]):
    """What a task does to encode the batches of ``documents``."""
    made = []

    def run(batches):
        if not made:
            made.append(Encoder(mapped(sent.value), byte_bpe.load(path)))
        for piece in pieces(batches):
            flat, offsets = made[0].encode([text or "" for text in piece.column("text").to_pylist()])
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*(piece.column(n) for n in kept), ids], names=[*kept, "ids"])

    return run


def _with(documents: DataFrame, added: dict[str, T.DataType]) -> tuple[list[str], DataFrame, T.StructType]:
    """The columns that stay beside the ``added`` ones, the frame of those, and the schema of both."""
    fields = [field for field in documents.schema.fields if field.name not in added]
    kept = [field.name for field in fields]
    schema = T.StructType([*fields, *(T.StructField(name, kind) for name, kind in added.items())])
    return kept, documents.select([F.col(f"`{name}`") for name in kept]), schema


def encode(documents: DataFrame, lexicon: np.ndarray, path: str | None = None) -> DataFrame:
    """``documents`` (all columns) with ``ids ARRAY<INT>``, the encoding of ``text`` without added tokens.

    Special tokens written in a text are recognised. NULL and empty texts have no ids. A column of the name ``ids``
    is replaced. No shuffle.
    """
    kept, rows, schema = _with(documents, {"ids": T.ArrayType(T.IntegerType())})
    sent = documents.sparkSession.sparkContext.broadcast(lexicon.tobytes())
    return rows.mapInArrow(_encoding(sent, path, kept), schema)


def encode_and_decode(documents: DataFrame, lexicon: np.ndarray, path: str | None = None) -> DataFrame:
    """``decode(encode(documents, lexicon))`` by one Python worker a task instead of two."""
    added = {"ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType()}
    kept, rows, schema = _with(documents, added)
    sent = documents.sparkSession.sparkContext.broadcast(lexicon.tobytes())
    encoding, decoding = _encoding(sent, path, kept), _decoding(path, [*kept, "ids"])
    return rows.mapInArrow(lambda batches: decoding(encoding(batches)), schema)


@lru_cache(2)
def _spellings(path: str | None) -> tuple[np.ndarray, np.ndarray]:
    tokens = byte_bpe.load(path).tokens
    return np.frombuffer(b"".join(tokens), np.uint8), offsets_of([len(token) for token in tokens])


def _decoding(path: str | None, kept: list[str]):
    """What a task does to decode batches with ``ids``."""

    def run(batches):
        data, places = _spellings(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, _ROWS):
                part = batch.slice(begin, _ROWS)
                column = part.column("ids")
                ids = column.flatten().to_numpy(zero_copy_only=False)
                ends = offsets_of(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)).tolist()
                texts = []
                for a, b, valid in zip(ends, ends[1:], column.is_valid().to_pylist()):
                    own = ids[a:b].astype(np.int64)
                    spelt = data[ranges(places[own], places[own + 1] - places[own])].tobytes()
                    texts.append(spelt.decode("utf-8", "replace") if valid else None)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in kept), pa.array(texts, pa.string())], names=[*kept, "decoded"]
                )

    return run


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (all columns) with ``decoded``, the text that ``ids`` spell, special tokens written out.

    Bytes that are no UTF-8 become replacement characters; NULL ids give NULL. No shuffle.
    """
    kept, rows, schema = _with(encoded, {"decoded": T.StringType()})
    return rows.mapInArrow(_decoding(path, kept), schema)


def digest(decoded: DataFrame) -> DataFrame:
    """The contract's columns from ``decode(encode(...))``."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def round_trip(documents: DataFrame, limit: int = LEXICON_WORDS) -> DataFrame:
    """Encodes and decodes ``documents`` (``doc_id``, ``text``) with a lexicon of their own frequent words."""
    rows = documents.select("doc_id", "text")
    return decode(encode(rows, compile_lexicon(rows, limit=limit)).drop("text"))
