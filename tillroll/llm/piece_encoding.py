"""SentencePiece encoding and decoding with a table of distinct chunks.

A text is normalised by the model's own rules, which mark its white space, and cut before each run of markers. No piece
of a usual model goes on past the end of a word into the next marker, so no merge crosses a cut and every chunk (markers
and the word after them) is encoded by itself; characters that are in no longer piece are chunks too. A task keeps one table of the chunks it has met: each distinct chunk is
merged once, and a text's ids are the table's, joined back by the positions of its chunks. A model with pieces that do
cross markers is cut nowhere and stays exact.
"""

import codecs
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from tillroll.llm.batches import offsets_of, pieces, ranges

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Chunks that a task's table holds before it starts afresh, and characters of chunks kept in it; about 250 MB.
TABLE_CHUNKS = 1 << 20
TABLE_CHARS = 1 << 24
#: Characters of a text that are cut into chunks at once.
_SPAN = 1 << 20
#: Longer chunks are looked through for places that no merge can cross.
_LONG = 64
#: Marks after words. A chunk that ends in some is looked up without them, where no merge crosses the place.
_MARKS = ".,;:!?#$%&*()[]{}<>|\"'-"
_ROWS = 256
_PLACE = 40


class PieceModel:
    """The pieces of a BPE model: their ranks for merging, their ids and spellings."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        held = {piece.type for piece in proto.pieces}
        if proto.trainer_spec.model_type != sentencepiece_model_pb2.TrainerSpec.BPE or held & {
            kinds.USER_DEFINED,
            kinds.UNUSED,
        }:
            raise ValueError("the model must be BPE without user-defined or unused pieces")
        if not proto.trainer_spec.byte_fallback:
            raise ValueError("the model must spell unknown characters in bytes")
        self.end = self.library.eos_id()
        self.strips_first = proto.normalizer_spec.add_dummy_prefix or proto.normalizer_spec.remove_extra_whitespaces
        self.ids: dict[str, int] = {}
        self.spelt: list[bytes] = []
        self.bytes = [self.library.unk_id()] * 256
        #: Ids that show nothing, and ids that start with a marker.
        self.silent = np.zeros(len(proto.pieces), bool)
        self.marked = np.zeros(len(proto.pieces), bool)
        scores = {}
        for number, piece in enumerate(proto.pieces):
            spelling = piece.piece.replace(MARK, " ").encode()
            if piece.type == kinds.BYTE:
                value = int(piece.piece[3:-1], 16)
                self.bytes[value] = number
                spelling = bytes([value])
            elif piece.type == kinds.CONTROL:
                self.silent[number], spelling = True, b""
            elif piece.type == kinds.UNKNOWN:
                spelling = proto.trainer_spec.unk_surface.encode()
            else:
                self.ids[piece.piece] = number
                self.marked[number] = piece.piece.startswith(MARK)
                scores[piece.piece] = piece.score
            self.spelt.append(spelling)
        places = {score: place for place, score in enumerate(sorted(set(scores.values()), reverse=True))}
        #: Merges with smaller ranks come first.
        self.ranks = {piece: places[score] for piece, score in scores.items() if len(piece) > 1}
        self.none = len(places)
        # Neighbouring characters within some piece; no merge joins any others.
        self.joined = {piece[i : i + 2] for piece in self.ranks for i in range(len(piece) - 1)}
        self.crossing = any(re.search(f"[^{MARK}]{MARK}", piece) for piece in self.ranks)
        # Digits, line ends and the like, where they are in no longer piece, are chunks of their own.
        social = set("".join(self.joined))
        single = "".join(f"\\x{code:02x}" for code in range(128) if chr(code) not in social)
        chunk = f"{MARK}*[^{MARK}{single}]+|{MARK}+" + (f"|[{single}]" if single else "")
        self.cut = re.compile(".+" if self.crossing else chunk, re.DOTALL)

    def segment(self, chunk: str) -> list[int]:
        """Ids of a chunk of normalised text: the pair of neighbours that makes the best piece is merged, the leftmost
        of equals first, until no pair makes one."""
        if len(chunk) <= _LONG:
            return self._merged_short(chunk)
        joined, ids, start = self.joined, [], 0
        for i in range(1, len(chunk)):
            if chunk[i - 1 : i + 1] not in joined:
                ids += self._merged(chunk[start:i])
                start = i
        return ids + self._merged(chunk[start:])

    def _merged_short(self, chunk: str) -> list[int]:
        get, none = self.ranks.get, self.none
        parts = list(chunk)
        ranks = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i] = merged = parts[i] + parts[i + 1]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(merged + parts[i + 1], none)
            if i:
                ranks[i - 1] = get(parts[i - 1] + merged, none)
        return self._ids(parts)

    def _merged(self, chunk: str) -> list[int]:
        """As ``_merged_short`` for chunks of any length, with a heap."""
        size, ranks = len(chunk), self.ranks
        after = array("q", range(1, size + 1))
        before = array("q", range(-1, size - 1))
        gone = bytearray(size)
        waiting = []
        for i in range(size - 1):
            rank = ranks.get(chunk[i : i + 2])
            if rank is not None:
                waiting.append(rank << _PLACE | i)
        heapify(waiting)
        while waiting:
            best = heappop(waiting)
            left = best & ((1 << _PLACE) - 1)
            if gone[left]:
                continue
            right = after[left]
            # A pair that has changed since is another piece or none.
            if right >= size or ranks.get(chunk[left : after[right]]) != best >> _PLACE:
                continue
            end = after[right]
            gone[right] = 1
            after[left] = end
            if end < size:
                before[end] = left
                rank = ranks.get(chunk[left : after[end]])
                if rank is not None:
                    heappush(waiting, rank << _PLACE | left)
            if left:
                rank = ranks.get(chunk[before[left] : end])
                if rank is not None:
                    heappush(waiting, rank << _PLACE | before[left])
        parts, start = [], 0
        while start < size:
            parts.append(chunk[start : after[start]])
            start = after[start]
        return self._ids(parts)

    def _ids(self, parts: list[str]) -> list[int]:
        ids: list[int] = []
        for part in parts:
            number = self.ids.get(part)
            if number is None:  # a character without a piece
                ids += [self.bytes[byte] for byte in part.encode()]
            else:
                ids.append(number)
        return ids

    def chunks(self, text: str) -> Iterator[list[str]]:
        """The chunks of a text, some at a time."""
        marked = self.library.normalize(text) if text else ""
        if len(marked) <= _SPAN or self.crossing:
            yield self.cut.findall(marked)
            return
        some, size = [], 0
        for match in self.cut.finditer(marked):
            some.append(match[0])
            size += len(match[0])
            if size >= _SPAN:
                yield some
                some, size = [], 0
        yield some


class ChunkTable:
    """Ids of the distinct chunks met so far."""

    def __init__(self, model: PieceModel, limit: int = TABLE_CHUNKS, chars: int = TABLE_CHARS):
        self.model, self.limit, self.chars = model, limit, chars
        self.segmented = 0
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.ids, self.ends, self.held = array("i"), array("q", [0]), 0

    def _add(self, chunk: str, ids: array) -> None:
        self.numbers[chunk] = len(self.numbers)
        self.ids.extend(ids)
        self.ends.append(len(self.ids))
        self.held += len(chunk)

    def _known(self, chunk: str) -> array:
        """The ids of a chunk, which is segmented if the table has it not."""
        number = self.numbers.get(chunk)
        if number is None:
            self.segmented += 1
            ids = array("i", self.model.segment(chunk))
            self._add(chunk, ids)
            return ids
        return self.ids[self.ends[number] : self.ends[number + 1]]

    def ids_of(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks end to end, and how many each has."""
        if len(self.numbers) > self.limit or self.held > self.chars:
            self._clear()
        numbers = self.numbers
        joined = self.model.joined
        for chunk in set(chunks).difference(numbers):
            if chunk in numbers:  # as a part of another by now
                continue
            size = len(chunk.rstrip(_MARKS))
            if 0 < size < len(chunk) and chunk[size - 1 : size + 1] not in joined:
                self._add(chunk, self._known(chunk[:size]) + self._known(chunk[size:]))
            else:
                self._known(chunk)
        own = np.fromiter(map(numbers.__getitem__, chunks), np.int64, len(chunks))
        ends = np.array(self.ends)
        starts, sizes = ends[own], ends[own + 1] - ends[own]
        return np.array(self.ids, np.int32)[ranges(starts, sizes)], sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each with the end id, and the offsets of each text."""
        found: list[np.ndarray] = []
        lengths = np.zeros(len(texts), np.int64)
        end = np.array([self.model.end], np.int32)
        some: list[str] = []
        owners: list[tuple[int, int]] = []

        def flush():
            flat, sizes = self.ids_of(some)
            at = 0
            bounds = offsets_of(sizes)
            for text, count in owners:
                part = flat[bounds[at] : bounds[at + abs(count)]] if count else flat[:0]
                at += abs(count)
                found.append(part)
                lengths[text] += len(part)
            some.clear()
            owners.clear()

        for i, text in enumerate(texts):
            for chunks in self.model.chunks(text):
                some += chunks
                owners.append((i, len(chunks)))
                if len(some) > _SPAN // 4:
                    flush()
        flush()
        flat = np.concatenate([*found, end[:0]])
        ends = np.cumsum(lengths)
        return np.insert(flat, ends, end[0]), offsets_of(lengths + 1)


@lru_cache(2)
def load(path: str | None = None) -> PieceModel:
    return PieceModel(path or public_tokenizers.path(MODEL))


def encode(documents: DataFrame, path: str | None = None) -> DataFrame:
    """``documents`` (all columns) with ``ids ARRAY<INT>``, the encoding of ``text`` and the end id.

    NULL and empty texts have the end id alone. A column of the name ``ids`` is replaced; rows may repeat, ids may be
    NULL. Control symbols written in a text are ordinary text. No shuffle.
    """
    kept = [name for name in documents.columns if name != "ids"]

    def run(batches):
        table = ChunkTable(load(path))
        for piece in pieces(batches):
            texts = piece.column("text").cast(pa.large_binary()).to_pylist()
            flat, offsets = table.encode([(text or b"").decode("utf-8", "replace") for text in texts])
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*(piece.column(n) for n in kept), ids], names=[*kept, "ids"])

    fields = [field for field in documents.schema.fields if field.name in kept]
    schema = T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return documents.select([F.col(f"`{name}`") for name in kept]).mapInArrow(run, schema)


def _bad_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("tillroll.byte", _bad_byte)


class Speller:
    """Texts that ids spell."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.data = np.frombuffer(b"".join(model.spelt), np.uint8)
        self.places = offsets_of([len(spelling) for spelling in model.spelt])

    def spell(self, ids: np.ndarray) -> str:
        quiet = np.flatnonzero(self.model.silent[ids])
        if not len(quiet):
            return self._run(ids, True)
        # Bytes on two sides of a control symbol make no character together.
        texts, first = [], True
        for run in np.split(ids, quiet):
            run = run[self.model.silent[run[:1]].sum() :]
            if len(run):
                texts.append(self._run(run, first))
                first = False
        return "".join(texts)

    def _run(self, ids: np.ndarray, first: bool) -> str:
        ids = ids.astype(np.int64)
        starts, ends = self.places[ids], self.places[ids + 1]
        if first and len(ids) and self.model.strips_first and self.model.marked[ids[0]]:
            starts[0] += 1  # the marker before the first word is not of the text
        spelt = self.data[ranges(starts, ends - starts)].tobytes()
        return spelt.decode("utf-8", "tillroll.byte")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (all columns) with ``decoded``, the text that ``ids`` spell without control symbols.

    Byte pieces that are no UTF-8 become replacement characters, one each; NULL ids give NULL. A column of the name
    ``decoded`` is replaced. No shuffle.
    """
    kept = [name for name in encoded.columns if name != "decoded"]

    def run(batches):
        codecs.register_error("tillroll.byte", _bad_byte)
        speller = Speller(load(path))
        for batch in batches:
            for begin in range(0, batch.num_rows, _ROWS):
                part = batch.slice(begin, _ROWS)
                column = part.column("ids")
                ids = column.flatten().to_numpy(zero_copy_only=False)
                ends = offsets_of(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)).tolist()
                valid = column.is_valid().to_pylist()
                texts = [speller.spell(ids[a:b]) if ok else None for a, b, ok in zip(ends, ends[1:], valid)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in kept), pa.array(texts, pa.string())], names=[*kept, "decoded"]
                )

    fields = [field for field in encoded.schema.fields if field.name in kept]
    schema = T.StructType([*fields, T.StructField("decoded", T.StringType())])
    return encoded.select([F.col(f"`{name}`") for name in kept]).mapInArrow(run, schema)


def digest(decoded: DataFrame) -> DataFrame:
    """The contract's columns from ``decode(encode(...))``."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def round_trip(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Encodes and decodes ``documents`` (``doc_id``, ``text``)."""
    return decode(encode(documents.select("doc_id", "text"), path).drop("text"), path)
