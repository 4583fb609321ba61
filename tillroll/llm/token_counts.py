"""Token counts by compiled finite-state transducers.

Two deterministic machines in a row count the tokens of whole texts. The first splits a text into words
(``splitting``, with chunk state maps composed by a prefix scan). The second reads the bytes of a word, and each of
its transitions carries the number of tokens that the byte adds to the encoding of the word so far, which may be none
or fewer than none where a byte lets earlier tokens merge.

The second machine follows from two facts about byte-pair merging: every prefix of an encoding is the encoding of
what it spells, and a sequence of tokens is an encoding exactly if every two neighbours would stay apart when encoded
alone. So the last token of the encoding of each prefix is unique, and it can be found from the last tokens of shorter
prefixes that a token can still reach back to. A state is just that: the longest suffix that begins some token, and
for each position from which a token may still go on, the last token there and the token count relative to the
present one. Last tokens that keep apart from the same possible successors are interchangeable, and one stands for
all of them. States and transitions are compiled when first met, into dense tables that all words of a piece of text step through together; tables that
have grown to their limit are cleared and compiled anew, so memory is bounded and results do not change.
"""

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm import byte_bpe
from tillroll.llm.batches import pieces, text_lengths
from tillroll.llm.splitting import split

STATE_LIMIT = 96 << 10
#: Last tokens are told apart by their successors where there are no more than these.
SUCCESSORS = 8
OVER_LIMIT = 1024


class CountingTransducer:
    """Bytes of a word to number of tokens."""

    def __init__(self, pairs: byte_bpe.BytePairs, limit: int = STATE_LIMIT):
        self.pairs = pairs
        self.limit = limit
        self._build_suffixes()
        self._apart: dict[tuple[int, int], bool] = {}
        self._stand_ins: dict[tuple[int, int], int] = {}
        self._classes: dict[tuple, int] = {}
        self.clear()

    def _build_suffixes(self) -> None:
        """Trie of all tokens with links to the longest proper suffix that is in it."""
        self.child: dict[int, int] = {}
        self.token = [-1]
        self.depth = [0]
        specials = set(self.pairs.special.values())
        nodes = [(0, 0)]  # parent and byte, in order of depth after sorting
        for number, spelling in sorted(enumerate(self.pairs.tokens), key=lambda item: len(item[1])):
            if number in specials or not spelling:
                continue
            node = 0
            for byte in spelling:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.depth.append(self.depth[node] + 1)
                    nodes.append((node, byte))
                node = self.child[key]
            self.token[node] = number
        self.suffix = [0] * len(nodes)
        for node in sorted(range(1, len(nodes)), key=self.depth.__getitem__):
            parent, byte = nodes[node]
            if parent:
                self.suffix[node] = self._go(self.suffix[parent], byte)

        # Tokens that begin with a node's spelling, None for too many.
        self.successors: list[list[int] | None] = [[] if number < 0 else [number] for number in self.token]
        for node in sorted(range(1, len(nodes)), key=self.depth.__getitem__, reverse=True):
            parent = nodes[node][0]
            own, above = self.successors[node], self.successors[parent]
            if own is None or above is None or len(own) + len(above) > SUCCESSORS:
                self.successors[parent] = None
            else:
                above.extend(own)

    def _go(self, node: int, byte: int) -> int:
        while True:
            found = self.child.get(node << 8 | byte)
            if found is not None:
                return found
            if not node:
                return 0
            node = self.suffix[node]

    def clear(self) -> None:
        # State 0 stands for transitions that are not compiled yet; state 1 is the beginning of a word.
        self.next = np.zeros((1024, 256), np.int32)
        self.emits = np.zeros((1024, 256), np.int16)
        self.states = [None, (0, (0, -1, 0))]
        self.numbers = {self.states[1]: 1}

    def apart(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are when their bytes are encoded together."""
        key = (left, right)
        known = self._apart.get(key)
        if known is None:
            if len(self._apart) > 1 << 20:
                self._apart.clear()
            tokens = self.pairs.tokens
            known = self.pairs.merge(tokens[left] + tokens[right]) == [left, right]
            self._apart[key] = known
        return known

    def stand_in(self, last: int, node: int) -> int:
        """The token that stands for ``last`` where only successors below ``node`` can follow."""
        successors = self.successors[node]
        if last < 0 or successors is None:
            return last
        key = (last, node)
        found = self._stand_ins.get(key)
        if found is None:
            if len(self._stand_ins) > 1 << 20:
                self._stand_ins.clear()
                self._classes.clear()
            shape = (node, *(self.apart(last, token) for token in successors))
            found = self._stand_ins[key] = self._classes.setdefault(shape, last)
        return found

    def compile(self, state: int, byte: int) -> None:
        node, flat = self.states[state]
        # How far back a position lies, to its last token and count.
        past = dict(zip(flat[::3], zip(flat[1::3], flat[2::3])))
        node = self._go(node, byte)
        suffix = node
        while True:
            token = self.token[suffix]
            if token >= 0:
                last, count = past[self.depth[suffix] - 1]
                if last < 0 or self.apart(last, token):
                    break
            suffix = self.suffix[suffix]
        added = count + 1
        flat = [0, token, 0]
        suffix = node
        while suffix:
            back = self.depth[suffix]
            last, count = past[back - 1]
            flat += (back, self.stand_in(last, suffix), count - added)
            suffix = self.suffix[suffix]
        fresh = (node, tuple(flat))
        number = self.numbers.get(fresh)
        if number is None:
            number = self.numbers[fresh] = len(self.states)
            self.states.append(fresh)
            if number >= len(self.next):
                self.next, self.emits = _doubled(self.next), _doubled(self.emits)
        self.next[state, byte] = number
        self.emits[state, byte] = added

    def count(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of each word. Words advance together, byte by byte."""
        if len(self.states) > self.limit:
            self.clear()
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        totals = np.zeros(len(starts), np.int64)
        state = np.ones(len(starts), np.int64)
        for step in range(int(lengths[0]) if len(lengths) else 0):
            active = int(np.searchsorted(-lengths, -step, side="left"))
            at = (state[:active] << 8) | data[starts[:active] + step]
            to = self.next.reshape(-1)[at]
            missing = at[to == 0]
            if len(missing):
                for place in np.unique(missing).tolist():
                    self.compile(place >> 8, place & 255)
                to = self.next.reshape(-1)[at]
            totals[:active] += self.emits.reshape(-1)[at]
            state[:active] = to
        out = np.empty_like(totals)
        out[order] = totals
        return out


def _doubled(table: np.ndarray) -> np.ndarray:
    # Fresh rows take memory only when they are first written.
    out = np.zeros((2 * len(table), table.shape[1]), table.dtype)
    out[: len(table)] = table
    return out


@lru_cache(2)
def transducer(path: str | None = None) -> CountingTransducer:
    return CountingTransducer(byte_bpe.load(path))


def segments(texts: list[str], special: dict[str, int]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts cut at special tokens: the parts, the text of each part, and the special token after it or -1."""
    pattern = re.compile("(" + "|".join(re.escape(token) for token in sorted(special, key=len, reverse=True)) + ")")
    parts, owners, after = [], [], []
    for owner, text in enumerate(texts):
        if special and any(token in text for token in special):
            cut = pattern.split(text)
            parts.extend(cut[::2])
            after.extend([*(special[token] for token in cut[1::2]), -1])
            owners.extend([owner] * (len(cut) // 2 + 1))
        else:
            parts.append(text)
            after.append(-1)
            owners.append(owner)
    return parts, np.array(owners, np.int64), np.array(after, np.int64)


def count_texts(texts: list[str], machine: CountingTransducer) -> np.ndarray:
    """Tokens of each text, special tokens inside it included."""
    parts, owners, after = segments(texts, machine.pairs.special)
    words = split(parts)
    counts = machine.count(words.data, words.starts, words.lengths)
    sums = np.append(0, np.cumsum(counts))[words.text_offsets]
    totals = np.zeros(len(texts), np.int64)
    np.add.at(totals, owners, np.diff(sums) + (after >= 0))
    return totals


def token_counts(documents: DataFrame, path: str | None = None, limit: int = OVER_LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of each document.

    Reads ``doc_id`` and ``text``; NULL counts as empty, an empty text has no tokens. ``path`` is a byte-level
    tokenizer file that every executor has. Whole texts of any length; no shuffle.
    """

    def count(batches):
        machine = transducer(path)
        for piece in pieces(batches):
            texts = [text or "" for text in piece.column("text").to_pylist()]
            tokens = count_texts(texts, machine)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(text_lengths(piece.column("text"))),
                    pa.array(tokens),
                    pa.array(tokens > limit),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, n_bytes BIGINT, n_tokens BIGINT, over_limit BOOLEAN"
    return documents.select("doc_id", "text").mapInArrow(count, schema)
