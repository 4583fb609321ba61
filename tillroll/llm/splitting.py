"""The word splitter of the byte-level tokenizer, as a finite-state transducer run over many chunks at once.

The vocabulary's split pattern is compiled into a deterministic machine over twelve character classes whose
transitions say where words begin: at the character just read or, where one character of look-ahead decides, at the
one before it. Text is cut into chunks of equal length. Each chunk is first read from every state at once, which
gives its state map; the maps are composed by a parallel prefix scan, which gives the state in which each chunk
really begins; then the chunks are read once more, all together, and the word starts are written down.
"""

import sys
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from tillroll.llm.batches import offsets_of

CHUNK = 256
_SETTLING = 24

# Character classes. Letters that occur in "'s 't 'm 'd 're 've 'll" have classes of their own.
(_ONE, _R, _V, _L, _E, _LETTER, _NUMBER, _OTHER, _QUOTE, _SPACE, _BLANK, _EDGE) = range(12)
# States. A quote that starts a word may begin a contraction; runs of blanks differ by their last
# character and by whether they are longer than one.
(START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, DONE, SPACE, BLANK, SPACES, BLANKS) = range(13)
STATES, CLASSES = 13, 12
#: Bits of a transition's output.
HERE, BEFORE = 1, 2


def _build() -> tuple[np.ndarray, np.ndarray]:
    target = np.zeros((STATES, CLASSES), np.uint8)
    output = np.zeros((STATES, CLASSES), np.uint8)
    letters = (_ONE, _R, _V, _L, _E, _LETTER)
    run_of = {**dict.fromkeys(letters, IN_LETTERS), _NUMBER: IN_NUMBERS, _OTHER: IN_OTHERS, _QUOTE: IN_OTHERS}
    fresh = {**run_of, _QUOTE: QUOTE, _SPACE: SPACE, _BLANK: BLANK}

    def arc(state, kind, to, out):
        target[state, kind], output[state, kind] = to, out

    for state in range(STATES):
        arc(state, _EDGE, START, 0)
        for kind, to in fresh.items():
            arc(state, kind, to, HERE)  # a new word, unless stated otherwise below
    for kind in run_of:
        for state, own in ((IN_LETTERS, IN_LETTERS), (IN_NUMBERS, IN_NUMBERS), (IN_OTHERS, IN_OTHERS)):
            if run_of[kind] == own:
                arc(state, kind, own, 0)
        arc(SPACE, kind, run_of[kind], 0)  # one space belongs to the word after it
        arc(SPACES, kind, run_of[kind], BEFORE)
        arc(BLANKS, kind, fresh[kind], BEFORE | HERE)
    for state in (SPACE, BLANK, SPACES, BLANKS):
        arc(state, _SPACE, SPACES, 0)
        arc(state, _BLANK, BLANKS, 0)
    for kind in (_OTHER, _QUOTE):
        arc(QUOTE, kind, IN_OTHERS, 0)
    arc(QUOTE, _ONE, DONE, 0)
    for kind, state, last in ((_R, QUOTE_R, _E), (_V, QUOTE_V, _E), (_L, QUOTE_L, _L)):
        arc(QUOTE, kind, state, 0)
        # No contraction after all: the quote stood alone and the letter began a word.
        for other in range(CLASSES):
            arc(state, other, target[IN_LETTERS, other], output[IN_LETTERS, other] | BEFORE)
        arc(state, last, DONE, 0)
    return target, output


TARGET, OUTPUT = _build()
_FLAT_TARGET = TARGET.reshape(-1)
_FLAT_OUTPUT = OUTPUT.reshape(-1)


@lru_cache(1)
def character_classes() -> np.ndarray:
    """Class of every code point. White space is Unicode's property, which differs from ``str.isspace``."""
    table = np.full(sys.maxunicode + 1, _OTHER, np.uint8)
    for code in range(sys.maxunicode + 1):
        category = unicodedata.category(chr(code))
        if category[0] == "L":
            table[code] = _LETTER
        elif category[0] == "N":
            table[code] = _NUMBER
        elif category in ("Zs", "Zl", "Zp"):
            table[code] = _BLANK
    table[[9, 10, 11, 12, 13, 0x85]] = _BLANK
    table[32] = _SPACE
    table[ord("'")] = _QUOTE
    for characters, kind in (("stmd", _ONE), ("r", _R), ("v", _V), ("l", _L), ("e", _E)):
        table[[ord(c) for c in characters]] = kind
    return table


def _read(states: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The states (several of each row) after reading the row's characters."""
    for column in np.ascontiguousarray(classes.T):
        states = _FLAT_TARGET[states.astype(np.int16) * CLASSES + column[:, None]]
    return states


def start_states(classes: np.ndarray) -> np.ndarray:
    """State at the beginning of each row of ``classes``, rows being chunks in order."""
    chunks, length = classes.shape
    states = np.tile(np.arange(STATES, dtype=np.uint8), (chunks, 1))
    states = _read(states, classes[:, :_SETTLING])
    # By now nearly every chunk has come to one state from all of them, and is read on from that one.
    settled = (states == states[:, :1]).all(axis=1)
    single = _read(states[settled][:, :1], classes[settled, _SETTLING:])
    states[settled] = np.repeat(single, STATES, axis=1)
    states[~settled] = _read(states[~settled], classes[~settled, _SETTLING:])
    # maps[i] leads from the beginning of chunk i to its end; after the scan, from the beginning of all.
    reach = 1
    while reach < chunks:
        # First the earlier map, then the later one.
        states[reach:] = np.take_along_axis(states[reach:], states[:-reach].astype(np.int64), axis=1)
        reach *= 2
    begins = np.full(chunks, START, np.uint8)
    begins[1:] = states[:-1, START]
    return begins


def word_starts(classes: np.ndarray) -> np.ndarray:
    """Positions at which words begin in a sequence of character classes."""
    size = len(classes)
    chunks = -(-size // CHUNK)
    padded = np.full(chunks * CHUNK, _EDGE, np.uint8)
    padded[:size] = classes
    table = padded.reshape(chunks, CHUNK)
    state = start_states(table)
    outputs = np.empty((CHUNK, chunks), np.uint8)
    for column in range(CHUNK):
        at = state.astype(np.int16) * CLASSES + table[:, column]
        outputs[column] = _FLAT_OUTPUT[at]
        state = _FLAT_TARGET[at]
    flat = outputs.T.reshape(-1)[:size]
    begins = (flat & HERE).astype(bool)
    begins[:-1] |= (flat[1:] & BEFORE).astype(bool)
    return np.flatnonzero(begins)


@dataclass
class Words:
    """Words of several texts: byte offsets into ``data``, and the first word of each text."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    text_offsets: np.ndarray

    def texts(self) -> list[bytes]:
        data = self.data.tobytes()
        return [data[a : a + n] for a, n in zip(self.starts.tolist(), self.lengths.tolist())]


def split(texts: list[str]) -> Words:
    """The words of each text, in order; joined they give the text."""
    # Each text ends at an edge, which is not part of any word.
    joined = "\x00".join([*texts, ""])
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum(np.fromiter((len(text) + 1 for text in texts), np.int64, len(texts))) - 1
    classes = character_classes()[codes]
    classes[ends] = _EDGE
    begins = word_starts(classes)
    first = np.searchsorted(begins, ends)
    widths = np.ones(len(codes), np.uint8)
    for limit in (0x80, 0x800, 0x10000):
        widths += codes >= limit
    places = offsets_of(widths)
    starts = places[begins]
    # A word ends where the next begins or at the edge.
    stops = np.append(starts[1:], places[-1]) if len(starts) else starts
    last = first[np.diff(np.append(0, first)) > 0] - 1
    stops[last] = places[ends[np.diff(np.append(0, first)) > 0]]
    return Words(
        np.frombuffer(joined.encode(), np.uint8), starts, stops - starts, np.append(0, first).astype(np.int64)
    )
