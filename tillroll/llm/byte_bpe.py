"""A byte-pair vocabulary: its tokens as bytes, and exact merging of one word."""

import json
from functools import lru_cache

import public_tokenizers

VOCABULARY = "byte_bpe_50k.json"


def _byte_letters() -> dict[str, int]:
    """The letters under which a byte-level vocabulary file writes bytes: printable Latin-1 characters stand for
    themselves, the other bytes for the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairs:
    """``tokens[id]`` is a token's bytes; ``special`` maps the texts of special tokens to ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        letters = _byte_letters()
        model = stored["model"]
        ids = {bytes(letters[c] for c in token): number for token, number in model["vocab"].items()}
        self.special = {token["content"]: token["id"] for token in stored["added_tokens"]}
        self.tokens = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, number in ids.items():
            self.tokens[number] = token
        for text, number in self.special.items():
            self.tokens[number] = text.encode()
        self.single = [ids[bytes([byte])] for byte in range(256)]
        self.ranks: dict[tuple[int, int], int] = {}
        self.joined: list[int] = []
        for rank, (left, right) in enumerate(model["merges"]):
            a, b = (bytes(letters[c] for c in part) for part in (left, right))
            self.ranks[ids[a], ids[b]] = rank
            self.joined.append(ids[a + b])
        self.never = len(self.joined)

    def merge(self, word: bytes) -> list[int]:
        """Ids of a word: the pair of lowest rank is joined, leftmost first, until no pair is left."""
        parts = [self.single[byte] for byte in word]
        if len(parts) > 64:
            return self._merge_long(parts)
        rank_of, never = self.ranks.get, self.never
        ranks = [rank_of(pair, never) for pair in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            place = ranks.index(best)
            parts[place : place + 2] = [self.joined[best]]
            del ranks[place]
            if place:
                ranks[place - 1] = rank_of((parts[place - 1], parts[place]), never)
            if place < len(ranks):
                ranks[place] = rank_of((parts[place], parts[place + 1]), never)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same by a heap over a linked list, for words of any length."""
        import heapq

        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        heap = []

        def offer(i):
            if i >= 0 and after[i] >= 0:
                rank = self.ranks.get((parts[i], parts[after[i]]))
                if rank is not None:
                    heapq.heappush(heap, (rank, i, parts[i], parts[after[i]]))

        for i in range(len(parts)):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue
            parts[i], parts[j] = self.joined[rank], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [part for part in parts if part >= 0]


@lru_cache(2)
def load(path: str | None = None) -> BytePairs:
    return BytePairs(path or public_tokenizers.path(VOCABULARY))
