"""SentencePiece encoding and decoding against the library."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_fixtures import ODD_TEXTS, documents_from, rows_of  # noqa: F401

from tillroll.llm import piece_encoding
from tillroll.llm.piece_encoding import MARK, ChunkTable, Speller

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_encoding.MODEL))


def random_texts(count, seed):
    draw = random.Random(seed)
    letters = "ab'sre'Tt rvlem d\n\t    é1²½٣漢字🙂‍!!''\"—ñß\x85\x1c\x00▁ﬁ中文"
    words = "the hello international 's 1234 !!! ==== aaaa </s> <unk> <0x0A> The ▁ the ▁▁x 中文字".split(" ")
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(count)]
    texts += [draw.choice(["", " ", "\n ", "   "]).join(draw.choice(words) for _ in range(draw.randint(1, 30))) for _ in range(count)]
    return [*texts, *(text or "" for text in ODD_TEXTS), "漢字" * 5000, "=-" * 9000, " " * 5000, "é" * 3000]


def encoded(table, texts):
    flat, offsets = table.encode(texts)
    return [flat[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


@pytest.mark.parametrize("limit", [1 << 18, 20])
def test_ids_are_the_librarys(limit):
    texts = random_texts(1500, 4)
    table = ChunkTable(piece_encoding.load(), limit=limit)
    for i in range(0, len(texts), 400):
        assert encoded(table, texts[i : i + 400]) == LIBRARY.encode(texts[i : i + 400], add_eos=True)


def test_each_distinct_chunk_is_segmented_once(monkeypatch):
    model = piece_encoding.PieceModel(public_tokenizers.path(piece_encoding.MODEL))
    seen, segment = [], model.segment
    monkeypatch.setattr(model, "segment", lambda chunk: seen.append(chunk) or segment(chunk))
    texts = random_texts(300, 5)
    table = ChunkTable(model)
    table.encode(texts)
    table.encode(texts)
    chunks = [chunk for text in texts for some in model.chunks(text) for chunk in some]
    assert len(seen) == len(set(seen)) == table.segmented
    assert set(chunks) <= set(table.numbers) and len(set(chunks)) < len(chunks)
    # What was not segmented whole is a word and the marks after it.
    for chunk in set(chunks) - set(seen):
        word = chunk.rstrip(piece_encoding._MARKS)
        assert word in table.numbers and chunk[len(word) :] in table.numbers


def test_chunks_join_to_the_marked_text(monkeypatch):
    model = piece_encoding.load()
    texts = [*random_texts(300, 6), "one two  three " * 4000]
    for span in (1 << 20, 100):
        monkeypatch.setattr(piece_encoding, "_SPAN", span)
        for text in texts:
            marked = LIBRARY.normalize(text) if text else ""
            chunks = [chunk for some in model.chunks(text) for chunk in some]
            assert "".join(chunks) == marked
            assert not any(re.search(f"[^{MARK}]{MARK}", chunk) for chunk in chunks)
        assert encoded(ChunkTable(model), texts) == LIBRARY.encode(texts, add_eos=True)


def test_short_and_long_merging_agree():
    model = piece_encoding.load()
    draw = random.Random(2)
    for _ in range(2000):
        chunk = "".join(draw.choice("▁theinrsoa.=- é中漢") for _ in range(draw.randint(1, 80)))
        assert model._merged(chunk) == model._merged_short(chunk)
        assert model.segment(chunk) == model._merged(chunk)


def test_a_model_whose_pieces_cross_markers_is_not_cut():
    model = piece_encoding.PieceModel(public_tokenizers.path(piece_encoding.MODEL))
    model.crossing, model.cut = True, re.compile(".+", re.DOTALL)
    texts = [text for text in random_texts(100, 9) if len(text) < 2000]
    assert encoded(ChunkTable(model), texts) == LIBRARY.encode(texts, add_eos=True)


def test_texts_are_the_librarys():
    speller = Speller(piece_encoding.load())
    for text in random_texts(500, 7):
        ids = LIBRARY.encode(text, add_eos=True)
        assert speller.spell(np.array(ids, np.int32)) == LIBRARY.decode(ids) == text.replace(MARK, " ")
    draw = random.Random(8)
    for _ in range(3000):  # bytes that are no UTF-8, control and unknown ids among others
        ids = [draw.randrange(300 if draw.random() < 0.7 else 32000) for _ in range(draw.randint(0, 20))]
        assert speller.spell(np.array(ids, np.int32)) == LIBRARY.decode(ids)


def test_rows(spark, documents_from):
    documents = documents_from(ODD_TEXTS)
    got = rows_of(piece_encoding.digest(piece_encoding.round_trip(documents)))
    wanted = []
    for i, text in enumerate(ODD_TEXTS):
        ids = LIBRARY.encode(text or "", add_eos=True)
        spelt = LIBRARY.decode(ids)
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), spelt)]
        wanted.append((i, len(ids), *digests))
    assert got == sorted(wanted)


def test_all_columns_stay_and_clashing_ones_are_replaced(spark, documents_from):
    documents = documents_from(["one two", None])
    out = piece_encoding.decode(piece_encoding.encode(documents))
    assert set(out.columns) == set(documents.columns)
    rows = {row["doc_id"]: row for row in out.collect()}
    assert rows[0]["ids"] == LIBRARY.encode("one two", add_eos=True) and rows[0]["decoded"] == "one two"
    assert rows[1]["ids"] == [2] and rows[1]["decoded"] == "" and rows[1]["n"] == "clash"
    assert piece_encoding.digest(piece_encoding.round_trip(documents.limit(0))).collect() == []
    missing = out.withColumn("ids", out["ids"].cast("array<int>")).selectExpr("doc_id", "if(doc_id = 0, NULL, ids) AS ids")
    assert {row["doc_id"]: row["decoded"] for row in piece_encoding.decode(missing).collect()} == {0: None, 1: ""}


def test_repeated_and_missing_ids(spark):
    rows = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (None, None)], "doc_id BIGINT, text STRING")
    got = piece_encoding.digest(piece_encoding.round_trip(rows)).collect()
    assert sorted((row["doc_id"] or 0, row["n_tokens"]) for row in got) == [(0, 1), (0, 3), (1, 3), (1, 3)]
