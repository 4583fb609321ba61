"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text becomes lower-case letters with one space for whatever lies between them. Its n-grams of one to four
characters are hashed to a fixed number of buckets. Training counts buckets by language over all training documents;
the matrix of log-probabilities, whose size depends on the numbers of languages and buckets only, is broadcast, and
batches of texts are scored as sparse count matrices in numpy.
"""

import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import pieces

ORDERS = 4
BUCKET_BITS = 16
SMOOTHING = 0.5
#: The broadcast matrix has this many columns at most, of a quarter of a megabyte each.
MAX_LANGUAGES = 1000
UNKNOWN = "und"

_BLOCK = 1 << 10
_MERGE_WAYS = 256
_EDGE = 0
_MIX = np.uint32(0x9E3779B1)


@lru_cache(1)
def _letters() -> np.ndarray:
    kinds = (unicodedata.category(chr(code))[0] for code in range(sys.maxunicode + 1))
    return np.fromiter((kind == "L" for kind in kinds), bool, sys.maxunicode + 1)


def normal_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts, each word after a space and each text between edges; where the texts begin."""
    joined = "\x00".join(["", *texts, ""]).lower()
    # Lower case may change a text's length, so edges are told from text by their count.
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    edges = np.flatnonzero(codes == _EDGE)
    if len(edges) != len(texts) + 1:  # a text holds the edge character itself
        return normal_codes([text.replace("\x00", " ") for text in texts])
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:]
    keep[edges] = True
    kept = np.where(letter, codes, 32).astype(np.uint32)
    kept[edges] = _EDGE
    kept = kept[keep]
    return kept, np.flatnonzero(kept == _EDGE)


def buckets(codes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Places at which an n-gram of one text begins, and its bucket."""
    size = len(codes) - order + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed = np.full(size, order, np.uint32)
    inside = np.ones(size, bool)
    for i in range(order):
        part = codes[i : size + i]
        mixed = (mixed ^ part) * _MIX
        mixed ^= mixed >> np.uint32(15)
        inside &= part != _EDGE
    if order == 1:
        inside &= codes != 32
    places = np.flatnonzero(inside)
    return places, (mixed[places] >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def _count(batches):
    """Bucket counts of a partition by language, in blocks."""
    size = 1 << BUCKET_BITS
    counts: dict[str, np.ndarray] = {}
    documents: dict[str, int] = {}
    for piece in pieces(batches):
        langs = piece.column("lang").to_pylist()
        names = sorted(set(langs))
        place = {name: i for i, name in enumerate(names)}
        codes, edges = normal_codes([text or "" for text in piece.column("text").to_pylist()])
        lang_of_text = np.array([place[lang] for lang in langs], np.int64)
        lang_of_code = np.repeat(np.append(lang_of_text, 0), np.diff(np.append(edges, len(codes))))
        total = np.zeros(len(names) * size, np.int64)
        for order in range(1, ORDERS + 1):
            places, found = buckets(codes, order)
            total += np.bincount(lang_of_code[places] * size + found, minlength=len(total))
        for name in names:
            part = total[place[name] * size :][:size]
            counts[name] = counts[name] + part if name in counts else part.copy()
            documents[name] = documents.get(name, 0) + langs.count(name)
    for name, table in counts.items():
        blocks = table.reshape(-1, _BLOCK)
        rows = len(blocks)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([name] * rows),
                pa.array(range(rows), pa.int32()),
                pa.array([documents[name]] * rows, pa.int64()),
                pa.array([block.tobytes() for block in blocks], pa.binary()),
            ],
            names=["lang", "block", "docs", "counts"],
        )


def _add(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(_BLOCK, np.int64)
    for blob in frame["counts"]:
        total += np.frombuffer(blob, np.int64)
    first = frame.iloc[0]
    row = {"lang": first["lang"], "block": first["block"], "docs": frame["docs"].sum(), "counts": total.tobytes()}
    return pd.DataFrame([row])


_COUNTS = "lang STRING, block INT, docs BIGINT, counts BINARY"


def bucket_counts(training: DataFrame) -> DataFrame:
    """Counts of all training rows (``text``, ``lang``): per language and block of buckets.

    Partitions' counts are added in two rounds, so that no group holds a block of every partition.
    """
    parts = training.select("text", "lang").mapInArrow(_count, _COUNTS)
    ways = parts.withColumn("way", F.spark_partition_id() % _MERGE_WAYS)
    once = ways.groupBy("lang", "block", "way").applyInPandas(lambda frame: _add(frame), _COUNTS)
    return once.groupBy("lang", "block").applyInPandas(lambda frame: _add(frame), _COUNTS)


class Model:
    def __init__(self, languages: list[str], prior: np.ndarray, logs: np.ndarray):
        self.languages, self.prior, self.logs = languages, prior, logs

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Joint log-probability of each text and language, and the n-grams of each text."""
        codes, edges = normal_codes(texts)
        totals = np.tile(self.prior, (len(texts), 1))
        grams = np.zeros(len(texts), np.int64)
        for order in range(1, ORDERS + 1):
            places, found = buckets(codes, order)
            bounds = np.searchsorted(places, edges)
            sizes = np.diff(bounds)
            grams += sizes
            filled = np.flatnonzero(sizes)
            if len(filled):
                for lang in range(len(self.languages)):
                    weights = self.logs[lang][found]
                    totals[filled, lang] += np.add.reduceat(weights, bounds[filled], dtype=np.float64)
        return totals, grams

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        totals, grams = self.scores(texts)
        best = totals.argmax(axis=1)
        # The posterior of the best language.
        shares = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
        known = grams > 0
        names = [self.languages[i] if k else UNKNOWN for i, k in zip(best.tolist(), known.tolist())]
        return names, np.where(known, shares, 0.0)


def train(training: DataFrame) -> Model:
    """The model from all rows with a language; the driver receives sums alone."""
    labelled = training.filter(F.col("lang").isNotNull())
    rows = bucket_counts(labelled).collect()
    languages = sorted({row["lang"] for row in rows})
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; the matrix is built for {MAX_LANGUAGES}")
    size = 1 << BUCKET_BITS
    counts = np.zeros((len(languages), size))
    documents = np.zeros(len(languages))
    for row in rows:
        place = languages.index(row["lang"])
        start = row["block"] * _BLOCK
        counts[place, start : start + _BLOCK] = np.frombuffer(row["counts"], np.int64)
        documents[place] = row["docs"]
    logs = np.log((counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * size))
    prior = np.log(documents / documents.sum()) if len(rows) else documents
    return Model(languages, prior, logs.astype(np.float32))


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` (all columns) with ``lang_pred`` and ``score``, the posterior of the prediction.

    Reads ``text`` alone. NULL texts and texts without letters are ``und`` with score 0; equally likely languages go
    to the first by name. Columns of these two names are replaced. No shuffle.
    """
    kept = [name for name in documents.columns if name not in ("lang_pred", "score")]
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for piece in pieces(batches):
            names, shares = sent.value.predict([text or "" for text in piece.column("text").to_pylist()])
            arrays = [piece.column(name) for name in kept]
            arrays += [pa.array(names, pa.string()), pa.array(shares, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(kept).schema.fields)
    return documents.select(kept).mapInArrow(score, f"{fields}, lang_pred STRING, score DOUBLE")


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; -1 for a NULL id."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % folds, F.lit(-1))


def held_out_predictions(documents: DataFrame) -> DataFrame:
    """Trains on three of four folds of ``documents`` and predicts all of them."""
    held_out = fold("doc_id", 4) == 2
    model = train(documents.filter(~held_out))
    rows = documents.select("doc_id", "text", held_out.alias("held_out"))
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")
