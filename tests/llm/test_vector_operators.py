"""Whitening and hard negatives against plain numpy and brute force."""

import math
import random

import numpy as np
import pytest
from llm_fixtures import rows_of
from pyspark.sql import functions as F

from tillroll.llm import hard_negatives, whitening
from tillroll.llm.strassen import inner_products

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, rank STRING, x STRING, n STRING, score STRING"
NAN, INF = float("nan"), float("inf")


def table_of(spark, rows):
    """Rows of (id, vector, label) with clashing extra columns."""
    return spark.createDataFrame([(*row, "a", "b", "c", "d") for row in rows], SCHEMA).repartition(3)


def vectors(count, size, seed, spread=0.3):
    draw = np.random.default_rng(seed)
    mixed = draw.normal(size=(count, size)) @ draw.normal(size=(size, size)) * spread
    return mixed.astype(np.float32)


def plain_whitening(embeddings, components):
    """Whitened rows, explained shares and deviations by the library's eigenvectors."""
    x = np.floor(embeddings.astype(float) * 64).astype(np.int64) + 1_000_000
    fitted = np.unique(x, axis=0)
    n, sums = len(fitted), fitted.sum(axis=0)
    centred = (n * fitted - sums) / n
    covariance = centred.T @ centred / n
    values, columns = np.linalg.eigh(covariance)
    values, columns = values[::-1][:components], columns[:, ::-1][:, :components]
    rows = (n * x - sums) / n @ columns / np.sqrt(values)
    deviations = [sum(int(v) ** 2 for v in line) for line in (n * x - sums).tolist()]
    return n, rows, values / np.trace(covariance), deviations


@pytest.mark.parametrize("size", [1, 2, 7, 20])
def test_whitening_is_that_of_the_library(spark, size):
    own = vectors(400, size, size)
    own = np.concatenate([own, own[:50]])  # copies weigh once
    n, wanted, shares, deviations = plain_whitening(own, 16)
    rows = [(i, own[i].tolist(), 0) for i in range(len(own))]
    got = whitening.whitened(table_of(spark, rows)).toPandas().sort_values(["vec_id", "component"])
    kept = min(size, 16)
    assert len(got) == len(own) * kept
    assert got["component"].tolist() == list(range(1, kept + 1)) * len(own)
    found = got["whitened"].to_numpy().reshape(len(own), kept)
    found = found * np.sign((found * wanted).sum(axis=0))
    assert np.abs(found - wanted).max() < 1e-8
    assert np.abs(got["explained"].to_numpy()[:kept] / shares - 1).max() < 1e-9
    assert got["deviation"].to_numpy().reshape(len(own), kept)[:, 0].tolist() == deviations
    assert set(got["n"]) == {n}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].max() < 1e-9


def test_factor_and_rotation():
    draw = np.random.default_rng(1)
    for size, rank in [(1, 1), (5, 5), (12, 4), (33, 33)]:
        root = draw.normal(size=(size, rank)) * 10.0 ** np.arange(rank) ** 0.5
        matrix = root @ root.T
        factor = whitening.pivoted_cholesky(matrix)
        assert factor.shape == (size, rank)
        assert np.abs(factor @ factor.T - matrix).max() <= 1e-13 * np.abs(matrix).max() * size
        # In pivot order the factor is triangular with a falling diagonal.
        pivots = [int(np.flatnonzero(factor[:, k] * (factor[:, k + 1 :] == 0).all(axis=1))[0]) for k in range(rank)]
        assert len(set(pivots)) == rank
        values, rows = whitening.jacobi(factor)
        wanted = np.linalg.eigvalsh(matrix)[::-1][:rank]
        assert np.abs(values - wanted).max() < 1e-13 * wanted[0] * size
        assert np.abs(rows @ rows.T - np.eye(rank)).max() < 1e-12
        assert np.abs(matrix @ rows.T - rows.T * values).max() < 1e-12 * values[0] * size
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


@pytest.mark.parametrize("size", [0, 1, 2, 5, 8])
def test_rounds_meet_every_pair_once(size):
    met = sorted((min(a, b), max(a, b)) for p, q in whitening.rounds(size) for a, b in zip(p.tolist(), q.tolist()))
    assert met == [(a, b) for a in range(size) for b in range(a + 1, size)]
    assert all(len({*p.tolist(), *q.tolist()}) == 2 * len(p) for p, q in whitening.rounds(size))


def test_whitening_of_odd_rows(spark):
    good = vectors(40, 3, 9)
    odd = [
        (None, good[0].tolist(), None),  # a NULL id and label
        (900, None, 1),
        (901, [1.0, None, 2.0], 1),
        (902, [1.0, NAN, 2.0], 1),
        (903, [1.0, INF, 2.0], 1),
        (904, [1e30, 0.0, 0.0], 1),
        (905, [], 1),
        (906, [0.5, 0.25], 1),  # alone of its length: no variance
        (3, good[3].tolist(), 1),  # a repeated row
    ]
    rows = [(i, own.tolist(), 1) for i, own in enumerate(good)] + odd
    got = rows_of(whitening.whitened(table_of(spark, rows)).fillna(-1, ["vec_id"]), "vec_id", "component", "n")
    wanted = [*range(40), -1, 3]
    assert got == sorted((i, component, 40) for i in wanted for component in (1, 2, 3))
    assert whitening.whitened(table_of(spark, rows).limit(0)).collect() == []
    same = [(i, [1.0, 2.0], 1) for i in range(5)]
    assert whitening.whitened(table_of(spark, same)).collect() == []
    # A plane in three dimensions has two components.
    flat = [(i, [float(a), float(b), float(a + b)], 1) for i, (a, b) in enumerate(np.random.default_rng(2).integers(-9, 9, (60, 2)).tolist())]
    got = whitening.whitened(table_of(spark, flat)).toPandas()
    assert sorted(set(got["component"])) == [1, 2] and got["identity_error"].max() < 1e-9


def test_exact_deviations_beyond_the_fast_path():
    draw = np.random.default_rng(4)
    x = draw.integers(-(1 << 30), 1 << 30, (50, 4))
    model = whitening.Model(50, x.sum(axis=0).tolist(), np.zeros(0), np.zeros((0, 4)), 1.0)
    large = whitening.Model(1 << 31, [7, -7, 1 << 60, 0], np.zeros(0), np.zeros((0, 4)), 1.0)
    for own in (model, large):
        wanted = [sum((own.n * v - s) ** 2 for v, s in zip(line, own.sums)) for line in x.tolist()]
        assert own.deviations(x) == wanted


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 2), (33, 65, 129), (40, 64, 70), (100, 7, 100), (0, 3, 4), (2, 0, 2)])
@pytest.mark.parametrize("leaf", [1, 4, 32])
def test_strassen_is_exact(shape, leaf):
    draw = np.random.default_rng(sum(shape))
    rows, width, columns = shape
    for size in (200, 1 << 28):
        a, b = draw.integers(-size, size, (rows, width)), draw.integers(-size, size, (columns, width))
        assert (inner_products(a, b, leaf) == a @ b.T).all()


def plain_mining(rows, anchors, positives, negatives, low, high):
    """By brute force over all pairs."""
    usable = []
    for number, vector, label in rows:
        if label is None or vector is None or any(c is None or not abs(c) < 2**18 for c in vector):
            continue
        usable.append((number, [math.floor(256 * float(np.float32(c))) for c in vector], label))
    chosen = {(i, tuple(v), label) for i, v, label in usable if i is not None and anchors(i)}
    out = []
    for number, vector, label in sorted(chosen):
        scored = sorted(
            (-sum(a * b for a, b in zip(vector, other)), i is None, i or 0, own == label)
            for i, other, own in usable
            if i != number
        )
        same = [(-s, None if none else i) for s, none, i, equal in scored if equal][:positives]
        others = [(-s, None if none else i) for s, none, i, equal in scored if not equal]
        for score, partner in same:
            inside = [(s, i) for s, i in others if low * score <= 100 * s <= high * score][:negatives]
            out += [(number, partner, rank, i, score, s) for rank, (s, i) in enumerate(inside, 1)]
    return sorted(out, key=repr)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mined_rows(frame):
    return sorted((tuple(row[c] for c in COLUMNS) for row in frame.collect()), key=repr)


def noisy_rows(seed, count=400, size=6):
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        vector = [draw.choice([draw.uniform(-1, 1), 0.5, -0.25]) for _ in range(draw.choice([size, size, size - 2]))]
        rows.append((i, vector, draw.choice([0, 1, 1, 1, 2])))
    hot = [0.5, 0.25, 0.5, 0.125, 0.0, 0.5][:size]
    rows += [(1000 + i, hot, i % 3) for i in range(150)]  # many equal vectors: ties by id
    rows += [
        (2000, None, 1), (2010, [NAN] * size, 1), (2020, [INF] * size, 1), (2030, [None] * size, 1), (2040, hot, None),
        (2050, [], 1), (2060, [3e5] * size, 1), (None, hot, 1), (None, hot, 2),
        rows[0], rows[0], (0, hot, 2), rows[7],
    ]
    return rows


@pytest.mark.parametrize("cells", [(1 << 16, 1 << 16), (7, 50)])
def test_mining_is_that_of_brute_force(spark, cells, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 37 if cells[0] == 7 else 4096)
    rows = noisy_rows(3)
    frame = table_of(spark, rows)
    got = hard_negatives.mined(
        frame, F.col("vec_id") % 10 == 0, cell_anchors=cells[0], cell_rows=cells[1]
    )
    assert mined_rows(got) == plain_mining(rows, lambda i: i % 10 == 0, 5, 5, 80, 100)
    assert mined_rows(got)


def test_mining_with_other_sizes_and_labels_of_text(spark):
    rows = noisy_rows(8, count=120)
    frame = table_of(spark, rows).withColumn("label", F.concat(F.lit("l"), "label"))
    got = hard_negatives.mined(frame, F.col("vec_id") % 5 == 0, positives=2, negatives=3, low=50, high=90)
    assert mined_rows(got) == plain_mining(rows, lambda i: i % 5 == 0, 2, 3, 50, 90)


def test_mining_without_rows(spark):
    rows = noisy_rows(3, count=20)
    frame = table_of(spark, rows)
    assert hard_negatives.mined(frame.limit(0), F.col("vec_id") % 10 == 0).collect() == []
    assert hard_negatives.mined(frame, F.lit(False)).collect() == []
    alone = table_of(spark, [(i, [1.0, 0.5], i) for i in range(12)])
    assert hard_negatives.mined(alone, F.col("vec_id") % 10 == 0).collect() == []


def test_heaps_merge_in_any_order():
    draw = np.random.default_rng(6)
    score = draw.integers(0, 9, 300)
    slot = np.sort(draw.integers(0, 5, 300))
    heaps = hard_negatives.Heaps(5, 4)
    for part in np.array_split(draw.permutation(300), 11):
        part = np.sort(part)
        heaps.merge(slot[part], score[part], part)
    for one in range(5):
        own = sorted((-score[i], i) for i in np.flatnonzero(slot == one))[:4]
        assert list(zip((-heaps.score[one]).tolist(), heaps.row[one].tolist())) == own
