"""Whitening of embeddings: pivoted Cholesky of the centred scatter, one-sided Jacobi on the triangular factor.

The scatter of the distinct vectors is added up by Spark, in two passes over a stored list: exact sums first, then
products of centred entries. Its pivoted factor is triangular with falling diagonal; rotations of pairs of its columns
make them orthogonal, and as the factor times its transpose is the scatter, the columns' squared norms are then its
eigenvalues and the normalised columns its components. Every row is projected where it lies.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.sinks.scratch import materialise

SCALE = 64
OFFSET = 1_000_000
#: Entries of this size and more count as not finite: sums of 2^33 scaled ones fit 64 bits.
TOO_LARGE = 1 << 24
_SWEEPS = 60


@dataclass(frozen=True)
class Model:
    """Whitening of the vectors of one length. ``components`` are rows, by falling ``eigenvalues``."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Vectors less their mean, whose whole part is taken off as whole numbers."""
        whole = np.array([total // self.n for total in self.sums], np.int64)
        rest = np.array([total % self.n / self.n for total in self.sums])
        return (x - whole) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T / np.sqrt(self.eigenvalues)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Per vector, the sum of ``(n * x - sum)^2``, exactly."""
        whole = np.array([total // self.n for total in self.sums], np.int64)
        rest = np.array([total % self.n for total in self.sums], np.int64)
        apart = x - whole
        # |n * apart - rest| in floating point, with room for its rounding.
        bound = np.abs(apart).astype(np.float64).max(initial=0) * self.n + self.n
        if bound < 2.0**62 and bound * bound * x.shape[1] < 2.0**62:
            exact = self.n * apart - rest
            return (exact * exact).sum(axis=1).tolist()
        exact = self.n * apart.astype(object) - rest.astype(object)
        return [sum(entry * entry for entry in line) for line in exact.tolist()]


def scaled(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, ``size`` and ``x``, the vector as whole numbers, of rows whose entries are all there and finite."""
    fine = F.forall(
        "embedding", lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float(TOO_LARGE)), F.lit(False))
    )
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE) + F.lit(OFFSET))
    return (
        embeddings.select("vec_id", "embedding")
        .filter(F.coalesce(fine, F.lit(False)))
        .select("vec_id", F.size("embedding").alias("size"), x.alias("x"))
    )


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """A factor ``f`` with ``f @ f.T`` the symmetric ``matrix``, one column for each dimension of its range.

    The largest diagonal entry left is the next pivot, so rows in pivot order make a lower triangle; they are returned
    in the matrix's own order.
    """
    left = matrix.copy()
    least = len(matrix) * np.finfo(float).eps * left.diagonal().max(initial=0)
    columns, free = [], np.ones(len(matrix), bool)
    for _ in range(len(matrix)):
        pivot = int(np.argmax(np.where(free, left.diagonal(), -np.inf)))
        if not left[pivot, pivot] > least:
            break
        column = np.where(free, left[:, pivot], 0) / np.sqrt(left[pivot, pivot])
        left -= np.outer(column, column)
        free[pivot] = False
        columns.append(column)
    return np.array(columns).T.reshape(len(matrix), len(columns))


def rounds(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``range(size)`` in rounds of disjoint pairs, as in a tournament."""
    seats = list(range(size + size % 2))
    out = []
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:])) if max(a, b) < size]
        out.append((np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int)))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return out


def jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors (rows) of ``factor @ factor.T``, largest first.

    Pairs of columns are turned until each is at right angles to all others, up to rounding; the pairs of a round are
    disjoint and turn together. The largest entry of each vector is made positive.
    """
    turned = np.ascontiguousarray(factor.T)
    limit = len(factor) * np.finfo(float).eps
    schedule = rounds(len(turned))
    for _ in range(_SWEEPS):
        worst = 0.0
        for p, q in schedule:
            a, b = turned[p], turned[q]
            aa, bb, ab = (a * a).sum(1), (b * b).sum(1), (a * b).sum(1)
            cosine = np.abs(ab) / np.sqrt(aa * bb)
            worst = max(worst, cosine.max(initial=0))
            some = cosine > np.finfo(float).eps
            slope = (bb - aa) / np.where(some, 2 * ab, 1)
            tangent = np.where(slope < 0, -1.0, 1.0) / (np.abs(slope) + np.hypot(1, slope))
            tangent = np.where(some, tangent, 0)[:, None]
            c = 1 / np.sqrt(1 + tangent * tangent)
            turned[p], turned[q] = c * (a - tangent * b), c * (b + tangent * a)
        if worst <= limit:
            break
    norms = np.sqrt((turned * turned).sum(1))
    order = np.argsort(-norms, kind="stable")
    vectors = turned[order] / norms[order][:, None]
    largest = np.abs(vectors).argmax(axis=1) if len(vectors) else np.zeros(0, int)
    return norms[order] ** 2, vectors * np.sign(vectors[np.arange(len(vectors)), largest])[:, None]


def _vectors(batch: pa.RecordBatch) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length, the vectors of a batch and their places in it."""
    sizes = batch.column("size").to_numpy()
    out = {}
    for size in np.unique(sizes).tolist():
        places = np.flatnonzero(sizes == size)
        own = batch.column("x") if len(places) == len(sizes) else batch.column("x").take(pa.array(places))
        out[size] = places, own.flatten().to_numpy(zero_copy_only=False).reshape(len(places), size)
    return out


def _totals(vectors: DataFrame, made, kind: str) -> dict[int, np.ndarray]:
    """Per length, the sum over all vectors of ``made(size, x)``, a matrix of one shape per length.

    A task adds up its own vectors; Spark adds up the entries of all tasks. The driver gets one matrix per length.
    """
    element = pa.int64() if kind.startswith("decimal") else pa.float64()

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, (_, x) in _vectors(batch).items():
                part = made(size, x)
                sums[size] = sums[size] + part if size in sums else part
        for size, total in sums.items():
            for line, values in enumerate(total.tolist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size], pa.int32()), pa.array([line], pa.int32()), pa.array([values], pa.list_(element))],
                    names=["size", "line", "entries"],
                )

    numbers = "BIGINT" if pa.types.is_integer(element) else "DOUBLE"
    parts = vectors.select("size", "x").mapInArrow(run, f"size INT, line INT, entries ARRAY<{numbers}>")
    added = (
        parts.select("size", "line", F.posexplode("entries").alias("place", "entry"))
        .groupBy("size", "line", "place")
        .agg(F.sum(F.col("entry").cast(kind)).alias("total"))
    )
    out: dict[int, dict[tuple[int, int], object]] = {}
    for size, line, place, total in added.collect():
        out.setdefault(size, {})[line, place] = total
    return {size: _filled(entries) for size, entries in out.items()}


def _filled(entries: dict) -> np.ndarray:
    lines, places = (max(index) + 1 for index in zip(*entries))
    exact = not isinstance(next(iter(entries.values())), float)
    out = np.zeros((lines, places), object if exact else float)
    for index, total in entries.items():
        out[index] = int(total) if exact else total
    return out


def fit(vectors: DataFrame, components: int) -> dict[int, Model]:
    """A model per length of the distinct ``vectors`` (``size``, ``x``)."""
    sums = _totals(
        vectors, lambda size, x: np.concatenate([x.sum(axis=0), [len(x)]]).reshape(1, -1), "decimal(38,0)"
    )
    models = {}
    for size, total in sums.items():
        *own, n = total[0].tolist()
        models[size] = Model(n, own, np.zeros(0), np.zeros((0, size)), 0.0)

    def scatter(size, x):
        centred = models[size].centred(x)
        return centred.T @ centred

    for size, total in _totals(vectors, scatter, "double").items():
        model = models[size]
        covariance = (total + total.T) / 2 / model.n
        values, rows = jacobi(pivoted_cholesky(covariance))
        models[size] = Model(
            model.n, model.sums, values[:components], rows[:components], float(covariance.diagonal().sum())
        )

    def products(size, x):
        w = models[size].whitened(x)
        return np.concatenate([w.T @ w, w.sum(axis=0).reshape(1, -1)])

    for size, total in _totals(vectors, products, "double").items():
        model = models[size]
        mean = total[-1] / model.n
        apart = total[:-1] / model.n - np.outer(mean, mean) - np.eye(len(mean))
        models[size] = Model(
            model.n, model.sums, model.eigenvalues, model.components, model.trace, float(np.abs(apart).max(initial=0))
        )
    return models


def whitened(embeddings: DataFrame, components: int = 16) -> DataFrame:
    """The first ``components`` whitened coordinates of each row of ``embeddings`` (``vec_id``, ``embedding``).

    An entry ``c`` becomes ``floor(64 * c) + 1000000``; mean, scatter and components are those of the distinct vectors
    of whole numbers. Rows whose vector is NULL or has an entry that is NULL, not finite or of 2^24 and more are left
    out. Other columns are ignored, ids may repeat or be NULL, and equal rows each have their result. Vectors of
    different lengths are whitened apart, each length by its own fit. Only components of positive variance exist: fewer
    than ``components`` where the vectors span less, none for one distinct vector or an empty table. ``deviation`` is
    NULL where it is beyond BIGINT.

    Per row and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``. The driver holds a
    matrix of ``length^2`` doubles, never vectors.
    """
    rows = scaled(embeddings)
    vectors = materialise(rows.select("size", "x").filter("size > 0").distinct(), "vectors")
    models = fit(vectors, components)
    names = ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches):
        for batch in batches:
            for size, (places, x) in _vectors(batch).items():
                model = models.get(size)
                if model is None or not len(model.eigenvalues):
                    continue
                count = len(places)
                deviations = [d if d < 1 << 63 else None for d in model.deviations(x)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(places)),
                        pa.array(np.full(count, model.n)),
                        pa.array(deviations, pa.int64()),
                        pa.array(list(model.whitened(x)), pa.list_(pa.float64())),
                        pa.array([(model.eigenvalues / model.trace).tolist()] * count, pa.list_(pa.float64())),
                        pa.array(np.full(count, model.identity_error)),
                    ],
                    names=names,
                )

    kind = embeddings.schema["vec_id"].dataType.simpleString()
    projected = rows.mapInArrow(
        run,
        f"vec_id {kind}, n BIGINT, deviation BIGINT, whitened ARRAY<DOUBLE>, explained ARRAY<DOUBLE>, identity_error DOUBLE",
    )
    both = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "pair")
    return projected.select("vec_id", "n", "deviation", "identity_error", both).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("pair.whitened").alias("whitened"),
        F.col("pair.explained").alias("explained"),
        "identity_error",
    )
