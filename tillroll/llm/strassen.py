"""Inner products of int64 rows by Strassen's recursion."""

import numpy as np

#: Sides up to this length are multiplied directly.
LEAF = 32


def inner_products(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b.T`` for int64 matrices, exact wherever the result fits 64 bits.

    Both are padded with zeros until every level halves all sides evenly. Additions and products of the recursion wrap
    around modulo 2^64, so an intermediate that does not fit does no harm.
    """
    rows, width, columns = len(a), a.shape[1], len(b)
    if not min(rows, width, columns):
        return np.zeros((rows, columns), np.int64)
    levels = 0
    while min(rows, width, columns) > leaf << levels:
        levels += 1
    padded = [-(-side // (1 << levels)) << levels for side in (rows, width, columns)]
    left, right = _padded(a, padded[0], padded[1]), _padded(b, padded[2], padded[1])
    return _multiply(left, right, levels)[:rows, :columns]


def _padded(matrix: np.ndarray, rows: int, columns: int) -> np.ndarray:
    if matrix.shape == (rows, columns):
        return matrix
    out = np.zeros((rows, columns), np.int64)
    out[: matrix.shape[0], : matrix.shape[1]] = matrix
    return out


def _multiply(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return a @ b.T
    rows, width, columns = a.shape[0] // 2, a.shape[1] // 2, b.shape[0] // 2
    a11, a12, a21, a22 = a[:rows, :width], a[:rows, width:], a[rows:, :width], a[rows:, width:]
    # Quarters of the right matrix, by their place in its transpose.
    b11, b21, b12, b22 = b[:columns, :width], b[:columns, width:], b[columns:, :width], b[columns:, width:]
    out = np.empty((2 * rows, 2 * columns), np.int64)
    c11, c12, c21, c22 = out[:rows, :columns], out[:rows, columns:], out[rows:, :columns], out[rows:, columns:]
    # Each of the seven products is added where it belongs and dropped.
    levels -= 1
    m = _multiply(a11 + a22, b11 + b22, levels)
    c11[:] = m
    c22[:] = m
    m = _multiply(a21 + a22, b11, levels)
    c21[:] = m
    c22 -= m
    m = _multiply(a11, b12 - b22, levels)
    c12[:] = m
    c22 += m
    m = _multiply(a22, b21 - b11, levels)
    c11 += m
    c21 += m
    m = _multiply(a11 + a12, b22, levels)
    c11 -= m
    c12 += m
    c22 += _multiply(a21 - a11, b11 + b12, levels)
    c11 += _multiply(a12 - a22, b21 + b22, levels)
    return out
