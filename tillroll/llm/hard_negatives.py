"""Hard negatives of anchors: inner products by Strassen's recursion, the best kept in mergeable heaps.

Anchors and rows are dealt to a grid: a cell holds a bounded number of anchors and of rows, and every anchor meets every
row in just one cell. In a cell, tiles of scores come from ``strassen.inner_products``; each anchor's best rows stay in a
small sorted heap that merges with the next tile's, and the heaps of all cells merge by rank. A first pass finds the
positives, over rows of the anchor's label. A second finds, in the window of scores below each positive, the best rows
of other labels.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.batches import offsets_of, ranges
from tillroll.llm.strassen import inner_products
from tillroll.sinks.scratch import materialise

SCALE = 256
#: Anchors and rows in a cell of the grid, at most and on average.
CELL_ANCHORS = 1 << 16
CELL_ROWS = 1 << 16
#: A row with an entry of this size after scaling takes no part, so that scores of up to 1,024 dimensions fit 64 bits.
TOO_LARGE = 1 << 26
#: Sides of a tile of scores.
TILE_ANCHORS = 512
TILE_ROWS = 4096
_LOWEST = np.iinfo(np.int64).min
_FOUND = "anchor_id BIGINT, variant BIGINT, top BIGINT, partner BIGINT, score BIGINT"
_FOUND_NAMES = ["anchor_id", "variant", "top", "partner", "score"]


def mined(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    cell_anchors: int = CELL_ANCHORS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """For each row with ``is_anchor``, its ``positives`` best other rows of the same label, and for each of those the
    ``negatives`` best rows of other labels with ``low * positive_score <= 100 * score <= high * positive_score``.

    Reads ``vec_id``, ``label`` and ``embedding`` (an array of FLOAT or DOUBLE); other columns are ignored. A score is
    the inner product of the ``floor(256 * entry)``; higher ones come first, then smaller ids, a NULL id last. Rows with
    a NULL label, a NULL vector or an entry that is NULL, not finite or of 2^18 and more take no part; rows without an
    id are no anchors. Vectors of different lengths meet as if the shorter ended in zeros. Rows with the anchor's own
    id, copies of it too, are not its partners. Any other repeated row counts as often as it is there; an anchor that
    is there several times gives its rows once. An empty table, an anchor without positives and a window without rows
    give no rows.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    """
    stored = materialise(_usable(rows, is_anchor), "vectors")
    anchors = (
        stored.filter(F.col("picked") & F.col("vec_id").isNotNull())
        .select(
            F.col("vec_id").alias("anchor_id"),
            F.xxhash64("label", "embedding").alias("variant"),
            # Names of their own: in a cogroup, columns that both sides share are lost on one.
            F.col("label").alias("own_label"),
            F.col("embedding").alias("own_vector"),
        )
        .dropDuplicates(["anchor_id", "variant"])
    )
    n_rows, n_anchors = stored.count(), anchors.count()
    spread = min(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-n_rows // TILE_ROWS))
    across = max(-(-n_rows // cell_rows), spread, 1)
    down = max(-(-n_anchors // cell_anchors), 1)

    found = _best(anchors.withColumn("tops", F.lit(None).cast("array<bigint>")), stored, down, across, positives, low, high)
    own = Window.partitionBy("anchor_id", "variant").orderBy(*_best_first())
    placed = found.withColumn("place", F.row_number().over(own)).filter(F.col("place") <= positives)
    pairs = materialise(
        placed.select("anchor_id", "variant", F.col("partner").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )
    windows = pairs.groupBy("anchor_id", "variant").agg(F.array_sort(F.collect_set("positive_score")).alias("tops"))
    below = _best(anchors.join(windows, ["anchor_id", "variant"]), stored, down, across, negatives, low, high)
    own = Window.partitionBy("anchor_id", "variant", "top").orderBy(*_best_first())
    ranked = (
        below.withColumn("rank", F.row_number().over(own))
        .filter(F.col("rank") <= negatives)
        .select(
            "anchor_id", "variant", F.col("top").alias("positive_score"), "rank",
            F.col("partner").alias("negative_id"), F.col("score").alias("negative_score"),
        )
    )
    # Positives of equal score share a window, five at most by the number of positives.
    return pairs.join(ranked, ["anchor_id", "variant", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _usable(rows: DataFrame, is_anchor: Column) -> DataFrame:
    size = F.lit(float(TOO_LARGE // SCALE))
    fine = F.forall("embedding", lambda c: F.coalesce(F.abs(c.cast("double")) < size, F.lit(False)))
    return rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        "label",
        "embedding",
        F.coalesce(is_anchor, F.lit(False)).alias("picked"),
    ).filter(F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))


def _best_first() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("partner")]


def _best(
    anchors: DataFrame, rows: DataFrame, down: int, across: int, keep: int, low: int, high: int
) -> DataFrame:
    """The ``keep`` best partners of each anchor in each cell: rows of its label where ``tops`` is NULL, else, for each
    score in ``tops``, rows of other labels in the window below it."""
    line = F.pmod(F.xxhash64("anchor_id", "variant"), F.lit(down)).cast("int")
    dealt_anchors = anchors.withColumn("line", line).withColumn(
        "column", F.explode(F.sequence(F.lit(0), F.lit(across - 1)))
    )
    # Rows are dealt by their place in a stored table, so that no number of equal rows fills a cell.
    column = F.pmod(F.monotonically_increasing_id(), F.lit(across)).cast("int")
    dealt_rows = (
        rows.select("vec_id", "label", "embedding", column.alias("column"))
        .withColumn("line", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return _search_cell(left, right, keep, low, high)

    return (
        dealt_anchors.groupBy("line", "column")
        .cogroup(dealt_rows.groupBy("line", "column"))
        .applyInArrow(search, _FOUND)
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Scaled vectors as rows, shorter ones ended by zeros."""
    column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).astype(np.int64)
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return entries.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out.reshape(-1)[ranges(np.arange(len(lengths)) * width, lengths)] = entries
    return out


class Heaps:
    """The best ``keep`` of each slot, best first: higher scores, then earlier rows."""

    def __init__(self, slots: int, keep: int):
        self.score = np.full((slots, keep), _LOWEST, np.int64)
        self.row = np.full((slots, keep), -1, np.int64)

    def least(self, slots: slice) -> np.ndarray:
        """A later row must score more than this to enter."""
        return self.score[slots, -1]

    def merge(self, slot: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        if not len(slot):
            return
        keep = self.score.shape[1]
        touched = np.unique(slot)
        held_slot, held_score, held_row = np.repeat(touched, keep), self.score[touched].ravel(), self.row[touched].ravel()
        held = held_row >= 0
        slot = np.concatenate([held_slot[held], slot])
        score = np.concatenate([held_score[held], score])
        row = np.concatenate([held_row[held], row])
        order = np.lexsort((row, -score, slot))
        slot, score, row = slot[order], score[order], row[order]
        starts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        place = np.arange(len(slot)) - np.repeat(starts, np.diff(np.append(starts, len(slot))))
        kept = place < keep
        self.score[slot[kept], place[kept]] = score[kept]
        self.row[slot[kept], place[kept]] = row[kept]


def _entering(scores: np.ndarray, low: np.ndarray, high: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the scores between the bounds of their line that may be among its best ``keep``."""
    inside = (scores >= low[:, None]) & (scores <= high[:, None])
    if scores.shape[1] > keep and np.count_nonzero(inside) > 16 * keep * len(scores):
        masked = np.where(inside, scores, _LOWEST)
        least = np.partition(masked, scores.shape[1] - keep, axis=1)[:, scores.shape[1] - keep]
        inside &= scores >= least[:, None]
    return np.nonzero(inside)


def _search_cell(left: pa.Table, right: pa.Table, keep: int, low: int, high: int) -> pa.Table:
    if not left.num_rows or not right.num_rows:
        return pa.Table.from_arrays([pa.array([], pa.int64())] * 5, names=_FOUND_NAMES)
    # Tiles hold rows in the order of ids, so that of equal scores the first row met is the better one.
    right = right.sort_by([("label", "ascending"), ("vec_id", "ascending")])
    by_label = left["tops"].null_count == left.num_rows
    if by_label:
        left = left.sort_by("own_label")
    else:
        right = right.sort_by("vec_id")
    a, b = _matrix(left["own_vector"]), _matrix(right["embedding"])
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m for m in (a, b))
    labels = pc.unique(pa.concat_arrays([left["own_label"].combine_chunks(), right["label"].combine_chunks()]))
    a_label, b_label = (
        pc.index_in(column.combine_chunks(), labels).to_numpy(zero_copy_only=False)
        for column in (left["own_label"], right["label"])
    )
    a_id = left["anchor_id"].to_numpy()
    b_id = pc.fill_null(right["vec_id"], 0).to_numpy()
    b_own = np.isin(b_id, a_id) & right["vec_id"].is_valid().to_numpy()
    if by_label:
        tops = np.full((len(a), 1), np.iinfo(np.int64).max)
        bottoms = np.full((len(a), 1), _LOWEST + 1)
    else:
        lists = left["tops"].combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        tops = np.full((len(a), int(sizes.max())), _LOWEST, np.int64)
        line = np.repeat(np.arange(len(a)), sizes)
        place = np.arange(len(line)) - np.repeat(offsets_of(sizes)[:-1], sizes)
        tops[line, place] = lists.flatten().to_numpy(zero_copy_only=False)
        whole, rest = tops // 100, tops % 100
        bottoms = np.where(tops > _LOWEST, low * whole - (-low * rest // 100), _LOWEST + 1)
        tops = np.where(tops > _LOWEST, tops, _LOWEST)
    limits = tops if by_label else np.where(tops > _LOWEST, high * (tops // 100) + high * (tops % 100) // 100, _LOWEST)
    heaps = Heaps(tops.size, keep)
    windows = tops.shape[1]

    for lines, columns in _tiles(a_label, b_label, by_label):
        scores = inner_products(a[lines], b[columns])
        own = np.flatnonzero(b_own[columns])
        scores[:, own] = np.where(b_id[columns][own] == a_id[lines][:, None], _LOWEST, scores[:, own])
        if not by_label:
            scores[a_label[lines][:, None] == b_label[columns]] = _LOWEST
        for window in range(windows):
            slots = np.arange(lines.start, lines.stop) * windows + window
            bar = np.maximum(bottoms[lines, window], heaps.least(slots) + 1)
            i, j = _entering(scores, bar, limits[lines, window], keep)
            heaps.merge(slots[i], scores[i, j], j + columns.start)

    slot, place = np.nonzero(heaps.row >= 0)
    line = pa.array(slot // windows)
    top = pa.array(tops.ravel()[slot], mask=np.full(len(slot), by_label))
    partners = right["vec_id"].combine_chunks().take(pa.array(heaps.row[slot, place]))
    return pa.Table.from_arrays(
        [
            left["anchor_id"].combine_chunks().take(line),
            left["variant"].combine_chunks().take(line),
            top,
            partners,
            pa.array(heaps.score[slot, place]),
        ],
        names=_FOUND_NAMES,
    )


def _tiles(a_label: np.ndarray, b_label: np.ndarray, by_label: bool):
    """Slices of anchors and rows that meet: of one label each, or all with all."""
    if not by_label:
        pairs = [(0, len(a_label), 0, len(b_label))]
    else:  # both are sorted by label, whose numbers need not rise
        a_runs, b_runs = _runs(a_label), _runs(b_label)
        pairs = [(*a_runs[label], *b_runs[label]) for label in a_runs.keys() & b_runs.keys()]
    for a_start, a_stop, b_start, b_stop in pairs:
        for i in range(a_start, a_stop, TILE_ANCHORS):
            for j in range(b_start, b_stop, TILE_ROWS):
                yield slice(i, min(i + TILE_ANCHORS, a_stop)), slice(j, min(j + TILE_ROWS, b_stop))


def _runs(labels: np.ndarray) -> dict[int, tuple[int, int]]:
    starts = np.flatnonzero(np.append(True, labels[1:] != labels[:-1]))
    return {int(labels[a]): (int(a), int(b)) for a, b in zip(starts, np.append(starts[1:], len(labels)))}
