"""Quality rules: hard limits first, then robust multivariate outliers per language and source.

Each document becomes a short vector of transformed statistics. For every language and source, minimum-covariance-
determinant estimates of centre and scatter are fitted over all documents that pass the hard limits, and a document is
rejected when its Mahalanobis distance from the estimates of its group is out of range.

The fit is deterministic. It starts from medians and quartiles and takes concentration steps: the three quarters of a
group that lie nearest under the present estimates give the next ones. Statistics are whole numbers on a grid, so
sums are exact and histograms give the cut-offs; each step is two aggregations over a small table, in which a
group of any size is a few partial sums per task. Groups with too few documents use the estimates of their language,
or else of all documents.
"""

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.batches import pieces, texts_of
from tillroll.sinks.scratch import materialise

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: Documents of a group without which it takes the estimates of a wider group.
MIN_GROUP = 200
COVERAGE = 0.75
STEPS = 4
#: Chance that a clean document of normal statistics is rejected.
FALSE_ALARMS = 1e-6

#: Statistics and the spread that each may have beyond a group's own scatter, so that a group in which nearly all
#: documents agree does not reject the first that differs a little.
SPREAD = {"word_length": 0.1, "symbols": 0.6, "copied_lines": 0.8, "repeats": 0.8, "digits": 0.6, "capitals": 0.4}
STATISTICS = list(SPREAD)
_PAIRS = [(a, b) for i, a in enumerate(STATISTICS) for b in STATISTICS[i:]]
_GRID = 256

_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
_CONTINUATION = bytes(range(0x80, 0xC0))
_CAPITALS = bytes(range(0x41, 0x5B))
_DIGITS = bytes(range(0x30, 0x3A))
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _without(text: bytes, unwanted: bytes) -> int:
    return len(text) - len(text.translate(None, unwanted))


def measures(text: bytes) -> tuple[int, ...]:
    """Words, their characters, symbols, copied lines and words in repeated windows."""
    words = text.split()
    blank = _without(text, _SPACE)
    characters = len(text) - _without(text, _CONTINUATION) - blank
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        covered = -1
        for start, window in enumerate(windows):
            if counts[window] > 1:
                repeated += start + 2 - max(covered, start - 1)
                covered = start + 2
    return len(words), characters, _without(text, _SYMBOLS), len(lines) - len(set(lines)), repeated


def statistics(text: bytes, measured: tuple[int, ...]) -> tuple[int, ...]:
    """The vector of a document, on the grid."""
    words, characters, symbols, copied, repeated = measured
    lines = text.count(b"\n") + 1

    def share(part, whole):
        return math.log1p(100 * part / max(1, whole))

    values = (
        math.log(max(1, characters) / max(1, words)),
        share(symbols, words),
        share(copied, lines),
        share(repeated, words),
        share(_without(text, _DIGITS), characters),
        share(_without(text, _CAPITALS), characters),
    )
    return tuple(round(value * _GRID) for value in values)


def measured(documents: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep``, the measures, ``base_failed``, the statistics and
    the group ``keys`` of each document. No shuffle."""
    own = [*MEASURES, "base_failed", *(f"z_{name}" for name in STATISTICS), "group_key", "lang_key"]
    columns = [*dict.fromkeys(["text", "lang", "source", *keep])]
    schema = T.StructType(
        [field for field in documents.select(keep).schema.fields if field.name not in own]
        + [T.StructField(name, T.LongType()) for name in MEASURES]
        + [T.StructField("base_failed", T.BooleanType())]
        + [T.StructField(f"z_{name}", T.LongType()) for name in STATISTICS]
        + [T.StructField("group_key", T.StringType()), T.StructField("lang_key", T.StringType())]
    )
    kept = [name for name in keep if name not in own]

    def measure(batches):
        for piece in pieces(batches):
            rows = []
            for text in texts_of(piece.column("text")):
                base = measures(text)
                rows.append((*base, *statistics(text, base)))
            table = np.array(rows, np.int64).reshape(len(rows), -1)
            failed = (table[:, 0] < MIN_WORDS) | (100 * table[:, 4] > MAX_REPEATED_PERCENT * table[:, 0])
            # NULL and text are told apart, as an empty name is a name.
            langs = ["-" if x is None else f"={x}" for x in piece.column("lang").to_pylist()]
            sources = ["-" if x is None else f"={x}" for x in piece.column("source").to_pylist()]
            groups = [f"{len(lang)}{lang}{source}" for lang, source in zip(langs, sources)]
            arrays = [piece.column(name) for name in kept]
            arrays += [pa.array(table[:, i]) for i in range(5)] + [pa.array(failed)]
            arrays += [pa.array(table[:, 5 + i]) for i in range(len(STATISTICS))]
            arrays += [pa.array(groups, pa.string()), pa.array([f"lang {x}" for x in langs], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[field.name for field in schema.fields])

    return documents.select(columns).mapInArrow(measure, schema)


def chi_square(value: float, degrees: int) -> float:
    """P(X <= value), by the series of the incomplete gamma function."""
    half, x = degrees / 2, value / 2
    if x <= 0:
        return 0.0
    term = total = 1 / half
    for step in range(1, 10_000):
        term *= x / (half + step)
        total += term
        if term < total * 1e-16:
            break
    return min(1.0, total * math.exp(half * math.log(x) - x - math.lgamma(half)))


def chi_square_quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < share else (low, middle)
    return high


def _factor(share: float) -> float:
    """By how much the scatter of the nearest ``share`` of normal vectors is too small."""
    size = len(STATISTICS)
    return share / chi_square(chi_square_quantile(share, size), size + 2)


_ESTIMATES = "key STRING, n BIGINT, " + ", ".join(
    [f"m_{a} DOUBLE" for a in STATISTICS] + [f"p_{a}_{b} DOUBLE" for a, b in _PAIRS]
)


def _distance() -> str:
    """Squared Mahalanobis distance as an expression over statistics and estimates."""
    terms = [
        f"{1 if a == b else 2} * p_{a}_{b} * (z_{a} - m_{a}) * (z_{b} - m_{b})" for a, b in _PAIRS
    ]
    return " + ".join(terms)


def _estimates(moments: DataFrame, share: float) -> DataFrame:
    """Centre and inverse scatter from the sums of each key."""
    factor = _factor(share)
    spread = np.array([SPREAD[name] * _GRID for name in STATISTICS]) ** 2

    def invert(frames):
        for frame in frames:
            rows = []
            for row in frame.to_dict("records"):
                mean = np.array([float(row[f"s_{a}"]) for a in STATISTICS]) / row["n"]
                cov = np.zeros((len(STATISTICS),) * 2)
                for a, b in _PAIRS:
                    i, j = STATISTICS.index(a), STATISTICS.index(b)
                    cov[i, j] = cov[j, i] = row[f"q_{a}_{b}"] / row["n"] - mean[i] * mean[j]
                inverse = np.linalg.inv(factor * cov + np.diag(spread))
                flat = [inverse[STATISTICS.index(a), STATISTICS.index(b)] for a, b in _PAIRS]
                rows.append([row["key"], row["n"], *mean, *flat])
            yield pd.DataFrame(rows, columns=[part.split(" ")[0] for part in _ESTIMATES.split(", ")])

    return moments.mapInPandas(invert, _ESTIMATES)


def _moments(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(f"z_{a}").alias(f"s_{a}") for a in STATISTICS],
        *[F.sum(F.col(f"z_{a}") * F.col(f"z_{b}")).alias(f"q_{a}_{b}") for a, b in _PAIRS],
    )


def _start(rows: DataFrame) -> DataFrame:
    """Medians and quartile spreads, from one histogram per statistic."""
    stacked = ", ".join(f"'{name}', z_{name}" for name in STATISTICS)
    histogram = (
        rows.selectExpr("key", f"stack({len(STATISTICS)}, {stacked}) AS (name, value)")
        .groupBy("key", "name", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    # A statistic has a few thousand grid values at most, whatever the group's size.
    each = Window.partitionBy("key", "name")
    seen = histogram.withColumn("below", F.sum("rows").over(each.orderBy("value"))).withColumn(
        "n", F.sum("rows").over(each)
    )
    quartiles = seen.groupBy("key", "name").agg(
        F.max("n").alias("n"),
        *[F.min(F.when(F.col("below") * 4 >= F.col("n") * q, F.col("value"))).alias(f"q{q}") for q in (1, 2, 3)],
    )
    named = quartiles.groupBy("key").agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("name") == a, F.col("q2"))).cast("double").alias(f"m_{a}") for a in STATISTICS],
        *[F.max(F.when(F.col("name") == a, F.col("q3") - F.col("q1"))).alias(f"w_{a}") for a in STATISTICS],
    )
    precision = [
        (1 / ((F.col(f"w_{a}") / 1.349) ** 2 + (SPREAD[a] * _GRID) ** 2) if a == b else F.lit(0.0)).alias(f"p_{a}_{b}")
        for a, b in _PAIRS
    ]
    return named.select("key", "n", *[f"m_{a}" for a in STATISTICS], *precision)


def _step(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One concentration step."""
    far = rows.join(estimates.drop("n"), "key").withColumn("bin", F.expr(f"floor(64 * ln(1 + {_distance()}))"))
    columns = ["key", "bin", *[f"z_{a}" for a in STATISTICS]]
    far = far.select(columns)
    counts = far.groupBy("key", "bin").agg(F.count(F.lit(1)).alias("rows"))
    each = Window.partitionBy("key")
    limit = (
        counts.withColumn("below", F.sum("rows").over(each.orderBy("bin")))
        .withColumn("n", F.sum("rows").over(each))
        .groupBy("key")
        .agg(F.min(F.when(F.col("below") >= COVERAGE * F.col("n"), F.col("bin"))).alias("limit"))
    )
    nearest = far.join(limit, "key").filter("bin <= limit")
    return _estimates(_moments(nearest), COVERAGE)


def fit(rows: DataFrame) -> DataFrame:
    """Estimates for each key of ``rows`` (``key`` and statistics), after
    concentration and one reweighting by the 97.5 % ellipsoid."""
    estimates = materialise(_start(rows), "start")
    for number in range(STEPS):
        estimates = materialise(_step(rows, estimates), f"step-{number}")
    within = rows.join(estimates.drop("n"), "key").filter(
        F.expr(_distance()) <= chi_square_quantile(0.975, len(STATISTICS))
    )
    final = _estimates(_moments(within), 0.975)
    return materialise(final, "estimates")


def group_estimates(table: DataFrame) -> DataFrame:
    """Estimates for every ``group_key`` of a measured table: its own, its language's, or those of all."""
    passed = table.filter(~F.col("base_failed"))
    z = [f"z_{a}" for a in STATISTICS]
    groups = table.groupBy("group_key", "lang_key").agg(F.count_if(~F.col("base_failed")).alias("own"))
    langs = groups.groupBy("lang_key").agg(F.sum("own").alias("of_lang"))
    choice = groups.join(langs, "lang_key").select(
        "group_key",
        F.when(F.col("own") >= MIN_GROUP, F.col("group_key"))
        .when(F.col("of_lang") >= MIN_GROUP, F.col("lang_key"))
        .otherwise("all")
        .alias("key"),
    )
    keys = F.explode(F.array("group_key", "lang_key", F.lit("all")))
    wanted = choice.select("key").distinct()
    rows = materialise(passed.select(keys.alias("key"), *z).join(wanted, "key", "left_semi"), "statistics")
    return materialise(choice.join(fit(rows), "key").drop("key", "n"), "group_estimates")


def judged(table: DataFrame, estimates: DataFrame) -> DataFrame:
    """``table`` with ``distance`` (squared Mahalanobis) and ``kept``."""
    limit = chi_square_quantile(1 - FALSE_ALARMS, len(STATISTICS))
    return (
        table.join(estimates, "group_key", "left")
        .withColumn("distance", F.expr(_distance()))
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True)))
        .drop(*[column for column in estimates.columns if column != "group_key"])
    )


def verdicts(documents: DataFrame) -> DataFrame:
    """One row per document: its measures, ``base_failed``, ``distance`` and ``kept``.

    Reads ``doc_id``, ``text``, ``lang``, ``source``. A NULL text has no words and fails the hard limits, as
    all texts below 50 words and those with more than half of their words in repeated windows do; NULL languages and
    sources form groups of their own. ``distance`` is NULL where no document passed the hard limits.
    """
    table = materialise(measured(documents, ["doc_id"]), "measured")
    return judged(table, group_estimates(table)).select("doc_id", *MEASURES, "base_failed", "distance", "kept")


def kept_documents(documents: DataFrame) -> DataFrame:
    """The documents that the rules keep, all columns as they came.

    The measures are taken twice, once to fit and once to decide, so that no text is shuffled.
    """
    table = materialise(measured(documents, []), "measured")
    estimates = group_estimates(table)
    names = documents.columns
    plain = documents.select([F.col(f"`{name}`").alias(f"doc_{i}") for i, name in enumerate(names)])
    plain = plain.withColumns({name: F.col(f"doc_{names.index(name)}") for name in ("text", "lang", "source")})
    decided = judged(measured(plain, [f"doc_{i}" for i in range(len(names))]), estimates).filter("kept")
    return decided.select([F.col(f"doc_{i}").alias(name) for i, name in enumerate(names)])
