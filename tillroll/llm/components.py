"""Connected components of edge tables of any size.

Alternates the large-star and small-star steps of Kiveris et al. (2014): every node's neighbours are linked to the
smallest node around it until only stars are left. A step is one aggregation and one join over edges; the edge table is
written to the shared folder after each round.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.sinks.scratch import materialise

MAX_ROUNDS = 60


def _round(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` with ``a > b``, nearer to stars."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = (
        both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )
    smallest = large.groupBy("a").agg(F.min("b").alias("m"))
    joined = large.join(smallest, "a")
    to_least = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return to_least.unionAll(smallest.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for all nodes of ``edges`` (``a``, ``b``).

    Self-loops give components of one node; NULL ends are ignored.
    """
    given = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), F.col("a").alias("own"))
    given = materialise(given.filter("a IS NOT NULL AND b IS NOT NULL").distinct(), "edges")
    edges = materialise(given.filter("a > b").select("a", "b").distinct(), "edges-0")
    before = None
    for number in range(1, MAX_ROUNDS + 1):
        # At the end every edge leads from a node to its component: no node has two, and no target a further one.
        edges = materialise(_round(edges), f"edges-{number}")
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components are not found after {MAX_ROUNDS} rounds")
    named = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = named.select(F.col("component").alias("node"), "component").distinct()
    alone = given.filter("a = b").select(F.col("a").alias("node"), F.col("b").alias("component")).distinct()
    alone = alone.join(named.select("node").unionAll(roots.select("node")).distinct(), "node", "left_anti")
    return named.unionAll(roots).unionAll(alone)
