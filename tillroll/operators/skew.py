"""Totals and joins for keys of very uneven size."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import merged_money, partial_money


def salted_revenue(
    silver: DataFrame, keys: Sequence[str], row_key: Sequence[str], salts: int = 5
) -> DataFrame:
    """Revenue and units per ``keys``, first per key and salt, then per key.

    The salt is a hash of ``row_key``, columns that vary within a key, so a
    retried task draws it again and no other column is read for it. Spark sums
    within each task before it shuffles, so rows that share a salt reach the
    second task as one row per task and not one by one.
    """
    salt = F.pmod(F.xxhash64(*row_key), F.lit(salts))
    per_salt = silver.groupBy(*keys, salt.alias("salt")).agg(
        *partial_money(F.col("total_amount"), "amount"), F.sum("quantity").alias("units")
    )
    return per_salt.groupBy(*keys).agg(
        merged_money("amount").alias("revenue"), F.sum("units").alias("units")
    )


def hot_keys(rows: DataFrame, key: str, share: float = 0.01) -> list:
    """The values of ``key``, NULL left out, that hold about ``share`` of the rows or more.

    A frequent-items sketch finds them in one pass: tasks keep a bounded number of counters, which merge, so the result
    has at most ``1 / share`` values and misses none that holds ``share``; its counts are estimates.
    """
    if not 0.0001 <= share <= 1:
        raise ValueError("share must be between 0.0001 and 1")
    most = int(1 / share)
    counters = min(1_000_000, 8 * most)
    found = rows.agg(
        F.expr(f"approx_top_k(`{key}`, {most}, {counters})").alias("items"), F.count(F.lit(1)).alias("total")
    ).first()
    return [item["item"] for item in found["items"] if item["item"] is not None and item["count"] >= share * found["total"]]


def hot_key_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    row_key: Sequence[str | Column],
    how: str = "left",
    share: float = 0.01,
    salts: int = 16,
) -> DataFrame:
    """``facts`` joined to ``dimension`` on ``key``, for a dimension too large to broadcast.

    Rows of hot keys, and rows without a key, are dealt to ``salts`` tasks by a hash of ``row_key``, columns that vary
    within a key; only the dimension rows of hot keys are repeated, once per salt, so little more moves than in a plain
    join. Whether a key is hot changes where its rows are joined, never the result.

    Rows that are equal in ``row_key`` share a task. Where copies of one row are many and ``facts`` is a stored table as
    it is read, ``[F.monotonically_increasing_id()]`` deals those out too; over anything else a retried task could number
    its rows anew.
    """
    hot = hot_keys(facts, key, share)

    def is_hot(column: Column) -> Column:
        return F.coalesce(column.isin(hot), F.lit(False)) if hot else F.lit(False)

    drawn = F.pmod(F.xxhash64(*row_key), F.lit(salts)).cast("int")
    left = facts.withColumn("salt", F.when(is_hot(F.col(key)) | F.col(key).isNull(), drawn).otherwise(0))
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    right = dimension.withColumn(
        "salt", F.explode(F.when(is_hot(F.col(key)), all_salts).otherwise(F.array(F.lit(0))))
    )
    return left.join(right, [key, "salt"], how).drop("salt")
