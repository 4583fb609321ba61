"""Rejected bronze orders and their counts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.lookup import lookup_join

REQUIRED = ("order_id", "order_ts", "customer_id", "product_id", "quantity")


def _as_rows(counts: DataFrame, name: str) -> DataFrame:
    """One row of counts turned into a row per count."""
    pairs = [F.struct(F.lit(c).alias(name), F.col(c).alias("rejected")) for c in counts.columns]
    return counts.select(F.inline(F.array(*pairs)))


def broken_rules(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """``orders`` with ``rules``, the sorted names of the rules that a row breaks: a missing required value, a quantity
    that is not positive, or a key without a dimension row."""
    checked = lookup_join(
        orders,
        {
            "customer_id": customers.select("customer_id", F.lit(True).alias("has_customer")),
            "product_id": products.select("product_id", F.lit(True).alias("has_product")),
        },
        "left",
    )
    names = [F.when(test, rule) for rule, test in sorted(_order_rules().items())]
    return checked.select(*orders.columns, F.array_compact(F.array(*names)).alias("rules"))


def _order_rules() -> dict[str, Column]:
    rules = {f"null_{column}": F.col(column).isNull() for column in REQUIRED}
    rules["non_positive_quantity"] = F.col("quantity") <= 0
    rules["orphan_customer"] = F.col("customer_id").isNotNull() & F.col("has_customer").isNull()
    rules["orphan_product"] = F.col("product_id").isNotNull() & F.col("has_product").isNull()
    return rules


def split_orders(
    orders: DataFrame, customers: DataFrame, products: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The orders that break no rule, and the others with the ``rules`` that they break."""
    checked = broken_rules(orders, customers, products)
    broken = F.size("rules") > 0
    return checked.filter(~broken).drop("rules"), checked.filter(broken)


def order_rejects(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Rows that break each rule. One pass over the orders; an order that breaks
    several rules counts in each."""
    checked = broken_rules(orders, customers, products)
    counts = checked.agg(
        *[F.count_if(F.array_contains("rules", rule)).alias(rule) for rule in _order_rules()]
    )
    return _as_rows(counts, "rule")


def duplicate_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Keys with more than one row and their number; a star join needs this to be empty. NULL keys join nothing."""
    rows = dimension.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return rows.filter("row_count > 1")


def cast_failures(raw: DataFrame, schema: str) -> DataFrame:
    """Per column, the values of ``raw`` that do not parse as the declared type."""
    fields = T.StructType.fromDDL(schema)
    counts = raw.agg(
        *[
            F.count_if(
                F.col(field.name).isNotNull()
                & F.col(field.name).try_cast(field.dataType).isNull()
            ).alias(field.name)
            for field in fields
        ]
    )
    return _as_rows(counts, "column")
