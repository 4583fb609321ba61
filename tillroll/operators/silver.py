"""Bronze to silver: type cleaning, enrichment, redistribution."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.calendar import month_key, order_date
from tillroll.operators.lookup import lookup_join


def clean(raw: DataFrame, schema: str) -> DataFrame:
    """``raw`` with each column cast to the declared type; what does not parse
    becomes NULL and is counted by ``quality.cast_failures``."""
    fields = T.StructType.fromDDL(schema)
    return raw.select(
        [F.col(field.name).try_cast(field.dataType).alias(field.name) for field in fields]
    )


def with_calendar(orders: DataFrame) -> DataFrame:
    ts = F.col("order_ts")
    return orders.withColumns({"order_date": order_date(ts), "yyyymm": month_key(ts)})


def enrich(
    orders: DataFrame,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
    how: str = "left",
    customer_columns: Sequence[str] = ("region", "country"),
    product_columns: Sequence[str] = ("category", "subcategory", "base_price"),
) -> DataFrame:
    """Orders with dimension columns, line amount and calendar columns.

    ``how="left"`` keeps orders without a customer or product (their dimension
    columns are NULL); ``how="inner"`` drops them. In a left join a dimension may
    be left out where nothing downstream reads it: since dimensions hold one row
    per key, that changes no other column and saves a join over the whole fact
    table. An inner join needs both.
    """
    if how != "left" and (customers is None or products is None):
        raise ValueError("only a left join may leave a dimension out")
    lookups = {}
    added = []
    if customers is not None:
        lookups["customer_id"] = customers.select("customer_id", *customer_columns)
        added += customer_columns
    if products is not None:
        lookups["product_id"] = products.select("product_id", *product_columns)
        added += product_columns
    joined = lookup_join(orders, lookups, how) if lookups else orders
    silver = joined.select(*orders.columns, *added)
    if "base_price" in added:
        silver = silver.withColumn("unit_price", F.col("base_price"))
        silver = silver.withColumn("total_amount", F.col("unit_price") * F.col("quantity"))
    return with_calendar(silver)


def redistribute(
    frame: DataFrame, partitions: int | None = None, keys: Sequence[str] = ("yyyymm", "region")
) -> DataFrame:
    """Rows with equal keys brought together.

    With a fixed ``partitions`` this is a hash repartition, one task per key
    value at most. Without, adaptive execution sizes the partitions: it merges
    small ones and splits a month and region that is too large for one task.
    """
    columns = [F.col(key) for key in keys]
    if partitions is not None:
        return frame.repartition(partitions, *columns)
    return frame.hint("rebalance", *columns)
