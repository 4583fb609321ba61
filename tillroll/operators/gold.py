"""Silver to gold: the business tables."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.calendar import month_index, month_key
from tillroll.functions.money import money_sum
from tillroll.operators.lookup import lookup_join


def monthly_region_category(silver: DataFrame) -> DataFrame:
    """Revenue and units per month, region and category."""
    return silver.groupBy("yyyymm", "region", "category").agg(
        money_sum(F.col("total_amount")).alias("revenue"),
        F.sum("quantity").alias("units"),
    )


def customer_spend(
    lines: DataFrame, customers: DataFrame | None = None, how: str = "left"
) -> DataFrame:
    """Total spent per region and customer.

    With ``customers``, the lines need no region: they are totalled per customer
    first and the region is looked up once per customer, not once per line. A
    hot customer is one row before any join, and a large customer table is
    joined on the partitioning that the totals already have.
    """
    spent = money_sum(F.col("total_amount")).alias("total_spent")
    if customers is None:
        # Lines joined on the customer are partitioned by it, and a grouping by the same column would be tied to that
        # partitioning, hot customer and all. Under another name it is summed in every task first and then shuffled,
        # so that adaptive execution may split the join.
        key = F.struct("customer_id").alias("key")
        totals = lines.groupBy("region", key).agg(spent)
        return totals.select("region", F.col("key.customer_id").alias("customer_id"), "total_spent")
    totals = lines.groupBy("customer_id").agg(spent)
    regions = customers.select("customer_id", "region")
    return lookup_join(totals, {"customer_id": regions}, how).select(
        "region", "customer_id", "total_spent"
    )


def top_customers(spend: DataFrame, n: int, salts: int = 64) -> DataFrame:
    """Customers whose spend is among the ``n`` highest of their region, by dense
    rank: equal spends share a rank and are all kept; a NULL spend sorts last.

    Only distinct spends are ranked, so a tie is one row from the first task on:
    within splits of a region first, and then the at most ``n`` left of each
    split. The few ranked spends are joined back to the customers on region,
    spend and a hash of the customer. No task ever holds a region or all
    customers of a tie, however large.
    """
    highest = F.desc("total_spent")

    def split(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(salts))

    place = F.dense_rank().over(Window.partitionBy("region", "split").orderBy(highest))
    rank = F.dense_rank().over(Window.partitionBy("region").orderBy(highest))
    tops = (
        spend.select("region", "total_spent")
        .distinct()
        .withColumn("split", split("total_spent"))
        .withColumn("place", place)
        .filter(F.col("place") <= n)
        .withColumn("rank", rank)
        .filter(F.col("rank") <= n)
        .select(
            F.col("region").alias("top_region"),
            F.col("total_spent").alias("top_spent"),
            "rank",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).alias("top_salt"),
        )
    )
    salted = spend.withColumn("salt", split("customer_id"))
    is_top = (
        salted["salt"].eqNullSafe(tops["top_salt"])
        & salted["region"].eqNullSafe(tops["top_region"])
        & salted["total_spent"].eqNullSafe(tops["top_spent"])
    )
    return salted.join(tops, is_top).select("region", "customer_id", "total_spent", "rank")


def monthly_total(silver: DataFrame) -> DataFrame:
    return silver.groupBy("yyyymm").agg(money_sum(F.col("total_amount")).alias("revenue"))


def moving_average(monthly: DataFrame, months: int = 3, calendar: bool = False) -> DataFrame:
    """Average revenue of the last ``months`` rows, fewer at the start.

    By default the frame counts rows, so a missing month widens its span; with
    ``calendar`` it counts calendar months. The window has one partition, whose
    size is the number of months.
    """
    if calendar:
        frame = Window.orderBy(month_index(F.col("yyyymm"))).rangeBetween(1 - months, 0)
    else:
        frame = Window.orderBy("yyyymm").rowsBetween(1 - months, 0)
    return monthly.withColumn(f"rev_ma_{months}m", F.avg("revenue").over(frame))


def latest_month(orders: DataFrame) -> DataFrame:
    """The month of the latest ``order_ts``, formatted once and not for every line."""
    return orders.agg(F.max("order_ts").alias("ts")).select(month_key(F.col("ts")).alias("yyyymm"))


def channel_mix(silver: DataFrame) -> DataFrame:
    """Revenue per month and channel and its percentage of the month; NULL for a
    month that totals zero."""
    month = F.sum("revenue").over(Window.partitionBy("yyyymm"))
    return (
        silver.groupBy("yyyymm", "channel")
        .agg(money_sum(F.col("total_amount")).alias("revenue"))
        .withColumn("pct", 100 * F.col("revenue") / F.nullif(month, F.lit(0.0)))
    )


def net_revenue(silver: DataFrame) -> DataFrame:
    """Gross, returned and net revenue per month and region, and the share of
    lines returned. ``is_return`` is a column of 0 and 1."""
    amount, returned = F.col("total_amount"), F.col("is_return")
    return silver.groupBy("yyyymm", "region").agg(
        money_sum(amount).alias("gross_revenue"),
        money_sum(amount * returned).alias("returned_revenue"),
        money_sum(amount * (1 - returned)).alias("net_revenue"),
        F.avg(returned).alias("return_rate"),
    )
