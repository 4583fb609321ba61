"""Reports over the star schema and over gold tables."""

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.calendar import in_month, month_key
from tillroll.functions.money import money_sum
from tillroll.operators.gold import monthly_region_category
from tillroll.operators.silver import enrich

# The texts name frames in braces, which ``run`` binds; no view of the session is touched.
REVENUE_TREND = """
SELECT yyyymm, revenue, rev_ma_3m FROM {gold_moving_rev} ORDER BY yyyymm
"""

TOP_CUSTOMERS = """
SELECT region, customer_id, total_spent, rank FROM {gold_top_customers}
ORDER BY region, rank, customer_id
"""

# What the newest month is of each region's revenue, in per cent. Column names are matched in any case.
NEWEST_MONTH_SHARE = """
WITH newest AS (SELECT max(yyyymm) AS month FROM {gold_monthly_region_category})
SELECT Region AS region,
       round(100 * sum(CASE WHEN month IS NOT NULL THEN REVENUE ELSE 0 END) / sum(Revenue), 4) AS newest_pct
FROM {gold_monthly_region_category} LEFT JOIN newest ON YYYYMM = newest.month
GROUP BY Region
"""


def run(text: str, **frames: DataFrame) -> DataFrame:
    """The report ``text`` over the named frames."""
    session = next(iter(frames.values())).sparkSession
    return session.sql(text, **frames)


def _month(day: date) -> str:
    return f"{day:%Y%m}" if day.year > 999 else f"{day.year:04d}{day.month:02d}"


def report_month(orders: DataFrame, month: str = "latest") -> str | None:
    """The month a report is about: ``latest`` is that of the latest order; ``last_full`` the newest month with orders
    whose last day is not after the latest order's day. None without orders."""
    if month not in ("latest", "last_full"):
        raise ValueError(f"{month!r} is neither latest nor last_full")

    def newest(rows: DataFrame) -> date | None:
        return rows.agg(F.to_date(F.max("order_ts")).alias("day")).first()["day"]

    day = newest(orders)
    if day is None or month == "latest" or (day + timedelta(days=1)).day == 1:
        return day and _month(day)
    # The latest month is under way; the one before it with orders is full.
    before = newest(orders.filter(F.col("order_ts") < F.lit(f"{day.replace(day=1)} 00:00:00")))
    return before and _month(before)


def calendar_months(orders: DataFrame) -> DataFrame:
    """The months that have orders, with their year and quarter: a dimension of silver's folders."""
    month = F.trunc(F.to_date("order_ts"), "month").alias("first_day")
    months = orders.select(month).distinct().filter("first_day IS NOT NULL")
    return months.select(
        month_key(F.col("first_day")).alias("yyyymm"),
        F.year("first_day").alias("year"),
        F.quarter("first_day").alias("quarter"),
    )


def sales_of_months(silver: DataFrame, months: DataFrame) -> DataFrame:
    """Revenue and units per region of stored silver in the chosen ``months``, rows of ``calendar_months``.

    The months are not known when the query is planned. Spark finds them while it runs, from the small side of the join,
    and lists just their folders of silver.
    """
    chosen = silver.select("yyyymm", "region", "total_amount", "quantity").join(months, "yyyymm")
    return chosen.groupBy("region").agg(
        money_sum(F.col("total_amount")).alias("revenue"), F.sum("quantity").alias("units")
    )


def top_categories(
    orders: DataFrame, customers: DataFrame, products: DataFrame, month: str = "latest", n: int = 5
) -> DataFrame:
    """The ``n`` categories with the highest revenue in each region in one month; equal revenues rank by name.

    The month is found first, from the timestamps alone, and only its range of the orders is read, joined and totalled.
    """
    found = report_month(orders, month)
    chosen = orders.filter(in_month(F.col("order_ts"), found) if found else F.lit(False))
    lines = enrich(
        chosen, customers, products, customer_columns=["region"], product_columns=["category", "base_price"]
    )
    order = Window.partitionBy("region").orderBy(F.desc("revenue"), "category")
    return (
        monthly_region_category(lines)
        .withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= n)
        .select("region", "category", "revenue")
    )
