"""Calendar columns of an order timestamp (TIMESTAMP or TIMESTAMP_NTZ)."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_date(ts: Column) -> Column:
    return F.to_date(ts)


def month_key(ts: Column) -> Column:
    """The month as a six-character ``yyyyMM`` string.

    Taken from the calendar date, which costs about two thirds of
    ``date_format`` on a fact table; years that are not four digits long go
    through ``date_format``, so the result is the same for every timestamp.
    """
    year = F.year(F.to_date(ts))
    month = F.month(F.to_date(ts))
    return F.when(
        year.between(1000, 9999), (year * 100 + month).cast("string")
    ).otherwise(F.date_format(ts, "yyyyMM"))


def in_month(ts: Column, yyyymm: str) -> Column:
    """Whether ``ts`` lies in the month, as a range that Parquet readers can push
    down, which a comparison of the derived ``yyyymm`` column is not."""
    first = date(int(yyyymm[:4]), int(yyyymm[4:]), 1)
    following = date(first.year + first.month // 12, first.month % 12 + 1, 1)
    return (ts >= F.lit(f"{first} 00:00:00")) & (ts < F.lit(f"{following} 00:00:00"))


def month_index(yyyymm: Column) -> Column:
    """Months counted from year 0, so that neighbouring months differ by one."""
    year = F.substring(yyyymm, 1, 4).cast("int")
    month = F.substring(yyyymm, 5, 2).cast("int")
    return year * 12 + month
