"""Exact, order-independent totals of DOUBLE amounts, to the millionth.

A float sum depends on the order in which tasks finish, and a DECIMAL sum over a
fact table takes several times as long as one of BIGINT. So an amount is cut,
without rounding, into whole multiples of 2^24, the whole units below that, and
millionths, of which only the last are rounded. The three are summed as BIGINT
and put together once per group.

Amounts of 1e18 and more, infinities and NaN are summed apart, as DOUBLE, and
added at the end; they do not change how the others of their group are summed.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

STEP = float(1 << 24)
LIMIT = 1e18


def _cut(amount: Column) -> tuple[Column, Column, Column, Column]:
    """Multiples of ``STEP``, units, millionths; and the amount if it is beyond them."""
    value = amount.cast("double")
    fits = F.abs(value) < LIMIT
    high = F.floor(value / STEP)
    rest = value - high * STEP
    units = F.floor(rest)
    millionths = F.rint((rest - units) * 1e6).cast("bigint")
    beyond = F.when(~fits, value)
    return F.when(fits, high), F.when(fits, units), F.when(fits, millionths), beyond


def _joined(high: Column, units: Column, millionths: Column, beyond: Column) -> Column:
    whole = high.cast("decimal(20,0)") * F.expr("16777216BD") + units.cast("decimal(20,0)")
    exact = (whole + millionths.cast("decimal(20,0)") * F.expr("0.000001BD")).cast("double")
    return F.when(high.isNull(), beyond).otherwise(exact + F.coalesce(beyond, F.lit(0.0)))


def money_sum(amount: Column) -> Column:
    """Total of ``amount``; NULL amounts are skipped, an all-NULL group is NULL."""
    return _joined(*[F.sum(part) for part in _cut(amount)])


def partial_money(amount: Column, name: str) -> list[Column]:
    """The columns a first aggregation keeps so that ``merged_money`` can finish."""
    return [
        F.sum(part).alias(f"{name}_{place}")
        for part, place in zip(_cut(amount), ("high", "units", "millionths", "beyond"))
    ]


def merged_money(name: str) -> Column:
    """Total over the columns of ``partial_money``."""
    return _joined(*[F.sum(f"{name}_{place}") for place in ("high", "units", "millionths", "beyond")])


PLACES = ("high", "units", "millionths", "beyond")


def cut_money(amount: Column, name: str) -> list[Column]:
    """The parts of each amount, whose sums ``join_money`` puts together."""
    return [part.alias(f"{name}_{place}") for part, place in zip(_cut(amount), PLACES)]


def join_money(name: str) -> Column:
    """The total over sums of ``cut_money``, under the same names."""
    return _joined(*[F.col(f"{name}_{place}") for place in PLACES])
