"""Seeded draws that depend on a row's key alone.

``rand(seed)`` changes with the partitioning and with task retries; a hash of
the key and a salt gives every row the same draw on any cluster. The hash is
MD5, which every SQL engine has, so the draws can be checked elsewhere.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hexadecimal digits of the hash that make the drawn number.
DIGITS = 15


def uniform_int(low: int, high: int, seed: int, salt: str, *keys: Column) -> Column:
    """A whole number from ``low`` to ``high``, both included."""
    text = F.concat_ws("|", *[key.cast("string") for key in keys], F.lit(str(seed)), F.lit(salt))
    drawn = F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("bigint")
    return drawn % F.lit(high - low + 1).cast("bigint") + F.lit(low)


def pick(values: list[str], seed: int, salt: str, *keys: Column) -> Column:
    """One of ``values``, each equally likely."""
    index = uniform_int(1, len(values), seed, salt, *keys).cast("int")
    return F.element_at(F.array(*[F.lit(value) for value in values]), index)


def simulated_return(percent: int, seed: int, *keys: Column) -> Column:
    """1 for about ``percent`` per cent of the keys, else 0."""
    return (uniform_int(0, 99, seed, "return", *keys) < percent).cast("int")
