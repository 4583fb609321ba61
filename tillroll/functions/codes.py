"""Identifier, label and region columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The region of a country, first match wins.
NORTH_AMERICA_WORDS = ["United States", "Canada"]
EUROPE_COUNTRIES = ["France", "Germany", "Italy", "Spain", "United Kingdom"]
ASIA_COUNTRIES = ["India", "China", "Japan", "Singapore"]


def region_of_country(country: Column) -> Column:
    """Coarse sales region. Names that merely contain one of the North American
    words count as North America; the other lists match whole names. The
    comparison is case-sensitive, and NULL falls through to ``Other``."""
    north_america = F.lit(False)
    for word in NORTH_AMERICA_WORDS:
        north_america = north_america | country.contains(word)
    return (
        F.when(north_america, "North America")
        .when(country.isin(EUROPE_COUNTRIES), "Europe")
        .when(country.isin(ASIA_COUNTRIES), "Asia")
        .otherwise("Other")
    )


def order_code(number: Column) -> Column:
    """``ORD-`` and the number padded to nine digits, never cut.

    The padding of ordinary numbers avoids the much slower Java formatter.
    """
    digits = number.cast("string")
    return F.when(
        number.between(0, 999_999_999), F.concat(F.lit("ORD-"), F.lpad(digits, 9, "0"))
    ).otherwise(F.format_string("ORD-%09d", number))


def product_label(category: Column, subcategory: Column, number: Column) -> Column:
    """``category-subcategory-NNNN``."""
    return F.format_string("%s-%s-%04d", category, subcategory, number)
