"""Unusual prices per product."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.lookup import lookup_join
from tillroll.sinks.scratch import materialise


def price_outliers(
    orders: DataFrame, price: str = "sold_price", key: str = "product_id", deviations: float = 3.0
) -> DataFrame:
    """Orders whose price is more than ``deviations`` standard deviations from
    the mean price of their product, with mean, deviation and z-score.

    A product sold once has no deviation, and one whose prices differ only by
    rounding has none that means anything; neither yields outliers.

    Mean and deviation are aggregated, not windowed, so a product with a large
    share of the orders never sits in one task. They are written out once: the
    second pass then joins a table of known size.
    """
    statistics = materialise(
        orders.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.avg(price).alias("mean_price"), F.stddev_samp(price).alias("sd_price")),
        "price_statistics",
    )
    spread = F.col("sd_price") > 1e-9 * F.abs("mean_price")
    distance = F.col(price) - F.col("mean_price")
    return (
        lookup_join(orders, {key: statistics.filter(spread)}, "inner")
        .filter(F.abs(distance) > deviations * F.col("sd_price"))
        .withColumn("z_score", distance / F.col("sd_price"))
    )
