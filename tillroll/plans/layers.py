"""From bronze and dimensions to silver and gold as one set of frames."""

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillroll.operators import gold
from tillroll.operators.silver import enrich
from tillroll.sinks.tables import write_gold, write_silver
from tillroll.sources.star import read_silver


@dataclass(frozen=True)
class Layers:
    """Silver and the gold tables derived from it; all lazy, nothing is written."""

    orders_silver: DataFrame
    gold_monthly_region_category: DataFrame
    gold_top_customers: DataFrame
    gold_moving_rev: DataFrame
    top: int = 10

    def gold(self) -> dict[str, DataFrame]:
        return {
            "gold_monthly_region_category": self.gold_monthly_region_category,
            "gold_top_customers": self.gold_top_customers,
            "gold_moving_rev": self.gold_moving_rev,
        }


def layers_of(silver: DataFrame, n: int = 10) -> Layers:
    return Layers(
        orders_silver=silver,
        gold_monthly_region_category=gold.monthly_region_category(silver),
        gold_top_customers=gold.top_customers(gold.customer_spend(silver), n),
        gold_moving_rev=gold.moving_average(gold.monthly_total(silver)),
        top=n,
    )


def build_layers(
    orders: DataFrame, customers: DataFrame, products: DataFrame, how: str = "left", n: int = 10
) -> Layers:
    """All layers over one silver frame with all its columns."""
    return layers_of(enrich(orders, customers, products, how), n)


def stored_layers(silver: DataFrame, path: str, n: int = 10) -> Layers:
    """Silver written to ``path``, by month and region, and all layers over the table as written, so that the joins run
    once however many gold tables are computed."""
    write_silver(silver, path)
    return layers_of(read_silver(silver.sparkSession, path, silver.schema).select(silver.columns), n)


def write_layers(layers: Layers, base: str, dry_run: bool = True) -> list[str]:
    """Write silver and, from silver as written, gold below ``base``; returns the target paths. A dry run writes
    nothing and only returns the paths."""
    targets = {name: f"{base}/{name}" for name in layers.gold()}
    silver_target = f"{base}/silver_orders"
    if not dry_run:
        stored = stored_layers(layers.orders_silver, silver_target, layers.top)
        for name, frame in stored.gold().items():
            write_gold(frame, targets[name])
    return [silver_target, *targets.values()]


def register_views(layers: Layers) -> None:
    """Make silver and gold available to SQL under their own names."""
    layers.orders_silver.createOrReplaceTempView("orders_silver")
    for name, frame in layers.gold().items():
        frame.createOrReplaceTempView(name)
