"""Seeded customers, products and orders, generated on the executors.

Each generator takes a frame of ids, so its size is the size of that frame:
``sequence`` for plain test data, or the keys of existing tables.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.codes import order_code, product_label, region_of_country
from tillroll.functions.hashing import pick, uniform_int

# The domains of the generated columns.
GENDERS = ["Male", "Female", "Other"]
CHANNELS = ["Online", "Store", "Marketplace"]
SUBCATEGORIES = {
    "Electronics": ["Phone", "Laptop", "Headphones", "Camera"],
    "Clothing": ["Shirt", "Jeans", "Jacket", "Shoes"],
    "Home & Kitchen": ["Blender", "Cookware", "Lamp", "Desk"],
    "Sports": ["Ball", "Gloves", "Shoes", "Watch"],
    "Toys": ["Doll", "Blocks", "Car", "Puzzle"],
}

COUNTRIES = [
    "United States of America", "Canada", "France", "Germany", "Italy", "Spain",
    "United Kingdom", "India", "China", "Japan", "Singapore", "Brazil", "Mexico",
    "Argentina", "Chile", "Australia", "New Zealand", "South Africa", "Nigeria",
    "Kenya", "Egypt", "Sweden", "Norway", "Poland", "Portugal",
]
FIRST_NAMES = [
    "Ada", "Ben", "Chloe", "Dev", "Elif", "Farid", "Grace", "Hugo", "Ines", "Jun",
    "Kofi", "Lena", "Mateo", "Nora", "Omar", "Priya", "Rosa", "Sam", "Tara", "Yuki",
]
LAST_NAMES = [
    "Abebe", "Bauer", "Costa", "Diaz", "Evans", "Fischer", "Gupta", "Haddad",
    "Ito", "Jensen", "Kim", "Lopez", "Moreau", "Novak", "Okafor", "Patel", "Rossi",
    "Silva", "Tanaka", "Weber",
]


def sequence(spark: SparkSession, name: str, count: int) -> DataFrame:
    """Ids 1 to ``count``."""
    return spark.range(1, count + 1).select(F.col("id").alias(name))


def customers(ids: DataFrame, seed: int) -> DataFrame:
    """One customer per ``customer_id``."""
    key = F.col("customer_id")
    country = pick(COUNTRIES, seed, "country", key)
    return ids.select(
        key,
        F.concat_ws(
            " ", pick(FIRST_NAMES, seed, "first", key), pick(LAST_NAMES, seed, "last", key)
        ).alias("customer_name"),
        uniform_int(18, 75, seed, "age", key).cast("int").alias("age"),
        pick(GENDERS, seed, "gender", key).alias("gender"),
        country.alias("country"),
    ).withColumn("region", region_of_country(F.col("country")))


def products(ids: DataFrame, seed: int) -> DataFrame:
    """One product per ``product_id``; the subcategory fits the category."""
    key = F.col("product_id")
    subcategory = F.coalesce(
        *[
            F.when(F.col("category") == category, pick(names, seed, "subcategory", key))
            for category, names in SUBCATEGORIES.items()
        ]
    )
    return (
        ids.select(key, pick(list(SUBCATEGORIES), seed, "category", key).alias("category"))
        .withColumn("subcategory", subcategory)
        .withColumn("product_name", product_label(F.col("category"), F.col("subcategory"), key))
        .withColumn("base_price", uniform_int(500, 150_000, seed, "price", key) / 100)
    )


def orders(
    ids: DataFrame,
    customer_count: int,
    product_count: int,
    as_of: str,
    seed: int,
    days_back: int = 240,
) -> DataFrame:
    """One order per ``order_number``, placed on ``as_of`` or one of the
    ``days_back`` days before it, at a random second of the day."""
    key = F.col("order_number")
    day = F.date_sub(
        F.lit(as_of).cast("date"), uniform_int(0, days_back, seed, "day", key).cast("int")
    )
    second = uniform_int(0, 86_399, seed, "second", key)
    order_ts = day.cast("timestamp_ntz") + F.make_dt_interval(secs=second)
    return ids.select(
        order_code(key).alias("order_id"),
        order_ts.cast("timestamp").alias("order_ts"),
        uniform_int(1, customer_count, seed, "customer", key).alias("customer_id"),
        uniform_int(1, product_count, seed, "product", key).alias("product_id"),
        uniform_int(1, 5, seed, "quantity", key).cast("int").alias("quantity"),
        pick(CHANNELS, seed, "channel", key).alias("channel"),
    )
