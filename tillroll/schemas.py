"""Declared schemas of the star schema and of the derived tables."""

from pyspark.sql import types as T

# Keys are BIGINT everywhere: large tables hold more keys than an INT can number. Parquet files whose owner stored them
# as INT are read all the same.
DIM_CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("customer_name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

DIM_PRODUCTS = (
    "product_id BIGINT, category STRING, subcategory STRING, product_name STRING, base_price DOUBLE"
)

ORDERS_BRONZE = (
    "order_id STRING, order_ts TIMESTAMP, customer_id BIGINT, product_id BIGINT, quantity INT, channel STRING"
)

ORDERS_SILVER = (
    ORDERS_BRONZE + ", region STRING, country STRING, category STRING, subcategory STRING, "
    "base_price DOUBLE, unit_price DOUBLE, total_amount DOUBLE, order_date DATE, yyyymm STRING"
)

GOLD_MONTHLY_REGION_CATEGORY = (
    "yyyymm STRING, region STRING, category STRING, revenue DOUBLE, units BIGINT"
)

GOLD_TOP_CUSTOMERS = "region STRING, customer_id BIGINT, total_spent DOUBLE, rank INT"

GOLD_MOVING_REV = "yyyymm STRING, revenue DOUBLE, rev_ma_3m DOUBLE"
