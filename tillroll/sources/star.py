"""Readers of a stored star schema. Schemas are declared, never inferred."""

from pyspark.sql import DataFrame, SparkSession

from tillroll import schemas


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DIM_CUSTOMERS).parquet(path)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DIM_PRODUCTS).parquet(path)


def read_orders(spark: SparkSession, path: str, schema=schemas.ORDERS_BRONZE) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_silver(spark: SparkSession, path: str, schema=schemas.ORDERS_SILVER) -> DataFrame:
    """Silver as written by ``sinks.tables.write_silver``.

    The declared schema keeps the partition column ``yyyymm`` a string. Filters
    on ``yyyymm`` and ``region`` select folders before any file is opened.
    """
    return spark.read.schema(schema).parquet(path)
