"""The star schema as a view of order-entry tables in one folder.

Expects ``region nation customer part orders lineitem`` as Parquet. Keys stay
BIGINT: large order tables hold more keys than an INT can number.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.codes import order_code

SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    # nation and region are plain scans, so Spark itself checks their file size
    # before it broadcasts them.
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            "c_custkey AS customer_id",
            "c_name AS customer_name",
            "CAST(18 + c_custkey % 58 AS INT) AS age",
            "CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Other' END AS gender",
            "n_name AS country",
            "r_name AS region",
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "p_partkey AS product_id",
        "p_type AS category",
        "p_brand AS subcategory",
        "p_name AS product_name",
        "p_retailprice AS base_price",
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines, with the price paid and a return flag beside the bronze columns.

    Both sides are plain scans: Spark broadcasts the order headers only while
    their files are below its threshold and otherwise merges the two on the key.
    """
    lines = table(spark, folder, "lineitem")
    headers = table(spark, folder, "orders")
    return (
        lines.join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("order_id", order_code(F.col("o_orderkey")))
        .selectExpr(
            "order_id",
            "o_orderdate AS order_ts",
            "o_custkey AS customer_id",
            "l_partkey AS product_id",
            "CAST(l_quantity AS INT) AS quantity",
            "CASE o_orderkey % 3 WHEN 0 THEN 'Online' WHEN 1 THEN 'Store' ELSE 'Marketplace' END AS channel",
            "try_divide(l_extendedprice, l_quantity) AS sold_price",
            "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_return",
        )
    )
