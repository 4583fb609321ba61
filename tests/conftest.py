import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"
TABLES = ["region", "nation", "customer", "part", "orders", "lineitem"]

# The driver's tables bent into what they do not contain: orphan and NULL keys,
# a customer and a product with a third of the lines, and many exact copies.
HARD_TABLES = {
    "region": "SELECT * FROM region",
    "nation": "SELECT * FROM nation",
    "customer": "SELECT * FROM customer WHERE c_custkey % 7 <> 0",
    "part": "SELECT * FROM part WHERE p_partkey % 11 <> 0",
    "orders": """
        SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 8 WHEN o_orderkey % 50 = 1 THEN NULL
                               ELSE o_custkey END AS o_custkey) FROM orders""",
    "lineitem": """
        WITH bent AS (
          SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 1 THEN 5 WHEN l_orderkey % 40 = 2 THEN NULL
                                 ELSE l_partkey END AS l_partkey) FROM lineitem
        )
        SELECT * FROM bent UNION ALL
        SELECT one.* FROM (SELECT * FROM bent ORDER BY ALL LIMIT 1) one, range(3000)""",
}


def open_tables(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tillroll-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.maxMetadataStringLength", "1000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Session settings changed for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture(scope="session")
def hard_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("hard")
    connection = open_tables(f"{DATA}/sf0.001")
    for name, text in HARD_TABLES.items():
        connection.execute(f"COPY ({text}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


def rows_of(frame, columns=None):
    columns = columns or frame.columns
    return [tuple(row[c] for c in columns) for row in frame.select(columns).collect()]


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((value is not None, value) for value in row))
