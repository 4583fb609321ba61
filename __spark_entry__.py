
from __future__ import annotations

import os
import sys
import tempfile
from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_queries import ORACLES  # noqa: E402
from tillroll import schemas  # noqa: E402
from tillroll.functions.calendar import in_month  # noqa: E402
from tillroll.functions.codes import order_code, product_label, region_of_country  # noqa: E402
from tillroll.functions.hashing import simulated_return  # noqa: E402
from tillroll.operators import gold  # noqa: E402
from tillroll.operators.outliers import price_outliers  # noqa: E402
from tillroll.operators.quality import cast_failures, order_rejects, split_orders  # noqa: E402
from tillroll.operators.running import running_total  # noqa: E402
from tillroll.operators.silver import clean, enrich, with_calendar  # noqa: E402
from tillroll.operators.skew import hot_key_join, salted_revenue  # noqa: E402
from tillroll.plans import incremental, quarantine, reports  # noqa: E402
from tillroll.plans.layers import build_layers, register_views, stored_layers, write_layers  # noqa: E402
from tillroll.plans.upsert import upsert  # noqa: E402
from tillroll.sinks import versions  # noqa: E402
from tillroll.sinks.scratch import SETTING, materialise, scratch_path  # noqa: E402
from tillroll.sinks.tables import (  # noqa: E402
    append_bronze,
    count_rows,
    rebuild_months,
    reused,
    sample,
    write_bucketed,
    write_clustered,
    write_gold,
    write_silver,
)
from tillroll.sources import generate, sales_tables as sales  # noqa: E402
from tillroll.sources.star import read_orders, read_silver  # noqa: E402


def importable(name: str) -> bool:
    """Whether a module is there; its own import errors are not hidden."""
    try:
        return find_spec(name) is not None
    except ModuleNotFoundError:  # the package that would hold it is missing
        return False


# The library is whole without the subpackage and the pipeline, which needs the subpackage.
llm = pipeline = None
if importable("tillroll.llm.queries"):
    from tillroll.llm import queries as llm

    if importable("corpus_pipeline"):
        import corpus_pipeline as pipeline

Query = Callable[[SparkSession, str], DataFrame]

SEED = 42
BRONZE_COLUMNS = ["order_id", "order_ts", "customer_id", "product_id", "quantity", "channel"]
ALL_CUSTOMER_COLUMNS = ["customer_name", "age", "gender", "country", "region"]
ALL_PRODUCT_COLUMNS = ["category", "subcategory", "product_name", "base_price"]


def silver_left(spark: SparkSession, folder: str) -> DataFrame:
    bronze = sales.orders(spark, folder).select(BRONZE_COLUMNS)
    return enrich(bronze, sales.customers(spark, folder), sales.products(spark, folder))


def silver_inner(spark: SparkSession, folder: str) -> DataFrame:
    return enrich(
        sales.orders(spark, folder).select(BRONZE_COLUMNS),
        sales.customers(spark, folder),
        sales.products(spark, folder),
        how="inner",
        customer_columns=ALL_CUSTOMER_COLUMNS,
        product_columns=ALL_PRODUCT_COLUMNS,
    ).drop("unit_price")


def priced_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with amount and month for tables that read no customer column."""
    products = sales.products(spark, folder)
    return enrich(sales.orders(spark, folder), products=products, product_columns=["base_price"])


def lines_by_region(spark: SparkSession, folder: str) -> DataFrame:
    return enrich(
        sales.orders(spark, folder),
        sales.customers(spark, folder),
        sales.products(spark, folder),
        customer_columns=["region"],
        product_columns=["category", "base_price"],
    )


def monthly_region_category(spark: SparkSession, folder: str) -> DataFrame:
    monthly = gold.monthly_region_category(lines_by_region(spark, folder))
    return monthly.orderBy("yyyymm", "region", "category")


def customer_spend(spark: SparkSession, folder: str) -> DataFrame:
    return gold.customer_spend(priced_lines(spark, folder), sales.customers(spark, folder))


def top_customers(n: int) -> Query:
    return lambda spark, folder: gold.top_customers(customer_spend(spark, folder), n)


def moving_average(calendar: bool) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        monthly = gold.monthly_total(priced_lines(spark, folder))
        average = gold.moving_average(monthly, calendar=calendar)
        return average.withColumn("rev_ma_3m", F.round("rev_ma_3m", 4))

    return query


def running_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue of each day and of all days up to it."""
    lines = priced_lines(spark, folder)
    daily = lines.groupBy("order_date").agg(gold.money_sum(F.col("total_amount")).alias("revenue"))
    return running_total(daily, "revenue", ["order_date"])


def running_by_order(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue up to and with each order line, in order of time."""
    key = ["order_ts", "order_id", "product_id", "quantity"]
    return running_total(priced_lines(spark, folder).select(*key, "total_amount"), "total_amount", key)


def channel_mix(spark: SparkSession, folder: str) -> DataFrame:
    mix = gold.channel_mix(priced_lines(spark, folder))
    return mix.withColumn("pct", F.round("pct", 4))


def net_revenue(simulated: bool) -> Query:
    """With ``simulated``, about 5 % of the orders are taken as returned, whatever their flag says."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        lines = lines_by_region(spark, folder)
        if simulated:
            lines = lines.withColumn("is_return", simulated_return(5, SEED, F.col("order_id")))
        return gold.net_revenue(lines).withColumn("return_rate", F.round("return_rate", 6))

    return query


def outliers(spark: SparkSession, folder: str) -> DataFrame:
    return price_outliers(sales.orders(spark, folder)).select(
        "order_id", "product_id", "sold_price", F.round("z_score", 4).alias("z_score")
    )


def top_categories(month: str) -> Query:
    return lambda spark, folder: reports.top_categories(
        sales.orders(spark, folder), sales.customers(spark, folder), sales.products(spark, folder), month
    )


def revenue_trend(spark: SparkSession, folder: str) -> DataFrame:
    return reports.run(reports.REVENUE_TREND, gold_moving_rev=moving_average(False)(spark, folder))


def top_customers_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.run(reports.TOP_CUSTOMERS, gold_top_customers=top_customers(10)(spark, folder))


def newest_month_share(spark: SparkSession, folder: str) -> DataFrame:
    monthly = gold.monthly_region_category(lines_by_region(spark, folder))
    return reports.run(reports.NEWEST_MONTH_SHARE, gold_monthly_region_category=monthly)


def layer_counts(spark: SparkSession, folder: str) -> DataFrame:
    built = stored_layers(silver_left(spark, folder), scratch_path(spark, "silver_orders"))
    return count_rows(
        {
            "orders_bronze": sales.orders(spark, folder),
            "orders_silver": built.orders_silver,
            **built.gold(),
        }
    )


def written_layers(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """Where the layers were written, and silver as built."""
    bronze = sales.orders(spark, folder).select(BRONZE_COLUMNS)
    layers = build_layers(bronze, sales.customers(spark, folder), sales.products(spark, folder))
    base = scratch_path(spark, "layers")
    write_layers(layers, base, dry_run=False)
    return base, layers.orders_silver


def layers_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Silver with all its columns, after all layers were built and written in one go."""
    base, silver = written_layers(spark, folder)
    return read_silver(spark, f"{base}/silver_orders", silver.schema).select(silver.columns)


def gold_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The three gold tables written, read back and laid under each other."""
    base, _ = written_layers(spark, folder)
    columns = {
        "gold_monthly_region_category": ["yyyymm", "region", "category", "revenue AS amount", "units"],
        "gold_top_customers": [
            "region", "customer_id", "total_spent AS amount", "CAST(rank AS BIGINT) AS units",
        ],
        "gold_moving_rev": ["yyyymm", "revenue AS amount", "round(rev_ma_3m, 4) AS average"],
    }
    stacked = None
    for name, chosen in columns.items():
        frame = spark.read.parquet(f"{base}/{name}").selectExpr(f"'{name}' AS layer", *chosen)
        stacked = frame if stacked is None else stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def layers_views(spark: SparkSession, folder: str) -> DataFrame:
    """Filled values per month and region of silver, and its best customer, by SQL over the registered views."""
    register_views(stored_layers(silver_left(spark, folder), scratch_path(spark, "silver_orders")))
    return spark.sql(
        """
        SELECT s.yyyymm, s.region, count(order_id) AS orders, count(product_id) AS products, count(channel) AS channels,
               count(unit_price) AS prices, sum(quantity) AS units, any_value(best.total_spent) AS best_spend
        FROM orders_silver s
        LEFT JOIN (SELECT region, max(total_spent) AS total_spent FROM gold_top_customers GROUP BY region) best
          ON s.region <=> best.region
        GROUP BY s.yyyymm, s.region
        """
    )


def silver_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    silver = silver_left(spark, folder)
    path = scratch_path(spark, "silver_orders")
    write_silver(silver, path)
    return read_silver(spark, path, silver.schema).select(silver.columns)


def silver_roundtrip_pruned(spark: SparkSession, folder: str) -> DataFrame:
    """The first region by name in the last full month, read from its own folder."""
    month = reports.report_month(sales.orders(spark, folder), "last_full")
    region = sales.customers(spark, folder).agg(F.min("region").alias("region")).first()["region"]
    silver = silver_roundtrip(spark, folder)
    return silver.filter((F.col("yyyymm") == F.lit(month)) & (F.col("region") == F.lit(region)))


def changed_month(spark: SparkSession, folder: str) -> tuple[str | None, DataFrame]:
    """The last full month, and its silver after a third of the customers moved and all quantities grew by one."""
    orders = sales.orders(spark, folder).select(BRONZE_COLUMNS)
    month = reports.report_month(orders, "last_full")
    moved = sales.customers(spark, folder).withColumn(
        "region", F.when(F.col("customer_id") % 3 == 0, "MOVED").otherwise(F.col("region"))
    )
    rows = orders.filter(in_month(F.col("order_ts"), month) if month else F.lit(False))
    changed = rows.withColumn("quantity", F.col("quantity") + 1)
    return month, enrich(changed, moved, sales.products(spark, folder))


def region_totals(silver: DataFrame) -> DataFrame:
    return silver.groupBy("yyyymm", "region").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("quantity").alias("units"),
        gold.money_sum(F.col("total_amount")).alias("revenue"),
    )


def silver_month_rebuilt(spark: SparkSession, folder: str) -> DataFrame:
    """Silver written, then its last full month made again; totals per month and region."""
    silver = silver_left(spark, folder)
    path = scratch_path(spark, "silver_orders")
    write_silver(silver, path)
    month, changed = changed_month(spark, folder)
    if month:
        rebuild_months(changed, path, [month])
    return region_totals(read_silver(spark, path, silver.schema))


def fourth_quarters(spark: SparkSession, folder: str) -> DataFrame:
    """Sales of all fourth quarters, from stored silver and a stored calendar."""
    silver = silver_left(spark, folder)
    path, calendar = scratch_path(spark, "silver_orders"), scratch_path(spark, "calendar")
    write_silver(silver, path)
    write_gold(reports.calendar_months(sales.orders(spark, folder)), calendar)
    months = spark.read.schema("yyyymm STRING, year INT, quarter INT").parquet(calendar)
    return reports.sales_of_months(read_silver(spark, path, silver.schema), months.filter("quarter = 4"))


def clustered_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of the first, the last and a missing order, from bronze clustered by order."""
    bronze = sales.orders(spark, folder).select(BRONZE_COLUMNS)
    ends = bronze.agg(F.min("order_id").alias("first"), F.max("order_id").alias("last")).first()
    path = scratch_path(spark, "orders_clustered")
    write_clustered(bronze, path, "order_id", 8, 1 << 20)
    return read_orders(spark, path, bronze.schema).filter(F.col("order_id").isin(ends["first"], ends["last"], "ORD-X"))


def versioned_silver(spark: SparkSession, folder: str, then: Callable[[str], None] = lambda path: None) -> str:
    """Where silver is stored in versions: as built, what ``then`` makes of it, and its last full month made again."""
    path = scratch_path(spark, "silver_orders")
    versions.replace(silver_left(spark, folder), path)
    then(path)
    month, changed = changed_month(spark, folder)
    if month:
        versions.replace(changed, path, [month])
    return path


def silver_version(version: int | None) -> Query:
    """Totals of silver in its first or its latest version."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = versioned_silver(spark, folder)
        return region_totals(versions.read(spark, path, silver_left(spark, folder).schema, version))

    return query


def gold_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Gold from partial totals that were made for all months and then for the one that changed."""
    base, schema = scratch_path(spark, "gold"), silver_left(spark, folder).schema
    path = versioned_silver(spark, folder, lambda path: incremental.refresh(spark, path, base, schema))
    incremental.refresh(spark, path, base, schema)
    layers = [
        incremental.monthly_region_category(spark, base).selectExpr(
            "'monthly' AS layer", "yyyymm", "region", "category", "revenue AS amount", "units"
        ),
        incremental.monthly_total(spark, base).selectExpr("'total' AS layer", "yyyymm", "revenue AS amount"),
        incremental.customer_spend(spark, base).selectExpr(
            "'spend' AS layer", "region", "customer_id", "total_spent AS amount"
        ),
    ]
    stacked = layers[0].unionByName(layers[1], allowMissingColumns=True)
    return stacked.unionByName(layers[2], allowMissingColumns=True)


def stored_latest_month(spark: SparkSession, folder: str) -> DataFrame:
    """The latest month by the manifest of stored silver alone."""
    path = scratch_path(spark, "silver_orders")
    versions.replace(silver_left(spark, folder), path)
    return incremental.latest_month(spark, path)


def bronze_append_once(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze stored by two named batches, each of them sent twice."""
    bronze = sales.orders(spark, folder)
    path = scratch_path(spark, "orders_bronze")
    for name, flag in (("sales", 0), ("returns", 1), ("sales", 0), ("returns", 1)):
        versions.append_batch(bronze.filter(F.col("is_return") == flag), path, name)
    return versions.read(spark, path, bronze.schema)


def order_changes(bronze: DataFrame) -> DataFrame:
    """For every hundredth order a correction, half of them to another month; a stale one; two of which the later holds;
    and a late order."""
    number = F.substring("order_id", 5, 20).cast("bigint")

    def change(rest: int, added: int, days: int, ts: Column | None = None, order_id: Column | None = None) -> DataFrame:
        return bronze.filter(number % 100 == rest).select(
            (order_id if order_id is not None else F.col("order_id")).alias("order_id"),
            (ts if ts is not None else F.col("order_ts")).alias("order_ts"),
            "customer_id",
            "product_id",
            (F.col("quantity") + added).alias("quantity"),
            "channel",
            (F.col("order_ts") + F.make_dt_interval(F.lit(days))).alias("sent_at"),
        )

    moved = F.when(number % 200 == 7, F.col("order_ts") + F.make_dt_interval(F.lit(31))).otherwise(F.col("order_ts"))
    changes = [
        change(7, 1, 10, ts=moved),
        change(8, 5, -1),
        change(9, 2, 1),
        change(9, 3, 2),
        change(10, 0, 0, order_id=F.concat(F.lit("LATE-"), F.col("order_id"))),
    ]
    stacked = changes[0]
    for more in changes[1:]:
        stacked = stacked.unionAll(more)
    return stacked


def silver_upserted(spark: SparkSession, folder: str) -> DataFrame:
    """Silver after late and corrected orders were put into it."""
    bronze = sales.orders(spark, folder).select(BRONZE_COLUMNS)
    dimensions = sales.customers(spark, folder), sales.products(spark, folder)
    silver = enrich(bronze.withColumn("sent_at", F.col("order_ts")), *dimensions)
    changes = enrich(order_changes(bronze), *dimensions)
    path = scratch_path(spark, "silver_orders")
    versions.replace(silver, path)
    upsert(changes, path, silver.schema)
    return versions.read(spark, path, silver.schema)


def bent_star(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders with NULL keys, unknown keys and quantities of zero, and thinned dimensions."""
    orders = (
        sales.orders(spark, folder)
        .select(BRONZE_COLUMNS)
        .withColumn("quantity", F.when(F.col("quantity") == 50, 0).otherwise(F.col("quantity")))
        .withColumn("order_id", F.when(F.col("product_id") % 17 != 3, F.col("order_id")))
        .withColumn("customer_id", F.when(F.col("customer_id") % 13 != 5, F.col("customer_id")))
    )
    customers = sales.customers(spark, folder).filter(F.col("customer_id") % 7 != 0)
    products = sales.products(spark, folder).filter(F.col("product_id") % 11 != 0)
    return orders, customers, products


def bent_silver(how: str) -> Query:
    return lambda spark, folder: enrich(*bent_star(spark, folder), how=how)


def orders_rejected(spark: SparkSession, folder: str) -> DataFrame:
    _, rejected = split_orders(*bent_star(spark, folder))
    return rejected.withColumn("rules", F.array_join("rules", ","))


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze as text, with numbers and times that do not parse."""
    text = sales.orders(spark, folder).select([F.col(c).cast("string").alias(c) for c in BRONZE_COLUMNS])
    number = F.col("product_id").cast("long")
    return text.withColumn("quantity", F.when(number % 5 == 0, "many").otherwise(F.col("quantity"))).withColumn(
        "order_ts", F.when(number % 9 == 4, "soon").otherwise(F.col("order_ts"))
    )


def orders_quarantined(spark: SparkSession, folder: str) -> DataFrame:
    """What does not parse in raw orders, value by value."""
    _, broken = quarantine.split_raw(raw_orders(spark, folder), RAW_SCHEMA)
    return quarantine.listed_failures(broken, "order_id")


def orders_replayed(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze from raw orders, the quarantined ones with a quantity of one for those that were not numbers; orders
    without a time that parses stay away."""
    bronze, held = scratch_path(spark, "orders_bronze"), scratch_path(spark, "quarantine")
    quarantine.ingest(raw_orders(spark, folder), RAW_SCHEMA, bronze, held, "first")
    one = F.when(F.col("quantity").try_cast("int").isNull(), "1").otherwise(F.col("quantity"))
    quarantine.replay(spark, RAW_SCHEMA, bronze, held, {"quantity": one})
    return versions.read(spark, bronze, RAW_SCHEMA)


def hot_customers_joined(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and the country of their customer, joined by salting the customers with a hundredth of the lines."""
    lines = sales.orders(spark, folder).select(BRONZE_COLUMNS)
    countries = sales.customers(spark, folder).select("customer_id", "country")
    return hot_key_join(lines, countries, "customer_id", ["order_id", "product_id"])


RAW_SCHEMA = schemas.ORDERS_BRONZE.replace("order_ts TIMESTAMP", "order_ts TIMESTAMP_NTZ")


def gapped_average(calendar: bool) -> Query:
    """The moving average where every third and seventh month of a year is missing."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        lines = priced_lines(spark, folder).filter(~F.month("order_ts").isin(3, 7))
        average = gold.moving_average(gold.monthly_total(lines), calendar=calendar)
        return average.withColumn("rev_ma_3m", F.round("rev_ma_3m", 4))

    return query


def first_orders(spark: SparkSession, folder: str) -> DataFrame:
    bronze = sales.orders(spark, folder).select(BRONZE_COLUMNS)
    return sample(bronze.orderBy(*BRONZE_COLUMNS), 25)


def gold_in_one_file(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "gold")
    write_gold(monthly_region_category(spark, folder), path, files=1)
    stored = spark.read.parquet(path).select(F.input_file_name().alias("file"))
    return stored.agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("row_count"))


def bucketed_spend(spark: SparkSession, folder: str) -> DataFrame:
    """Spend and region per customer over two tables bucketed by customer; joins and totals need no shuffle."""
    write_bucketed(priced_lines(spark, folder).select("customer_id", "total_amount"), "tillroll_bucketed_lines", 8)
    write_bucketed(sales.customers(spark, folder).select("customer_id", "region"), "tillroll_bucketed_customers", 8)
    lines, customers = spark.table("tillroll_bucketed_lines"), spark.table("tillroll_bucketed_customers")
    totals = lines.groupBy("customer_id").agg(gold.money_sum(F.col("total_amount")).alias("total_spent"))
    return totals.join(customers, "customer_id", "left").select("region", "customer_id", "total_spent")


def reused_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of one cached frame and of a part of it, stored before the frame is released."""
    with reused(priced_lines(spark, folder)) as lines:
        counts = count_rows({"lines": lines, "returns": lines.filter("is_return = 1")})
        return materialise(counts, "counts")


def bronze_append(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze stored by two appends, first sales and then returns."""
    bronze = sales.orders(spark, folder)
    path = scratch_path(spark, "orders_bronze")
    for flag in (0, 1):
        append_bronze(bronze.filter(F.col("is_return") == flag), path)
    return read_orders(spark, path, bronze.schema)


# Countries of every region, of none, and some that only look like one.
COUNTRIES = [
    "United States of America", "United States Minor Outlying Islands", "Canada", "France", "france", "Germany", "Spain",
    "United Kingdom", "India", "Japan", "Singapore", "Brazil",
]


def region_map(spark: SparkSession, folder: str) -> DataFrame:
    """The region of a country chosen by the customer's key; every thirteenth has none."""
    number = F.col("customer_id") % (len(COUNTRIES) + 1)
    names = F.array(*[F.lit(name) for name in COUNTRIES])
    chosen = F.when(number < len(COUNTRIES), F.get(names, number.cast("int")))
    return sales.customers(spark, folder).select(
        "customer_id", chosen.alias("country"), region_of_country(chosen).alias("sales_region")
    )


def order_ids(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("o_orderkey")
    long = number * 1_000_003  # ids of up to twelve digits
    return sales.table(spark, folder, "orders").select(
        number.alias("order_number"), order_code(number).alias("order_id"), order_code(long).alias("long_order_id")
    )


def product_names(spark: SparkSession, folder: str) -> DataFrame:
    return sales.products(spark, folder).select(
        "product_id",
        product_label(F.col("category"), F.col("subcategory"), F.col("product_id")).alias(
            "product_label"
        ),
    )


def order_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return with_calendar(sales.orders(spark, folder)).select(
        "order_id", "order_ts", "order_date", "yyyymm"
    )


def gen_customers(spark: SparkSession, folder: str) -> DataFrame:
    ids = sales.customers(spark, folder).select((F.col("customer_id") + 1).alias("customer_id"))
    return generate.customers(ids, SEED)


def gen_products(spark: SparkSession, folder: str) -> DataFrame:
    ids = sales.products(spark, folder).select((F.col("product_id") + 1).alias("product_id"))
    return generate.products(ids, SEED)


def gen_orders(spark: SparkSession, folder: str) -> DataFrame:
    """As many orders as the order table has, up to its last day."""
    headers = sales.table(spark, folder, "orders")
    last_day = headers.agg(F.max(F.to_date("o_orderdate")).alias("day")).first()["day"]
    return generate.orders(
        headers.select((F.col("o_orderkey") + 1).alias("order_number")),
        sales.table(spark, folder, "customer").count(),
        sales.table(spark, folder, "part").count(),
        as_of=last_day.isoformat(),
        seed=SEED,
    )


def entry(spark: SparkSession) -> DataFrame:
    """Monthly revenue and units per region and category."""
    return monthly_region_category(spark, "/root/testdata/sf0.001")


def with_shared_folder(query: Query) -> Query:
    """``query`` in sessions of one machine too that name no shared folder; those of a cluster must name one."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SETTING, None)
        if not named and spark.sparkContext.master.startswith("local"):
            spark.conf.set(SETTING, tempfile.mkdtemp(prefix="tillroll-"))
        return query(spark, folder)

    return run


def queries() -> dict[str, Query]:
    return {name: with_shared_folder(query) for name, query in all_queries().items()}


def all_queries() -> dict[str, Query]:
    return {
        "dim_customers": sales.customers,
        "dim_products": sales.products,
        "orders_bronze": sales.orders,
        "order_calendar": order_calendar,
        "order_ids": order_ids,
        "product_names": product_names,
        "region_map": region_map,
        "silver_left": silver_left,
        "silver_inner": silver_inner,
        "silver_left_bent": bent_silver("left"),
        "silver_inner_bent": bent_silver("inner"),
        "order_rejects": lambda spark, folder: order_rejects(*bent_star(spark, folder)),
        "orders_rejected": orders_rejected,
        "orders_cleaned": lambda spark, folder: clean(raw_orders(spark, folder), RAW_SCHEMA),
        "cast_failures": lambda spark, folder: cast_failures(raw_orders(spark, folder), RAW_SCHEMA),
        "orders_quarantined": orders_quarantined,
        "orders_replayed": orders_replayed,
        "hot_customers_joined": hot_customers_joined,
        "monthly_region_category": monthly_region_category,
        "customer_spend": customer_spend,
        "top_customers_10": top_customers(10),
        "top_customers_5": top_customers(5),
        "monthly_total": lambda spark, folder: gold.monthly_total(priced_lines(spark, folder)),
        "latest_month": lambda spark, folder: gold.latest_month(sales.orders(spark, folder)),
        "moving_avg_3m": moving_average(calendar=False),
        "moving_avg_3m_calendar": moving_average(calendar=True),
        "moving_avg_gap": gapped_average(calendar=False),
        "moving_avg_gap_calendar": gapped_average(calendar=True),
        "running_by_day": running_by_day,
        "running_by_order": running_by_order,
        "channel_mix": channel_mix,
        "net_revenue": net_revenue(simulated=False),
        "net_revenue_simulated": net_revenue(simulated=True),
        "price_outliers": outliers,
        "salted_region_revenue": lambda spark, folder: salted_revenue(
            lines_by_region(spark, folder), ["region"], ["customer_id", "product_id"]
        ),
        "top_categories_latest": top_categories("latest"),
        "top_categories_last_full": top_categories("last_full"),
        "newest_month_share": newest_month_share,
        "revenue_trend": revenue_trend,
        "top_customers_report": top_customers_report,
        "layer_counts": layer_counts,
        "silver_roundtrip": silver_roundtrip,
        "silver_roundtrip_pruned": silver_roundtrip_pruned,
        "silver_month_rebuilt": silver_month_rebuilt,
        "gold_roundtrip": gold_roundtrip,
        "layers_roundtrip": layers_roundtrip,
        "layers_views": layers_views,
        "first_orders": first_orders,
        "gold_in_one_file": gold_in_one_file,
        "bucketed_spend": bucketed_spend,
        "reused_counts": reused_counts,
        "bronze_append": bronze_append,
        "bronze_append_once": bronze_append_once,
        "silver_version_first": silver_version(1),
        "silver_version_latest": silver_version(None),
        "silver_upserted": silver_upserted,
        "gold_incremental": gold_incremental,
        "stored_latest_month": stored_latest_month,
        "fourth_quarters": fourth_quarters,
        "clustered_lookup": clustered_lookup,
        "gen_customers": gen_customers,
        "gen_products": gen_products,
        "gen_orders": gen_orders,
        **(llm.queries() if llm else {}),
        **({"pipeline": pipeline.run} if pipeline else {}),
    }


def oracle_sql() -> dict[str, str]:
    return {**ORACLES, **(llm.oracles() if llm else {})}
