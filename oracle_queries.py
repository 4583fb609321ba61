"""DuckDB statements for the checks of ``__spark_entry__.queries``."""

from tillroll.sources import generate

CUSTOMERS = """
customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, CAST(18 + c_custkey % 58 AS INT) AS age,
         CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Other' END AS gender,
         n_name AS country, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, p_type AS category, p_brand AS subcategory, p_name AS product_name,
         p_retailprice AS base_price
  FROM part
)"""

BRONZE = """
bronze AS (
  SELECT printf('ORD-%09d', o_orderkey) AS order_id, o_orderdate AS order_ts, o_custkey AS customer_id,
         l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,
         CASE o_orderkey % 3 WHEN 0 THEN 'Online' WHEN 1 THEN 'Store' ELSE 'Marketplace' END AS channel,
         l_extendedprice / l_quantity AS sold_price,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_return
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def silver(how: str) -> str:
    return f"""
silver AS (
  SELECT b.*, c.customer_name, c.age, c.gender, c.country, c.region, p.category, p.subcategory,
         p.product_name, p.base_price, p.base_price AS unit_price,
         p.base_price * b.quantity AS total_amount, CAST(b.order_ts AS DATE) AS order_date,
         strftime(b.order_ts, '%Y%m') AS yyyymm
  FROM bronze b {how} JOIN customers c ON b.customer_id = c.customer_id
                {how} JOIN products p ON b.product_id = p.product_id
)"""


def money(amount: str) -> str:
    return f"CAST(sum(CAST({amount} AS DECIMAL(38,6))) AS DOUBLE)"


REVENUE = money("total_amount")

MONTHLY = f"""
monthly AS (
  SELECT yyyymm, region, category, {REVENUE} AS revenue, CAST(sum(quantity) AS BIGINT) AS units
  FROM silver GROUP BY yyyymm, region, category
)"""

SPEND = f"""
spend AS (
  SELECT region, customer_id, {REVENUE} AS total_spent FROM silver GROUP BY region, customer_id
)"""

TREND = f"""
totals AS (SELECT yyyymm, {REVENUE} AS revenue FROM silver GROUP BY yyyymm),
trend AS (
  SELECT yyyymm, revenue,
         round(avg(revenue) OVER (ORDER BY yyyymm ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS rev_ma_3m
  FROM totals
)"""

SILVER_COLUMNS = (
    "order_id, order_ts, customer_id, product_id, quantity, channel, region, country, category, "
    "subcategory, base_price, unit_price, total_amount, order_date, yyyymm"
)


def over(ctes: list[str], select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def over_silver(select: str, *ctes: str, how: str = "LEFT") -> str:
    return over([CUSTOMERS, PRODUCTS, BRONZE, silver(how), *ctes], select)


def top_customers(n: int) -> str:
    return over_silver(
        "SELECT region, customer_id, total_spent, rank FROM ("
        "  SELECT *, CAST(dense_rank() OVER (PARTITION BY region ORDER BY total_spent DESC NULLS LAST) AS INT)"
        f"  AS rank FROM spend) WHERE rank <= {n}",
        SPEND,
    )


LAST_FULL = (
    "SELECT max(strftime(order_ts, '%Y%m')) FROM bronze"
    " WHERE last_day(CAST(order_ts AS DATE)) <= (SELECT max(CAST(order_ts AS DATE)) FROM bronze)"
)

REGION_TOTALS = (
    "yyyymm, region, count(*) AS row_count, CAST(sum(quantity) AS BIGINT) AS units, " + REVENUE + " AS revenue"
)

# Silver after the last full month was made again.
REBUILT = f"""
rebuilt AS (
  SELECT * REPLACE (
    CASE WHEN changed AND customer_id % 3 = 0 AND region IS NOT NULL THEN 'MOVED' ELSE region END AS region,
    quantity + CASE WHEN changed THEN 1 ELSE 0 END AS quantity,
    unit_price * (quantity + CASE WHEN changed THEN 1 ELSE 0 END) AS total_amount)
  FROM (SELECT *, yyyymm = ({LAST_FULL}) AS changed FROM silver)
)"""

# Bronze after late and corrected orders: of each order, the rows that were sent last.
UPSERTED = """
numbered AS (SELECT *, CAST(order_id[5:] AS BIGINT) AS number FROM bronze),
sent AS (
  SELECT *, order_ts AS sent_at, 0 AS place FROM numbered
  UNION ALL BY NAME
  SELECT * REPLACE (quantity + 1 AS quantity, order_ts + CASE WHEN number % 200 = 7 THEN INTERVAL 31 DAY
                    ELSE INTERVAL 0 DAY END AS order_ts),
         order_ts + INTERVAL 10 DAY AS sent_at, 1 AS place FROM numbered WHERE number % 100 = 7
  UNION ALL BY NAME
  SELECT * REPLACE (quantity + 5 AS quantity), order_ts - INTERVAL 1 DAY AS sent_at, 1 AS place
  FROM numbered WHERE number % 100 = 8
  UNION ALL BY NAME
  SELECT * EXCLUDE (later) REPLACE (quantity + later + 1 AS quantity), order_ts + to_days(later) AS sent_at, 1 AS place
  FROM (SELECT *, unnest([1, 2]) AS later FROM numbered WHERE number % 100 = 9)
  UNION ALL BY NAME
  SELECT * REPLACE ('LATE-' || order_id AS order_id), order_ts AS sent_at, 1 AS place FROM numbered WHERE number % 100 = 10
),
upserted AS (
  SELECT * EXCLUDE (number, place) FROM sent
  QUALIFY order_id IS NULL OR rank() OVER (PARTITION BY order_id ORDER BY sent_at DESC, place DESC) = 1
)"""

# Bronze and dimensions with NULL keys, unknown keys and quantities of zero.
BENT = f"""
bent_bronze AS (
  SELECT CASE WHEN product_id % 17 <> 3 THEN order_id END AS order_id, order_ts,
         CASE WHEN customer_id % 13 <> 5 THEN customer_id END AS customer_id, product_id,
         CASE WHEN quantity = 50 THEN 0 ELSE quantity END AS quantity, channel
  FROM bronze
),
bent_customers AS (SELECT * FROM customers WHERE customer_id % 7 <> 0),
bent_products AS (SELECT * FROM products WHERE product_id % 11 <> 0),
rejects AS (
  SELECT b.*, list_filter([
    CASE WHEN quantity <= 0 THEN 'non_positive_quantity' END,
    CASE WHEN b.customer_id IS NULL THEN 'null_customer_id' END,
    CASE WHEN order_id IS NULL THEN 'null_order_id' END,
    CASE WHEN order_ts IS NULL THEN 'null_order_ts' END,
    CASE WHEN b.product_id IS NULL THEN 'null_product_id' END,
    CASE WHEN quantity IS NULL THEN 'null_quantity' END,
    CASE WHEN b.customer_id IS NOT NULL AND c.customer_id IS NULL THEN 'orphan_customer' END,
    CASE WHEN b.product_id IS NOT NULL AND p.product_id IS NULL THEN 'orphan_product' END
  ], lambda x: x IS NOT NULL) AS rules
  FROM bent_bronze b LEFT JOIN bent_customers c ON b.customer_id = c.customer_id
                     LEFT JOIN bent_products p ON b.product_id = p.product_id
)"""


def bent_silver(how: str) -> str:
    return over(
        [CUSTOMERS, PRODUCTS, BRONZE, BENT],
        "SELECT b.*, c.region, c.country, p.category, p.subcategory, p.base_price, p.base_price AS unit_price,"
        " p.base_price * b.quantity AS total_amount, CAST(b.order_ts AS DATE) AS order_date,"
        f" strftime(b.order_ts, '%Y%m') AS yyyymm FROM bent_bronze b {how} JOIN bent_customers c"
        f" ON b.customer_id = c.customer_id {how} JOIN bent_products p ON b.product_id = p.product_id",
    )


RAW = """
raw AS (
  SELECT order_id, CASE WHEN product_id % 9 = 4 THEN NULL ELSE order_ts END AS order_ts, customer_id, product_id,
         CASE WHEN product_id % 5 = 0 THEN NULL ELSE quantity END AS quantity, channel,
         product_id % 9 = 4 AND order_ts IS NOT NULL AS bad_ts, product_id % 5 = 0 AS bad_quantity
  FROM bronze
)"""


def gapped(window: str) -> str:
    return over_silver(
        f"SELECT yyyymm, revenue, round(avg(revenue) OVER ({window}), 4) AS rev_ma_3m FROM totals"
        " WHERE yyyymm[5:6] NOT IN ('03', '07')",
        TREND,
    )


# The generator's draws.


def draw(low: int, high: int, salt: str, *keys: str) -> str:
    text = f"md5(concat_ws('|', {', '.join(keys)}, 42, '{salt}'))"
    return f"(CAST('0x' || {text}[1:15] AS BIGINT) % {high - low + 1} + {low})"


def pick(values: list[str], salt: str, *keys: str) -> str:
    return "[" + ", ".join(f"'{value}'" for value in values) + f"][{draw(1, len(values), salt, *keys)}]"


def region_of(country: str) -> str:
    return (
        f"CASE WHEN contains({country}, 'United States') OR contains({country}, 'Canada') THEN 'North America'"
        f" WHEN {country} IN ('France', 'Germany', 'Italy', 'Spain', 'United Kingdom') THEN 'Europe'"
        f" WHEN {country} IN ('India', 'China', 'Japan', 'Singapore') THEN 'Asia' ELSE 'Other' END"
    )


SUBCATEGORY = (
    "CASE category "
    + " ".join(f"WHEN '{c}' THEN {pick(names, 'subcategory', 'id')}" for c, names in generate.SUBCATEGORIES.items())
    + " END"
)

SIMULATED = f"(CASE WHEN {draw(0, 99, 'return', 'order_id')} < 5 THEN 1 ELSE 0 END)"


def net_revenue(flag: str) -> str:
    return over_silver(
        f"SELECT yyyymm, region, {REVENUE} AS gross_revenue,"
        f" {money(f'total_amount * {flag}')} AS returned_revenue,"
        f" {money(f'total_amount * (1 - {flag})')} AS net_revenue,"
        f" round(avg({flag}), 6) AS return_rate FROM silver GROUP BY yyyymm, region"
    )


def top_categories(month: str) -> str:
    return over_silver(
        "SELECT region, category, revenue FROM ("
        "  SELECT *, row_number() OVER (PARTITION BY region ORDER BY revenue DESC NULLS LAST, category) AS rn"
        f"  FROM monthly WHERE yyyymm = ({month})) WHERE rn <= 5",
        MONTHLY,
    )


ORACLES = {
    "dim_customers": over([CUSTOMERS], "SELECT * FROM customers"),
    "dim_products": over([PRODUCTS], "SELECT * FROM products"),
    "orders_bronze": over([BRONZE], "SELECT * FROM bronze"),
    "order_calendar": over(
        [BRONZE],
        "SELECT order_id, order_ts, CAST(order_ts AS DATE) AS order_date,"
        " strftime(order_ts, '%Y%m') AS yyyymm FROM bronze",
    ),
    "order_ids": (
        "SELECT o_orderkey AS order_number, printf('ORD-%09d', o_orderkey) AS order_id,"
        " printf('ORD-%09d', o_orderkey * 1000003) AS long_order_id FROM orders"
    ),
    "product_names": (
        "SELECT p_partkey AS product_id, printf('%s-%s-%04d', p_type, p_brand, p_partkey) AS product_label FROM part"
    ),
    "region_map": over(
        [CUSTOMERS],
        f"SELECT customer_id, country, {region_of('country')} AS sales_region FROM (SELECT customer_id, ["
        "'United States of America', 'United States Minor Outlying Islands', 'Canada', 'France', 'france', 'Germany',"
        " 'Spain', 'United Kingdom', 'India', 'Japan', 'Singapore', 'Brazil', NULL][customer_id % 13 + 1] AS country"
        " FROM customers)",
    ),
    "silver_left": over_silver(f"SELECT {SILVER_COLUMNS} FROM silver"),
    "silver_inner": over_silver(
        "SELECT order_id, order_ts, customer_id, product_id, quantity, channel, customer_name, age, gender,"
        " country, region, category, subcategory, product_name, base_price, total_amount, order_date, yyyymm"
        " FROM silver",
        how="INNER",
    ),
    "silver_left_bent": bent_silver("LEFT"),
    "silver_inner_bent": bent_silver("INNER"),
    "orders_rejected": over(
        [CUSTOMERS, PRODUCTS, BRONZE, BENT],
        "SELECT * REPLACE (array_to_string(rules, ',') AS rules) FROM rejects WHERE len(rules) > 0",
    ),
    "orders_cleaned": over(
        [BRONZE, RAW], "SELECT order_id, order_ts, customer_id, product_id, quantity, channel FROM raw"
    ),
    "cast_failures": over(
        [BRONZE, RAW],
        "SELECT unnest(['order_id', 'order_ts', 'customer_id', 'product_id', 'quantity', 'channel']) AS column,"
        " unnest([0, count(*) FILTER (WHERE bad_ts), 0, 0, count(*) FILTER (WHERE bad_quantity), 0]) AS rejected FROM raw",
    ),
    "orders_quarantined": over(
        [BRONZE, RAW],
        "SELECT order_id, 'order_ts' AS column, 'soon' AS value, 'not a timestamp_ntz' AS reason FROM raw WHERE bad_ts"
        " UNION ALL SELECT order_id, 'quantity', 'many', 'not a int' FROM raw WHERE bad_quantity",
    ),
    "orders_replayed": over(
        [BRONZE, RAW],
        "SELECT order_id, order_ts, customer_id, product_id, CASE WHEN bad_quantity THEN 1 ELSE quantity END AS quantity,"
        " channel FROM raw WHERE NOT coalesce(bad_ts, false)",
    ),
    "hot_customers_joined": over(
        [CUSTOMERS, BRONZE],
        "SELECT order_id, order_ts, b.customer_id, product_id, quantity, channel, country"
        " FROM bronze b LEFT JOIN customers c ON b.customer_id = c.customer_id",
    ),
    "order_rejects": over(
        [CUSTOMERS, PRODUCTS, BRONZE, BENT],
        "SELECT rule, count(*) FILTER (WHERE list_contains(rules, rule)) AS rejected FROM rejects, (SELECT unnest(["
        "'null_order_id', 'null_order_ts', 'null_customer_id', 'null_product_id', 'null_quantity',"
        " 'non_positive_quantity', 'orphan_customer', 'orphan_product']) AS rule) GROUP BY rule",
    ),
    "monthly_region_category": over_silver(
        "SELECT * FROM monthly ORDER BY yyyymm, region NULLS FIRST, category NULLS FIRST", MONTHLY
    ),
    "customer_spend": over_silver("SELECT * FROM spend", SPEND),
    "top_customers_10": top_customers(10),
    "top_customers_5": top_customers(5),
    "monthly_total": over_silver("SELECT yyyymm, revenue FROM totals", TREND),
    "latest_month": over([BRONZE], "SELECT max(strftime(order_ts, '%Y%m')) AS yyyymm FROM bronze"),
    "moving_avg_3m": over_silver("SELECT * FROM trend", TREND),
    "moving_avg_3m_calendar": over_silver(
        "SELECT yyyymm, revenue, round(avg(revenue) OVER (ORDER BY CAST(yyyymm[1:4] AS INT) * 12"
        " + CAST(yyyymm[5:6] AS INT) RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS rev_ma_3m FROM totals",
        TREND,
    ),
    "moving_avg_gap": gapped("ORDER BY yyyymm ROWS BETWEEN 2 PRECEDING AND CURRENT ROW"),
    "moving_avg_gap_calendar": gapped(
        "ORDER BY CAST(yyyymm[1:4] AS INT) * 12 + CAST(yyyymm[5:6] AS INT) RANGE BETWEEN 2 PRECEDING AND CURRENT ROW"
    ),
    "running_by_day": over_silver(
        "SELECT order_date, revenue, CAST(sum(CAST(revenue AS DECIMAL(38,6))) OVER (ORDER BY order_date) AS DOUBLE)"
        f" AS running_total FROM (SELECT order_date, {REVENUE} AS revenue FROM silver GROUP BY order_date)"
    ),
    "running_by_order": over_silver(
        "SELECT order_ts, order_id, product_id, quantity, total_amount, CAST(sum(CAST(total_amount AS DECIMAL(38,6)))"
        " OVER (ORDER BY order_ts NULLS FIRST, order_id NULLS FIRST, product_id NULLS FIRST, quantity NULLS FIRST"
        " ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total FROM silver"
    ),
    "channel_mix": over_silver(
        "SELECT yyyymm, channel, revenue,"
        " round(100 * revenue / nullif(sum(revenue) OVER (PARTITION BY yyyymm), 0), 4) AS pct"
        f" FROM (SELECT yyyymm, channel, {REVENUE} AS revenue FROM silver GROUP BY yyyymm, channel)"
    ),
    "net_revenue": net_revenue("is_return"),
    "net_revenue_simulated": net_revenue(SIMULATED),
    "price_outliers": over(
        [BRONZE],
        "SELECT order_id, product_id, sold_price, round((sold_price - mean_price) / sd_price, 4) AS z_score"
        " FROM bronze JOIN (SELECT product_id, avg(sold_price) AS mean_price, stddev_samp(sold_price) AS sd_price"
        "  FROM bronze GROUP BY product_id) USING (product_id)"
        " WHERE sd_price > 1e-9 * abs(mean_price) AND abs(sold_price - mean_price) > 3 * sd_price",
    ),
    "salted_region_revenue": over_silver(
        f"SELECT region, {REVENUE} AS revenue, CAST(sum(quantity) AS BIGINT) AS units FROM silver GROUP BY region"
    ),
    "top_categories_latest": top_categories("SELECT max(yyyymm) FROM monthly"),
    "top_categories_last_full": top_categories(LAST_FULL),
    "newest_month_share": over_silver(
        "SELECT region, round(100 * sum(CASE WHEN yyyymm = (SELECT max(yyyymm) FROM monthly) THEN revenue ELSE 0 END)"
        " / sum(revenue), 4) AS newest_pct FROM monthly GROUP BY region",
        MONTHLY,
    ),
    "revenue_trend": over_silver("SELECT * FROM trend ORDER BY yyyymm", TREND),
    "top_customers_report": top_customers(10) + " ORDER BY region NULLS FIRST, rank, customer_id NULLS FIRST",
    "layer_counts": over_silver(
        "SELECT 'orders_bronze' AS layer, count(*) AS row_count FROM bronze"
        " UNION ALL SELECT 'orders_silver', count(*) FROM silver"
        " UNION ALL SELECT 'gold_monthly_region_category', count(*) FROM monthly"
        " UNION ALL SELECT 'gold_top_customers', count(*) FROM (SELECT dense_rank() OVER"
        "  (PARTITION BY region ORDER BY total_spent DESC NULLS LAST) AS rank FROM spend) WHERE rank <= 10"
        " UNION ALL SELECT 'gold_moving_rev', count(*) FROM trend",
        MONTHLY,
        SPEND,
        TREND,
    ),
    "silver_roundtrip": over_silver(f"SELECT {SILVER_COLUMNS} FROM silver"),
    "silver_roundtrip_pruned": over_silver(
        f"SELECT {SILVER_COLUMNS} FROM silver WHERE yyyymm = ({LAST_FULL})"
        " AND region = (SELECT min(region) FROM customers)"
    ),
    "silver_month_rebuilt": over_silver(f"SELECT {REGION_TOTALS} FROM rebuilt GROUP BY yyyymm, region", REBUILT),
    "silver_version_latest": over_silver(f"SELECT {REGION_TOTALS} FROM rebuilt GROUP BY yyyymm, region", REBUILT),
    "silver_version_first": over_silver(f"SELECT {REGION_TOTALS} FROM silver GROUP BY yyyymm, region"),
    "gold_incremental": over_silver(
        f"SELECT 'monthly' AS layer, yyyymm, region, category, NULL::BIGINT AS customer_id, {REVENUE} AS amount,"
        " CAST(sum(quantity) AS BIGINT) AS units FROM rebuilt GROUP BY yyyymm, region, category"
        f" UNION ALL SELECT 'total', yyyymm, NULL, NULL, NULL, {REVENUE}, NULL FROM rebuilt GROUP BY yyyymm"
        f" UNION ALL SELECT 'spend', NULL, region, NULL, customer_id, {REVENUE}, NULL FROM rebuilt"
        " GROUP BY region, customer_id",
        REBUILT,
    ),
    "fourth_quarters": over_silver(
        f"SELECT region, {REVENUE} AS revenue, CAST(sum(quantity) AS BIGINT) AS units FROM silver"
        " WHERE yyyymm[5:6] IN ('10', '11', '12') GROUP BY region"
    ),
    "clustered_lookup": over(
        [BRONZE],
        "SELECT order_id, order_ts, customer_id, product_id, quantity, channel FROM bronze"
        " WHERE order_id IN ((SELECT min(order_id) FROM bronze), (SELECT max(order_id) FROM bronze))",
    ),
    "stored_latest_month": over([BRONZE], "SELECT max(strftime(order_ts, '%Y%m')) AS yyyymm FROM bronze"),
    "silver_upserted": over(
        [CUSTOMERS, PRODUCTS, BRONZE, UPSERTED, silver("LEFT").replace("FROM bronze b", "FROM upserted b")],
        f"SELECT {SILVER_COLUMNS}, sent_at FROM silver",
    ),
    "bronze_append_once": over([BRONZE], "SELECT * FROM bronze"),
    "bronze_append": over([BRONZE], "SELECT * FROM bronze"),
    "gold_roundtrip": over_silver(
        "SELECT 'gold_monthly_region_category' AS layer, yyyymm, region, category, NULL::BIGINT AS customer_id,"
        " revenue AS amount, units, NULL::DOUBLE AS average FROM monthly"
        " UNION ALL SELECT 'gold_top_customers', NULL, region, NULL, customer_id, total_spent, rank, NULL FROM ("
        "  SELECT *, dense_rank() OVER (PARTITION BY region ORDER BY total_spent DESC NULLS LAST) AS rank FROM spend)"
        "  WHERE rank <= 10"
        " UNION ALL SELECT 'gold_moving_rev', yyyymm, NULL, NULL, NULL, revenue, NULL, rev_ma_3m FROM trend",
        MONTHLY,
        SPEND,
        TREND,
    ),
    "layers_roundtrip": over_silver(f"SELECT {SILVER_COLUMNS} FROM silver"),
    "layers_views": over_silver(
        "SELECT s.yyyymm, s.region, count(order_id) AS orders, count(product_id) AS products, count(channel) AS channels,"
        " count(unit_price) AS prices, CAST(sum(quantity) AS BIGINT) AS units, max(best) AS best_spend FROM silver s"
        " LEFT JOIN (SELECT region, max(total_spent) AS best FROM spend GROUP BY region) b"
        " ON s.region IS NOT DISTINCT FROM b.region GROUP BY s.yyyymm, s.region",
        SPEND,
    ),
    "first_orders": over(
        [BRONZE],
        "SELECT order_id, order_ts, customer_id, product_id, quantity, channel FROM bronze"
        " ORDER BY order_id NULLS FIRST, order_ts NULLS FIRST, customer_id NULLS FIRST, product_id NULLS FIRST,"
        " quantity NULLS FIRST, channel NULLS FIRST LIMIT 25",
    ),
    "gold_in_one_file": over_silver("SELECT 1 AS files, count(*) AS row_count FROM monthly", MONTHLY),
    "bucketed_spend": over_silver("SELECT region, customer_id, total_spent FROM spend", SPEND),
    "reused_counts": over(
        [BRONZE],
        "SELECT 'lines' AS layer, count(*) AS row_count FROM bronze"
        " UNION ALL SELECT 'returns', count(*) FILTER (WHERE is_return = 1) FROM bronze",
    ),
    "gen_customers": (
        f"SELECT *, {region_of('country')} AS region FROM (SELECT id AS customer_id,"
        f" {pick(generate.FIRST_NAMES, 'first', 'id')} || ' ' || {pick(generate.LAST_NAMES, 'last', 'id')} AS customer_name,"
        f" CAST({draw(18, 75, 'age', 'id')} AS INT) AS age, {pick(generate.GENDERS, 'gender', 'id')} AS gender,"
        f" {pick(generate.COUNTRIES, 'country', 'id')} AS country FROM (SELECT c_custkey + 1 AS id FROM customer))"
    ),
    "gen_products": (
        "SELECT id AS product_id, category, subcategory, printf('%s-%s-%04d', category, subcategory, id) AS product_name,"
        f" {draw(500, 150_000, 'price', 'id')} / 100 AS base_price FROM (SELECT *, {SUBCATEGORY} AS subcategory FROM ("
        f"SELECT id, {pick(list(generate.SUBCATEGORIES), 'category', 'id')} AS category"
        " FROM (SELECT p_partkey + 1 AS id FROM part)))"
    ),
    "gen_orders": (
        "SELECT printf('ORD-%09d', id) AS order_id, (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)"
        f" - CAST({draw(0, 240, 'day', 'id')} AS INT) + to_seconds({draw(0, 86_399, 'second', 'id')}) AS order_ts,"
        " CAST('0x' || md5(concat_ws('|', id, 42, 'customer'))[1:15] AS BIGINT) % (SELECT count(*) FROM customer) + 1"
        " AS customer_id, CAST('0x' || md5(concat_ws('|', id, 42, 'product'))[1:15] AS BIGINT)"
        " % (SELECT count(*) FROM part) + 1 AS product_id,"
        f" CAST({draw(1, 5, 'quantity', 'id')} AS INT) AS quantity, {pick(generate.CHANNELS, 'channel', 'id')} AS channel"
        " FROM (SELECT o_orderkey + 1 AS id FROM orders)"
    ),
}
