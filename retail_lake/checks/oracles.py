"""The SQL each query must agree with, in DuckDB's dialect."""

from __future__ import annotations

from retail_lake.checks.queries import LOADED_UNTIL, STORED_UNTIL
from retail_lake.plans.sample_shop import LEAST_VALUE, MOST_VALUE

CALENDAR = """CAST(week(order_date) AS INT) AS date_week,
    CAST(month(order_date) AS INT) AS date_month,
    CAST(year(order_date) AS INT) AS date_year,
    CAST(dayofweek(order_date) + 1 AS INT) AS date_weekday"""

PRODUCTS = """SELECT p_partkey AS product_id, p_name AS product_name, department, aisle
  FROM part
  JOIN (SELECT DISTINCT p_type AS aisle FROM part) a ON p_type = aisle
  JOIN (SELECT DISTINCT p_brand AS department FROM part) d ON p_brand = department"""

STORES = """SELECT s_suppkey AS store_id, s_nationkey AS location_area_id, r_name AS store_type
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey"""

AREAS = "SELECT n_nationkey AS area_id, n_name AS area FROM nation"

CLIENTS = """SELECT c_custkey AS client_id, c_name AS fullname,
    c_nationkey AS location_area_id FROM customer"""

ORDER_DATES = f"""SELECT order_date, {CALENDAR}
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS order_date FROM orders)"""

FACT = """SELECT l_partkey AS product_id, o_custkey AS client_id,
    CAST(o_orderdate AS DATE) AS order_date, l_suppkey AS store_id,
    CAST(l_quantity AS INT) AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

FACT_AS_INT = """SELECT CAST(product_id AS INT) AS product_id,
    CAST(client_id AS INT) AS client_id, order_date, CAST(store_id AS INT) AS store_id"""

FACT_FIRST = f"""{FACT_AS_INT}, MIN(quantity) AS quantity
  FROM ({FACT}) GROUP BY product_id, client_id, order_date, store_id"""

#: Dates of the orders that have lines, as the daily run sees them.
FACT_DATES = f"SELECT order_date, {CALENDAR} FROM (SELECT DISTINCT order_date FROM ({FACT}))"

RAW_STOCK = f"""SELECT CASE WHEN value >= {LEAST_VALUE} THEN user_id END AS product_id,
    CASE WHEN value <= {MOST_VALUE} THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS date,
    CAST(ts AS DATE) AS ds
  FROM events"""

CLEAN_STOCK = f"""SELECT DISTINCT product_id, date FROM ({RAW_STOCK})
  WHERE product_id IS NOT NULL AND date IS NOT NULL"""

OUT_OF_STOCK = f"""SELECT CAST(product_id AS INT) AS product_id, CAST(date AS DATE) AS order_date,
    CAST(NULL AS INT) AS store_id FROM ({CLEAN_STOCK})"""

STOCK_DATES = f"""SELECT order_date, {CALENDAR}
  FROM (SELECT DISTINCT CAST(date AS DATE) AS order_date FROM ({CLEAN_STOCK}))"""


def _as_text(name: str, sql: str, key: list[str], rest: list[str]) -> str:
    def joined(columns):
        return " || '|' || ".join(f"COALESCE(CAST({c} AS VARCHAR), 'NULL')" for c in columns)

    return (
        f"SELECT '{name}' AS table_name, {joined(key)} AS row_key, "
        f"{joined(rest)} AS attributes FROM ({sql})"
    )


_CALENDAR_COLUMNS = ["date_week", "date_month", "date_year", "date_weekday"]

SHOP_DAY = " UNION ALL ".join(
    [
        _as_text("products", PRODUCTS, ["product_id"], ["product_name", "aisle", "department"]),
        _as_text("location_areas", AREAS, ["area_id"], ["area"]),
        _as_text("clients", CLIENTS, ["client_id"], ["fullname", "location_area_id"]),
        _as_text("stores", STORES, ["store_id"], ["location_area_id", "store_type"]),
        _as_text("dates", FACT_DATES, ["order_date"], _CALENDAR_COLUMNS),
        _as_text(
            "orders",
            FACT_FIRST,
            ["product_id", "client_id", "order_date", "store_id"],
            ["quantity"],
        ),
    ]
)

STOCK_RUN = " UNION ALL ".join(
    [
        _as_text("dates", STOCK_DATES, ["order_date"], _CALENDAR_COLUMNS),
        _as_text("out_of_stock", OUT_OF_STOCK, ["product_id", "order_date"], ["store_id"]),
    ]
)

ORACLES: dict[str, str] = {
    "products_gold": PRODUCTS,
    "products_positional": PRODUCTS,
    "stores_gold": STORES,
    "location_areas_gold": AREAS,
    "clients_gold": CLIENTS,
    "dates_from_orders": ORDER_DATES,
    "orders_gold": FACT,
    "orders_conformed": f"{FACT_AS_INT}, quantity FROM ({FACT})",
    "oos_clean": CLEAN_STOCK,
    "out_of_stock_gold": OUT_OF_STOCK,
    "dates_from_stock": STOCK_DATES,
    "merge_single_key": f"""SELECT * FROM ({CLIENTS}) n
  WHERE NOT EXISTS (SELECT 1 FROM customer o
    WHERE o.c_mktsegment = 'BUILDING' AND o.c_custkey = n.client_id)""",
    "merge_composite_key": f"""WITH fact AS ({FACT}) SELECT * FROM fact n
  WHERE NOT EXISTS (SELECT 1 FROM fact o
    WHERE o.order_date < DATE '{LOADED_UNTIL}' AND o.product_id = n.product_id
      AND o.client_id = n.client_id AND o.order_date = n.order_date
      AND o.store_id = n.store_id)""",
    "merge_null_key": """SELECT client_id
  FROM (SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS client_id FROM customer) n
  WHERE NOT EXISTS (SELECT 1 FROM customer o
    WHERE o.c_mktsegment = 'BUILDING' AND o.c_custkey = n.client_id)""",
    "key_violations": """SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows
  FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "first_line": """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate, l_partkey, l_suppkey) AS n FROM lineitem) WHERE n = 1""",
    "stock_contract_report": f"""WITH raw AS ({RAW_STOCK}),
  repeated AS (SELECT COUNT(*) AS n FROM raw
    WHERE product_id IS NOT NULL AND date IS NOT NULL
    GROUP BY product_id, date HAVING COUNT(*) > 1)
  SELECT * FROM (
    SELECT 'null' AS "rule", 'product_id' AS column_name, COUNT(*) AS n_rows
      FROM raw WHERE product_id IS NULL
    UNION ALL SELECT 'null', 'order_date', COUNT(*) FROM raw WHERE date IS NULL
    UNION ALL SELECT 'duplicate_key', 'product_id,order_date', CAST(SUM(n) AS BIGINT)
      FROM repeated) WHERE n_rows > 0""",
    "lossy_casts": "SELECT event_id, value FROM events WHERE value <> trunc(value)",
    "lossy_days": "SELECT event_id, ts FROM events WHERE ts <> date_trunc('day', ts)",
    "stage_counts": f"""SELECT (SELECT COUNT(*) FROM ({RAW_STOCK})) AS n_read,
    (SELECT COUNT(*) FROM ({RAW_STOCK})
      WHERE product_id IS NOT NULL AND date IS NOT NULL) AS n_valid,
    (SELECT COUNT(*) FROM ({CLEAN_STOCK})) AS n_clean""",
    "csv_roundtrip": "SELECT * FROM documents",
    "json_roundtrip": f"SELECT product_id, date FROM ({RAW_STOCK})",
    "silver_rerun": "SELECT * FROM lineitem",
    "silver_days": f"SELECT * FROM ({RAW_STOCK}) WHERE ds >= DATE '{STORED_UNTIL}'",
    "missing_dates": """SELECT CAST(d AS DATE) AS ds
  FROM (SELECT UNNEST(generate_series(MIN(l_shipdate), MAX(l_shipdate), INTERVAL 1 DAY)) AS d
    FROM lineitem)
  WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
    "stock_source": RAW_STOCK,
    "stock_backfill": RAW_STOCK,
    "stock_update": f"""WITH raw AS ({RAW_STOCK})
  SELECT * FROM raw
    WHERE ds <> (SELECT MIN(ds) FROM raw) AND ds <> DATE '{STORED_UNTIL}'
  UNION ALL SELECT CAST(1 AS BIGINT), 'replaced', MIN(ds) FROM raw""",
    "stock_get": RAW_STOCK,
    "stock_answers": f"""WITH raw AS ({RAW_STOCK}),
  rows AS (SELECT ds, COUNT(*) AS n FROM raw GROUP BY ds),
  answered AS (SELECT ds FROM rows UNION SELECT CAST(d AS DATE) FROM (SELECT
      UNNEST(generate_series(MIN(ds), MAX(ds), INTERVAL 1 DAY)) AS d FROM raw) WHERE day(d) % 2 = 1)
  SELECT a.ds, CASE WHEN day(a.ds) % 2 = 1 THEN 0 ELSE COALESCE(n, 0) END AS n_rows
    FROM answered a LEFT JOIN rows r ON r.ds = a.ds""",
    "store_cleared": f"SELECT * FROM ({RAW_STOCK}) WHERE ds < DATE '{STORED_UNTIL}'",
    "orders_merged": FACT_FIRST,
    "orders_merged_bucketed": FACT_FIRST,
    "orders_merged_yearly": FACT_FIRST,
    "clients_merged": """SELECT CAST(c_custkey AS INT) AS client_id,
    CASE WHEN c_mktsegment = 'BUILDING' THEN c_name WHEN c_nationkey = 7 THEN 'a copy'
      ELSE 'later ' || c_name END AS fullname, CAST(c_nationkey AS INT) AS location_area_id
  FROM customer""",
    "refused_load": """SELECT CAST(c_custkey AS INT) AS client_id, c_name AS fullname,
    CAST(c_nationkey AS INT) AS location_area_id FROM customer WHERE c_nationkey < 10""",
    "shop_day": SHOP_DAY,
    "stock_days": STOCK_RUN,
}
