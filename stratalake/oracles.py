"""The same answers in DuckDB SQL, stated on the driver's tables."""

from __future__ import annotations

from stratalake.queries import NEW_START, OLD_END
from stratalake.recast import HOURS_PER_DOCUMENT, LATITUDE, LONGITUDE

ORDER = "l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_partkey"


def _mean_16(hundredths: str, rows: str) -> str:
    """Mean of two-decimal numbers times 10^16, rounded half up, in 128-bit integers."""
    return (
        f"((2 * CAST(SUM({hundredths}) AS HUGEINT) * CAST(100000000000000 AS HUGEINT) + COUNT({rows}))"
        f" // (2 * COUNT({rows})))"
    )


def _mean_2(hundredths: str, rows: str, kind: str) -> str:
    """The same mean rounded to two places."""
    cents = f"(({_mean_16(hundredths, rows)} + 50000000000000) // 100000000000000)"
    return f"CAST(CAST({cents} AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(3,2)) AS {kind})"


SALES = """
  SELECT l_orderkey AS order_id, p_brand AS product, l_quantity AS quantity,
         p_retailprice AS price, l_extendedprice, l_linenumber, l_suppkey, l_quantity,
         l_shipdate, l_partkey, l_returnflag, l_discount, p_brand
  FROM lineitem JOIN part ON l_partkey = p_partkey
"""

STG_ORDERS = f"""
  SELECT CAST(order_id AS INTEGER) AS order_id, product, CAST(quantity AS INTEGER) AS quantity,
         CAST(price AS DECIMAL(10,2)) AS price, CAST(price * quantity AS DECIMAL(12,2)) AS total
  FROM ({SALES})
"""

HOURLY = f"""
  SELECT ts AS ts_utc, value AS temp_c,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS rh_pct,
         CAST({LATITUDE} AS DOUBLE) AS lat, CAST({LONGITUDE} AS DOUBLE) AS lon
  FROM events
"""

STG_WEATHER = f"""
  SELECT ts_utc, CAST(temp_c AS DECIMAL(5,2)) AS temp_c, CAST(rh_pct AS INTEGER) AS rh_pct, lat, lon
  FROM ({HOURLY})
"""


def _told_apart(mark: str) -> str:
    parts = ("l_linenumber", "l_suppkey", "l_partkey", "l_returnflag", "CAST(l_quantity AS BIGINT)", "CAST(trunc(l_discount * 100) AS INTEGER)")
    return f"p_brand || {mark} || " + " || ' ' || ".join(parts)


def _dim_product(orders: str) -> str:
    mean = _mean_2("CAST(price * 100 AS BIGINT)", "price", "DECIMAL(12,2)")
    return f"""
      SELECT md5(product) AS product_key, product, {mean} AS avg_price
      FROM ({orders}) GROUP BY product
    """


def _fct(orders: str) -> str:
    mean = _mean_16("CAST(price * 100 AS BIGINT)", "price")
    return f"""
      SELECT product, n_orders, qty, revenue,
             CAST(CAST(mean // 10000000000000000 AS VARCHAR) || '.' ||
                  lpad(CAST(mean % 10000000000000000 AS VARCHAR), 16, '0') AS DECIMAL(34,16)) AS avg_price
      FROM (
        SELECT product, COUNT(*) AS n_orders, CAST(SUM(quantity) AS BIGINT) AS qty,
               CAST(SUM(total) AS DECIMAL(22,2)) AS revenue, {mean} AS mean
        FROM ({orders}) GROUP BY product
      )
    """


def _fact(orders: str) -> str:
    return f"""
      SELECT md5(product) AS product_key, order_id, quantity AS qty,
             CAST(price AS DECIMAL(12,2)) AS unit_price_eur, total AS revenue_eur
      FROM ({orders})
    """


def _dim_weather(weather: str) -> str:
    temperature = _mean_2("CAST(temp_c * 100 AS BIGINT)", "temp_c", "DECIMAL(5,2)")
    humidity = _mean_2("CAST(rh_pct AS BIGINT) * 100", "rh_pct", "DECIMAL(5,2)")
    return f"""
      SELECT CAST(strftime(CAST(ts_utc AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
             CAST(ts_utc AS DATE) AS date, {temperature} AS avg_temp_c,
             MIN(temp_c) AS min_temp_c, MAX(temp_c) AS max_temp_c, {humidity} AS avg_rh
      FROM ({weather}) GROUP BY CAST(ts_utc AS DATE)
    """


def _dim_date(weather: str) -> str:
    return f"""
      SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date,
             CAST(isodow(d) AS INTEGER) AS weekday, strftime(d, '%a') AS weekday_name,
             CAST(month(d) AS INTEGER) AS month, strftime(d, '%b') AS month_name,
             CAST(year(d) AS INTEGER) AS year, isodow(d) IN (6, 7) AS is_weekend
      FROM (
        SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS d
        FROM (SELECT date_trunc('day', MIN(ts_utc))::TIMESTAMP AS first,
                     date_trunc('day', MAX(ts_utc))::TIMESTAMP AS last FROM ({weather}))
      )
    """


def _gold(hourly: str) -> str:
    return f"""
      SELECT CAST(ts_utc AS DATE) AS date, round(AVG(temp_c), 6) AS avg_temp_c,
             MIN(temp_c) AS min_temp_c, MAX(temp_c) AS max_temp_c
      FROM ({hourly}) GROUP BY 1
    """


def _silver(total: str) -> str:
    return f"""
      SELECT order_id, product, CAST(quantity AS BIGINT) AS quantity, price, {total} AS total
      FROM ({SALES})
    """


def _merged(newest_side: int) -> str:
    """Old and new hours; `newest_side` says which side wins the overlap."""
    direction = "DESC" if newest_side else "ASC"
    return f"""
      SELECT ts_utc, temp_c, rh_pct, lat, lon FROM (
        SELECT *, row_number() OVER (PARTITION BY ts_utc ORDER BY side {direction}) AS place FROM (
          SELECT *, 0 AS side FROM ({HOURLY}) WHERE ts_utc < TIMESTAMP '{OLD_END}'
          UNION ALL
          SELECT ts_utc, temp_c + 1, rh_pct, lat, lon, 1 FROM ({HOURLY})
          WHERE ts_utc >= TIMESTAMP '{NEW_START}'
        )
      ) WHERE place = 1
    """


HUMIDITY_AS_DOUBLE = "SELECT ts_utc, temp_c, CAST(rh_pct AS DOUBLE) AS rh_pct, lat, lon FROM ({})"


def _not_null(model: str, column: str, name: str | None = None) -> str:
    label = f"'{name}' AS model, " if name else ""
    return (f"SELECT {label}'{column}' AS \"column\", 'not_null' AS test,"
            f" COUNT(*) FILTER ({column} IS NULL) AS failures FROM ({model})")


def _unique(model: str, column: str, name: str | None = None) -> str:
    label = f"'{name}' AS model, " if name else ""
    return (f"SELECT {label}'{column}' AS \"column\", 'unique' AS test, COUNT(*) AS failures FROM ("
            f"SELECT {column} FROM ({model}) WHERE {column} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)")


def _reference(child: str, column: str, parent: str, parent_column: str, name: str | None = None) -> str:
    label = f"'{name}' AS model, " if name else ""
    return (f"SELECT {label}'{column}' AS \"column\", 'relationships' AS test, COUNT(*) AS failures"
            f" FROM ({child}) WHERE {column} IS NOT NULL"
            f" AND {column} NOT IN (SELECT {parent_column} FROM ({parent}) WHERE {parent_column} IS NOT NULL)")


def _report() -> str:
    product, fact, fct = _dim_product(STG_ORDERS), _fact(STG_ORDERS), _fct(STG_ORDERS)
    days, weather = _dim_date(STG_WEATHER), _dim_weather(STG_WEATHER)
    parts = [_not_null(STG_ORDERS, c, "stg_orders") for c in ("order_id", "product", "quantity", "total")]
    parts += [_not_null(fct, c, "fct_sales_by_product") for c in ("product", "revenue")]
    parts += [_unique(fct, "product", "fct_sales_by_product")]
    for name, model in (("dim_date", days), ("dim_weather", weather)):
        parts += [_not_null(model, c, name) for c in ("date_key", "date")]
        parts += [_unique(model, "date_key", name)]
    parts += [_not_null(product, c, "dim_product") for c in ("product_key", "product")]
    parts += [_unique(product, "product_key", "dim_product")]
    parts += [_not_null(fact, c, "fact_sales") for c in ("order_id", "product_key", "revenue_eur")]
    parts += [_reference(fact, "product_key", product, "product_key", "fact_sales")]
    return " UNION ALL ".join(parts)


def _draw(start: int) -> str:
    return f"CAST('0x' || substr(digest, {start}, 8) AS BIGINT)"


DEDUPED_SALES = f"""
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, product ORDER BY {ORDER}) AS place
    FROM (SELECT order_id, product, quantity, price, l_linenumber, l_suppkey, l_quantity,
                 l_extendedprice, l_shipdate, l_partkey FROM ({SALES}))
  ) WHERE place = 1
"""

SYNTHETIC = f"""
  SELECT o_orderkey AS order_id,
         (['Zapatos', 'Camiseta', 'Pantalon', 'Gorra'])[{_draw(1)} % 4 + 1] AS product,
         {_draw(9)} % 5 + 1 AS quantity,
         round(10 + 90 * ({_draw(17)} / 4294967296.0::DOUBLE), 2) AS price
  FROM (SELECT o_orderkey, md5('7:' || o_orderkey) AS digest FROM orders)
"""

ORACLES: dict[str, str] = {
    "stg_orders": STG_ORDERS,
    "stg_weather": STG_WEATHER,
    "dim_product": _dim_product(STG_ORDERS),
    "dim_date": _dim_date(STG_WEATHER),
    "dim_weather": _dim_weather(STG_WEATHER),
    "fact_sales": _fact(STG_ORDERS),
    "fct_sales_by_product": _fct(STG_ORDERS) + " ORDER BY revenue DESC NULLS FIRST",
    "revenue_nulls_first": f"""
      SELECT product, CAST(SUM(CASE WHEN product <> 'Brand#13' THEN total END) AS DECIMAL(22,2)) AS revenue
      FROM ({STG_ORDERS}) GROUP BY product ORDER BY revenue DESC NULLS FIRST
    """,
    "gold_weather_daily": _gold(HOURLY),
    "sales_silver_total_computed": _silver("price * quantity"),
    "sales_silver_total_given": _silver("l_extendedprice"),
    "numeric_coerce": """
      SELECT o_orderkey, CASE o_orderkey % 10
               WHEN 0 THEN o_totalprice WHEN 1 THEN o_totalprice WHEN 8 THEN -o_totalprice
               WHEN 6 THEN CAST(o_orderkey * 1000 AS DOUBLE) END AS number
      FROM orders
    """,
    "strict_integer": """
      SELECT o_orderkey, CASE o_orderkey % 6
               WHEN 3 THEN o_orderkey * 100 WHEN 4 THEN o_orderkey + 9007199254740993
               WHEN 5 THEN -o_orderkey ELSE o_orderkey END AS whole
      FROM orders
    """,
    "sales_dedup_keep_first": f"SELECT * EXCLUDE (place) FROM ({DEDUPED_SALES})",
    "sales_union_missing_cols": f"""
      SELECT order_id, product, quantity, price, CAST(NULL AS DOUBLE) AS total FROM ({SALES})
      UNION ALL
      SELECT o_orderkey, NULL, NULL, NULL, o_totalprice FROM orders
    """,
    "weather_merge_first_wins": _merged(0),
    "weather_merge_last_wins": _merged(1),
    "timestamp_formats": """
      SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp, date_trunc('minute', ts) AS minute
      FROM events
    """,
    "latest_partition": """
      SELECT event_id, ts, value FROM events
      WHERE CAST(ts AS DATE) = (SELECT MAX(CAST(ts AS DATE)) FROM events)
    """,
    "latest_key": """
      SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem
      WHERE l_orderkey = (SELECT MAX(l_orderkey) FROM lineitem)
    """,
    "weather_explode": HUMIDITY_AS_DOUBLE.format(HOURLY),
    "weather_doc_validation": f"""
      SELECT document, has_hourly,
             CASE WHEN has_hourly THEN n ELSE 0 END AS n_time,
             CASE WHEN has_hourly THEN n_low ELSE 0 END AS n_temperature_2m,
             CASE WHEN has_hourly THEN n ELSE 0 END AS n_relative_humidity_2m,
             has_hourly AND n = n_low AS is_valid
      FROM (
        SELECT event_id // {HOURS_PER_DOCUMENT} AS document, CAST(COUNT(*) AS INTEGER) AS n,
               CAST(COUNT(*) FILTER (value <= 300) AS INTEGER) AS n_low,
               arg_min(CAST(json_extract_string(props, '$.k') AS BIGINT), (ts, event_id)) >= 20 AS has_hourly
        FROM events GROUP BY 1
      )
    """,
    "test_not_null": " UNION ALL ".join(
        _not_null(f"""
          SELECT order_id, CASE WHEN quantity <= 45 THEN product END AS product,
                 CASE WHEN price < 990 THEN total END AS total FROM ({STG_ORDERS})
        """, column) for column in ("order_id", "product", "total")
    ),
    "test_unique": " UNION ALL ".join([
        _unique("SELECT * FROM orders", "o_orderkey"), _unique("SELECT * FROM orders", "o_custkey"),
        _unique("SELECT * FROM lineitem", "l_orderkey"),
    ]),
    "test_relationships": " UNION ALL ".join([
        _reference("SELECT * FROM lineitem", "l_orderkey", "SELECT * FROM orders", "o_orderkey"),
        _reference("SELECT * FROM orders", "o_orderkey", "SELECT * FROM lineitem", "l_orderkey"),
    ]),
    "test_report": _report(),
    "required_columns_report": f"""
      SELECT name, missing, has_total, n_rows FROM (
        VALUES ('with_total', '', true), ('without_total', '', false),
               ('incomplete', 'product, price', true)
      ) AS inputs(name, missing, has_total), (SELECT COUNT(*) AS n_rows FROM ({SALES}))
    """,
    "synthetic_sales_rows": SYNTHETIC,
    "roundtrip_seed_csv": f"SELECT *, price * quantity AS total FROM ({SYNTHETIC})",
    "sales_part_folders": f"""
      SELECT way, product, COUNT(DISTINCT order_id) AS n_rows, true AS in_place
      FROM ({SALES}), (VALUES ('files'), ('landed')) AS ways(way) GROUP BY way, product
    """,
    "sales_line_breaks": f"""
      SELECT DISTINCT order_id, {_told_apart("chr(10) || '\"\",' || chr(10) || chr(10)")} AS product,
             CAST(quantity AS BIGINT) AS quantity, price, price * quantity AS total, way
      FROM ({SALES}), (VALUES ('files'), ('landed')) AS ways(way)
    """,
    "extra_column_types": f"""
      SELECT DISTINCT order_id, {_told_apart("' '")} AS product, CAST(quantity AS BIGINT) AS quantity, price, price * quantity AS total,
             CASE WHEN l_linenumber <= 3 THEN l_discount WHEN l_linenumber = 4 THEN 1.0::DOUBLE END AS discount,
             CASE WHEN l_linenumber <= 3 THEN l_suppkey END AS supplier,
             CASE WHEN l_linenumber > 3 THEN l_returnflag WHEN l_linenumber > 1 THEN l_suppkey::VARCHAR END AS mixed,
             CASE WHEN l_linenumber <= 3 THEN l_returnflag END AS flag,
             CASE WHEN l_linenumber > 3 THEN (l_suppkey || '00000000000000000000')::DECIMAL(38,0) END AS wide
      FROM ({SALES})
    """,
    "sales_files_to_silver": f"""
      SELECT order_id, product, CAST(quantity AS BIGINT) AS quantity, price, total FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id, product ORDER BY file, {ORDER}) AS place
        FROM (
          SELECT 1 AS file, price * quantity AS total, * FROM ({SALES}) WHERE l_linenumber <= 4
          UNION ALL
          SELECT 2, l_extendedprice, * FROM ({SALES}) WHERE l_linenumber >= 3
        )
      ) WHERE place = 1
    """,
    "sales_end_to_end": _fct(f"""
      SELECT order_id, product, CAST(quantity AS INTEGER) AS quantity,
             CAST(price AS DECIMAL(10,2)) AS price, CAST(price * quantity AS DECIMAL(12,2)) AS total
      FROM ({DEDUPED_SALES})
    """),
    "weather_end_to_end": _dim_weather(f"""
      SELECT ts_utc, CAST(temp_c AS DECIMAL(5,2)) AS temp_c, CAST(rh_pct AS INTEGER) AS rh_pct
      FROM ({_merged(0)})
    """),
    "incremental_merge": HUMIDITY_AS_DOUBLE.format(_merged(0)),
    "truncate_append_count": f"""
      SELECT product, COUNT(*) AS n_rows FROM ({SALES}) WHERE quantity > 25 GROUP BY product
    """,
    "model_descriptions": f"""
      SELECT 'stg_orders' AS model, 'Staging: the orders table with set types' AS description, COUNT(*) AS n_rows FROM ({SALES})
      UNION ALL
      SELECT 'fct_sales_by_product', 'Facts: sales aggregated per product', COUNT(DISTINCT product) FROM ({SALES})
    """,
    "refused_inputs": f"""
      SELECT 'good' AS input, 'none' AS refusal, COUNT(DISTINCT order_id || product) AS n_rows FROM ({SALES})
      UNION ALL
      SELECT * FROM (VALUES ('no price', 'ValueError', 0), ('no sales file', 'FileNotFoundError', 0),
        ('unknown format', 'ValueError', 0), ('no silver', 'AnalysisException', 0))
    """,
    "roundtrip_csv_gold": _gold(HOURLY),
    "roundtrip_bronze_lineage": f"""
      SELECT 'ventas_2024.csv' AS raw_name,
             order_id || ',' || product || ',' || quantity || ',' || price AS line
      FROM ({SALES})
    """,
    "roundtrip_dynamic_overwrite": f"""
      SELECT ts_utc, CASE WHEN ts_utc >= TIMESTAMP '{NEW_START}' THEN temp_c + 1 ELSE temp_c END AS temp_c,
             rh_pct, lat, lon
      FROM ({HOURLY})
    """,
}
