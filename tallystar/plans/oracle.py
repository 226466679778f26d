"""Plain SQL for the registered queries, to check them in another engine.

Written from the meaning of each operator, not from the Spark plans: the unpivot
is a union of one branch per product, the upsert a full outer join, money a
decimal sum.
"""

from __future__ import annotations

# The products of the two daily files.
PRODUCTS = [f"P{n}" for n in range(1, 5)]
BRANDS = [f"P{n}" for n in range(1, 26)]

MONEY = "CAST(SUM(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"


def _text(day: str) -> str:
    return (
        f"CASE WHEN EXTRACT(day FROM {day}) = 29 THEN strftime({day}, '%Y-%m-%d') "
        f"ELSE strftime({day}, '%d-%m-%Y') END"
    )


LINES = """lines AS (
  SELECT CAST(l_shipdate AS DATE) AS d, l_partkey AS partkey, l_quantity AS units,
         l_extendedprice AS revenue, 'P' || CAST(l_partkey % 4 + 1 AS VARCHAR) AS product
  FROM lineitem)"""

BRAND_LINES = """lines AS (
  SELECT CAST(l_shipdate AS DATE) AS d, l_quantity AS units, l_extendedprice AS revenue,
         'P' || split_part(p_brand, '#', 2) AS product
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _wide_daily(products: list[str]) -> str:
    cells = ",\n".join(
        f"CAST(SUM(units) FILTER (WHERE product = '{p}') AS INT) AS \"Q-{p}\",\n"
        f"CAST(SUM(CAST(revenue AS DECIMAL(18,2))) FILTER (WHERE product = '{p}') AS DOUBLE) "
        f'AS "S-{p}"'
        for p in products
    )
    return f'wide AS (SELECT {_text("d")} AS "Date", {cells} FROM lines GROUP BY d)'


def _wide_lines() -> str:
    cells = ",\n".join(
        f"CASE WHEN product = '{p}' THEN units END AS \"Q-{p}\",\n"
        f"CASE WHEN product = '{p}' THEN revenue END AS \"S-{p}\""
        for p in PRODUCTS
    )
    return f'wide AS (SELECT {_text("d")} AS "Date", {cells} FROM lines)'


def _long(products: list[str]) -> str:
    branches = "\nUNION ALL\n".join(
        f"SELECT sale_date, '{p}' AS product_id, \"Q-{p}\" AS total_units_sold, "
        f'"S-{p}" AS total_revenue FROM dated'
        for p in products
    )
    return f"""dated AS (
  SELECT *, CAST(try_strptime("Date", '%d-%m-%Y') AS DATE) AS sale_date FROM wide),
long AS (
  SELECT sale_date AS date, CAST(EXTRACT(year FROM sale_date) AS INT) AS year,
         CAST(EXTRACT(month FROM sale_date) AS INT) AS month,
         CAST(EXTRACT(day FROM sale_date) AS INT) AS day,
         product_id, total_units_sold, total_revenue
  FROM ({branches}))"""


CLEAN = """clean AS (
  SELECT date AS "Date", year AS "Year", month AS "Month", day AS "Day", product_id,
         CAST(trunc(total_units_sold) AS INT) AS "Total_Units_Sold",
         CAST(total_revenue AS DOUBLE) AS "Total_Revenue"
  FROM long
  WHERE date IS NOT NULL AND total_units_sold IS NOT NULL AND total_revenue IS NOT NULL
    AND NOT isnan(CAST(total_revenue AS DOUBLE)))"""

FACT = """fact AS (
  SELECT "Date" AS date_key, product_id AS product_key,
         "Total_Units_Sold" AS total_units_sold, "Total_Revenue" AS total_revenue
  FROM clean)"""

LINE_FACT = f"""{LINES},
fact AS (
  SELECT d AS date_key, 'P' || CAST(partkey AS VARCHAR) AS product_key,
         CAST(units AS INT) AS total_units_sold, revenue AS total_revenue
  FROM lines)"""

KEYED_FACT = f"""{LINES},
fact AS (
  SELECT d AS date_key, 'P' || CAST(partkey AS VARCHAR) AS product_key,
         CAST(SUM(units) AS INT) AS total_units_sold,
         {MONEY.format("revenue")} AS total_revenue
  FROM lines GROUP BY 1, 2)"""

DATE_DIM = """date_dim AS (
  SELECT DISTINCT "Date" AS date_key, "Year" AS year, "Month" AS month, "Day" AS day
  FROM clean)"""

PRODUCT_DIM = """product_dim AS (
  SELECT DISTINCT product_id AS product_key,
         concat('Product ', substr(product_id, 2)) AS product_name
  FROM clean)"""

DAILY_WIDE = f"{LINES}, {_wide_daily(PRODUCTS)}"
DAILY_LONG = f"{DAILY_WIDE}, {_long(PRODUCTS)}"
DAILY_CLEAN = f"{DAILY_LONG}, {CLEAN}"
DAILY_FACT = f"{DAILY_CLEAN}, {FACT}"
BRAND_LONG = f"{BRAND_LINES}, {_wide_daily(BRANDS)}, {_long(BRANDS)}"
LINE_LONG = f"{LINES}, {_wide_lines()}, {_long(PRODUCTS)}"
LINE_CLEAN = f"{LINE_LONG}, {CLEAN}"

COUNTS = """SELECT COUNT(*) AS rows_in,
  COUNT(*) FILTER (WHERE date IS NULL) AS bad_date,
  COUNT(*) FILTER (WHERE product_id IS NULL) AS bad_product,
  COUNT(*) FILTER (WHERE total_units_sold IS NULL) AS bad_units,
  COUNT(*) FILTER (WHERE total_revenue IS NULL) AS bad_revenue,
  COUNT(*) FILTER (WHERE date IS NOT NULL AND total_units_sold IS NOT NULL
                   AND total_revenue IS NOT NULL) AS rows_out
FROM long"""

MANIFEST = """SELECT COUNT(*) AS record_count, MIN("Date") AS min_date, MAX("Date") AS max_date,
  COUNT(DISTINCT product_id) AS n_products, '1.0' AS pipeline_version FROM clean"""

BY_PRODUCT = f"""SELECT product_key, {MONEY.format("total_revenue")} AS total_sales
FROM fact GROUP BY product_key ORDER BY total_sales DESC, product_key"""

BY_MONTH = f"""SELECT CAST(date_trunc('month', date_key) AS DATE) AS month,
  {MONEY.format("total_revenue")} AS total_sales
FROM fact GROUP BY 1 ORDER BY 1"""

TOP = """SELECT product_key, CAST(SUM(total_units_sold) AS BIGINT) AS total_units
FROM fact GROUP BY product_key ORDER BY total_units DESC, product_key LIMIT 5"""

AVERAGE = f"""SELECT {MONEY.format("total_revenue")} / COUNT(total_revenue) AS avg_revenue
FROM fact"""

MERGED = """target AS (
  SELECT date_key, product_key, total_units_sold - 1 AS total_units_sold, total_revenue
  FROM fact WHERE date_key < DATE '1999-01-01'),
source AS (SELECT * FROM fact WHERE date_key >= DATE '1998-01-01')
SELECT COALESCE(s.date_key, t.date_key) AS date_key,
  COALESCE(s.product_key, t.product_key) AS product_key,
  CASE WHEN s.date_key IS NULL THEN t.total_units_sold ELSE s.total_units_sold END
    AS total_units_sold,
  CASE WHEN s.date_key IS NULL THEN t.total_revenue ELSE s.total_revenue END
    AS total_revenue
FROM target t FULL OUTER JOIN source s
  ON t.date_key = s.date_key AND t.product_key = s.product_key"""

STAR = f"""SELECT d.year, d.month, p.product_key, p.product_name,
  CAST(SUM(f.total_units_sold) AS BIGINT) AS total_units,
  {MONEY.format("f.total_revenue")} AS total_sales
FROM fact f JOIN date_dim d ON f.date_key = d.date_key
  JOIN product_dim p ON f.product_key = p.product_key
GROUP BY d.year, d.month, p.product_key, p.product_name"""

STAGED = """staged AS (
  SELECT CASE WHEN EXTRACT(day FROM d) = 29 THEN strftime(d, '%d-%m-%Y')
              ELSE strftime(d, '%Y-%m-%d') END AS date_str,
         d, 'P' || CAST(partkey AS VARCHAR) AS product_key,
         CAST(units + 0.5 AS VARCHAR) AS units_str, CAST(revenue AS VARCHAR) AS revenue_str
  FROM lines),
long AS (
  SELECT CAST(try_strptime(date_str, '%Y-%m-%d') AS DATE) AS date,
         CAST(EXTRACT(year FROM d) AS INT) AS year,
         CAST(EXTRACT(month FROM d) AS INT) AS month,
         CAST(EXTRACT(day FROM d) AS INT) AS day,
         product_key AS product_id,
         CAST(round(CAST(units_str AS DOUBLE)) AS INT) AS total_units_sold,
         CAST(revenue_str AS DOUBLE) AS total_revenue
  FROM staged)"""

FILES = """files AS (
  SELECT 'processed_data/output_' || strftime(ts, '%Y%m%d_%H%M%S') || '.csv' AS filename,
         ts AS modified, event_type FROM events)"""

CONTENT = """hashes AS (SELECT doc_id, md5(COALESCE(text, '')) AS content_hash FROM documents),
incoming AS (SELECT * FROM hashes WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
ledger AS (SELECT content_hash FROM hashes WHERE doc_id IN (SELECT doc_id FROM labels))"""

PARSED = f"""SELECT o_orderkey, CAST(try_strptime(text, '%d-%m-%Y') AS DATE) AS strict_date,
  d AS date, CAST(EXTRACT(year FROM d) AS INT) AS year,
  CAST(EXTRACT(month FROM d) AS INT) AS month, CAST(EXTRACT(day FROM d) AS INT) AS day
FROM (SELECT o_orderkey, d, {_text("d")} AS text
      FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders))"""


SMALL_PARTS = """(SELECT 'P' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_size <= 25)"""


def _check(name: str, key: str, condition: str) -> str:
    return f"""SELECT '{name}' AS check_name, COUNT(*) AS keys_affected,
  CAST(COALESCE(SUM(n), 0) AS BIGINT) AS rows_affected
FROM (SELECT {key}, COUNT(*) AS n FROM fact {condition})"""


INTEGRITY = "\nUNION ALL\n".join(
    [
        _check(
            "sales_fact primary key",
            "date_key, product_key",
            "GROUP BY date_key, product_key HAVING COUNT(*) > 1",
        ),
        "SELECT 'date_dim primary key', 0, 0",
        "SELECT 'product_dim primary key', 0, 0",
        _check(
            "sales_fact date",
            "date_key",
            "WHERE EXTRACT(month FROM date_key) = 2 GROUP BY date_key",
        ),
        _check(
            "sales_fact product",
            "product_key",
            f"WHERE product_key NOT IN {SMALL_PARTS} GROUP BY product_key",
        ),
    ]
)


def _label(width: str) -> str:
    return f"""WITH {LINE_FACT}
SELECT DISTINCT product_key, concat('Product ', substr(product_key, 2{width})) AS product_name
FROM fact"""


FINE_FACT = """fact AS (
  SELECT 'P' || CAST(l_partkey % 25 AS VARCHAR) AS product_key,
         round(l_extendedprice * (1 - l_discount), 4) AS total_revenue FROM lineitem)"""

FINE_SUM = "CAST(SUM(CAST(total_revenue AS DECIMAL(18,4))) AS DOUBLE)"

# Clean lines with their order; each line has one product.
KEYED_CLEAN = """clean AS (
  SELECT l_orderkey AS orderkey, CAST(l_shipdate AS DATE) AS "Date",
    CAST(EXTRACT(year FROM l_shipdate) AS INT) AS "Year",
    CAST(EXTRACT(month FROM l_shipdate) AS INT) AS "Month",
    CAST(EXTRACT(day FROM l_shipdate) AS INT) AS "Day",
    'P' || CAST(l_partkey % 4 + 1 AS VARCHAR) AS product_id,
    CAST(trunc(l_quantity) AS INT) AS "Total_Units_Sold", l_extendedprice AS "Total_Revenue"
  FROM lineitem WHERE EXTRACT(day FROM l_shipdate) <> 29)"""


def _delivered(number: str, order: str = "orderkey") -> str:
    """Every group of rows in four deliveries, of which three differ for some numbers."""
    return f"""delivered AS (
  SELECT {order}, delivery, "Date", "Year", "Month", "Day", product_id,
    "Total_Units_Sold" - CASE WHEN delivery = 2 AND number % 4 = 0 THEN 1 ELSE 0 END AS units,
    round("Total_Revenue" + CASE WHEN delivery = 1 AND number % 3 = 0 THEN 0.01 ELSE 0 END, 2) AS revenue
  FROM (SELECT *, {number} AS number FROM clean),
    (SELECT unnest(range(0, 4)) AS delivery),
    LATERAL (SELECT unnest(range(0, CASE WHEN delivery = 3 AND number % 5 = 0 THEN 2 ELSE 1 END)) AS copy))"""


def _copies(keys: str) -> str:
    return f"""SELECT copies, COUNT(*) AS contents FROM (
  SELECT COUNT(*) AS copies FROM (
    SELECT {keys}, list_sort(list(ROW("Date", "Year", "Month", "Day", product_id, units, revenue))) AS content
    FROM delivered GROUP BY {keys})
  GROUP BY content) GROUP BY copies"""


# Four deliveries of each order as files; the first of every seventh order was loaded before.
ACCEPTED = f"""{KEYED_CLEAN}, {_delivered("orderkey")},
files AS (
  SELECT DISTINCT l_orderkey AS orderkey, delivery
  FROM lineitem, (SELECT unnest(range(0, 4)) AS delivery)),
contents AS (
  SELECT orderkey, delivery, COUNT(*) > COUNT(DISTINCT ROW("Date", product_id)) AS repeated,
    CAST(list_sort(list(ROW("Date", "Year", "Month", "Day", product_id, units, revenue))) AS VARCHAR) AS content
  FROM delivered GROUP BY 1, 2),
sound AS (
  SELECT orderkey, delivery, delivery * 86400 + orderkey AS arrival, coalesce(content, '') AS content,
    concat_ws('/', 'orders', orderkey, delivery) AS filename
  FROM files LEFT JOIN contents USING (orderkey, delivery) WHERE NOT coalesce(repeated, false)),
ledger AS (SELECT * FROM sound WHERE orderkey % 7 = 0 AND delivery = 0)
SELECT arg_min(filename, ROW(arrival, filename)) AS filename, COUNT(*) - 1 AS copies_skipped
FROM sound WHERE filename NOT IN (SELECT filename FROM ledger)
  AND content NOT IN (SELECT content FROM ledger) GROUP BY content"""

IN_ONE = f"""SELECT 'total_sales_by_product' AS report, product_key AS key, total_sales AS value FROM ({BY_PRODUCT})
UNION ALL SELECT 'monthly_sales_trend', CAST(month AS VARCHAR), total_sales FROM ({BY_MONTH})
UNION ALL SELECT 'top_products', product_key, CAST(total_units AS DOUBLE) FROM ({TOP})
UNION ALL SELECT 'avg_revenue', NULL, avg_revenue FROM ({AVERAGE})"""

ORACLE: dict[str, str] = {
    "csv_snapshot_rows": f"WITH {DAILY_CLEAN} SELECT * FROM clean",
    "csv_staging_rejects": f"""WITH {LINES}, {STAGED}
SELECT COUNT(*) AS rows_in, CAST(0 AS BIGINT) AS corrupt,
  COUNT(*) FILTER (WHERE date IS NULL) AS unreadable FROM long""",
    "csv_refused_rows": f"""WITH {LINES}, {STAGED}
SELECT date_str, CAST(EXTRACT(year FROM d) AS VARCHAR) || '.0' AS year,
  CAST(EXTRACT(month FROM d) AS VARCHAR) || '.0' AS month,
  CAST(EXTRACT(day FROM d) AS VARCHAR) || '.0' AS day, product_key,
  units_str AS total_units_sold, revenue_str AS total_revenue, 'unreadable: date_str' AS reason
FROM staged
WHERE try_strptime(date_str, '%Y-%m-%d') IS NULL""",
    "accepted_deliveries": f"WITH {ACCEPTED}",
    "written_manifest": f"""WITH {LINE_CLEAN}
SELECT COUNT(*) AS record_count, MIN("Date") AS min_date, MAX("Date") AS max_date,
  '1.0' AS pipeline_version FROM clean""",
    "newest_snapshot_rows": f"WITH {DAILY_CLEAN} SELECT * FROM clean WHERE product_id <> 'P4'",
    "globbed_sales": f"WITH {DAILY_CLEAN} SELECT * FROM clean",
    "ledger_months": f"""WITH {DAILY_CLEAN}
SELECT DISTINCT CAST("Year" * 100 + "Month" AS INT) AS ym FROM clean""",
    "written_marts": f"WITH {LINE_FACT} {IN_ONE}",
    "kept_reports": f"""WITH {DAILY_FACT.replace("fact AS", "days AS")},
fact AS (SELECT * FROM (WITH fact AS (SELECT * FROM days), {MERGED})) {IN_ONE}""",
    "total_sales_fine": f"""WITH {FINE_FACT}
SELECT product_key, {FINE_SUM} AS total_sales FROM fact GROUP BY product_key""",
    "avg_revenue_fine": f"""WITH {FINE_FACT}
SELECT {FINE_SUM} / COUNT(total_revenue) AS avg_revenue FROM fact""",
    "merge_fact_shuffled": f"WITH {KEYED_FACT}, {MERGED}",
    "merge_fact_broadcast": f"WITH {KEYED_FACT}, {MERGED}",
    "content_fingerprint": f"""WITH {KEYED_CLEAN}, {_delivered("orderkey")}
{_copies("orderkey, delivery")}""",
    "content_fingerprint_rows": f"""WITH {LINE_CLEAN},
{_delivered("""date_diff('day', DATE '1970-01-01', "Date")""", "number")}
{_copies('"Date", product_id, delivery')}""",
    "combined_fingerprint": f"""WITH {LINE_CLEAN}
SELECT product_id, COUNT(*) AS lines, true AS same FROM clean GROUP BY product_id""",
    "unpivot_sales": f"WITH {DAILY_LONG} SELECT * FROM long",
    "unpivot_brands": f"WITH {BRAND_LONG} SELECT * FROM long",
    "unpivot_lines": f"WITH {LINE_LONG} SELECT * FROM long",
    "clean_sales": f"WITH {DAILY_CLEAN} SELECT * FROM clean",
    "clean_lines": f"WITH {LINE_CLEAN} SELECT * FROM clean",
    "narrow_revenue": f"""WITH {DAILY_CLEAN}
SELECT * REPLACE (CAST("Total_Revenue" AS FLOAT) AS "Total_Revenue") FROM clean""",
    "parse_dates": PARSED,
    "staged_sales": f"""WITH {LINES}, {STAGED}
SELECT date AS "Date", year AS "Year", month AS "Month", day AS "Day", product_id,
  total_units_sold AS "Total_Units_Sold", total_revenue AS "Total_Revenue" FROM long""",
    "validation_counts": f"WITH {DAILY_LONG} {COUNTS}",
    "validation_counts_lines": f"WITH {LINE_LONG} {COUNTS}",
    "staging_rejects": f"WITH {LINES}, {STAGED} {COUNTS}",
    "snapshot_manifest": f"WITH {DAILY_CLEAN} {MANIFEST}",
    "snapshot_manifest_lines": f"WITH {LINE_CLEAN} {MANIFEST}",
    "content_hash": "SELECT doc_id, md5(COALESCE(text, '')) AS content_hash FROM documents",
    "page_hash": "SELECT page_id, md5(COALESCE(html, '')) AS content_hash FROM pages",
    "fact_duplicate_keys": """SELECT l_orderkey, l_partkey, COUNT(*) AS n
FROM lineitem GROUP BY l_orderkey, l_partkey HAVING COUNT(*) > 1""",
    "fact_orphans": f"""WITH {DAILY_FACT}
SELECT * FROM fact WHERE date_key NOT IN (
  SELECT date_key FROM fact WHERE EXTRACT(month FROM date_key) <> 2)""",
    "fact_orphans_lines": f"""WITH {LINE_FACT}
SELECT * FROM fact f WHERE NOT EXISTS (
  SELECT 1 FROM part WHERE p_size <= 25
    AND 'P' || CAST(p_partkey AS VARCHAR) = f.product_key)""",
    "orphan_products": f"""WITH {LINE_FACT}
SELECT product_key, COUNT(*) AS n FROM fact WHERE product_key NOT IN {SMALL_PARTS}
GROUP BY product_key""",
    "star_integrity": f"WITH {LINE_FACT} {INTEGRITY}",
    "unprocessed_files": f"""WITH {FILES}
SELECT DISTINCT filename FROM files
WHERE filename NOT IN (SELECT filename FROM files WHERE event_type <> 'error')""",
    "latest_snapshot": f"""WITH {FILES}
SELECT filename, modified FROM files ORDER BY modified DESC, filename DESC LIMIT 1""",
    "known_content": f"""WITH {CONTENT}
SELECT content_hash, doc_id FROM incoming
WHERE content_hash IN (SELECT content_hash FROM ledger)""",
    "new_content": f"""WITH {CONTENT}
SELECT content_hash, doc_id FROM incoming
WHERE content_hash NOT IN (SELECT content_hash FROM ledger)""",
    "first_uploads": """SELECT md5(COALESCE(text, '')) AS content_hash, MIN(doc_id) AS doc_id,
  COUNT(*) - 1 AS copies_skipped FROM documents GROUP BY 1""",
    "date_dim": f"WITH {DAILY_CLEAN}, {DATE_DIM} SELECT * FROM date_dim",
    "date_dim_lines": f"WITH {LINE_CLEAN}, {DATE_DIM} SELECT * FROM date_dim",
    "product_dim": f"WITH {DAILY_CLEAN}, {PRODUCT_DIM} SELECT * FROM product_dim",
    "product_dim_many": _label(""),
    "product_dim_one_digit": _label(", 1"),
    "merge_date_dim": f"""WITH {DAILY_CLEAN}, {DATE_DIM}
SELECT date_key, year, month,
  CASE WHEN date_key >= DATE '1998-01-01' THEN day ELSE 0 END AS day FROM date_dim""",
    "merge_product_dim": f"""WITH {DAILY_CLEAN}, {PRODUCT_DIM}
SELECT product_key, CASE WHEN product_key = 'P1' THEN 'Old P1' ELSE product_name END
  AS product_name FROM product_dim""",
    "merge_product_dim_many": f"""WITH {LINE_FACT},
target AS (SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_key, p_brand AS product_name
           FROM part),
source AS (SELECT DISTINCT product_key, concat('Product ', substr(product_key, 2))
             AS product_name FROM fact WHERE date_key >= DATE '1998-01-01')
SELECT COALESCE(s.product_key, t.product_key) AS product_key,
  CASE WHEN s.product_key IS NULL THEN t.product_name ELSE s.product_name END AS product_name
FROM target t FULL OUTER JOIN source s ON t.product_key = s.product_key""",
    "merge_fact": f"WITH {DAILY_FACT}, {MERGED}",
    "merge_fact_many": f"WITH {KEYED_FACT}, {MERGED}",
    "total_sales_by_product": f"WITH {DAILY_FACT} {BY_PRODUCT}",
    "total_sales_by_brand": f"WITH {BRAND_LONG}, {CLEAN}, {FACT} {BY_PRODUCT}",
    "total_sales_by_product_many": f"WITH {LINE_FACT} {BY_PRODUCT}",
    "monthly_sales_trend": f"WITH {DAILY_FACT} {BY_MONTH}",
    "monthly_sales_trend_lines": f"WITH {LINE_FACT} {BY_MONTH}",
    "top_products": f"WITH {DAILY_FACT} {TOP}",
    "top_products_many": f"WITH {LINE_FACT} {TOP}",
    "avg_revenue": f"WITH {DAILY_FACT} {AVERAGE}",
    "avg_revenue_lines": f"WITH {LINE_FACT} {AVERAGE}",
    "fact_preview": f"""WITH {DAILY_FACT}
SELECT * FROM fact ORDER BY date_key, product_key LIMIT 5""",
    "star_monthly_by_product": f"WITH {DAILY_FACT}, {DATE_DIM}, {PRODUCT_DIM} {STAR}",
    "star_monthly_by_product_many": f"""WITH {LINE_FACT},
date_dim AS (SELECT DISTINCT date_key, CAST(EXTRACT(year FROM date_key) AS INT) AS year,
  CAST(EXTRACT(month FROM date_key) AS INT) AS month FROM fact),
product_dim AS (SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_key,
  p_name AS product_name FROM part)
{STAR}""",
    "etl_sales_fact": f"WITH {DAILY_FACT}, {MERGED}",
    "ingest_sales_fact": f"WITH {DAILY_FACT}, {MERGED}",
    "year_report_pruned": f"""WITH {DAILY_FACT}, {DATE_DIM}, {PRODUCT_DIM}
SELECT * FROM ({STAR}) WHERE year = 1997""",
}
