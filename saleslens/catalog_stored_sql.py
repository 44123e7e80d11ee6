"""SQL twins of ``catalog_stored``: the questions in plain SQL over the raw test tables,
whatever is written in between."""

from __future__ import annotations

from saleslens.catalog_sql import ORACLE_SQL, STAR

_FOLDED = """, mixed AS (
  SELECT product_id, brand,
         CASE WHEN product_id % 2 = 1 THEN upper(product_name) ELSE product_name END AS product_name,
         CASE product_id % 3 WHEN 1 THEN lower(category) WHEN 2 THEN upper(category) ELSE category END AS category
  FROM products), folded AS (
  SELECT product_id, brand, MIN(product_name) OVER (PARTITION BY lower(product_name)) AS product_name,
         MIN(category) OVER (PARTITION BY lower(category)) AS category
  FROM mixed)"""


def _ignoring_case(name: str) -> str:
    return ORACLE_SQL[name].replace(STAR, STAR + _FOLDED, 1).replace("JOIN products p", "JOIN folded p")


_DOCS = "documents LEFT JOIN labels USING (doc_id)"
# (column, rule, broken) in the order of the rules
_PROBLEMS = [("text", "max_length 2000", "length(text) > 2000"), ("lang", "not null", "lang IS NULL"),
             ("source", "max_length 4", "length(source) > 4"),
             ("n_chars", "decimal(3,0)", "n_chars IS NOT NULL AND TRY_CAST(n_chars AS DECIMAL(3,0)) IS NULL"),
             ("quality", "not null", "quality IS NULL")]
_NEVER = [("doc_id", "null key"), ("doc_id", "type bigint"), ("quality", "type int"), ("toxic", "not null"), ("toxic", "type tinyint")]
_BROKEN = ", ".join(f"CASE WHEN {broken} THEN '{c} {rule}' END" for c, rule, broken in _PROBLEMS)

_LOADS = STAR + """, old AS (
  SELECT *, COUNT(*) OVER (PARTITION BY sale_id) > 1 AS repeated, FALSE AS present,
         product_id NOT IN (SELECT product_id FROM products WHERE NOT is_organic) AS no_product,
         customer_id NOT IN (SELECT customer_id FROM customers) AS no_customer
  FROM sales WHERE sale_date < DATE '1998-07-01'), kept AS (
  SELECT * FROM old WHERE NOT (repeated OR no_product OR no_customer)), new AS (
  SELECT *, COUNT(*) OVER (PARTITION BY sale_id) > 1 AS repeated, sale_id IN (SELECT sale_id FROM kept) AS present,
         product_id NOT IN (SELECT product_id FROM products) AS no_product,
         customer_id NOT IN (SELECT customer_id FROM customers) AS no_customer
  FROM sales), loaded AS (
  SELECT 'first' AS load_id, * FROM old UNION ALL SELECT 'second', * FROM new), judged AS (
  SELECT *, NOT (repeated OR present OR no_product OR no_customer) AS accepted FROM loaded)
"""

_CARDS = """CAST(SUM(s.total_amount) AS DOUBLE) AS revenue, COUNT(s.sale_id) AS orders,
       COUNT(DISTINCT s.customer_id) AS active_customers,
       CAST(SUM(s.total_amount) AS DOUBLE) / NULLIF(COUNT(s.total_amount), 0) AS avg_order_value,
       CAST(SUM(s.discount_pct) AS DOUBLE) / NULLIF(COUNT(s.discount_pct), 0) AS avg_discount_pct"""

_PERIOD = """FROM sales s LEFT JOIN customers c ON s.customer_id = c.customer_id
WHERE s.sale_date >= DATE '1997-03-01' AND s.sale_date < DATE '1999-03-01'"""
_BUYERS = "COUNT(s.sale_id) AS orders, CAST(SUM(s.total_amount) AS DOUBLE) AS revenue, COUNT(DISTINCT s.customer_id) AS buyers, TRUE AS within"

STORED_SQL = {
    "monthly_trend_by_month": ORACLE_SQL["monthly_trend"],
    "revenue_yoy_quarter_by_month": ORACLE_SQL["revenue_yoy_quarter"],
    "kpi_summary_by_month": ORACLE_SQL["kpi_summary"],
    "load_problems": "\nUNION ALL ".join(
        [f"SELECT 'documents' AS table_name, '{c}' AS column_name, '{rule}' AS rule, COUNT(*) FILTER (WHERE {broken}) AS violations FROM {_DOCS}"
         for c, rule, broken in _PROBLEMS] + [f"SELECT 'documents', '{c}', '{rule}', CAST(0 AS BIGINT)" for c, rule in _NEVER]),
    "load_rejects": f"""
SELECT doc_id, array_to_string(list_filter([{_BROKEN}], lambda x: x IS NOT NULL), '; ') AS problems,
       CAST(COALESCE(toxic, 0) AS BIGINT) AS toxic
FROM {_DOCS} WHERE {" OR ".join(f"({broken})" for _, _, broken in _PROBLEMS)}""",
    "star_load_counts": _LOADS + """
SELECT load_id, 'sales' AS table_name, COUNT(*) FILTER (WHERE accepted) AS accepted, COUNT(*) FILTER (WHERE NOT accepted) AS refused
FROM judged GROUP BY load_id
UNION ALL SELECT 'first', 'products', COUNT(*), 0 FROM products WHERE NOT is_organic
UNION ALL SELECT 'first', 'customers', COUNT(*), 0 FROM customers
UNION ALL SELECT 'first', 'calendar', COUNT(*), 0 FROM calendar
UNION ALL SELECT 'second', 'products', COUNT(*) FILTER (WHERE is_organic), COUNT(*) FILTER (WHERE NOT is_organic) FROM products""",
    "star_load_rejects": _LOADS + "\nUNION ALL ".join(
        f"SELECT load_id, '{c}' AS column_name, '{rule}' AS rule, COUNT(*) AS violations FROM judged WHERE {broken} GROUP BY load_id"
        for c, rule, broken in [("sale_id", "repeated key", "repeated"), ("sale_id", "key already present", "present AND NOT repeated"),
                                ("product_id", "unknown parent", "no_product"), ("customer_id", "unknown parent", "no_customer")]),
    "star_load_revenue": ORACLE_SQL["revenue_by_year"].replace(STAR, _LOADS, 1).replace("FROM sales GROUP BY", "FROM judged WHERE accepted GROUP BY"),
    "sales_cube": STAR + f"""
SELECT CAST(GROUPING(year, region, category) AS BIGINT) AS level, CAST(year AS BIGINT) AS year, region, category, {_CARDS}
FROM (SELECT s.*, year(s.sale_date) AS year, c.region, p.category
      FROM sales s LEFT JOIN products p ON s.product_id = p.product_id LEFT JOIN customers c ON s.customer_id = c.customer_id) s
GROUP BY CUBE (year, region, category)""",
    "buyer_estimates": STAR + f"""
SELECT c.region, FALSE AS whole, {_BUYERS} {_PERIOD} GROUP BY c.region
UNION ALL SELECT NULL, TRUE, {_BUYERS} {_PERIOD}""",
    "rfm_scores_from_state": ORACLE_SQL["rfm_scores"],
    "new_customers_from_state": ORACLE_SQL["new_customers"],
    "top_customers_from_state": ORACLE_SQL["top_customers"],
    "top_products_share_ignore_case": _ignoring_case("top_products_share"),
    "rank_in_category_ignore_case": _ignoring_case("rank_in_category"),
    "top3_per_category_ignore_case": _ignoring_case("top3_per_category"),
    "csv_round_trip": "SELECT * FROM customer",
    "json_pages": """
SELECT CAST(p_partkey // 50 AS BIGINT) AS page,
       ROW_NUMBER() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey) - 1 AS position,
       p_name AS product_name, p_brand AS brands, p_type AS categories, CAST(p_size AS VARCHAR) AS energy_kcal
FROM part""",
}
