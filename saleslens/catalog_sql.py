"""SQL twins of the registered queries, over the raw test tables (lineitem, orders,
part, customer, nation, region). Each text first maps the tables onto the retail star
with the same rules as ``sources.adapter``, then asks the question in plain SQL.
"""

from __future__ import annotations

_GROSS = "CAST(l.l_extendedprice AS DECIMAL(12,2))"
_DISC = "CAST(l.l_discount AS DECIMAL(4,2))"
_DISC_AMT = f"CAST(ROUND({_GROSS} * {_DISC}, 2) AS DECIMAL(12,2))"

STAR = f"""
WITH sales AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS sale_id,
         l.l_partkey AS product_id,
         o.o_custkey AS customer_id,
         CAST(o.o_orderdate AS DATE) AS sale_date,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(ROUND(CAST(l.l_extendedprice / NULLIF(l.l_quantity, 0) AS DECIMAL(38,9)), 2)
              AS DECIMAL(10,2)) AS unit_price,
         CAST({_DISC} * 100 AS DECIMAL(5,2)) AS discount_pct,
         {_DISC_AMT} AS discount_amount,
         CAST({_GROSS} - {_DISC_AMT} AS DECIMAL(12,2)) AS total_amount
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
), products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_type AS category,
         CAST(NULL AS DECIMAL(8,2)) AS calories_per_100g, (p_size % 4) = 0 AS is_organic,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price, CAST(NULL AS DATE) AS launch_date
  FROM part
), customers AS (
  SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, c.c_mktsegment AS customer_type,
         r.r_name AS region, n.n_name AS country, CAST(NULL AS DATE) AS registration_date,
         c.c_acctbal > 0 AS is_active
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
), calendar AS (
  SELECT year(d) * 10000 + month(d) * 100 + day(d) AS date_key, d AS full_date, year(d) AS year,
         quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
         weekofyear(d) AS week, isodow(d) AS day_of_week
  FROM (SELECT CAST(range AS DATE) AS d
        FROM (SELECT unnest(range(date_trunc('year', min(o_orderdate)),
                                  date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR, INTERVAL 1 DAY)) AS range
              FROM orders))
)"""


def _r(expr: str, scale: int) -> str:
    """HALF_UP rounding of a DOUBLE through DECIMAL, as ``functions.round_half_up``."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,9)), {scale}) AS DOUBLE)"


_MONTHLY = """, m AS (
  SELECT c.year, c.month, c.month_name, SUM(s.total_amount) AS revenue
  FROM sales s JOIN calendar c ON s.sale_date = c.full_date
  GROUP BY c.year, c.month, c.month_name)
"""

_PROD_JOIN = "FROM sales s JOIN products p ON s.product_id = p.product_id"


def _rfm(group_cols: str, as_of: str) -> str:
    return f""", b AS (
  SELECT {group_cols},
         datediff('day', MAX(s.sale_date), DATE '{as_of}') AS recency_days,
         COUNT(s.sale_id) AS frequency, SUM(s.total_amount) AS monetary
  FROM customers c JOIN sales s ON c.customer_id = s.customer_id
  GROUP BY {group_cols}
), t AS (
  SELECT *, NTILE(4) OVER (ORDER BY recency_days ASC, customer_id ASC) AS r_score,
            NTILE(4) OVER (ORDER BY frequency DESC, customer_id ASC) AS f_score,
            NTILE(4) OVER (ORDER BY monetary DESC, customer_id ASC) AS m_score
  FROM b)
"""


def _segment(score: str) -> str:
    return (f"CASE WHEN {score} >= 10 THEN 'Champions' WHEN {score} >= 8 THEN 'Loyal Customers' "
            f"WHEN {score} >= 6 THEN 'Potential Loyalists' WHEN {score} >= 4 THEN 'At Risk' "
            f"ELSE 'Lost' END")


def _rfm_scores(flip: bool) -> str:
    r, f, m = (("5 - r_score", "5 - f_score", "5 - m_score") if flip
               else ("r_score", "f_score", "m_score"))
    score = f"({r} + {f} + {m})"
    return STAR + _rfm("c.customer_id, c.customer_name, c.customer_type, c.region", "2001-12-31") + f"""
SELECT CAST(customer_id AS BIGINT) AS customer_id, customer_name, customer_type, region,
       CAST(recency_days AS BIGINT) AS recency_days, CAST(frequency AS BIGINT) AS frequency,
       CAST(ROUND(monetary, 2) AS DOUBLE) AS monetary,
       CAST({r} AS BIGINT) AS r_score, CAST({f} AS BIGINT) AS f_score, CAST({m} AS BIGINT) AS m_score,
       CAST({score} AS BIGINT) AS rfm_score, {_segment(score)} AS segment
FROM t ORDER BY rfm_score DESC, customer_id"""


_KPI_WHERE = "FROM sales WHERE year(sale_date) = 2000"

def _unsold(sales: str) -> str:
    return STAR + f"""
SELECT CAST(p.product_id AS BIGINT) AS product_id, p.product_name, p.brand, p.category,
       CAST(p.unit_price AS DOUBLE) AS unit_price, p.launch_date
FROM products p LEFT JOIN {sales} s ON p.product_id = s.product_id
WHERE s.sale_id IS NULL ORDER BY p.category, p.product_name"""


def _priced(products: str) -> str:
    return STAR + f""", j AS (
  SELECT s.sale_id, s.product_id, s.quantity, p.unit_price AS price,
         COALESCE(s.discount_pct, 0) AS pct, s.discount_pct
  FROM sales s LEFT JOIN {products} p ON s.product_id = p.product_id)
SELECT CAST(sale_id AS BIGINT) AS sale_id, CAST(product_id AS BIGINT) AS product_id,
       CAST(quantity AS BIGINT) AS quantity, CAST(price AS DOUBLE) AS unit_price,
       CAST(discount_pct AS DOUBLE) AS discount_pct,
       CAST(ROUND(price * quantity * pct * 0.01, 2) AS DOUBLE) AS discount_amount,
       CAST(ROUND(price * quantity - ROUND(price * quantity * pct * 0.01, 2), 2) AS DOUBLE) AS total_amount
FROM j"""


ORACLE_SQL: dict[str, str] = {
    "revenue_by_year": STAR + """
SELECT CAST(year(sale_date) AS BIGINT) AS year, COUNT(sale_id) AS orders,
       CAST(SUM(total_amount) AS DOUBLE) AS revenue,
       CAST(SUM(total_amount) AS DOUBLE) / NULLIF(COUNT(total_amount), 0) AS avg_order_value,
       CAST(SUM(quantity) AS BIGINT) AS units
FROM sales GROUP BY year(sale_date) ORDER BY year""",

    "rank_products": STAR + f"""
SELECT product_name, category, brand, CAST(revenue AS DOUBLE) AS revenue, CAST(units AS BIGINT) AS units,
       CAST(RANK() OVER (ORDER BY revenue DESC) AS BIGINT) AS rank
FROM (SELECT p.product_name, p.category, p.brand, SUM(s.total_amount) AS revenue,
             SUM(s.quantity) AS units
      {_PROD_JOIN} GROUP BY p.product_name, p.category, p.brand)""",

    "rank_products_top10": STAR + f"""
SELECT * FROM (
SELECT product_name, category, brand, CAST(revenue AS DOUBLE) AS revenue, CAST(units AS BIGINT) AS units,
       CAST(RANK() OVER (ORDER BY revenue DESC) AS BIGINT) AS rank
FROM (SELECT p.product_name, p.category, p.brand, SUM(s.total_amount) AS revenue,
             SUM(s.quantity) AS units
      {_PROD_JOIN} GROUP BY p.product_name, p.category, p.brand)) WHERE rank <= 10""",

    "top_products_share": STAR + f""", g AS (
  SELECT p.product_name, p.category, SUM(s.total_amount) AS revenue
  {_PROD_JOIN} GROUP BY p.product_name, p.category
  HAVING p.product_name NOT IN ('?????'))
SELECT product_name, category, CAST(revenue AS DOUBLE) AS revenue,
       {_r("CAST(revenue AS DOUBLE) / NULLIF(CAST(SUM(revenue) OVER () AS DOUBLE), 0) * 100", 2)}
         AS pct_of_total
FROM g ORDER BY revenue DESC, product_name, category LIMIT 10""",

    "revenue_mom": STAR + _MONTHLY + f"""
SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, month_name,
       CAST(revenue AS DOUBLE) AS revenue, CAST(LAG(revenue) OVER w AS DOUBLE) AS prev_revenue,
       {_r("CAST(revenue - LAG(revenue) OVER w AS DOUBLE) / NULLIF(CAST(LAG(revenue) OVER w AS DOUBLE), 0) * 100", 2)}
         AS mom_pct
FROM m WINDOW w AS (ORDER BY year, month) ORDER BY year, month""",

    "revenue_ytd": STAR + _MONTHLY + """
SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, month_name,
       CAST(revenue AS DOUBLE) AS revenue,
       CAST(SUM(revenue) OVER (PARTITION BY year ORDER BY month
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS revenue_ytd
FROM m ORDER BY year, month""",

    "revenue_yoy_quarter": STAR + f""", q AS (
  SELECT c.year, c.quarter, SUM(s.total_amount) AS revenue
  FROM sales s JOIN calendar c ON s.sale_date = c.full_date GROUP BY c.year, c.quarter
), pv AS (
  SELECT quarter, SUM(CASE WHEN year = 1999 THEN revenue ELSE 0 END) AS rb,
         SUM(CASE WHEN year = 2000 THEN revenue ELSE 0 END) AS rc
  FROM q GROUP BY quarter)
SELECT CAST(quarter AS BIGINT) AS quarter, CAST(rb AS DOUBLE) AS revenue_base,
       CAST(rc AS DOUBLE) AS revenue_current, CAST(rc - rb AS DOUBLE) AS change_abs,
       {_r("CAST(rc - rb AS DOUBLE) * 100.0 / NULLIF(CAST(rb AS DOUBLE), 0)", 2)} AS change_pct
FROM pv ORDER BY quarter""",

    "rank_in_category": STAR + f""", g AS (
  SELECT p.category, p.product_name, p.brand, COUNT(s.sale_id) AS orders,
         SUM(s.total_amount) AS revenue,
         CAST(SUM(s.discount_pct) AS DOUBLE) / NULLIF(COUNT(s.discount_pct), 0) AS avg_discount_pct
  {_PROD_JOIN} GROUP BY p.category, p.product_name, p.brand)
SELECT category, product_name, brand, CAST(orders AS BIGINT) AS orders,
       CAST(revenue AS DOUBLE) AS revenue, avg_discount_pct,
       CAST(RANK() OVER (PARTITION BY category ORDER BY revenue DESC) AS BIGINT) AS rank_in_category
FROM g ORDER BY category, rank_in_category""",

    "organic_split": STAR + """
SELECT CASE WHEN p.is_organic THEN 'Organico' ELSE 'Convenzionale' END AS product_type,
       COUNT(DISTINCT p.product_id) AS products, COUNT(s.sale_id) AS sales,
       CAST(SUM(s.total_amount) AS DOUBLE) AS revenue,
       CAST(SUM(s.total_amount) AS DOUBLE) / NULLIF(COUNT(s.total_amount), 0) AS avg_order_value,
       CAST(SUM(p.unit_price) AS DOUBLE) / NULLIF(COUNT(p.unit_price), 0) AS avg_list_price,
       CAST(SUM(s.discount_pct) AS DOUBLE) / NULLIF(COUNT(s.discount_pct), 0) AS avg_discount_pct
FROM products p LEFT JOIN sales s ON p.product_id = s.product_id
GROUP BY p.is_organic ORDER BY revenue DESC""",

    "unsold_products": _unsold("sales"),
    "unsold_products_in_period": _unsold(
        "(SELECT * FROM sales WHERE sale_date >= DATE '1997-12-01' AND sale_date < DATE '1998-01-01')"),

    "rfm_scores": _rfm_scores(flip=False),
    "rfm_scores_best_high": _rfm_scores(flip=True),

    "segment_distribution": STAR + _rfm("c.customer_id", "2001-12-31") + f""", sg AS (
  SELECT customer_id, ROUND(monetary, 2) AS monetary,
         {_segment("(r_score + f_score + m_score)")} AS segment
  FROM t)
SELECT segment, COUNT(customer_id) AS customers,
       {_r("CAST(SUM(monetary) AS DOUBLE) / NULLIF(COUNT(monetary), 0)", 2)} AS avg_monetary,
       CAST(ROUND(SUM(monetary), 2) AS DOUBLE) AS total_monetary,
       {_r("CAST(COUNT(customer_id) AS DOUBLE) * 100.0 / NULLIF(CAST(SUM(COUNT(customer_id)) OVER () AS DOUBLE), 0)", 1)}
         AS pct_customers
FROM sg GROUP BY segment ORDER BY total_monetary DESC""",

    "top3_per_category": STAR + f""", g AS (
  SELECT p.category, p.product_name, p.brand, SUM(s.total_amount) AS revenue
  {_PROD_JOIN} GROUP BY p.category, p.product_name, p.brand
), r AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY revenue DESC,
                               product_name ASC NULLS FIRST, brand ASC NULLS FIRST) AS rn
  FROM g)
SELECT category, product_name, brand, CAST(ROUND(revenue, 2) AS DOUBLE) AS revenue,
       CAST(rn AS BIGINT) AS position
FROM r WHERE rn <= 3 ORDER BY category, rn""",

    "discount_impact": STAR + f"""
SELECT cu.region, COUNT(s.sale_id) AS orders,
       CAST(ROUND(SUM(s.total_amount), 2) AS DOUBLE) AS revenue,
       CAST(ROUND(SUM(s.discount_amount), 2) AS DOUBLE) AS discounts,
       CAST(ROUND(SUM(s.total_amount) + SUM(s.discount_amount), 2) AS DOUBLE) AS potential_revenue,
       {_r("CAST(SUM(s.discount_amount) AS DOUBLE) * 100.0 / NULLIF(CAST(SUM(s.total_amount) + SUM(s.discount_amount) AS DOUBLE), 0)", 2)}
         AS pct_lost,
       {_r("CAST(SUM(s.discount_pct) AS DOUBLE) / NULLIF(COUNT(s.discount_pct), 0)", 2)}
         AS avg_discount_pct
FROM sales s JOIN customers cu ON s.customer_id = cu.customer_id
GROUP BY cu.region ORDER BY revenue DESC""",

    "revenue_moving_avg": STAR + _MONTHLY + f"""
SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, month_name,
       CAST(ROUND(revenue, 2) AS DOUBLE) AS revenue,
       {_r("CAST(SUM(revenue) OVER w AS DOUBLE) / NULLIF(COUNT(revenue) OVER w, 0)", 2)} AS moving_avg_3m
FROM m WINDOW w AS (ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
ORDER BY year, month""",

    "kpi_summary": STAR + f"""
SELECT 'Fatturato Totale 2000' AS kpi, CAST(ROUND(SUM(total_amount), 2) AS DOUBLE) AS value, '€' AS unit
{_KPI_WHERE}
UNION ALL SELECT 'Ordini Totali 2000', CAST(COUNT(sale_id) AS DOUBLE), 'n.' {_KPI_WHERE}
UNION ALL SELECT 'Clienti Attivi 2000', CAST(COUNT(DISTINCT customer_id) AS DOUBLE), 'n.' {_KPI_WHERE}
UNION ALL SELECT 'Sconto Medio 2000',
  {_r("CAST(SUM(discount_pct) AS DOUBLE) / NULLIF(COUNT(discount_pct), 0)", 2)}, '%' {_KPI_WHERE}
UNION ALL SELECT 'Prodotti Venduti 2000', CAST(COUNT(DISTINCT product_id) AS DOUBLE), 'n.' {_KPI_WHERE}""",

    "build_calendar": STAR + """, bnd AS (SELECT MIN(sale_date) AS lo, MAX(sale_date) AS hi FROM sales),
days AS (
  SELECT CAST(unnest(generate_series(CAST(date_trunc('year', lo) AS TIMESTAMP),
                                     CAST(date_trunc('year', hi) AS TIMESTAMP) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                                     INTERVAL 1 DAY)) AS DATE) AS d
  FROM bnd WHERE lo IS NOT NULL)
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS date_key, d AS full_date,
       CAST(year(d) AS BIGINT) AS year, CAST(quarter(d) AS BIGINT) AS quarter,
       CAST(month(d) AS BIGINT) AS month, monthname(d) AS month_name,
       CAST(weekofyear(d) AS BIGINT) AS week, CAST(isodow(d) AS BIGINT) AS day_of_week
FROM days""",

    "row_counts": STAR + """
SELECT 'products' AS table_name, COUNT(*) AS row_count FROM products
UNION ALL SELECT 'customers', COUNT(*) FROM customers
UNION ALL SELECT 'sales', COUNT(*) FROM sales
UNION ALL SELECT 'calendar', COUNT(*) FROM calendar""",

    "check_pk": STAR + """
SELECT CAST(sale_id AS BIGINT) AS sale_id, COUNT(*) AS row_count,
       CASE WHEN sale_id IS NULL THEN 'null key' ELSE 'duplicate key' END AS problem
FROM sales GROUP BY sale_id HAVING COUNT(*) > 1 OR sale_id IS NULL""",

    "check_fk": """
SELECT doc_id, COUNT(*) AS row_count FROM documents
WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)
GROUP BY doc_id""",

    "check_not_null": "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count "
        f"FROM documents LEFT JOIN labels USING (doc_id)"
        for c in ["doc_id", "lang", "source", "quality", "toxic"]),

    "check_domain": "\nUNION ALL ".join(
        [f"SELECT '{c}' AS column_name, 'max_length {n}' AS rule, "
         f"COUNT(*) FILTER (WHERE length({c}) > {n}) AS violations FROM {t}"
         for t, c, n in [("documents", "text", 2000), ("documents", "source", 150), ("part", "p_name", 300)]]
        + ["SELECT 'p_retailprice', 'decimal(5,2)', COUNT(*) FILTER (WHERE p_retailprice IS NOT NULL AND "
           "TRY_CAST(p_retailprice AS DECIMAL(5,2)) IS NULL) FROM part"]),

    "clean_products": """
SELECT p_partkey, trim(p_name) AS product_name,
       CASE WHEN p_size % 5 IN (0, 1) THEN 'Unknown' ELSE trim(p_brand) END AS brand,
       CASE WHEN p_size % 3 = 0 OR p_size % 7 = 0 THEN NULL ELSE CAST(p_size % 7 AS DOUBLE) END AS calories_per_100g
FROM part WHERE length(trim(p_name)) >= 3""",

    "coerce_dates": """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
       CASE WHEN o_orderkey % 2 = 0 THEN TRY_CAST(o_orderpriority AS DATE) ELSE CAST(o_orderdate AS DATE) END AS mixed
FROM orders""",

    "fill_defaults": """
SELECT doc_id, CAST(coalesce(quality, -1) AS BIGINT) AS quality, CAST(coalesce(toxic, 0) AS BIGINT) AS toxic
FROM documents LEFT JOIN labels USING (doc_id)""",

    "assign_ids_by_text": """
SELECT p_partkey, ROW_NUMBER() OVER (ORDER BY p_brand, p_name, p_partkey) AS new_id FROM part""",

    "price_sales": _priced("products"),
    "price_sales_unknown_product": _priced("(SELECT * FROM products WHERE is_organic)"),

    "assign_ids": """
SELECT c_custkey, CAST(ROW_NUMBER() OVER (ORDER BY c_acctbal ASC, c_custkey ASC) AS BIGINT) AS new_id
FROM customer""",

    "global_ntile": """
SELECT o_orderkey, CAST(NTILE(100) OVER (ORDER BY o_totalprice DESC, o_orderkey ASC) AS BIGINT) AS tile
FROM orders""",

    "global_rank": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(RANK() OVER (ORDER BY l_quantity DESC) AS BIGINT) AS rank
FROM lineitem""",

    "kpi_cards": STAR + f"""
SELECT CAST(SUM(total_amount) AS DOUBLE) AS revenue, COUNT(sale_id) AS orders,
       COUNT(DISTINCT customer_id) AS active_customers,
       CAST(SUM(total_amount) AS DOUBLE) / NULLIF(COUNT(total_amount), 0) AS avg_order_value,
       CAST(SUM(discount_pct) AS DOUBLE) / NULLIF(COUNT(discount_pct), 0) AS avg_discount_pct
{_KPI_WHERE}""",

    "monthly_trend": STAR + f""", m AS (
  SELECT c.year, c.month, c.month_name, SUM(s.total_amount) AS revenue
  FROM sales s JOIN calendar c ON s.sale_date = c.full_date
  WHERE c.year IN (1999, 2000)
  GROUP BY c.year, c.month, c.month_name
), pv AS (
  SELECT month, month_name, SUM(CASE WHEN year = 1999 THEN revenue ELSE 0 END) AS rb,
         SUM(CASE WHEN year = 2000 THEN revenue ELSE 0 END) AS rc
  FROM m GROUP BY month, month_name)
SELECT CAST(month AS BIGINT) AS month, month_name, CAST(rb AS DOUBLE) AS revenue_base,
       CAST(rc AS DOUBLE) AS revenue_current, CAST(rc - rb AS DOUBLE) AS change_abs,
       {_r("CAST(rc - rb AS DOUBLE) * 100.0 / NULLIF(CAST(rb AS DOUBLE), 0)", 2)} AS change_pct
FROM pv ORDER BY month""",

    "revenue_by_region": STAR + f""", g AS (
  SELECT cu.region, COUNT(s.sale_id) AS orders, SUM(s.total_amount) AS revenue
  FROM sales s JOIN customers cu ON s.customer_id = cu.customer_id GROUP BY cu.region)
SELECT region, CAST(orders AS BIGINT) AS orders, CAST(revenue AS DOUBLE) AS revenue,
       {_r("CAST(revenue AS DOUBLE) / NULLIF(CAST(SUM(revenue) OVER () AS DOUBLE), 0) * 100", 2)} AS pct_of_total
FROM g ORDER BY revenue DESC""",

    "revenue_by_category": STAR + f""", g AS (
  SELECT p.category, COUNT(s.sale_id) AS orders, SUM(s.total_amount) AS revenue
  {_PROD_JOIN} GROUP BY p.category)
SELECT category, CAST(orders AS BIGINT) AS orders, CAST(revenue AS DOUBLE) AS revenue,
       {_r("CAST(revenue AS DOUBLE) / NULLIF(CAST(SUM(revenue) OVER () AS DOUBLE), 0) * 100", 2)} AS pct_of_total
FROM g ORDER BY revenue DESC""",

    "category_year_matrix": STAR + f""", g AS (
  SELECT p.category, c.year, SUM(s.total_amount) AS revenue
  FROM sales s JOIN calendar c ON s.sale_date = c.full_date
  JOIN products p ON s.product_id = p.product_id
  GROUP BY p.category, c.year)
SELECT category, CAST(year AS BIGINT) AS year, CAST(revenue AS DOUBLE) AS revenue,
       {_r("CAST(revenue AS DOUBLE) * 100.0 / NULLIF(CAST(SUM(revenue) OVER (PARTITION BY year) AS DOUBLE), 0)", 2)}
         AS pct_of_year
FROM g ORDER BY category, year""",

    "sales_in_year": STAR + """
SELECT CAST(sale_id AS BIGINT) AS sale_id, sale_date, CAST(product_id AS BIGINT) AS product_id,
       CAST(customer_id AS BIGINT) AS customer_id, CAST(total_amount AS DOUBLE) AS total_amount
FROM sales WHERE year(sale_date) = 2000""",

    "top_customers": STAR + """, g AS (
  SELECT customer_id, COUNT(sale_id) AS orders, SUM(total_amount) AS revenue
  FROM sales GROUP BY customer_id)
SELECT CAST(c.customer_id AS BIGINT) AS customer_id, c.customer_name, c.customer_type, c.region,
       CAST(g.orders AS BIGINT) AS orders, CAST(g.revenue AS DOUBLE) AS revenue
FROM g JOIN customers c ON g.customer_id = c.customer_id
ORDER BY g.revenue DESC, c.customer_id LIMIT 10""",

    "purchase_trend": STAR + """
SELECT CAST(c.year AS BIGINT) AS year, CAST(c.month AS BIGINT) AS month, c.month_name,
       COUNT(s.sale_id) AS orders, CAST(SUM(s.total_amount) AS DOUBLE) AS revenue,
       COUNT(DISTINCT s.customer_id) AS buyers
FROM sales s JOIN calendar c ON s.sale_date = c.full_date
GROUP BY c.year, c.month, c.month_name ORDER BY year, month""",

    "new_customers": STAR + """, f AS (
  SELECT customer_id, MIN(sale_date) AS first_date FROM sales GROUP BY customer_id)
SELECT CAST(c.year AS BIGINT) AS year, CAST(c.month AS BIGINT) AS month, c.month_name,
       COUNT(f.customer_id) AS new_customers
FROM f JOIN calendar c ON f.first_date = c.full_date
GROUP BY c.year, c.month, c.month_name ORDER BY year, month""",

    "product_kpis": STAR + """, a AS (
  SELECT product_id, COUNT(sale_id) AS orders, SUM(quantity) AS units, SUM(total_amount) AS revenue,
         COUNT(total_amount) AS n_total, SUM(discount_pct) AS disc_sum, COUNT(discount_pct) AS disc_n,
         COUNT(DISTINCT customer_id) AS customers
  FROM sales WHERE product_id = 42 GROUP BY product_id)
SELECT CAST(p.product_id AS BIGINT) AS product_id, p.product_name, p.category, p.brand,
       CAST(COALESCE(a.orders, 0) AS BIGINT) AS orders, CAST(a.units AS BIGINT) AS units,
       CAST(a.revenue AS DOUBLE) AS revenue,
       CAST(a.revenue AS DOUBLE) / NULLIF(a.n_total, 0) AS avg_order_value,
       CAST(a.disc_sum AS DOUBLE) / NULLIF(a.disc_n, 0) AS avg_discount_pct,
       CAST(COALESCE(a.customers, 0) AS BIGINT) AS customers
FROM products p LEFT JOIN a ON p.product_id = a.product_id
WHERE p.product_id = 42""",

    "product_vs_category": STAR + """, pr AS (
  SELECT p.product_id, p.product_name, p.category, SUM(s.total_amount) AS revenue
  FROM sales s JOIN products p ON s.product_id = p.product_id
  GROUP BY p.product_id, p.product_name, p.category
), ca AS (
  SELECT *, CAST(SUM(revenue) OVER (PARTITION BY category) AS DOUBLE)
            / NULLIF(COUNT(revenue) OVER (PARTITION BY category), 0) AS category_avg_revenue
  FROM pr)
SELECT CAST(product_id AS BIGINT) AS product_id, product_name, category,
       CAST(revenue AS DOUBLE) AS revenue, category_avg_revenue,
       CAST(revenue AS DOUBLE) - category_avg_revenue AS diff_vs_category,
       CAST(revenue AS DOUBLE) / NULLIF(category_avg_revenue, 0) AS ratio_vs_category
FROM ca ORDER BY category, revenue DESC, product_id""",

    "top_customers_per_product": STAR + """, g AS (
  SELECT product_id, customer_id, COUNT(sale_id) AS orders, SUM(total_amount) AS revenue
  FROM sales GROUP BY product_id, customer_id
), r AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY revenue DESC, customer_id ASC) AS rn
  FROM g)
SELECT CAST(r.product_id AS BIGINT) AS product_id, CAST(r.customer_id AS BIGINT) AS customer_id,
       c.customer_name, CAST(r.orders AS BIGINT) AS orders, CAST(r.revenue AS DOUBLE) AS revenue,
       CAST(r.rn AS BIGINT) AS position
FROM r LEFT JOIN customers c ON r.customer_id = c.customer_id
WHERE r.rn <= 5 ORDER BY product_id, position""",

    "order_details": STAR + """
SELECT CAST(s.sale_id AS BIGINT) AS sale_id, s.sale_date, CAST(s.product_id AS BIGINT) AS product_id,
       p.product_name, CAST(s.customer_id AS BIGINT) AS customer_id, c.customer_name, c.region,
       CAST(s.quantity AS BIGINT) AS quantity, CAST(s.unit_price AS DOUBLE) AS unit_price,
       CAST(s.discount_pct AS DOUBLE) AS discount_pct,
       CAST(s.discount_amount AS DOUBLE) AS discount_amount,
       CAST(s.total_amount AS DOUBLE) AS total_amount
FROM sales s JOIN products p ON s.product_id = p.product_id
LEFT JOIN customers c ON s.customer_id = c.customer_id
WHERE s.product_id = 42 ORDER BY s.sale_date, s.sale_id""",
}

# The same questions with a dashboard filter.
ORACLE_SQL["product_monthly_trend"] = ORACLE_SQL["monthly_trend"].replace(
    "WHERE c.year IN (1999, 2000)", "WHERE c.year IN (1999, 2000) AND s.product_id = 42")
ORACLE_SQL["top_customers_in_year"] = ORACLE_SQL["top_customers"].replace(
    "FROM sales GROUP BY", "FROM sales WHERE year(sale_date) = 2000 GROUP BY")
ORACLE_SQL["product_vs_category_in_year"] = ORACLE_SQL["product_vs_category"].replace(
    "ON s.product_id = p.product_id\n", "ON s.product_id = p.product_id WHERE year(s.sale_date) = 2000\n")
ORACLE_SQL["rank_products_ignore_case"] = STAR + """, spelled AS (
  SELECT product_id, category, brand,
         CASE WHEN product_id % 2 = 1 THEN upper(product_name) ELSE product_name END AS product_name
  FROM products), g AS (
  SELECT MIN(p.product_name) AS product_name, MIN(p.category) AS category, MIN(p.brand) AS brand,
         SUM(s.total_amount) AS revenue, SUM(s.quantity) AS units
  FROM sales s JOIN spelled p ON s.product_id = p.product_id
  GROUP BY lower(p.product_name), lower(p.category), lower(p.brand))
SELECT product_name, category, brand, CAST(revenue AS DOUBLE) AS revenue, CAST(units AS BIGINT) AS units,
       CAST(RANK() OVER (ORDER BY revenue DESC) AS BIGINT) AS rank
FROM g"""
