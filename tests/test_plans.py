"""Analysis plans on hand-written fixtures (ties, NULL flags, gaps, zero totals)."""


from saleslens import plans as P
from tests import fixtures as fx

PRODS = [
    (1, "Bread", "B1", "Bakery", True, 2.00),
    (2, "Pasta", "B2", "Grains", False, 3.00),
    (3, "Crackers", "B3", "Snacks", None, 4.00),
    (4, "Rice", "B4", "Grains", False, 5.00),
    (5, "Unsold", "B5", "Snacks", True, 9.00),
    (6, "Bread", "B1", "Bakery", True, 2.50),   # same name/category/brand, other id
    (7, "Pasta", "Other", "Grains", False, 3.00),  # same name/category, other brand
]
CUST = [(1, "C1", "Shop", "North"), (2, "C2", "Shop", "South"), (3, "C3", "Bar", "North"),
        (4, "C4", "Bar", "East"), (5, "C5", "Bar", "East"), (6, "C6", "Shop", "West")]


def _star(spark, sales):
    return fx.star(spark, PRODS, CUST, sales)


def test_rank_products_ties_and_merge(spark):
    s = _star(spark, [
        (1, 1, 1, "2023-01-05", 1, 10), (2, 6, 1, "2023-01-06", 1, 10),   # Bread 20 (two ids)
        (3, 2, 2, "2023-02-01", 1, 20), (4, 3, 3, "2023-03-01", 1, 20),   # Pasta 20, Crackers 20
        (5, 4, 4, "2023-03-02", 1, 5)])
    got = sorted((r.product_name, r.rank) for r in P.rank_products(s.sales, s.products).collect())
    assert got == [("Bread", 1), ("Crackers", 1), ("Pasta", 1), ("Rice", 4)]


def test_top_share_excludes_name_from_total(spark):
    s = _star(spark, [(1, 1, 1, "2023-01-05", 1, 30), (2, 2, 1, "2023-01-05", 1, 10),
                      (3, 7, 1, "2023-01-05", 1, 10)])
    out = {r.product_name: r.pct_of_total for r in
           P.top_products_share(s.sales, s.products, n=10, exclude_names=["Bread"]).collect()}
    assert out == {"Pasta": 100.0}   # brands merge; the excluded name leaves the total


def test_mom_ytd_moving_avg_with_gaps(spark):
    s = _star(spark, [(1, 1, 1, "2023-01-10", 1, 100), (2, 1, 1, "2023-02-10", 1, 150),
                      (3, 1, 1, "2023-04-10", 1, 0), (4, 1, 1, "2024-01-10", 1, 50),
                      (5, 1, 1, "2022-12-31", 1, 999)])   # outside the calendar: dropped
    mom = [(r.year, r.month, r.prev_revenue, r.mom_pct) for r in P.revenue_mom(s.sales, s.calendar).collect()]
    assert mom == [(2023, 1, None, None), (2023, 2, 100.0, 50.0), (2023, 4, 150.0, -100.0),
                   (2024, 1, 0.0, None)]
    ytd = [r.revenue_ytd for r in P.revenue_ytd(s.sales, s.calendar).collect()]
    assert ytd == [100.0, 250.0, 250.0, 50.0]
    ma = [r.moving_avg_3m for r in P.revenue_moving_avg(s.sales, s.calendar).collect()]
    assert ma == [100.0, 125.0, 83.33, 66.67]


def test_yoy_quarter_absent_base(spark):
    s = _star(spark, [(1, 1, 1, "2024-01-10", 1, 80), (2, 1, 1, "2023-05-10", 1, 40),
                      (3, 1, 1, "2024-05-10", 1, 60)])
    out = [(r.quarter, r.revenue_base, r.revenue_current, r.change_pct)
           for r in P.revenue_yoy_quarter(s.sales, s.calendar, 2023, 2024).collect()]
    assert out == [(1, 0.0, 80.0, None), (2, 40.0, 60.0, 50.0)]


def test_organic_split_null_flag_and_weighted_price(spark):
    s = _star(spark, [(1, 1, 1, "2023-01-05", 1, 10), (2, 1, 1, "2023-01-06", 1, 10),
                      (3, 3, 1, "2023-01-05", 1, 10)])
    rows = P.organic_split(s.products, s.sales).collect()
    by = {(r.product_type, r.products): r for r in rows}
    assert len(rows) == 3   # true, false, NULL (labelled like false)
    org = by[("Organico", 3)]   # ids 1, 5, 6: product 1 weighs twice
    assert org.sales == 2 and abs(org.avg_list_price - (2 + 2 + 9 + 2.5) / 4) < 1e-9


def test_unsold_with_and_without_period(spark):
    s = _star(spark, [(1, 1, 1, "2023-01-05", 1, 10), (2, 2, 1, "2024-03-05", 1, 10)])
    all_time = {r.product_id for r in P.unsold_products(s.products, s.sales).collect()}
    assert all_time == {3, 4, 5, 6, 7}
    in_2023 = {r.product_id for r in P.unsold_products(s.products, s.sales, "2023-01-01", "2024-01-01").collect()}
    assert in_2023 == {2, 3, 4, 5, 6, 7}


def test_rfm_tiles_segments_and_orientation(spark):
    s = _star(spark, [(1, 1, 1, "2024-12-30", 1, 100), (2, 1, 1, "2024-12-01", 1, 100),
                      (3, 1, 2, "2024-11-01", 1, 50), (4, 1, 3, "2024-06-01", 1, 50),
                      (5, 1, 4, "2024-01-01", 1, 10)])  # customers 5, 6 have no sales
    ref = {r.customer_id: r for r in P.rfm_scores(s.sales, s.customers, "2024-12-31").collect()}
    assert set(ref) == {1, 2, 3, 4}
    assert (ref[1].recency_days, ref[1].frequency, ref[1].monetary) == (1, 2, 200.0)
    assert (ref[1].r_score, ref[1].f_score, ref[1].m_score, ref[1].segment) == (1, 1, 1, "Lost")
    assert (ref[4].rfm_score, ref[4].segment) == (12, "Champions")
    best = {r.customer_id: r for r in
            P.rfm_scores(s.sales, s.customers, "2024-12-31", orientation="best_high").collect()}
    assert best[1].rfm_score == 12 and best[1].segment == "Champions"
    dist = {r.segment: r for r in P.segment_distribution(s.sales, s.customers, "2024-12-31").collect()}
    assert sum(r.customers for r in dist.values()) == 4
    assert abs(sum(r.pct_customers for r in dist.values()) - 100.0) < 1e-9


def test_discount_impact_zero_revenue(spark):
    s = _star(spark, [(1, 1, 1, "2023-01-05", 1, 90, 10, 10), (2, 1, 2, "2023-01-05", 1, 0, 0, 0)])
    out = {r.region: r for r in P.discount_impact(s.sales, s.customers).collect()}
    assert out["North"].potential_revenue == 100.0 and out["North"].pct_lost == 10.0
    assert out["South"].pct_lost is None


def test_kpi_summary_one_year_distinct_counts(spark):
    s = _star(spark, [(1, 1, 1, "2024-01-05", 1, 10, 5), (2, 2, 1, "2024-02-05", 1, 20, 15),
                      (3, 2, 2, "2023-02-05", 1, 30)])
    out = {r.kpi: (r.value, r.unit) for r in P.kpi_summary(s.sales, 2024).collect()}
    assert out == {"Fatturato Totale 2024": (30.0, "€"), "Ordini Totali 2024": (2.0, "n."),
                   "Clienti Attivi 2024": (1.0, "n."), "Sconto Medio 2024": (10.0, "%"),
                   "Prodotti Venduti 2024": (2.0, "n.")}


def test_top3_per_category_exactly_n(spark):
    s = _star(spark, [(1, 2, 1, "2023-01-05", 1, 10), (2, 4, 1, "2023-01-05", 1, 10),
                      (3, 7, 1, "2023-01-05", 1, 10), (4, 1, 1, "2023-01-05", 1, 5)])
    out = [(r.category, r.product_name, r.brand, r.position)
           for r in P.top_products_per_category(s.sales, s.products, 2).collect()]
    assert out == [("Bakery", "Bread", "B1", 1), ("Grains", "Pasta", "B2", 1),
                   ("Grains", "Pasta", "Other", 2)]


def test_new_customers_first_purchase(spark):
    s = _star(spark, [(1, 1, 1, "2023-01-05", 1, 10), (2, 1, 1, "2023-03-05", 1, 10),
                      (3, 1, 2, "2023-03-06", 1, 10)])
    out = [(r.month, r.new_customers) for r in P.new_customers(s.sales, s.calendar).collect()]
    assert out == [(1, 1), (3, 1)]


def test_calendar_iso_week_at_year_end(spark):
    from saleslens.functions.dates import build_calendar
    cal = {r.full_date.isoformat(): r for r in build_calendar(spark, "2024-12-29", "2025-01-02").collect()}
    r = cal["2024-12-30"]
    assert (r.year, r.week, r.day_of_week, r.date_key, r.month_name) == (2024, 1, 1, 20241230, "December")
    assert cal["2024-12-29"].day_of_week == 7 and len(cal) == 5


def test_year_filter_pushes_both_bounds(spark):
    s = _star(spark, [(1, 1, 1, "2024-01-05", 1, 10)])
    path = spark.conf.get("spark.sql.warehouse.dir") + "/sales_push"
    s.sales.write.mode("overwrite").parquet(path)
    plan = P.filter_year(spark.read.parquet(path), 2024)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(sale_date" in plan and "LessThan(sale_date" in plan
