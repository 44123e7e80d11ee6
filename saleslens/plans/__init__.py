"""Whole-query analysis plans over the retail star."""

from saleslens.plans.customers import (  # noqa: F401
    discount_impact, rfm_base, rfm_scored, rfm_scores, segment_distribution, top_customers,
    top_customers_per_product,
)
from saleslens.plans.kpi import filter_year, kpi_cards, kpi_summary  # noqa: F401
from saleslens.plans.products import (  # noqa: F401
    order_details, organic_split, product_kpis, product_vs_category, rank_in_category,
    top_products_per_category, unsold_products,
)
from saleslens.plans.revenue import (  # noqa: F401
    product_totals, rank_products, revenue_by, revenue_by_year, top_products_share,
)
from saleslens.plans.timeseries import (  # noqa: F401
    category_year_matrix, monthly_revenue, monthly_trend, new_customers, purchase_trend,
    revenue_mom, revenue_moving_avg, revenue_ytd, revenue_yoy_quarter,
)
