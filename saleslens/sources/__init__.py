"""Sources and sinks: the star adapter, CSV/JSON readers, table loads."""

from saleslens.sources.adapter import (  # noqa: F401
    Star, customers_from_tpch, products_from_tpch, read_parquet_table,
    sales_from_tpch, star_from_tpch,
)
