"""Relational operators the plans are built from."""

from saleslens.operators.windows import (  # noqa: F401
    global_ntile, global_rank, global_row_number, ntile_of, top_n_per_group,
)
