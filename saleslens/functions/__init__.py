"""Column-level helpers (all Catalyst built-ins, no UDFs)."""

from saleslens.functions.expr import (  # noqa: F401
    as_double, as_long, col_, days_between, in_period, in_year, mean, round_half_up, safe_ratio,
)
from saleslens.functions.dates import (  # noqa: F401
    add_calendar_columns, build_calendar, calendar_covering, coerce_dates,
)
