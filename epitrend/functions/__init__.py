"""Column expressions and small helpers shared by the operators."""

from epitrend.functions.columns import first_with_prefix, last_with_prefix, strip_bom
from epitrend.functions.dates import date_text, parse_date, starts_with_year_prefix
from epitrend.functions.measures import active, to_double
from epitrend.functions.sizing import broadcast_if_bounded
from epitrend.functions.names import normalized_name

__all__ = [
    "active",
    "broadcast_if_bounded",
    "date_text",
    "first_with_prefix",
    "last_with_prefix",
    "normalized_name",
    "parse_date",
    "starts_with_year_prefix",
    "strip_bom",
    "to_double",
]
