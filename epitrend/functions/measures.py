"""Measure casts and the recomputed Active column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(name: str) -> Column:
    """String to double; malformed or empty text becomes null (ANSI-safe)."""
    return F.col(name).try_cast("double")


def active(confirmed: str = "Confirmed", deaths: str = "Deaths",
           recovered: str = "Recovered") -> Column:
    """Active = Confirmed - (Deaths + Recovered); any source Active is ignored."""
    return F.col(confirmed) - (F.col(deaths) + F.col(recovered))
