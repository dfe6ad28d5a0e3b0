"""Entity-name normalisation used as a join key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized_name(col: Column | str) -> Column:
    """Lower case, every run of non letters/digits becomes one space, trimmed:
    ``Korea, South`` and ``korea south`` give the same key."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", " ")))
