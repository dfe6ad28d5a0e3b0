"""Date text of a last-update field and its parses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from epitrend.config import YEAR_PREFIX


def date_text(col: Column | str) -> Column:
    """``/`` becomes ``-``; keep the text before the first space, then
    before the first ``T``: ``1/22/2020 17:00`` -> ``1-22-2020``."""
    c = F.regexp_replace(F.col(col) if isinstance(col, str) else col, "/", "-")
    c = F.element_at(F.split(c, " "), 1)
    return F.element_at(F.split(c, "T"), 1)


# Shapes of text each pattern can parse: digit groups split by dashes, month
# 1-12 and day 1-31 with optional leading zeros, ``yy`` exactly two digits;
# a sign is allowed on every group (Spark takes negative years). Text of
# another shape cannot parse, so the guard only skips a failing parse, whose
# exception costs about 7x a successful parse.
# One deliberate difference: years of more than 5 significant digits are
# unparsable here. Spark's parser raises a long overflow for some of them
# (a failed job instead of null); the others are dates after year 99999.
_SIGN = r"[-+]?"
_MONTH = rf"{_SIGN}0*(?:[1-9]|1[0-2])"
_DAY = rf"{_SIGN}0*(?:[1-9]|[12][0-9]|3[01])"
_YEAR = rf"{_SIGN}0*[0-9]{{1,5}}"
_SHAPES = {
    "M-d-y": rf"^{_MONTH}-{_DAY}-{_YEAR}$",
    "M-d-yy": rf"^{_MONTH}-{_DAY}-{_SIGN}[0-9]{{2}}$",
    "y-M-d": rf"^{_YEAR}-{_MONTH}-{_DAY}$",
}


def parse_date(text: Column, pattern: str) -> Column:
    """``try_to_date``: null instead of an error for text the pattern does
    not fit (ANSI on). Known patterns are tried only on text of their shape."""
    shape = _SHAPES.get(pattern)
    parsed = F.try_to_date(text, pattern)
    return parsed if shape is None else F.when(text.rlike(shape), parsed)


def starts_with_year_prefix(d: Column, prefix: str = YEAR_PREFIX) -> Column:
    """True when the date's ISO text starts with ``prefix``; never null.

    With pattern ``M-d-y`` a two-digit year parses as year 0020, which this
    rejects, so such files fall through to ``M-d-yy``."""
    return F.coalesce(d.cast("string").startswith(prefix), F.lit(False))
