"""Raw report ingestion: header drift, per-file date formats, measures.

Order as in the analysis: ``normalize_headers`` -> ``detect_dates`` ->
``coerce_measures`` -> (drop null dates) -> ``daily_rollup``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitrend.config import (COUNTRY_PREFIX, DATE_PATTERNS, ENTITY, LAST_UPDATE,
                             LAST_UPDATE_PREFIX, MEASURES)
from epitrend.functions.columns import first_with_prefix, last_with_prefix, strip_bom
from epitrend.functions.dates import date_text, parse_date, starts_with_year_prefix
from epitrend.functions.measures import active, to_double
from epitrend.functions.sizing import broadcast_if_bounded


def resolve_header(names: Sequence[str]) -> dict[str, int]:
    """Canonical name -> position in ``names``.

    Entity: the **first** name starting with ``Country``; timestamp: the
    **last** name starting with ``Last``; measures by name, ignoring case as
    Spark's column resolution does (first match). A missing column raises
    ``ValueError`` (the analysis this follows would index past the header
    instead)."""
    clean = [strip_bom(n).strip() for n in names]
    country = first_with_prefix(clean, COUNTRY_PREFIX)
    last = last_with_prefix(clean, LAST_UPDATE_PREFIX)
    missing = []
    if country is None:
        missing.append(f"a column starting with {COUNTRY_PREFIX!r}")
    if last is None:
        missing.append(f"a column starting with {LAST_UPDATE_PREFIX!r}")
    pos = {ENTITY: country, LAST_UPDATE: last}
    lowered = [n.lower() for n in clean]
    for m in MEASURES:
        if m.lower() in lowered:
            pos[m] = lowered.index(m.lower())
        else:
            missing.append(repr(m))
    if missing:
        raise ValueError(f"report header {list(names)} lacks " + ", ".join(missing))
    return pos


def normalize_headers(frames: Sequence[DataFrame], keep: Sequence[str] = ()) -> DataFrame:
    """One DataFrame from frames with drifting headers.

    Each frame is projected to ``Country, last_update, Confirmed, Deaths,
    Recovered`` (+ ``keep``) by ``resolve_header`` and the frames are unioned
    by name. A source column named exactly ``Country`` is kept, not lost."""
    out = None
    for df in frames:
        pos = resolve_header(df.columns)
        cols = [F.col(f"`{df.columns[i]}`").alias(name) for name, i in pos.items()]
        extra = [F.col(f"`{k}`") if k in df.columns else F.lit(None).cast("string").alias(k)
                 for k in keep]
        part = df.select(*cols, *extra)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("normalize_headers needs at least one frame")
    return out


def _date_choice(texts: DataFrame, source: str, mode: str,
                 patterns: Sequence[str]) -> DataFrame:
    """``texts`` (distinct ``source, _t``) with ``Date`` and ``_kept``: the date
    each text gets under its source's choice of pattern."""
    p1, p2, p3 = (parse_date(F.col("_t"), p) for p in patterns)
    parsed = texts.withColumns({"_d1": p1, "_d2": p2, "_d3": p3})
    ok1, ok2 = starts_with_year_prefix(F.col("_d1")), starts_with_year_prefix(F.col("_d2"))
    if mode == "row":
        date = F.coalesce(F.when(ok1, F.col("_d1")), F.when(ok2, F.col("_d2")), F.col("_d3"))
        return parsed.select(source, "_t", date.alias("Date"), F.lit(True).alias("_kept"))
    flags = parsed.groupBy(F.col(source).alias("_source")).agg(F.bool_or(ok1).alias("_any1"),
                                                               F.bool_or(ok2).alias("_any2"))
    any1, any2 = F.col("_any1"), F.col("_any2")
    date = F.when(any1, F.col("_d1")).when(any2, F.col("_d2")).otherwise(F.col("_d3"))
    kept = F.when(any1 | any2, starts_with_year_prefix(F.col("Date"))).otherwise(F.lit(True))
    return (parsed.join(flags, F.col(source).eqNullSafe(F.col("_source")))
            .withColumn("Date", date).select(source, "_t", "Date", kept.alias("_kept")))


def _check_mode(mode: str, patterns: Sequence[str]) -> None:
    if len(patterns) != 3:
        raise ValueError("detect_dates takes three patterns")
    if mode not in ("file", "row"):
        raise ValueError(f"mode must be 'file' or 'row', not {mode!r}")


def _dated(df: DataFrame, source: str, column: str, mode: str, patterns: Sequence[str],
           max_sources: int) -> DataFrame:
    """All rows with ``Date`` and ``_kept``."""
    _check_mode(mode, patterns)
    staged = df.withColumn("_t", date_text(column))
    choice = _date_choice(staged.select(source, "_t").distinct(), source, mode, patterns)
    choice = broadcast_if_bounded(choice, max_sources, materialize=True).withColumnsRenamed(
        {source: "_choice_source", "_t": "_choice_t"})
    return staged.join(choice, F.col(source).eqNullSafe(F.col("_choice_source"))
                       & F.col("_t").eqNullSafe(F.col("_choice_t")))


def detect_dates(df: DataFrame, source: str = "source_file", column: str = LAST_UPDATE,
                 mode: str = "file", patterns: Sequence[str] = DATE_PATTERNS,
                 max_sources: int = 200_000) -> DataFrame:
    """Add ``Date`` parsed from ``column``.

    The text is cut as ``date_text`` does. ``mode="file"`` (the reference
    behaviour) decides per ``source``: if any row parses with the first
    pattern to a year starting with 2, that pattern is used and the rows it
    does not fit are **dropped**; else the same with the second pattern; else
    the third pattern, keeping unparsed rows with a null ``Date``.
    ``mode="row"`` takes, per row, the first pattern that fits and drops
    nothing. Rows with a null ``source`` are one source.

    Dates are parsed once per distinct (source, date text). That table is
    checkpointed and broadcast when it has at most ``max_sources`` rows, so the
    raw rows are not shuffled; beyond it the join shuffles."""
    return _dated(df, source, column, mode, patterns, max_sources).where("_kept").select(*df.columns, "Date")


def rejected_rows(df: DataFrame, source: str = "source_file", column: str = LAST_UPDATE,
                  mode: str = "file", patterns: Sequence[str] = DATE_PATTERNS,
                  max_sources: int = 200_000) -> DataFrame:
    """The rows that cleaning loses by their date, with ``reason``:
    ``minority_format`` (another pattern was chosen for their source) or
    ``unparsed``."""
    d = _dated(df, source, column, mode, patterns, max_sources)
    reason = F.when(~F.col("_kept"), F.lit("minority_format")).otherwise(F.lit("unparsed"))
    return d.where(~F.col("_kept") | F.col("Date").isNull()).select(*df.columns, reason.alias("reason"))


def report_partials(raw: DataFrame, source: str = "source_file", column: str = LAST_UPDATE) -> DataFrame:
    """Mergeable sums per (report, date text, Country): ``report, date_text,
    Country, n_rows, n_valid, Confirmed, Deaths, Recovered``.

    Measures follow ``coerce_measures``; rows it drops count in ``n_rows``
    only, and so still have a say in their report's date pattern. One hash
    aggregate with map-side partial sums; partials of several inputs add up."""
    m = {c: to_double(c) for c in MEASURES}
    none = F.lit(True)
    for c in m.values():
        none = none & c.isNull()
    valid = F.col(ENTITY).isNotNull() & ~none
    return (raw.groupBy(F.col(source).alias("report"), date_text(column).alias("date_text"), F.col(ENTITY))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(valid).alias("n_valid"),
                 *[F.coalesce(F.sum(F.when(valid, F.coalesce(c, F.lit(0.0)))), F.lit(0.0)).alias(name)
                   for name, c in m.items()]))


def merge_partials(partials: DataFrame) -> DataFrame:
    """Partials of several inputs as one."""
    return partials.groupBy("report", "date_text", ENTITY).agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_valid", *MEASURES)])


def dated_partials(partials: DataFrame, mode: str = "file",
                   patterns: Sequence[str] = DATE_PATTERNS) -> DataFrame:
    """Partials -> ``report, Date, Country, Confirmed, Deaths, Recovered``: the
    sums that a report adds to each date, under its own choice of pattern.
    ``partials`` is read twice: pass a stored table."""
    _check_mode(mode, patterns)
    named = partials.withColumnsRenamed({"date_text": "_t", "report": "_report"})
    choice = _date_choice(named.select("_report", "_t").distinct(), "_report", mode, patterns) \
        .withColumnsRenamed({"_report": "_choice_report", "_t": "_choice_t"})
    dated = named.join(choice, F.col("_report").eqNullSafe(F.col("_choice_report"))
                       & F.col("_t").eqNullSafe(F.col("_choice_t")))
    used = dated.where(F.col("_kept") & F.col("Date").isNotNull() & (F.col("n_valid") > 0))
    return used.groupBy(F.col("_report").alias("report"), "Date", ENTITY).agg(*[F.sum(x).alias(x) for x in MEASURES])


def sum_dated(dated: DataFrame) -> DataFrame:
    """``dated_partials`` -> one row per (Date, Country) with Active."""
    c, d, r = MEASURES
    return dated.groupBy("Date", ENTITY).agg(*[F.sum(x).alias(x) for x in MEASURES]) \
        .select("Date", ENTITY, c, d, r, active(c, d, r).alias("Active"))


def finish_partials(partials: DataFrame, mode: str = "file",
                    patterns: Sequence[str] = DATE_PATTERNS) -> DataFrame:
    """Partials -> one row per (Date, Country), as ``detect_dates``,
    ``coerce_measures``, dropping null dates and ``daily_rollup`` would give.
    ``partials`` is read twice: pass a stored table."""
    return sum_dated(dated_partials(partials, mode, patterns).drop("report"))


def coerce_measures(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Measures to double and Active recomputed, in the reference's order:
    malformed text -> null; drop rows without ``Country``; drop rows whose
    three measures are **all** null; remaining nulls -> 0; Active =
    Confirmed - (Deaths + Recovered). Returns ``Date, Country, Confirmed,
    Deaths, Recovered, Active`` (+ ``keep``)."""
    c, d, r = MEASURES
    typed = df.select(F.col("Date"), F.col(ENTITY), *[to_double(m).alias(m) for m in MEASURES],
                      *keep)
    typed = typed.dropna(subset=[ENTITY]).dropna(how="all", subset=list(MEASURES))
    filled = typed.select("Date", ENTITY,
                          *[F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in MEASURES], *keep)
    return filled.select("Date", ENTITY, c, d, r, active(c, d, r).alias("Active"), *keep)


def rejected_dates(df: DataFrame) -> DataFrame:
    """Rows whose ``Date`` stayed null (unparsed text in the third pattern)."""
    return df.where(F.col("Date").isNull())
