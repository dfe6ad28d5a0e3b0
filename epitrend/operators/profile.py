"""A profile of every column from mergeable partials.

One pass keeps, per report (or any key) and column, counts and extremes that
add up exactly, a HyperLogLog sketch of the distinct values and a KLL sketch of
the numbers. Partials are small rows that can be stored beside the sums of
their report and merged in any grouping, so a profile of the whole table reads
them and not the data. The falls of cumulative series are kept the same way per
entity and span of dates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epitrend.config import DATE, ENTITY

LG_CONFIG = 12     # registers of the distinct sketch: 2^12
KLL_K = 200
# Stated bounds: three standard errors of the distinct count, and the error of
# a quantile's rank that KLL with this k exceeds in 1% of cases.
DISTINCT_ERROR = 3 * 1.04 / (1 << LG_CONFIG) ** 0.5
RANK_ERROR = 0.0133 * 1.25

_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")
_FIELDS = ("n", "nulls", "low", "high", "low_number", "high_number", "distinct_sketch", "number_sketch")


def _is_number(kind: str) -> bool:
    return kind in _NUMBERS or kind.startswith("decimal")


def _aggregates(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    kinds = dict(df.dtypes)
    out = []
    for i, c in enumerate(cols):
        col, number = F.col(f"`{c}`"), _is_number(kinds[c])
        text = col.cast("string")
        value = col.cast("double")
        # Sketches take no NaN; it counts as a value like any other elsewhere.
        usable = F.when(~F.isnan(value), value) if number else F.lit(None).cast("double")
        out += [F.count(F.lit(1)).alias(f"{i}_n"), F.count_if(col.isNull()).alias(f"{i}_nulls"),
                F.min(text).alias(f"{i}_low"), F.max(text).alias(f"{i}_high"),
                F.min(usable).alias(f"{i}_low_number"), F.max(usable).alias(f"{i}_high_number"),
                F.hll_sketch_agg(text, LG_CONFIG).alias(f"{i}_distinct_sketch"),
                F.kll_sketch_agg_double(usable, KLL_K).alias(f"{i}_number_sketch")]
    return out


def profile_partials(df: DataFrame, key: str | None = None, cols: Sequence[str] | None = None) -> DataFrame:
    """``key, column, n, nulls, low, high, low_number, high_number,
    distinct_sketch, number_sketch``: a row per value of ``key`` (one row without)
    and column. ``low`` and ``high`` are extremes as text, the numbers' own ones
    are null for other types. One aggregate with map-side partials."""
    cols = [c for c in df.columns if c != key] if cols is None else list(cols)
    grouped = df.groupBy(F.col(f"`{key}`").alias("key")) if key else df.groupBy(F.lit(None).cast("string").alias("key"))
    wide = grouped.agg(*_aggregates(df, cols))
    rows = F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{i}_{f}").alias(f) for f in _FIELDS])
                     for i, c in enumerate(cols)])
    return wide.select("key", F.explode(rows).alias("r")).select("key", "r.*")


def merge_profiles(partials: DataFrame) -> DataFrame:
    """Partials of all keys as one row per column, in the same form."""
    return partials.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("low_number").alias("low_number"), F.max("high_number").alias("high_number"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("number_sketch").alias("number_sketch")) \
        .select(F.lit(None).cast("string").alias("key"), "column", *_FIELDS)


def finish_profile(partials: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``column, n, nulls, low, high, low_number, high_number, distinct, q<p>``:
    counts and extremes are exact, ``distinct`` is within ``DISTINCT_ERROR`` of the
    true number and the rank of a quantile within ``RANK_ERROR`` of its share."""
    merged = merge_profiles(partials)
    some = F.kll_sketch_get_n_double("number_sketch") > 0
    points = [F.when(some, F.kll_sketch_get_quantile_double("number_sketch", F.lit(float(p)))).alias(f"q{p:g}".replace(".", "_"))
              for p in quantiles]
    return merged.select("column", "n", "nulls", "low", "high", "low_number", "high_number",
                         F.hll_sketch_estimate("distinct_sketch").alias("distinct"), *points)


def fall_states(df: DataFrame, measure: str, entity: str = ENTITY, date: str = DATE, span: str | None = None) -> DataFrame:
    """Per entity (and value of ``span``): ``since``, ``first``, ``last`` and ``falls``, the
    rows of ``measure`` below the row before. Null values are no rows. The rows are
    dealt by entity, which ``merge_falls`` needs as well: both make one shuffle."""
    keys = [entity] if span is None else [entity, span]
    # The hash leads the sort: names often share their first characters.
    series = Window.partitionBy(F.xxhash64(entity), *keys).orderBy(date)
    upto = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = F.col(measure)
    dated = F.when(F.col(date).isNotNull(), value)
    rows = df.where(value.isNotNull()).select(*keys, date, measure).repartition(entity) \
        .withColumns({"_fell": F.coalesce((value < F.lag(measure).over(series)).cast("long"), F.lit(0)),
                      "_next": F.lead(F.lit(True)).over(series)})
    # The state stands at the last row of the sorted series: no aggregate beside the sort.
    return rows.withColumns({"since": F.min(date).over(upto), "first": F.first(dated, ignorenulls=True).over(upto),
                             "falls": F.sum("_fell").over(upto)}) \
        .where(F.col("_next").isNull()).select(*keys, "since", "first", dated.alias("last"), "falls")


def merge_falls(states: DataFrame, entity: str = ENTITY) -> DataFrame:
    """States of spans that do not overlap as one per entity."""
    before = F.lag("last").over(Window.partitionBy(entity).orderBy("since"))
    joined = states.withColumn("_fell", F.coalesce((F.col("first") < before).cast("long"), F.lit(0)))
    return joined.groupBy(entity).agg(F.min("since").alias("since"), F.min_by("first", "since").alias("first"),
                                      F.max_by("last", "since").alias("last"),
                                      F.sum(F.col("falls") + F.col("_fell")).alias("falls"))
