"""Per-entity features over the clean table.

Every operator here works on the clean table, whose key (Date, entity) is
unique, so a per-entity window or list holds at most one row per calendar
day of that entity: its size is bounded by the calendar, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epitrend.config import BANDS, DATE, ENTITY, band_column

_MEASURE = "Confirmed"


def positive_rows(df: DataFrame, measure: str = _MEASURE) -> DataFrame:
    """Rows with ``measure > 0``: the series every feature is defined on."""
    return df.where(F.col(measure) > 0)


def _ranked(df: DataFrame, entity: str, date: str, measure: str) -> DataFrame:
    """Positive rows with ``_rn`` = 1-based row number in date order."""
    w = Window.partitionBy(entity).orderBy(date)
    return positive_rows(df, measure).withColumn("_rn", F.row_number().over(w))


def first_day(df: DataFrame, measure: str = _MEASURE, entity: str = ENTITY,
              date: str = DATE) -> DataFrame:
    """``FirstDay``: first date with ``measure > 0``, per entity (the
    minimum, so it does not depend on row order)."""
    return positive_rows(df, measure).groupBy(entity).agg(F.min(date).alias("FirstDay"))


def next_value(df: DataFrame, measure: str = _MEASURE, offset: int = 1,
               entity: str = ENTITY, date: str = DATE, out: str | None = None) -> DataFrame:
    """Add the value ``offset`` rows later in date order within the entity
    (null at the end)."""
    w = Window.partitionBy(entity).orderBy(date)
    return df.withColumn(out or f"next_{measure}", F.lead(measure, offset).over(w))


def first_crossing(df: DataFrame, threshold: float, lower: float = 1,
                   measure: str = _MEASURE, entity: str = ENTITY,
                   date: str = DATE) -> DataFrame:
    """Per entity, over its positive rows in date order: the first row with
    ``lower <= measure < threshold`` (``below_*``) and the first row with
    ``measure >= threshold`` (``above_*``), as 1-based row index and date.
    Null when there is no such row."""
    r = _ranked(df, entity, date, measure)
    c = F.col(measure)
    below = (c >= lower) & (c < threshold)
    above = c >= threshold
    return r.groupBy(entity).agg(
        F.min(F.when(below, F.col("_rn"))).cast("long").alias("below_index"),
        F.min(F.when(below, F.col(date))).alias("below_date"),
        F.min(F.when(above, F.col("_rn"))).cast("long").alias("above_index"),
        F.min(F.when(above, F.col(date))).alias("above_date"),
    )


def series_list(df: DataFrame, measure: str = _MEASURE, entity: str = ENTITY,
                date: str = DATE) -> DataFrame:
    """Per entity, ``series`` = its positive values in date order.

    Sorted as (date, value) structs, so the order does not depend on the
    order rows arrive after the shuffle."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(date).alias("d"),
                                                 F.col(measure).alias("v"))))
    return (positive_rows(df, measure).groupBy(entity).agg(pairs.alias("_s"))
            .select(entity, F.transform("_s", lambda x: x["v"]).alias("series")))


def array_index(series: DataFrame, threshold: float, col: str = "series",
                entity: str = ENTITY) -> DataFrame:
    """Per entity, the first value of ``col`` at or above ``threshold`` and
    its 1-based position in the list (``array_position``; null when no value
    reaches the threshold)."""
    value = F.try_element_at(F.filter(col, lambda x: x >= threshold), F.lit(1))
    return series.select(entity, value.alias("value"),
                         F.array_position(col, value).alias("position"))


def _band_days(c: Column, rn: Column, lo: float, up: float) -> Column:
    # Row index of the first row inside [lo, up) and of the first row at or
    # above up; days = rows from one to the other, both ends included.
    inside = F.min(F.when((c >= lo) & (c < up), rn))
    over = F.min(F.when(c >= up, rn))
    return (F.abs(inside - over) + 1).cast("long")


def days_in_bands(df: DataFrame, bands: Sequence[tuple[float, float]] = BANDS,
                  measure: str = _MEASURE, entity: str = ENTITY,
                  date: str = DATE, first: bool = False) -> DataFrame:
    """Per entity and band (lo, up): ``days_<lo>_to_<up>`` = number of
    reported positive rows from the first row inside [lo, up) to the first
    row at or above ``up``, both included (|i - j| + 1 of their row indexes,
    so a series that crosses ``up`` before it enters the band still counts).
    Null when the series skips the band or never reaches ``up``.

    One window (row number) and one aggregate; both use the same
    partitioning by entity, so the plan has a single shuffle of the clean
    table."""
    r = _ranked(df, entity, date, measure)
    c, rn = F.col(measure), F.col("_rn")
    aggs = [_band_days(c, rn, lo, up).alias(band_column(lo, up)) for lo, up in bands]
    if first:
        aggs.insert(0, F.min(date).alias("FirstDay"))
    return r.groupBy(entity).agg(*aggs)


def feature_table(df: DataFrame, bands: Sequence[tuple[float, float]] = BANDS,
                  measure: str = _MEASURE, entity: str = ENTITY,
                  date: str = DATE) -> DataFrame:
    """``entity, FirstDay, days_<lo>_to_<up>...``; entities with any null
    feature are dropped."""
    return days_in_bands(df, bands, measure, entity, date, first=True).dropna()


def band_columns(bands: Sequence[tuple[float, float]] = BANDS) -> list[str]:
    return [band_column(lo, up) for lo, up in bands]
