"""Band features from mergeable states, extended by new days.

A state covers one span of dates of one entity: the number of its positive
rows, its first day, and per band the place (1-based, within the span) of the
first row inside the band and of the first row at or above its upper bound.
States of neighbouring spans merge in date order: places of a later span move
by the rows of the earlier ones, and the least place wins. The merge is
associative, so spans may be cut and combined anyhow, and the features of an
entity follow from one small row per span instead of its whole series.

``extend_band_state`` keeps states stored by span. New days make new spans and
read only the new days of the clean table; corrected dates are read again with
the span that holds them, and only those folders are written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from epitrend.config import BANDS, DATE, ENTITY, band_column
from epitrend.operators.features import positive_rows
from epitrend.session import delete_folder, folder_names

SPAN = "span"
_SPANS = ("year", "quarter", "month", "week", "day")


def _places(bands: Sequence[tuple[float, float]]) -> list[str]:
    return [f"{side}_{band_column(lo, up)[5:]}" for lo, up in bands for side in ("inside", "over")]


def state_schema(bands: Sequence[tuple[float, float]] = BANDS, entity: str = ENTITY) -> StructType:
    return StructType([StructField(entity, StringType()), StructField("n", LongType()),
                       StructField("first_day", DateType()), StructField("until", DateType()),
                       *[StructField(c, LongType()) for c in _places(bands)], StructField(SPAN, DateType())])


def band_states(df: DataFrame, bands: Sequence[tuple[float, float]] = BANDS, measure: str = "Confirmed",
                entity: str = ENTITY, date: str = DATE, span: str = SPAN) -> DataFrame:
    """States of ``df`` per entity and value of its column ``span`` (the first
    date of the span; spans of an entity must not overlap). A row per
    calendar day at most is ordered for one state."""
    w = Window.partitionBy(entity, span).orderBy(date)
    r = positive_rows(df, measure).withColumn("_rn", F.row_number().over(w).cast("long"))
    c = F.col(measure)
    places = []
    for lo, up in bands:
        places += [F.min(F.when((c >= lo) & (c < up), F.col("_rn"))), F.min(F.when(c >= up, F.col("_rn")))]
    return r.groupBy(entity, span).agg(
        F.count(F.lit(1)).alias("n"), F.min(date).alias("first_day"), F.max(date).alias("until"),
        *[p.alias(name) for p, name in zip(places, _places(bands))]) \
        .select(entity, "n", "first_day", "until", *_places(bands), span)


def merge_band_states(states: DataFrame, bands: Sequence[tuple[float, float]] = BANDS, entity: str = ENTITY,
                      span: str = SPAN, into: str | None = None) -> DataFrame:
    """States merged in the order of ``span``: to one per entity, or one per
    entity and value of the column ``into``, which must keep that order. The
    merged span is the first of its parts."""
    keys = [entity] if into is None else [entity, into]
    before = Window.partitionBy(*keys).orderBy(span).rowsBetween(Window.unboundedPreceding, -1)
    moved = states.withColumn("_moved", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return moved.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.min("first_day").alias("first_day"), F.max("until").alias("until"),
        *[F.min(F.col(p) + F.col("_moved")).alias(p) for p in _places(bands)], F.min(span).alias("_span")) \
        .select(entity, "n", "first_day", "until", *_places(bands), F.col("_span").alias(SPAN))


def finish_band_states(states: DataFrame, bands: Sequence[tuple[float, float]] = BANDS, entity: str = ENTITY,
                       first: bool = False) -> DataFrame:
    """The columns of ``days_in_bands`` (with ``first`` also ``FirstDay``) from
    states of any spans."""
    merged = merge_band_states(states, bands, entity)
    names = _places(bands)
    days = [(F.abs(F.col(a) - F.col(b)) + 1).cast("long").alias(band_column(lo, up))
            for (lo, up), a, b in zip(bands, names[::2], names[1::2])]
    return merged.select(entity, *([F.col("first_day").alias("FirstDay")] if first else []), *days)


def _stored_spans(spark: SparkSession, path: str) -> list[dt.date]:
    found = [n.split("=")[1] for n in folder_names(spark, path) if n.startswith(f"{SPAN}=")]
    return sorted(dt.date.fromisoformat(x) for x in found)


def read_band_state(spark: SparkSession, path: str, bands: Sequence[tuple[float, float]] = BANDS,
                    entity: str = ENTITY) -> DataFrame:
    schema = state_schema(bands, entity)
    if not _stored_spans(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def extend_band_state(clean: DataFrame, path: str, bands: Sequence[tuple[float, float]] = BANDS,
                      changed: Sequence[dt.date] = (), length: str = "month", measure: str = "Confirmed",
                      entity: str = ENTITY, date: str = DATE) -> list[dt.date]:
    """Bring the states at ``path`` up to ``clean`` and return the spans written.

    Dates after the last one covered become new spans, one per ``length``
    (year, quarter, month, week, day) that they touch. ``changed`` names dates
    up to it whose rows were corrected, added or deleted (as ``refresh``
    reports them): their spans are made again. Both are date filters that are
    pushed to the scan of ``clean``; no other date is read."""
    if length not in _SPANS:
        raise ValueError(f"length must be one of {_SPANS}, not {length!r}")
    spark = clean.sparkSession
    spans = _stored_spans(spark, path)
    last = read_band_state(spark, path, bands, entity).agg(F.max("until")).first()[0]
    day = F.col(date)
    start = F.trunc(day, length) if length != "day" else day
    wanted, redone = (F.lit(True) if last is None else day > F.lit(last)), []
    if last is not None:
        start = F.greatest(start, F.date_add(F.lit(last), 1))
        for d in sorted({d for d in changed if d <= last}):
            # The span that holds the date; dates before the first go with it.
            redone.append(max((s for s in spans if s <= d), default=spans[0]))
        for s in sorted(set(redone)):
            later = [x for x in spans if x > s]
            low = F.lit(True) if s == spans[0] else day >= F.lit(s)
            # The last span ends with the days covered, the others before the next.
            high = day < F.lit(later[0]) if later else day <= F.lit(last)
            wanted = wanted | (low & high)
            start = F.when(low & high, F.lit(s)).otherwise(start)
    rows = clean.where(wanted).withColumn(SPAN, start)
    states = band_states(rows, bands, measure, entity, date)
    states.repartition(SPAN).sortWithinPartitions(entity).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(SPAN).parquet(path)
    written = set(_stored_spans(spark, path)) - set(spans)
    for s in set(redone):
        if rows.where(F.col(SPAN) == F.lit(s)).where(F.col(measure) > 0).isEmpty():
            delete_folder(spark, f"{path}/{SPAN}={s.isoformat()}")
    return sorted(written | set(redone))
