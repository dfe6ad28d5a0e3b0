"""Snapshots at one date and top / bottom k."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitrend.config import CLEAN_COLUMNS, DATE, ENTITY, TOP_K


def latest_snapshot(df: DataFrame, date: str = DATE) -> DataFrame:
    """All rows at the latest date of the table; an entity without a row on
    that day is absent.

    The maximum is a scalar subquery: Spark runs it first and the equality
    reaches the Parquet scan as a pushed filter. No join, no collect."""
    latest = df.select(F.max(date)).scalar()
    return df.where(F.col(date) == latest)


def as_of_snapshot(df: DataFrame, on: str | dt.date, date: str = DATE) -> DataFrame:
    """All rows at date ``on`` (the date-selector view of the dashboard)."""
    return df.where(F.col(date) == F.lit(on).cast("date"))


def value_as_of(df: DataFrame, on: str | dt.date, cols: Sequence[str] = CLEAN_COLUMNS[2:], max_age: int | None = None,
                entity: str = ENTITY, date: str = DATE) -> DataFrame:
    """Per entity the last observation up to ``on``: ``cols`` of that row, its
    date ``observed`` and its ``age`` in days. Entities that did not report on
    ``on`` keep their last values; those without a row up to it, or with one
    older than ``max_age`` days, are absent.

    One aggregate: the date filter reaches the scan, and each task sends one row
    per entity. Needs the key (date, entity) to be unique, as it is in the
    clean table."""
    day = F.lit(on).cast("date")
    rows = df.where((F.col(date) <= day) & F.col(entity).isNotNull())
    if max_age is not None:
        rows = rows.where(F.col(date) >= F.date_sub(day, max_age))
    # One max_by a column, not one of a struct: numbers fit a hash aggregate.
    last = rows.groupBy(entity).agg(F.max(date).alias("observed"), *[F.max_by(c, date).alias(c) for c in cols])
    return last.select(entity, "observed", F.date_diff(day, "observed").cast("long").alias("age"), *cols)


def top_bottom(snapshot: DataFrame, measure: str, k: int = TOP_K,
               entity: str = ENTITY) -> DataFrame:
    """The ``k`` highest and ``k`` lowest entities by ``measure``, labelled
    ``side`` = top / bottom; ties broken by entity ascending. When fewer than
    2k entities exist the two sides overlap and both rows are kept.

    Each side is a distributed top-k (TakeOrderedAndProject): every task keeps
    k rows, only k x tasks rows reach the final merge."""
    cols = [F.col(entity), F.col(measure)]
    top = (snapshot.select(*cols).orderBy(F.col(measure).desc(), F.col(entity).asc()).limit(k)
           .withColumn("side", F.lit("top")))
    bottom = (snapshot.select(*cols).orderBy(F.col(measure).asc(), F.col(entity).asc()).limit(k)
              .withColumn("side", F.lit("bottom")))
    return top.unionByName(bottom).select("side", entity, measure)
