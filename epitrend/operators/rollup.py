"""Daily roll-up and entity qualification."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitrend.config import DATE, ENTITY, MIN_ROWS, QUALIFY_DATE, QUALIFY_GT
from epitrend.functions.sizing import broadcast_if_bounded

_SUMMED = ("Confirmed", "Deaths", "Recovered", "Active")


def daily_rollup(df: DataFrame, date: str = DATE, entity: str = ENTITY) -> DataFrame:
    """One row per (Date, entity) with the four measures summed.

    A hash aggregate with a map-side partial sum: a hot entity is reduced
    to one row per date in every task before the shuffle."""
    return df.groupBy(date, entity).agg(*[F.sum(m).alias(m) for m in _SUMMED])


def qualify_entities(df: DataFrame, min_rows: int = MIN_ROWS,
                     on: str | dt.date = QUALIFY_DATE, measure: str = "Confirmed",
                     gt: float = QUALIFY_GT, entity: str = ENTITY, date: str = DATE,
                     max_entities: int = 1_000_000) -> DataFrame:
    """Rows of entities with at least ``min_rows`` rows and a ``measure``
    strictly above ``gt`` on date ``on``. An entity without a row on ``on``
    is dropped.

    One grouped aggregate gives the qualifying entities (one row each); it
    is checkpointed, broadcast when at most ``max_entities`` rows, and
    applied as a left-semi join, so the clean table itself is not shuffled."""
    on_date = F.lit(on).cast("date")
    stats = df.groupBy(entity).agg(
        F.count(F.lit(1)).alias("_n"),
        F.bool_or((F.col(date) == on_date) & (F.col(measure) > gt)).alias("_hit"),
    )
    keep = stats.where((F.col("_n") >= min_rows) & F.col("_hit")).select(entity)
    keep = broadcast_if_bounded(keep, max_entities, materialize=True)
    return df.join(keep, entity, "left_semi")
