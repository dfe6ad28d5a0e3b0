"""Comparisons of entities' feature rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epitrend.config import BASELINE, DATE, ENTITY, TOP_K
from epitrend.functions.ranks import numbered
from epitrend.functions.sizing import broadcast_if_bounded


MAX_ENTITIES = 2000  # columns of a whole transpose

_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _feature_cols(features: DataFrame, cols: Sequence[str] | None, entity: str) -> list[str]:
    """``cols``, or every numeric column but the entity."""
    return list(cols) if cols else [c for c, t in features.dtypes if c != entity
                                    and (t in _NUMBERS or t.startswith("decimal"))]


def unpivot_features(features: DataFrame, cols: Sequence[str] | None = None,
                     entity: str = ENTITY) -> DataFrame:
    """Long form ``entity, feature, value``: one row per entity and feature
    (a projection, no shuffle)."""
    names = _feature_cols(features, cols, entity)
    return features.unpivot([f"`{entity}`"], [f"`{c}`" for c in names], "feature", "value")


def _held_entities(rows: DataFrame, entity: str, most: int) -> list[str]:
    """The entities of ``rows`` in order, up to ``most``."""
    found = rows.select(entity).where(F.col(entity).isNotNull()).distinct().orderBy(entity).limit(most).collect()
    return [r[0] for r in found]


def transpose_features(features: DataFrame, entities: Sequence[str] | None = None,
                       cols: Sequence[str] | None = None, entity: str = ENTITY,
                       max_entities: int = MAX_ENTITIES, reports: DataFrame | None = None) -> DataFrame:
    """Features as rows and entities as columns (values keep their type): the
    listed ones, or all that ``features`` holds, in order. If it holds none, as
    when every entity skips a band, the table has no rows; its columns are then
    the entities of ``reports``, or ``feature`` alone. A column per entity
    bounds the table's width, so more than ``max_entities`` raise; use
    ``unpivot_features`` there. One conditional aggregate per entity gives the
    pivot with a single exchange."""
    if entities is None:
        entities = _held_entities(features, entity, max_entities + 1)
        if not entities and reports is not None:
            entities = _held_entities(reports, entity, max_entities + 1)
    names = list(entities)
    if len(names) > max_entities:
        raise ValueError(f"more than {max_entities} entities to transpose; unpivot_features has no such bound")
    long = unpivot_features(features.where(F.col(entity).isin(names)), cols, entity)
    if not names:
        return long.select("feature").distinct()
    return long.groupBy("feature").agg(
        *[F.max(F.when(F.col(entity) == e, F.col("value"))).alias(str(e)) for e in names])


def baseline_diff(features: DataFrame, baseline: str = BASELINE,
                  cols: Sequence[str] | None = None, entity: str = ENTITY) -> DataFrame:
    """For every entity other than ``baseline``: ``abs_total_diff`` =
    sum |x_i - b_i| and ``rel_total_diff`` = sum (x_i - b_i) over the feature
    columns, as doubles. Fails with a clear message if the baseline has no
    feature row.

    The baseline row is one scalar subquery (an array of its features,
    referenced once), so the feature table is neither joined nor shuffled,
    and the entity filter reaches the scan of the subquery's input."""
    names = _feature_cols(features, cols, entity)
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in names])
    base = features.where(F.col(entity) == baseline).select(values).scalar()
    base = F.coalesce(base, F.raise_error(
        F.lit(f"baseline {baseline!r} has no row in the feature table")))
    paired = (features.where(F.col(entity) != baseline)
              .select(F.col(entity), values.alias("_x"), base.alias("_b")))
    diffs = paired.select(entity, F.zip_with("_x", "_b", lambda x, b: x - b).alias("_d"))
    zero = F.lit(0.0)
    return diffs.select(
        F.col(entity), F.lit(baseline).alias("baseline"),
        F.aggregate("_d", zero, lambda acc, x: acc + F.abs(x)).alias("abs_total_diff"),
        F.aggregate("_d", zero, lambda acc, x: acc + x).alias("rel_total_diff"),
    )


def similar_entities(diffs: DataFrame, by: str = "abs", k: int = TOP_K,
                     entity: str = ENTITY) -> DataFrame:
    """The ``k`` most similar and ``k`` most different entities to the
    baseline, labelled ``category``: by ``abs_total_diff`` (``by="abs"``) or
    by |``rel_total_diff``| (``by="rel"``); ties broken by entity."""
    if by == "abs":
        key = F.col("abs_total_diff")
    elif by == "rel":
        key = F.abs(F.col("rel_total_diff"))
    else:
        raise ValueError(f"by must be 'abs' or 'rel', not {by!r}")
    cols = ["category", entity, "abs_total_diff", "rel_total_diff"]
    similar = (diffs.orderBy(key.asc(), F.col(entity).asc()).limit(k)
               .withColumn("category", F.lit("most_similar")))
    different = (diffs.orderBy(key.desc(), F.col(entity).asc()).limit(k)
                 .withColumn("category", F.lit("most_different")))
    return similar.select(*cols).unionByName(different.select(*cols))


def compare_curves(df: DataFrame, a: str, b: str, entity: str = ENTITY,
                   date: str = DATE) -> DataFrame:
    """The rows of entities ``a`` and ``b``, ordered by entity and date."""
    return df.where(F.col(entity).isin(a, b)).orderBy(entity, date)


def aligned_curves(df: DataFrame, threshold: float, measure: str = "Confirmed", entity: str = ENTITY,
                   date: str = DATE) -> DataFrame:
    """``entity, index, value``: every curve from its first row at or above
    ``threshold`` on (index 0), one index per reported row. One window per
    entity, bounded by the calendar; rows before the crossing are dropped."""
    w = Window.partitionBy(entity).orderBy(date)
    value = F.col(measure)
    crossed = df.withColumn("_over", F.max((value >= threshold).cast("int")).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where("_over = 1")
    return crossed.select(entity, (F.row_number().over(w) - 1).cast("long").alias("index"), value.alias("value"))


def curve_distances(df: DataFrame, baseline: str, threshold: float, measure: str = "Confirmed",
                    entity: str = ENTITY, date: str = DATE, max_days: int = 100_000) -> DataFrame:
    """How close every entity's curve is to that of ``baseline``, both counted
    from their first crossing of ``threshold``: ``n_common`` indexes that both
    have, ``mean_gap`` and ``max_gap`` of their values there, and ``rank``, 1 for
    the closest (ties by entity). Entities that never cross have no row; a
    ``baseline`` that never crosses raises ``ValueError``.

    An equi-join on the index with the baseline's curve, which has a row per
    calendar day at most and is broadcast behind that check. ``rank`` is counted
    in sorted ranges, not in one task."""
    curves = aligned_curves(df, threshold, measure, entity, date)
    base = aligned_curves(df.where(F.col(entity) == baseline), threshold, measure, entity, date)
    if base.isEmpty():
        raise ValueError(f"baseline {baseline!r} never reaches {threshold}")
    base = broadcast_if_bounded(base.select("index", F.col("value").alias("_base")), max_days)
    gap = F.abs(F.col("value") - F.col("_base"))
    others = curves.where(F.col(entity) != baseline)
    gaps = others.join(base, "index").groupBy(entity).agg(
        F.count(F.lit(1)).alias("n_common"), F.avg(gap).alias("mean_gap"), F.max(gap).alias("max_gap"))
    return numbered(gaps, ["mean_gap", entity], "rank")
