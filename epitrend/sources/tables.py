"""Driver tables (one Parquet file per table)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Relation handles of the read-only driver tables, per path: the file
# listing and footer read happen once instead of once per query. An entry is
# reused only by the same live session object; only the logical relation is
# kept, no data.
_RELATIONS: dict[str, tuple[SparkSession, DataFrame]] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Read ``<sf_dir>/<name>.parquet``; selecting ``columns`` prunes the scan."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    hit = _RELATIONS.get(path)
    if hit is not None and hit[0] is spark and spark.sparkContext._jsc is not None:
        df = hit[1]
    else:
        df = spark.read.parquet(path)
        _RELATIONS[path] = (spark, df)
    return df.select(*columns) if columns else df
