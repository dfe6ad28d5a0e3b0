"""Parquet sink/source of the clean table and named views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType

CLEAN_SCHEMA = StructType([
    StructField("Date", DateType()),
    StructField("Country", StringType()),
    StructField("Confirmed", DoubleType()),
    StructField("Deaths", DoubleType()),
    StructField("Recovered", DoubleType()),
    StructField("Active", DoubleType()),
])


def write_clean(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                sort_by: Sequence[str] = ("Date",)) -> str:
    """Overwrite ``path`` with ``df`` as Parquet. ``partition_by`` (e.g.
    ``["Date"]``) lets later date filters prune whole folders; ``sort_by``
    orders rows inside each task (no shuffle), so row-group min/max
    statistics are narrow and pushed date filters skip row groups."""
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """Read a clean table written by ``write_clean``."""
    return spark.read.parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a temp view and return ``spark.table(name)``, the
    hand-off between code that builds a table and SQL that reads it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
