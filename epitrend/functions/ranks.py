"""Row numbers over a whole table without a task that sees it all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epitrend.session import checkpoint_root


def numbered(df: DataFrame, order: Sequence[str], out: str = "rank") -> DataFrame:
    """``df`` with ``out`` = 1, 2, ... in ascending ``order``, which should be
    unique. Rows are sorted into ranges (their number is the session's), counted
    per range, and numbered within it from the sum of the ranges before."""
    spark = df.sparkSession
    checkpoint_root(spark)
    # Stored: the ranges must not be drawn again by the second reader.
    laid = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = laid.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # A row per range: the only window without a partition is over these.
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(*order)
    return laid.join(starts, "_range").withColumn(out, F.col("_start") + F.row_number().over(inside)) \
        .drop("_range", "_start")
