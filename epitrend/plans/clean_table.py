"""Directory of raw report CSVs -> clean table (stage 1 of the analysis).

    scan_reports -> report_partials (checkpointed) -> finish_partials
      -> qualify_entities -> Parquet

The raw rows are read once for the headers and once for the partial sums;
date choice and roll-up work on the sums.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epitrend import operators as op
from epitrend.config import MIN_ROWS, QUALIFY_DATE, QUALIFY_GT
from epitrend.sources.csv_reports import scan_reports
from epitrend.sources.parquet import write_clean


def report_key(level: str = "file", path_col: str = "source_file") -> Column:
    """Key of one report: its file (one CSV per daily report) or its parent
    directory (a report written by Spark as several part files)."""
    if level == "file":
        return F.col(path_col)
    if level == "directory":
        return F.regexp_extract(F.col(path_col), r"^(.*)/[^/]*$", 1)
    raise ValueError(f"level must be 'file' or 'directory', not {level!r}")


def clean_raw(raw: DataFrame, source: str = "source_file", date_mode: str = "file") -> DataFrame:
    """Raw canonical string rows -> one row per (Date, Country), unqualified.

    The raw rows are read once, into checkpointed partial sums per (report,
    date text, Country). Rows whose date text cannot be parsed are dropped
    (the reference grouped them under a null date); ``op.rejected_rows``
    returns them."""
    return op.finish_partials(op.materialize(op.report_partials(raw, source)), date_mode)


def read_directory(spark: SparkSession, path: str | Sequence[str], glob: str | None = "*.csv",
                   report_level: str = "file", aliases: DataFrame | None = None) -> DataFrame:
    """Raw rows of all report CSVs below ``path`` with their ``report``;
    ``aliases`` (alias, name) renames spelling variants of entities."""
    raw = scan_reports(spark, path, glob).withColumn("report", report_key(report_level))
    return raw if aliases is None else op.rename_entities(raw, aliases)


def ingest_directory(spark: SparkSession, path: str | Sequence[str], glob: str | None = "*.csv",
                     report_level: str = "file", date_mode: str = "file",
                     aliases: DataFrame | None = None) -> DataFrame:
    """All report CSVs below ``path`` -> rolled-up clean rows (unqualified)."""
    return clean_raw(read_directory(spark, path, glob, report_level, aliases), "report", date_mode)


def build_clean_table(spark: SparkSession, path: str | Sequence[str], out: str,
                      glob: str | None = "*.csv", report_level: str = "file",
                      min_rows: int = MIN_ROWS, on: str | dt.date = QUALIFY_DATE,
                      gt: float = QUALIFY_GT, partition_by: Sequence[str] = (),
                      date_mode: str = "file", aliases: DataFrame | None = None,
                      rejects: str | None = None) -> str:
    """Stage 1 end to end: CSV directory -> qualified clean table at ``out``;
    the rows lost by their dates go to ``rejects`` if a path is given."""
    clean = ingest_directory(spark, path, glob, report_level, date_mode, aliases)
    if rejects:
        raw = read_directory(spark, path, glob, report_level, aliases)
        op.rejected_rows(raw, "report", mode=date_mode).write.mode("overwrite").parquet(rejects)
    qualified = op.qualify_entities(clean, min_rows=min_rows, on=on, gt=gt)
    return write_clean(qualified, out, partition_by)
