"""Report CSV directories whose headers drift between files.

A single ``spark.read.csv(dir)`` binds columns by position, so files with
another header would be read silently wrong. Instead the files are read as
lines of text, for any path and any size:

1. ``file_headers`` finds the first non-blank line of every file (a row per
   file, checkpointed): tasks open the files and stop after that line
   (``headers``), or, where they cannot, read the text once. Only the distinct
   headers come to the driver, where each is resolved to column positions.
2. ``scan_reports`` joins every line with the positions of its file, parses it
   with ``from_csv`` and picks the canonical columns. All headers share one
   scan. No path is ever fed back into a reader.

Lines end as in Spark's CSV reader (LF, CRLF or CR), blank lines are skipped,
and compressed files are read through their codec.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from epitrend.config import ENTITY, LAST_UPDATE, MEASURES
from epitrend.functions.columns import strip_bom
from epitrend.functions.sizing import broadcast_if_bounded
from epitrend.operators.ingest import resolve_header
from epitrend.session import checkpoint_root
from epitrend.sources.headers import list_files, openable, opened_headers

MAX_FILES_BROADCAST = 200_000
CANONICAL = (ENTITY, LAST_UPDATE, *MEASURES)


def literal_path(path: str) -> str:
    """``path`` with glob characters escaped: it names exactly one file."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _without_bom(col: str) -> Column:
    return F.replace(F.col(col), F.lit("\ufeff"), F.lit(""))


def _lines(spark: SparkSession, paths: Sequence[str], glob: str | None) -> DataFrame:
    """``value, file, start``: the non-blank lines of all files."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return (reader.text(list(paths))
            .select("value", F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("start"))
            .where(F.length(F.trim(_without_bom("value"))) > 0))


def _scanned_headers(lines: DataFrame) -> DataFrame:
    # The first line is that of the least split; within a split the generated
    # ids rise with the rows. One row per file leaves each task.
    placed = lines.withColumn("place", F.struct("start", F.monotonically_increasing_id().alias("id")))
    return placed.groupBy("file").agg(F.min_by("value", "place").alias("header"))


def _headers(spark: SparkSession, paths: Sequence[str], glob: str | None) -> DataFrame:
    """``file, header``, checkpointed."""
    checkpoint_root(spark)
    files = list_files(spark, paths, glob)
    one = files.select("file").first()
    if one is not None and openable(one["file"]):
        found = opened_headers(files).checkpoint(eager=True)
        if found.where(~F.col("readable")).isEmpty():
            return found.where("header is not null").select("file", "header")
    return _scanned_headers(_lines(spark, paths, glob)).checkpoint(eager=True)


def _names(header: str, sep: str, quote: str) -> list[str]:
    return [strip_bom(n) for n in next(csv.reader([header], delimiter=sep, quotechar=quote))]


def file_headers(spark: SparkSession, path: str | Sequence[str], glob: str | None = "*.csv") -> DataFrame:
    """``file, header``: the header line of every non-empty file."""
    return _headers(spark, [path] if isinstance(path, str) else list(path), glob)


def discover_headers(spark: SparkSession, path: str | Sequence[str], glob: str | None = "*.csv",
                     sep: str = ",", quote: str = '"') -> list[tuple[list[str], int]]:
    """``[(header names, number of files)]``, one entry per distinct header."""
    rows = file_headers(spark, path, glob).groupBy("header").count().orderBy("header").collect()
    return [(_names(r["header"], sep, quote), r["count"]) for r in rows]


def _positions(names: list[str], keep: Sequence[str]) -> list[int | None]:
    """Position of every canonical and kept column; names are compared
    without surrounding blanks, a kept column may be missing."""
    pos = resolve_header(names)
    clean = [strip_bom(n).strip() for n in names]
    return [*(pos[c] for c in CANONICAL), *(clean.index(k) if k in clean else None for k in keep)]


def scan_reports(spark: SparkSession, path: str | Sequence[str], glob: str | None = "*.csv",
                 keep: Sequence[str] = (), sep: str = ",", quote: str = '"',
                 escape: str = "\\") -> DataFrame:
    """All report CSVs under ``path`` as one DataFrame with the canonical
    string columns ``Country, last_update, Confirmed, Deaths, Recovered``,
    the columns named in ``keep`` (null where a file lacks them) and
    ``source_file``. Raises ``ValueError`` naming a file whose header has
    no country, last-update or measure column. A line equal to its file's
    header is a header wherever it stands, as in files joined end to end.

    ``path`` may hold glob characters, as in any Spark reader; ``literal_path``
    escapes them."""
    paths = [path] if isinstance(path, str) else list(path)
    lines = _lines(spark, paths, glob)
    # Joined by digest: text that is not UTF-8 would not come back unchanged.
    headers = _headers(spark, paths, glob).withColumn("key", F.sha2("header", 256))
    distinct = headers.groupBy("key").agg(F.first("header").alias("header"), F.min("file").alias("file"),
                                          F.count(F.lit(1)).alias("n")).orderBy("header").collect()
    if not distinct:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in (*CANONICAL, *keep, "source_file")))
    known, width = [], 0
    for row in distinct:
        names = _names(row["header"], sep, quote)
        width = max(width, len(names))
        try:
            known.append((row["key"], *_positions(names, keep)))
        except ValueError as e:
            raise ValueError(f"{e} ({row['n']} files, one of them {row['file']})") from None
    columns = [*CANONICAL, *keep]
    schema = StructType([StructField("key", StringType()),
                         *[StructField(f"_p{i}", IntegerType()) for i in range(len(columns))]])
    # A row per file: broadcast within a checked bound, else joined by shuffle.
    files = headers.join(F.broadcast(spark.createDataFrame(known, schema)), "key").drop("key") \
        .withColumnRenamed("header", "_header")
    files = broadcast_if_bounded(files, MAX_FILES_BROADCAST)
    row_schema = StructType([StructField(f"_c{i}", StringType()) for i in range(width)])
    options = {"sep": sep, "quote": quote, "escape": escape, "mode": "PERMISSIVE"}
    parsed = (lines.join(files, "file").where(_without_bom("value") != _without_bom("_header"))
              .withColumn("_row", F.from_csv("value", row_schema.simpleString()[7:-1].replace(":", " "), options)))
    fields: Column = F.array(*[F.col(f"_row._c{i}") for i in range(width)])
    picked = [F.get(F.col("_fields"), F.col(f"_p{i}")).alias(name) for i, name in enumerate(columns)]
    return parsed.withColumn("_fields", fields).select(*picked, F.col("file").alias("source_file"))


def write_report_csvs(files: Sequence[DataFrame], path: str, by_report: bool = False,
                      report_col: str = "file", first: int = 0) -> str:
    """Write each header variant below ``path`` as CSV with a header line, in
    folders numbered from ``first``.

    Spark writes every variant in parallel as several part files, each
    carrying its variant's header, like a directory of daily reports. With
    ``by_report`` each report (``report_col``) gets its own folder."""
    for i, df in enumerate(files, first):
        w = df.write.mode("overwrite").options(header=True)
        (w.partitionBy(report_col) if by_report else w).csv(f"{path}/variant_{i}")
    return path
