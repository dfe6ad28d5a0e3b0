"""Report files arrive in a folder over time; ingest only the new ones.

A file-source stream lists new report files (``binaryFile`` with only the
``path`` column selected, so no content is read by the stream itself). Each
micro-batch writes the mergeable partial sums of its own files (per report,
date text and Country) to ``<out>/partials/epoch=<id>``, overwriting that
folder: a batch replayed after a failure rewrites the same output.

The date pattern of a report is chosen when the sums are read, over all
epochs, so the result is that of batch ingestion however the part files of a
report are spread over batches. The stream's own checkpoint lies in the
output folder, so starting it again on one folder goes on where it stopped.

Every ``compact_every`` epochs the sums so far are merged into a base,
``<out>/base/upto=<id>``, so a reader opens one base and the epochs after it
however long the stream has run. A base counts from the moment its write is
committed: that is the switch. Only epochs that the stream's checkpoint has
committed are merged, as the last one may still be replayed. What a base
replaces is deleted when the next one is there, so readers that began before
the switch can finish.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType)

from epitrend import operators as op
from epitrend.config import ENTITY, MEASURES
from epitrend.plans.clean_table import report_key
from epitrend.session import delete_folder, folder_names
from epitrend.sources.csv_reports import literal_path, scan_reports

COMPACT_EVERY = 100

# The binaryFile source's fixed schema (streams need it up front).
_BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
PARTIALS = StructType([StructField("report", StringType()), StructField("date_text", StringType()),
                       StructField(ENTITY, StringType()), StructField("n_rows", LongType()),
                       StructField("n_valid", LongType()),
                       *[StructField(m, DoubleType()) for m in MEASURES]])


def start_ingest(spark: SparkSession, source_dir: str, out_dir: str,
                 checkpoint: str | None = None, glob: str = "*.csv",
                 report_level: str = "file", max_files_per_trigger: int = 1000,
                 available_now: bool = True, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Start the ingestion stream; ``available_now`` processes what is there
    and stops, otherwise it keeps watching ``source_dir``.

    ``checkpoint`` defaults to a folder inside ``out_dir``; one output folder
    must always be used with the same checkpoint. ``max_files_per_trigger``
    only bounds the size of a batch: the result does not depend on it.
    ``compact_every`` epochs are merged into a base (0: never)."""
    state = checkpoint or f"{out_dir}/_checkpoint"
    files = (spark.readStream.format("binaryFile").schema(_BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", max_files_per_trigger)
             .load(source_dir)
             .select("path"))

    def ingest_batch(batch: DataFrame, epoch: int) -> None:
        # Paths of this batch only (bounded by maxFilesPerTrigger).
        paths = [literal_path(r["path"]) for r in batch.collect()]
        if paths:
            raw = scan_reports(spark, paths, glob=None).withColumn("report", report_key(report_level))
            op.report_partials(raw, "report").write.mode("overwrite").parquet(
                f"{out_dir}/partials/epoch={epoch}")
        if compact_every and epoch and epoch % compact_every == 0:
            compact_epochs(spark, out_dir, state)

    writer = (files.writeStream.foreachBatch(ingest_batch)
              .option("checkpointLocation", state))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def _numbers(spark: SparkSession, path: str, key: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in folder_names(spark, path) if re.fullmatch(rf"{key}=\d+", n))


def _bases(spark: SparkSession, out_dir: str) -> list[int]:
    """The bases whose write was committed."""
    return [n for n in _numbers(spark, f"{out_dir}/base", "upto")
            if "_SUCCESS" in folder_names(spark, f"{out_dir}/base/upto={n}")]


def _sums(spark: SparkSession, out_dir: str, upto: int | None = None) -> tuple[DataFrame | None, list[str]]:
    """The last base and the epochs after it (up to ``upto``), and their folders."""
    base = max(_bases(spark, out_dir), default=-1)
    folders = [f"{out_dir}/base/upto={base}"] if base >= 0 else []
    folders += [f"{out_dir}/partials/epoch={e}" for e in _numbers(spark, f"{out_dir}/partials", "epoch")
                if e > base and (upto is None or e <= upto)]
    return (spark.read.schema(PARTIALS).parquet(*folders) if folders else None), folders


def compact_epochs(spark: SparkSession, out_dir: str, checkpoint: str | None = None) -> int | None:
    """Merge the last base and all committed epochs after it into a new base;
    returns the last epoch in it, or None if there is nothing to merge. Done
    again after a failure at any point it gives the same base."""
    committed = [int(n) for n in folder_names(spark, f"{checkpoint or f'{out_dir}/_checkpoint'}/commits") if n.isdigit()]
    upto = max(committed, default=-1)
    before = _bases(spark, out_dir)
    if upto < 0 or upto <= max(before, default=-1):
        return None
    parts, folders = _sums(spark, out_dir, upto)
    if parts is None:
        return None
    # Epochs without new sums have no folder; the base still moves past them.
    op.merge_partials(parts).write.mode("overwrite").parquet(f"{out_dir}/base/upto={upto}")
    if before:  # readers of the base before this one's predecessor are long gone
        for e in _numbers(spark, f"{out_dir}/partials", "epoch"):
            if e <= max(before):
                delete_folder(spark, f"{out_dir}/partials/epoch={e}")
        for b in _numbers(spark, f"{out_dir}/base", "upto"):
            if b < max(before):
                delete_folder(spark, f"{out_dir}/base/upto={b}")
    return upto


def read_rollup(spark: SparkSession, out_dir: str, date_mode: str = "file") -> DataFrame:
    """The clean table so far, from the last base and the epochs after it."""
    parts = _sums(spark, out_dir)[0]
    if parts is None:
        parts = spark.createDataFrame([], PARTIALS)
    return op.finish_partials(op.materialize(op.merge_partials(parts)), date_mode)
