"""A stored clean table that follows its folder of reports.

The source "is updated regularly": files arrive, are corrected and vanish.
``refresh`` brings a store up to date by reading only the files that changed
and rewriting only the dates that they touch:

    <store>/files/version=<n>     the files of the table: path, length, time of
                                  modification, report, batch of their partials
    <store>/partials/batch=<n>    mergeable sums per (file, date text, Country)
    <store>/daily/Date=<d>        what each report adds to date d
    <store>/table/Date=<d>        the clean table
    <store>/pending               the refresh under way

1. The folder is listed and compared with the last version: a file whose length
   or time differs is a new version of it, whose sums replace the old ones.
2. Changed files are scanned into partial sums of a new batch.
3. The reports of changed files are dated anew, before and after the change, as
   a report's date pattern follows from all its rows. The dates of either side
   are the affected ones.
4. On the affected dates, these reports' rows of ``daily`` are replaced and the
   table's rows summed again, both by dynamic partition overwrite; dates that
   no report has any more are deleted. All other dates keep their files.
5. The new version of ``files`` is written last. A refresh that dies is done
   again by the next one: ``pending`` names its reports and dates, so whatever
   it may have written is replaced, even if files changed in the meantime.

The sums add up whole numbers exactly in any order; the table equals that of
``ingest_directory`` over the same files. Readers may see a refresh half done;
one refresh may run at a time. A file rewritten with the same length and time
of modification is not seen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)

from epitrend import operators as op
from epitrend.config import ENTITY, MEASURES
from epitrend.plans.clean_table import report_key
from epitrend.session import delete_folder, folder_names
from epitrend.sources.csv_reports import literal_path, scan_reports
from epitrend.sources.headers import list_files
from epitrend.sources.parquet import CLEAN_SCHEMA

MAX_PATHS = 10_000  # changed files that are scanned by their paths, more by a scan of the folder

_SUMS = [StructField("n_rows", LongType()), StructField("n_valid", LongType()),
         *[StructField(m, DoubleType()) for m in MEASURES]]
_FILES = StructType([StructField("file", StringType()), StructField("length", LongType()),
                     StructField("modified", TimestampType()), StructField("report", StringType()),
                     StructField("batch", IntegerType())])
_PARTIALS = StructType([StructField("file", StringType()), StructField("report", StringType()),
                        StructField("date_text", StringType()), StructField(ENTITY, StringType()), *_SUMS,
                        StructField("batch", IntegerType())])
_DAILY = StructType([StructField("report", StringType()), StructField(ENTITY, StringType()),
                     *[StructField(m, DoubleType()) for m in MEASURES], StructField("Date", DateType())])
_PENDING = StructType([StructField("report", StringType()), StructField("Date", DateType())])


@dataclass(frozen=True)
class Refreshed:
    """What a refresh did: files by kind of change and dates rewritten."""

    version: int
    added: int
    rewritten: int
    removed: int
    dates: tuple


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    if not folder_names(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _version(spark: SparkSession, store: str) -> int:
    """The last version that was written whole; 0 without any."""
    found = [int(n.split("=")[1]) for n in folder_names(spark, f"{store}/files") if n.startswith("version=")]
    return max((n for n in found if "_SUCCESS" in folder_names(spark, f"{store}/files/version={n}")), default=0)


def _files(spark: SparkSession, store: str, version: int) -> DataFrame:
    return _read(spark, f"{store}/files/version={version}", _FILES) if version else spark.createDataFrame([], _FILES)


def _live(spark: SparkSession, store: str, files: DataFrame, reports: DataFrame | None = None) -> DataFrame:
    """The partial sums of ``files``, or those of some reports: what a batch
    holds of files that were rewritten since does not count."""
    parts = _read(spark, f"{store}/partials", _PARTIALS)
    if reports is not None:
        parts = parts.join(reports, "report", "left_semi")
    return parts.join(files.select("file", "batch"), ["file", "batch"], "left_semi")


def _overwrite_dates(spark: SparkSession, rows: DataFrame, path: str, dates: list) -> None:
    """Replace the folders of ``dates`` by ``rows``, whose dates are among them."""
    rows.repartition("Date").sortWithinPartitions(ENTITY).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("Date").parquet(path)
    kept = {r[0] for r in rows.select("Date").distinct().collect()}
    for d in dates:
        if d not in kept:
            delete_folder(spark, f"{path}/Date={d.isoformat()}")


def _scan_changed(spark: SparkSession, source, glob: str | None, changed: DataFrame) -> DataFrame:
    paths = [r["file"] for r in changed.select("file").limit(MAX_PATHS + 1).collect()]
    if len(paths) > MAX_PATHS:
        return scan_reports(spark, source, glob).join(changed.select(F.col("file").alias("source_file")), "source_file", "left_semi")
    decoded = [r["p"] for r in spark.createDataFrame([(p,) for p in paths], "f string")
               .select(F.url_decode(F.replace("f", F.lit("+"), F.lit("%2B"))).alias("p")).collect()]
    return scan_reports(spark, [literal_path(p) for p in decoded], None)


def refresh(spark: SparkSession, source: str | list[str], store: str, glob: str | None = "*.csv",
            report_level: str = "file", date_mode: str = "file") -> Refreshed:
    """Bring the table below ``store`` up to the files below ``source``."""
    version = _version(spark, store)
    old = op.materialize(_files(spark, store, version))
    now = list_files(spark, source, glob).withColumn("report", report_key(report_level, "file"))
    was = old.withColumnsRenamed({c: f"old_{c}" for c in old.columns})
    same = F.col("length").eqNullSafe(F.col("old_length")) & F.col("modified").eqNullSafe(F.col("old_modified"))
    compared = op.materialize(now.join(was, F.col("file") == F.col("old_file"), "full_outer").withColumn(
        "kind", F.when(F.col("old_file").isNull(), "added").when(F.col("file").isNull(), "removed")
        .when(same, "same").otherwise("rewritten")))
    counts = {r["kind"]: r["count"] for r in compared.groupBy("kind").count().collect()}
    changes = compared.where("kind <> 'same'")
    pending = op.materialize(_read(spark, f"{store}/pending", _PENDING))
    if not any(counts.get(k) for k in ("added", "rewritten", "removed")) and pending.isEmpty():
        return Refreshed(version, 0, 0, 0, ())
    batch = version + 1
    files = op.materialize(compared.where("kind <> 'removed'").select(
        "file", "length", "modified", "report",
        F.when(F.col("kind") == "same", F.col("old_batch")).otherwise(F.lit(batch)).cast("int").alias("batch")))

    # Overwritten by the next try if this one dies: no version names it yet.
    fresh = changes.where("kind <> 'removed'")
    target = f"{store}/partials/batch={batch}"
    if fresh.isEmpty():
        delete_folder(spark, target)
    else:
        sums = op.report_partials(_scan_changed(spark, source, glob, fresh), "source_file").withColumnRenamed("report", "file")
        sums.withColumn("report", report_key(report_level, "file")).select(*[f.name for f in _PARTIALS if f.name != "batch"]) \
            .sortWithinPartitions("report").write.mode("overwrite").parquet(target)

    reports = op.materialize(changes.select(F.coalesce("report", "old_report").alias("report"))
                             .unionByName(pending.select("report").where("report is not null")).distinct())
    before = op.dated_partials(op.materialize(op.merge_partials(_live(spark, store, old, reports))), date_mode)
    after = op.materialize(op.dated_partials(op.materialize(op.merge_partials(_live(spark, store, files, reports))), date_mode))
    # A row per calendar day at most.
    dates = sorted(r[0] for r in before.select("Date").unionByName(after.select("Date")).unionByName(
        pending.select("Date").where("Date is not null")).distinct().collect())
    reports.select("report", F.lit(None).cast("date").alias("Date")).unionByName(
        spark.createDataFrame([(None, d) for d in dates], _PENDING)).write.mode("overwrite").parquet(f"{store}/pending")

    if dates:
        kept = _read(spark, f"{store}/daily", _DAILY).where(F.col("Date").isin(dates)).join(reports, "report", "left_anti")
        daily = op.materialize(kept.select(*_DAILY.names).unionByName(after.select(*_DAILY.names)))
        _overwrite_dates(spark, daily, f"{store}/daily", dates)
        _overwrite_dates(spark, op.sum_dated(daily), f"{store}/table", dates)
    files.write.mode("overwrite").parquet(f"{store}/files/version={batch}")
    delete_folder(spark, f"{store}/pending")
    return Refreshed(batch, *(counts.get(k, 0) for k in ("added", "rewritten", "removed")), tuple(dates))


def compact(spark: SparkSession, store: str) -> int:
    """Rewrite the live partial sums as one batch and delete all others and old
    versions; the tables stay as they are. The new version is the switch: up to
    it the old batches count, from it the new one."""
    version = _version(spark, store)
    if not version:
        return 0
    files = op.materialize(_files(spark, store, version))
    batch = version + 1
    _live(spark, store, files).drop("batch").sortWithinPartitions("report").write.mode("overwrite") \
        .parquet(f"{store}/partials/batch={batch}")
    files.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{store}/files/version={batch}")
    for folder, key in (("partials", "batch"), ("files", "version")):
        for name in folder_names(spark, f"{store}/{folder}"):
            if name.startswith(f"{key}=") and int(name.split("=")[1]) < batch:
                delete_folder(spark, f"{store}/{folder}/{name}")
    return batch


def read_refreshed(spark: SparkSession, store: str) -> DataFrame:
    """The clean table (unqualified), one folder per date."""
    names = [f.name for f in CLEAN_SCHEMA]
    return _read(spark, f"{store}/table", StructType([*[f for f in CLEAN_SCHEMA if f.name != "Date"], CLEAN_SCHEMA["Date"]])) \
        .select(*names)
