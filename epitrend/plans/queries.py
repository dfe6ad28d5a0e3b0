"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the driver tables (through ``epitrend.sources.fixtures``) and
runs one operator of the analysis on the whole tables. Operators on the clean
table read it as stored Parquet (``stored_reports``, built once per session
and scale), as the analysis does; ``parquet_roundtrip`` times building and
writing it from the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epitrend import operators as op
from epitrend.config import KMEANS_K, REFIT_K, SEED, SWEEP_KS
from epitrend.operators import profile as pf
from epitrend.operators.geo import listed_aliases
from epitrend.plans import params as P
from epitrend.plans.clean_table import clean_raw, ingest_directory
from epitrend.plans.refresh import read_refreshed, refresh
from epitrend.session import delete_folder, scratch_path
from epitrend.sources import fixtures as fx
from epitrend.sources.csv_reports import scan_reports, write_report_csvs
from epitrend.streaming import read_rollup, start_ingest
from epitrend.sources.parquet import read_clean, register_view, write_clean

Query = Callable[[SparkSession, str], DataFrame]


# ---- clean table --------------------------------------------------------

def q_daily_rollup(spark, d):
    return op.daily_rollup(fx.report_rows(spark, d))


def q_rename_entities(spark, d):
    """Nations renamed to their regions before the roll-up."""
    return op.daily_rollup(op.rename_entities(fx.report_rows(spark, d), fx.region_names(spark, d)))


def q_qualify_entities(spark, d):
    return op.qualify_entities(fx.stored_customer_reports(spark, d), **P.QUALIFY)


def q_latest_snapshot(spark, d):
    return op.latest_snapshot(fx.stored_customer_reports(spark, d))


def q_as_of_snapshot(spark, d):
    return op.as_of_snapshot(fx.stored_customer_reports(spark, d), P.AS_OF)


def _top_bottom(measure):
    def q(spark, d):
        """Over the last values of all customers, whenever they reported."""
        return op.top_bottom(op.value_as_of(fx.stored_customer_reports(spark, d), P.AS_OF_LATE), measure)
    return q


def q_country_codes(spark, d):
    snapshot = op.latest_snapshot(fx.stored_reports(spark, d))
    return op.country_codes(snapshot, fx.alias_table(spark, d))


def q_parquet_roundtrip(spark, d):
    path = write_clean(fx.reports(spark, d), scratch_path(spark, "clean"))
    return read_clean(spark, path)


def q_register_view(spark, d):
    register_view(fx.stored_customer_reports(spark, d), "epitrend_reports")
    return spark.sql("SELECT * FROM epitrend_reports "
                     "WHERE Date = (SELECT max(Date) FROM epitrend_reports)")


def q_value_as_of(spark, d):
    """The last values of every customer up to a day on which few reported."""
    return op.value_as_of(fx.stored_customer_reports(spark, d), P.AS_OF_LATE)


def q_match_names(spark, d):
    """Misspelt country names resolved against the listed ones, with the number
    of customers that report under each."""
    rows = fx.spelled_reports(spark, d, P.COUNTRY_NAMES)
    listed = spark.createDataFrame(listed_aliases(), "alias string, code string")
    found = op.match_names(rows, listed)
    return rows.groupBy("Country").agg(F.count(F.lit(1)).alias("n")).join(found, "Country") \
        .withColumn("candidates", F.array_join("candidates", ","))


def q_approximate_codes(spark, d):
    listed = spark.createDataFrame(listed_aliases(), "alias string, code string")
    return op.approximate_codes(fx.spelled_reports(spark, d, P.COUNTRY_NAMES), listed)


def q_profile_columns(spark, d):
    """The profile of every column from stored partials per month: exact counts
    and extremes, and whether the sketches keep within their stated bounds."""
    clean = fx.stored_customer_reports(spark, d)
    path = scratch_path(spark, "profile")
    pf.profile_partials(clean.withColumn("month", F.date_format("Date", "yyyy-MM")), "month").write.parquet(path)
    found = pf.finish_profile(spark.read.parquet(path))
    names = clean.columns
    exact = clean.agg(*[F.countDistinct(c).alias(f"d{i}") for i, c in enumerate(names)])
    long = exact.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("d"))
                                            for i, c in enumerate(names)])).alias("r")).select("r.*")
    near = F.abs(F.col("distinct") - F.col("d")) <= pf.DISTINCT_ERROR * F.col("d") + 1
    return found.join(long, "column").select("column", "n", "nulls", "low_number", "high_number", near.alias("distinct_ok"))


def q_series_falls(spark, d):
    """Falls of every customer's active count, from states per quarter."""
    clean = fx.stored_customer_reports(spark, d).withColumn("span", F.trunc("Date", "quarter"))
    return pf.merge_falls(pf.fall_states(clean, "Active", span="span"))


# ---- features (per customer: the rows grow with the tables) ---------------

def q_first_day(spark, d):
    return op.first_day(fx.stored_customer_reports(spark, d))


def q_next_value(spark, d):
    return op.next_value(fx.stored_customer_reports(spark, d)).select("Date", "Country", "Confirmed",
                                                                      "next_Confirmed")


def q_first_crossing(spark, d):
    return op.first_crossing(fx.stored_customer_reports(spark, d), P.THRESHOLD)


def q_series_list(spark, d):
    """The whole ordered list, as text (the quantities are whole numbers)."""
    s = op.series_list(fx.stored_customer_reports(spark, d))
    whole = F.transform("series", lambda x: x.cast("long").cast("string"))
    return s.select("Country", F.size("series").cast("long").alias("length"),
                    F.array_join(whole, ",").alias("series"))


def q_array_index(spark, d):
    return op.array_index(op.series_list(fx.stored_customer_reports(spark, d)), P.THRESHOLD)


def q_days_in_bands(spark, d):
    return op.days_in_bands(fx.stored_customer_reports(spark, d), P.CUSTOMER_BANDS)


def q_band_state(spark, d):
    """Stored states of the first part of the calendar, extended by the rest,
    then finished to the days in bands."""
    clean, path = fx.stored_customer_reports(spark, d), scratch_path(spark, "band-state")
    first = clean.where(F.col("Date") < F.lit(P.BAND_STATE_CUT).cast("date"))
    for part in (first, clean):
        op.extend_band_state(part, path, P.CUSTOMER_BANDS, length="quarter")
    return op.finish_band_states(op.read_band_state(spark, path, P.CUSTOMER_BANDS), P.CUSTOMER_BANDS)


def _features(spark, d):
    return op.feature_table(fx.stored_customer_reports(spark, d), P.CUSTOMER_BANDS)


def q_feature_table(spark, d):
    return _features(spark, d)


def q_unpivot_features(spark, d):
    return op.unpivot_features(_features(spark, d))


def q_transpose_features(spark, d):
    """All nations with features as columns; all that report if none has any."""
    clean = fx.stored_reports(spark, d)
    return op.transpose_features(op.feature_table(clean, P.NATION_BANDS), reports=clean)


def _diffs(spark, d):
    return op.baseline_diff(_features(spark, d), P.BASELINE)


def q_baseline_diff(spark, d):
    return _diffs(spark, d)


def q_similar_by_abs(spark, d):
    return op.similar_entities(_diffs(spark, d), "abs")


def q_similar_by_rel(spark, d):
    return op.similar_entities(_diffs(spark, d), "rel")


def q_compare_curves(spark, d):
    return op.compare_curves(fx.stored_customer_reports(spark, d), *P.CURVES)


def q_nearest_entities(spark, d):
    return op.nearest_entities(_features(spark, d))


def q_curve_distances(spark, d):
    return op.curve_distances(fx.stored_customer_reports(spark, d), P.BASELINE, P.THRESHOLD)


# ---- raw report ingestion -----------------------------------------------

def _normalized(spark, d):
    return op.normalize_headers(fx.raw_report_files(spark, d), keep=P.RAW_KEEP)


def _dated(spark, d):
    return op.detect_dates(_normalized(spark, d), source="file")


def q_normalize_headers(spark, d):
    return _normalized(spark, d)


def q_detect_dates(spark, d):
    return _dated(spark, d).select("event_id", "file", "Country", "last_update", "Date")


def q_detect_dates_row(spark, d):
    return op.detect_dates(_normalized(spark, d), source="file", mode="row") \
        .select("event_id", "file", "Country", "last_update", "Date")


def q_rejected_rows(spark, d):
    return op.rejected_rows(_normalized(spark, d), source="file") \
        .select("event_id", "file", "last_update", "reason")


def q_coerce_measures(spark, d):
    return op.coerce_measures(_dated(spark, d), keep=P.RAW_KEEP)


def q_clean_reports(spark, d):
    return clean_raw(_normalized(spark, d), source="file")


def q_scan_reports(spark, d):
    path = fx.stored_report_csvs(spark, d)
    return scan_reports(spark, path, keep=P.RAW_KEEP).drop("source_file")


def q_ingest_reports(spark, d):
    """Raw report CSVs (one folder per report, each with several part files)
    -> scan -> per-report dates -> measures -> roll-up."""
    return ingest_directory(spark, fx.stored_report_csvs(spark, d, by_report=True),
                            report_level="directory")


def q_stream_ingest_reports(spark, d):
    """The same report folder ingested by the stream (available-now trigger)
    into per-epoch partial sums, then summed again."""
    out = scratch_path(spark, "stream-out")
    query = start_ingest(spark, fx.stored_report_csvs(spark, d, by_report=True), out,
                         report_level="directory")
    query.awaitTermination()
    return read_rollup(spark, out)


def q_refresh_reports(spark, d):
    """A store built from early reports and refreshed after corrections: one
    variant is written again, one report is new and one withdrawn."""
    source, store = scratch_path(spark, "changing-csvs"), scratch_path(spark, "store")
    write_report_csvs(fx.early_report_files(spark, d), source, by_report=True)
    refresh(spark, source, store, report_level="directory")
    write_report_csvs(fx.raw_report_files(spark, d)[1:], source, by_report=True, first=1)
    delete_folder(spark, f"{source}/variant_2")
    refresh(spark, source, store, report_level="directory")
    return read_refreshed(spark, store)


# ---- clustering ---------------------------------------------------------
#
# Labels and scores depend on SparkML's arithmetic, so the queries return facts
# about them that SQL can state on its own.

def _assembled(spark, d):
    return op.assemble_features(_features(spark, d), op.band_columns(P.CUSTOMER_BANDS))


def _laid_out(spark, d):
    # One row per entity, stored once in the fits' layout: the fits and the
    # scoring reread it instead of the whole plan.
    return op.materialize(op.canonical_layout(op.materialize(_assembled(spark, d))))


def q_hash_split(spark, d):
    return op.hash_split(_features(spark, d), seed=SEED).select("Country", "split")


def q_assemble_features(spark, d):
    arr = vector_to_array(F.col("features"))
    n = len(P.CUSTOMER_BANDS)
    return _assembled(spark, d).select("Country", *[arr[i].alias(f"v{i + 1}") for i in range(n)])


def _kmeans(k):
    """Facts about the label of every entity, train or test, and about the
    centres: their number, and that they are their members' means."""
    def q(spark, d):
        rows = _laid_out(spark, d)
        train = op.train_test(rows)[0]
        model = op.kmeans_fit(train, k=k)
        return _with_centers(model, train, op.label_facts(model, op.kmeans_assign(model, rows)))
    return q


def _with_centers(model, train, facts):
    c = op.center_facts(model, train)
    return facts.withColumns({"n_centers": F.lit(c["n_centers"]), "used": F.lit(c["used"]), "means_ok": F.lit(c["means_ok"])})


def q_kmeans_best_k(spark, d):
    """The refit at the k of the best silhouette: facts about every label, and
    whether no k of the sweep scores higher."""
    rows = _laid_out(spark, d)
    train, test = op.train_test(rows)
    sweep = op.materialize(op.k_sweep(train, test, SWEEP_KS))
    k = op.best_k(sweep)
    scores = {r["k"]: r["silhouette"] for r in sweep.collect()}
    best = k is not None and all(s is None or s <= scores[k] for s in scores.values())
    model = op.kmeans_fit(train, k=k)
    return op.label_facts(model, op.kmeans_assign(model, rows)).withColumn("best_k", F.lit(best))


def q_kmeans_elbow(spark, d):
    """The cost curve of the sweep and its knee: per k that the cost is what the
    centres cost, that it does not rise, and that no k lies farther under the
    chord than the chosen one."""
    train, test = op.train_test(_laid_out(spark, d))
    sweep = op.materialize(op.k_sweep(train, test, SWEEP_KS, direct=True))
    rows = sweep.orderBy("k").collect()  # a row per k
    k, away = op.elbow_k(sweep), op.chord_distances([(r["k"], r["training_cost"]) for r in rows])
    out = []
    for i, r in enumerate(rows):
        direct = abs(r["training_cost"] - r["cost_direct"]) <= 1e-9 * r["cost_direct"] \
            or r["stopped"] and r["cost_direct"] <= r["training_cost"]
        falls = i == 0 or r["training_cost"] <= rows[i - 1]["training_cost"]
        out.append((r["k"], direct, falls, k is not None and (away[r["k"]], -r["k"]) <= (away[k], -k)))
    return spark.createDataFrame(out, "k int, equals_direct boolean, not_rising boolean, not_farther boolean")


def q_kmeans_elbow_k(spark, d):
    """The refit at the knee of the cost curve."""
    rows = _laid_out(spark, d)
    train, test = op.train_test(rows)
    k = op.elbow_k(op.k_sweep(train, test, SWEEP_KS))
    model = op.kmeans_fit(train, k=k)
    facts = _with_centers(model, train, op.label_facts(model, op.kmeans_assign(model, rows)))
    return facts.withColumns({"n_centers": F.col("n_centers") == F.lit(k), "used": F.col("used") == F.lit(k)})


def _score_facts(k, rows_scored, centers, score, direct) -> tuple:
    real = score is not None and direct is not None
    return (k, rows_scored, 1 <= centers <= k, real and -1 <= score <= 1 and score != 0,
            real and abs(score - direct) <= 1e-9 * max(1.0, abs(direct)))


_FACTS = "k int, rows_scored long, centers_ok boolean, in_range boolean, equals_direct boolean"


def q_silhouette(spark, d):
    train, test = op.train_test(_laid_out(spark, d))
    model = op.kmeans_fit(train, k=KMEANS_K)
    pred = op.kmeans_assign(model, test)
    row = _score_facts(KMEANS_K, test.count(), op.n_centers(model), op.silhouette(pred),
                       op.silhouette_direct(pred))
    return spark.createDataFrame([row], _FACTS)


def q_k_sweep(spark, d):
    train, test = op.train_test(_laid_out(spark, d))
    n = test.count()
    rows = op.k_sweep(train, test, SWEEP_KS, direct=True).collect()  # a row per k
    return spark.createDataFrame([_score_facts(r["k"], n, r["n_centers"], r["silhouette"], r["silhouette_direct"])
                                  for r in rows], _FACTS)


QUERIES: dict[str, Query] = {
    "daily_rollup": q_daily_rollup,
    "rename_entities": q_rename_entities,
    "qualify_entities": q_qualify_entities,
    "latest_snapshot": q_latest_snapshot,
    "as_of_snapshot": q_as_of_snapshot,
    "top_bottom_confirmed": _top_bottom("Confirmed"),
    "top_bottom_deaths": _top_bottom("Deaths"),
    "top_bottom_recovered": _top_bottom("Recovered"),
    "top_bottom_active": _top_bottom("Active"),
    "country_codes": q_country_codes,
    "parquet_roundtrip": q_parquet_roundtrip,
    "register_view": q_register_view,
    "profile_columns": q_profile_columns,
    "series_falls": q_series_falls,
    "value_as_of": q_value_as_of,
    "match_names": q_match_names,
    "approximate_codes": q_approximate_codes,
    "first_day": q_first_day,
    "next_value": q_next_value,
    "first_crossing": q_first_crossing,
    "series_list": q_series_list,
    "array_index": q_array_index,
    "days_in_bands": q_days_in_bands,
    "band_state": q_band_state,
    "feature_table": q_feature_table,
    "unpivot_features": q_unpivot_features,
    "transpose_features": q_transpose_features,
    "baseline_diff": q_baseline_diff,
    "similar_by_abs": q_similar_by_abs,
    "similar_by_rel": q_similar_by_rel,
    "compare_curves": q_compare_curves,
    "nearest_entities": q_nearest_entities,
    "curve_distances": q_curve_distances,
    "normalize_headers": q_normalize_headers,
    "detect_dates": q_detect_dates,
    "detect_dates_row": q_detect_dates_row,
    "rejected_rows": q_rejected_rows,
    "coerce_measures": q_coerce_measures,
    "clean_reports": q_clean_reports,
    "scan_reports": q_scan_reports,
    "ingest_reports": q_ingest_reports,
    "stream_ingest_reports": q_stream_ingest_reports,
    "refresh_reports": q_refresh_reports,
    "hash_split": q_hash_split,
    "assemble_features": q_assemble_features,
    "kmeans_k5": _kmeans(KMEANS_K),
    "kmeans_k3": _kmeans(REFIT_K),
    "kmeans_best_k": q_kmeans_best_k,
    "kmeans_elbow": q_kmeans_elbow,
    "kmeans_elbow_k": q_kmeans_elbow_k,
    "silhouette": q_silhouette,
    "k_sweep": q_k_sweep,
}
