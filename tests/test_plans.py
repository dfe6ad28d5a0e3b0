import os
import tempfile

from epitrend import operators as op
from epitrend.plans import params as P
from epitrend.plans.analysis import cluster_reports, feature_reports, snapshot_reports
from epitrend.plans.clean_table import build_clean_table, ingest_directory
from epitrend.sources import fixtures as fx
from epitrend.sources.parquet import read_clean
from tests.conftest import SF01

HEAD = "Province/State,Country/Region,Last Update,Confirmed,Deaths,Recovered\n"


def test_build_clean_table_qualifies_and_writes(spark):
    src = tempfile.mkdtemp(prefix="epitrend-src-")
    for day in range(1, 6):
        with open(os.path.join(src, f"05-0{day}-2020.csv"), "w") as fh:
            fh.write(HEAD + f"a,Mexico,5/{day}/2020 10:00,{100 * day},1,2\n"
                            f"b,Mexico,5/{day}/2020 10:00,{300 * day},0,0\n"
                            f"c,Peru,5/{day}/2020 10:00,{10 * day},0,0\n")
    out = os.path.join(tempfile.mkdtemp(prefix="epitrend-out-"), "clean")
    build_clean_table(spark, src, out, min_rows=5, on="2020-05-03", gt=350)
    clean = read_clean(spark, out)
    rows = {(r["Date"].day, r["Country"]): r for r in clean.collect()}
    assert {c for _, c in rows} == {"Mexico"}          # Peru never exceeds 350
    assert rows[(3, "Mexico")]["Confirmed"] == 1200.0
    assert rows[(3, "Mexico")]["Active"] == 1200.0 - 3.0
    assert ingest_directory(spark, src).count() == 10  # before qualification


def test_analysis_compositions(spark):
    clean = fx.reports(spark, SF01)
    snaps = snapshot_reports(clean)
    assert snaps["snapshot"].count() == 25
    assert snaps["top_bottom_active"].count() == 10
    dated = snapshot_reports(clean, on="1998-06-01")["snapshot"]
    assert {r["Date"].isoformat() for r in dated.collect()} == {"1998-06-01"}
    feats = feature_reports(clean, P.NATION_BANDS, "NATION_0", compare_with=["NATION_1"])
    assert feats["features"].count() == 25
    assert feats["diffs"].count() == 24
    assert feats["curves_NATION_1"].select("Country").distinct().count() == 2
    res = cluster_reports(feats["features"], op.band_columns(P.NATION_BANDS), ks=[2, 3],
                          refit_k=None)
    assert res["refit_k"] in (2, 3)
    assert res["all_assignments"].count() == 25


def test_clean_table_aliases_rejects_and_row_mode(spark):
    src = tempfile.mkdtemp(prefix="epitrend-src-")
    with open(os.path.join(src, "a.csv"), "w") as fh:
        fh.write(HEAD + "a,Mexcio,5/1/2020 10:00,100,0,0\nb,Mexico,2020-05-01 10:00,300,0,0\nc,Peru,5/1/2020 10:00,900,0,0\n")
    aliases = spark.createDataFrame([("mexcio", "Mexico")], "alias string, name string")
    base = tempfile.mkdtemp(prefix="epitrend-out-")
    for mode, want, lost in (("file", {"Peru": 900.0}, 1), ("row", {"Mexico": 400.0, "Peru": 900.0}, 0)):
        out, rejects = os.path.join(base, mode), os.path.join(base, f"{mode}-rejects")
        build_clean_table(spark, src, out, min_rows=1, on="2020-05-01", gt=150, date_mode=mode,
                          aliases=aliases, rejects=rejects)
        assert {r["Country"]: r["Confirmed"] for r in read_clean(spark, out).collect()} == want
        assert spark.read.parquet(rejects).count() == lost


def test_clustering_reads_the_features_once(spark):
    """Fits and scores reread the stored rows: the feature plan's jobs do not
    grow with the number of fits."""
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(len(b))
            yield b

    feats = op.feature_table(fx.reports(spark, SF01), P.NATION_BANDS)
    counted = feats.mapInPandas(seen, feats.schema)
    cluster_reports(counted, op.band_columns(P.NATION_BANDS), ks=[2, 3, 4])
    assert reads.value == 25
