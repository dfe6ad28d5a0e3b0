import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from epitrend import operators as op

COLS = [f"days_f{i}" for i in range(2, 9)]


def _features(spark, rows):
    return spark.createDataFrame(rows, "Country string, " + ", ".join(f"{c} long" for c in COLS))


def test_golden_example(spark):
    f = _features(spark, [("B", 10, 4, 1, 9, 8, 8, 10), ("Mexico", 3, 6, 2, 2, 8, 10, 7)])
    row = op.baseline_diff(f, "Mexico").collect()
    assert len(row) == 1
    assert (row[0]["Country"], row[0]["abs_total_diff"], row[0]["rel_total_diff"]) == ("B", 22, 12)


def test_missing_baseline_is_clear_error(spark):
    f = _features(spark, [("B", 10, 4, 1, 9, 8, 8, 10)])
    with pytest.raises((PySparkException, Py4JJavaError), match="baseline 'Mexico'"):
        op.baseline_diff(f, "Mexico").collect()


def test_similar_entities(spark):
    rows = [("M", 0, 0, 0, 0, 0, 0, 0)] + [(f"E{i}", i, -i, 0, 0, 0, 0, 0) for i in range(1, 8)]
    diffs = op.baseline_diff(_features(spark, rows), "M")
    out = op.similar_entities(diffs, "abs", k=2).collect()
    assert [(r["category"], r["Country"]) for r in out] == [
        ("most_similar", "E1"), ("most_similar", "E2"),
        ("most_different", "E7"), ("most_different", "E6")]
    rel = op.similar_entities(diffs, "rel", k=2).collect()
    # every relative total is 0 here: ties broken by entity
    assert [r["Country"] for r in rel] == ["E1", "E2", "E1", "E2"]


def test_unpivot_and_transpose(spark):
    f = _features(spark, [("A", 1, 2, 3, 4, 5, 6, 7), ("B", 7, 6, 5, 4, 3, 2, 1)])
    assert op.unpivot_features(f).count() == 14
    t = {r["feature"]: r for r in op.transpose_features(f, ["B", "A", "Z"]).collect()}
    assert t["days_f2"]["A"] == 1 and t["days_f2"]["B"] == 7 and t["days_f2"]["Z"] is None


def test_compare_curves(spark):
    import datetime as dt
    df = spark.createDataFrame(
        [(dt.date(2020, 1, d), c, float(d)) for d in (2, 1) for c in ("A", "B", "C")],
        "Date date, Country string, Confirmed double")
    out = [(r["Country"], r["Date"].day) for r in op.compare_curves(df, "C", "A").collect()]
    assert out == [("A", 1), ("A", 2), ("C", 1), ("C", 2)]


def test_differences_are_double(spark):
    f = spark.createDataFrame([("M", 1.1, 2), ("E", 1.9, 2)], "Country string, x double, y long")
    df = op.baseline_diff(f, "M")
    assert [t for c, t in df.dtypes if c.endswith("_diff")] == ["double", "double"]
    row = df.collect()[0]
    assert row["abs_total_diff"] == pytest.approx(0.8) and row["rel_total_diff"] == pytest.approx(0.8)


def test_fractional_bands_run_through(spark):
    import datetime as dt

    rows = [(dt.date(2020, 1, d + 1), c, v) for c, s in (("M", (0.2, 0.7, 2.0, 2.6)), ("E", (0.6, 1.0, 3.0, 4.0)))
            for d, v in enumerate(s)]
    df = spark.createDataFrame(rows, "Date date, Country string, Confirmed double")
    bands = [(0.5, 2.5), (0.5, 1.5)]
    feats = op.feature_table(df, bands)
    assert op.band_columns(bands) == ["days_0_5_to_2_5", "days_0_5_to_1_5"]
    assert op.unpivot_features(feats).count() == 4 and op.baseline_diff(feats, "M").count() == 1
    got = op.assemble_features(feats, op.band_columns(bands))
    assert got.columns == [*feats.columns, "features"] and got.count() == 2


def test_odd_column_names(spark):
    f = spark.createDataFrame([("M", 1, 2), ("E", 5, 2)], "Country string, `a.b` long, `c d` long")
    assert op.unpivot_features(f).count() == 4
    assert op.baseline_diff(f, "M").collect()[0]["abs_total_diff"] == 4.0
    assert op.assemble_features(f, ["a.b", "c d"]).columns == ["Country", "a.b", "c d", "features"]


def test_transpose_of_all_entities(spark):
    f = _features(spark, [("A", 1, 2, 3, 4, 5, 6, 7), ("B.x", 7, 6, 5, 4, 3, 2, 1)])
    t = op.transpose_features(f)
    assert t.columns == ["feature", "A", "B.x"] and t.count() == 7
    with pytest.raises(ValueError, match="more than 1"):
        op.transpose_features(f, max_entities=1)


def test_transpose_without_entities(spark):
    f = _features(spark, [("A", 1, 2, 3, 4, 5, 6, 7), ("B", 7, 6, 5, 4, 3, 2, 1)])
    none = f.where("Country = 'Z'")
    for t, cols in ((op.transpose_features(none), []), (op.transpose_features(f, []), []),
                    (op.transpose_features(none, reports=f), ["A", "B"])):
        assert t.columns == ["feature", *cols] and t.count() == 0
    assert op.transpose_features(f.where("Country = 'A'"), reports=f).columns == ["feature", "A"]
    with pytest.raises(ValueError, match="more than 1"):
        op.transpose_features(none, reports=f, max_entities=1)


def test_transpose_query_when_all_nations_skip_a_band(spark, tmp_path):
    """Many orders on the first day: no nation is ever within the first band."""
    import datetime as dt

    import duckdb

    from epitrend.plans.oracle import ORACLE_SQL
    from epitrend.plans.queries import QUERIES

    rows = {
        "nation": ([(i, f"NATION_{i}") for i in range(25)], "n_nationkey int, n_name string"),
        "customer": ([(i, i) for i in range(25)], "c_custkey long, c_nationkey int"),
        "orders": ([(i, dt.datetime(1995, 1, 1 + d), "F", "2-HIGH") for i in range(25) for d in range(3)
                    for _ in range(20)],
                   "o_custkey long, o_orderdate timestamp, o_orderstatus string, o_orderpriority string"),
    }
    duck = duckdb.connect()
    for t, (held, schema) in rows.items():
        spark.createDataFrame(held, schema).coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    got = QUERIES["transpose_features"](spark, str(tmp_path))
    want = duck.execute(ORACLE_SQL["transpose_features"])
    assert sorted(got.columns) == sorted(c[0] for c in want.description)
    assert [tuple(r) for r in got.collect()] == want.fetchall() == []
