"""Values as of a date, curve distances, the cost elbow and centre facts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from epitrend import operators as op
from epitrend.functions.ranks import numbered
from epitrend.sources.parquet import read_clean, write_clean

DAY0 = dt.date(2020, 1, 1)


def _clean(spark, rows):
    return spark.createDataFrame(
        [(DAY0 + dt.timedelta(days=d), c, float(v), 0.0, 1.0, v - 1.0) for d, c, v in rows],
        "Date date, Country string, Confirmed double, Deaths double, Recovered double, Active double")


def test_value_as_of_takes_the_last_row(spark):
    df = _clean(spark, [(0, "A", 1), (3, "A", 4), (9, "A", 8), (5, "B", 2), (8, "C", 7), (2, None, 5)])
    on = DAY0 + dt.timedelta(days=5)
    got = sorted(tuple(r)[:4] for r in op.value_as_of(df, on).collect())
    assert got == [("A", DAY0 + dt.timedelta(days=3), 2, 4.0), ("B", on, 0, 2.0)]
    assert [r["Country"] for r in op.value_as_of(df, on, max_age=1).collect()] == ["B"]
    assert op.value_as_of(df, "2019-12-31").count() == 0


def test_value_as_of_pushes_the_date_filter(spark):
    import tempfile

    path = write_clean(_clean(spark, [(d, "A", d) for d in range(20)]), tempfile.mkdtemp(prefix="epitrend-t-"))
    plan = op.value_as_of(read_clean(spark, path), DAY0)._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan and "LessThanOrEqual(Date" in plan and "Window" not in plan
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_curve_distances_equal_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for e in range(12):
        v = 0
        for d in range(50):
            v += rng.choice((0, 1, 3, -1))
            if rng.random() < 0.9:
                rows.append((d, f"E{e}", max(0, v)))
    got = {r["Country"]: r for r in op.curve_distances(_clean(spark, rows), "E0", 10).collect()}
    curve = {}
    for e in {r[1] for r in rows}:
        vs = [v for _, c, v in sorted(rows) if c == e]
        first = next((i for i, v in enumerate(vs) if v >= 10), None)
        if first is not None:
            curve[e] = vs[first:]
    want = {}
    for e in set(curve) - {"E0"}:
        gaps = [abs(a - b) for a, b in zip(curve[e], curve["E0"])]
        want[e] = (len(gaps), sum(gaps) / len(gaps), max(gaps))
    assert set(got) == set(want)
    assert all(tuple(got[e])[1:4] == pytest.approx(want[e]) for e in want)
    order = sorted(want, key=lambda e: (want[e][1], e))
    assert [got[e]["rank"] for e in order] == list(range(1, len(order) + 1))
    with pytest.raises(ValueError, match="never reaches"):
        op.curve_distances(_clean(spark, rows), "nobody", 10)


def test_numbers_over_many_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"))
    rows = numbered(df, ["x"], "n").collect()
    assert sorted(r["x"] for r in rows) == list(range(5000)) and all(r["n"] == r["x"] + 1 for r in rows)
    assert numbered(df.limit(0), ["x"]).count() == 0


def _sweep(spark, costs):
    return spark.createDataFrame(list(costs.items()), "k int, training_cost double")


def test_elbow_is_the_k_farthest_under_the_chord(spark):
    assert op.elbow_k(_sweep(spark, {2: 100.0, 3: 40.0, 4: 30.0, 5: 25.0, 6: 21.0})) == 3
    assert op.elbow_k(_sweep(spark, {2: 100.0, 3: 75.0, 4: 50.0, 5: 25.0, 6: 0.0})) == 2  # a straight line: the first
    assert op.elbow_k(_sweep(spark, {2: 9.0, 3: 9.0, 4: 9.0})) is None
    assert op.elbow_k(_sweep(spark, {2: 9.0, 3: 1.0})) is None and op.elbow_k(_sweep(spark, {})) is None
    # A cost that rises counts as the one before.
    assert op.chord_distances([(2, 10.0), (3, 2.0), (4, 5.0), (5, 0.0)])[4] == pytest.approx(1 - 2 / 3 - 0.2)


def test_center_facts_see_k_and_broken_centres(spark):
    from pyspark.ml.clustering import KMeans

    pts = [(f"E{i}", float(i % 3) * 10 + (i % 5) * 0.1, float(i % 7)) for i in range(210)]
    df = op.assemble_features(spark.createDataFrame(pts, "Country string, x double, y double"), ["x", "y"]).cache()
    for k in (2, 3, 5):
        facts = op.center_facts(op.kmeans_fit(df, k=k), df)
        assert facts["n_centers"] == facts["used"] == k and facts["means_ok"]
    early = KMeans(k=3, seed=1, maxIter=1, initMode="random", featuresCol="features").fit(df)
    assert not op.center_facts(early, df)["means_ok"]
    assert op.center_facts(early, df, max_iter=1)["means_ok"]  # stopped there on purpose
