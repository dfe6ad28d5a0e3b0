"""The pruned neighbour search against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from epitrend import operators as op
from epitrend.operators import neighbours as nb
from epitrend.plans import params as P
from epitrend.sources import fixtures as fx
from tests.conftest import SF001


def _brute(rows, k):
    out = {}
    for name, *x in rows:
        near = sorted((sum(abs(a - b) for a, b in zip(x, y)), other) for other, *y in rows if other != name)
        out[name] = [(n, float(d)) for d, n in near[:k]]
    return out


def _found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["Country"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["Country"], [])) + 1
        out[r["Country"]].append((r["neighbour"], r["distance"]))
    return out


@pytest.mark.parametrize("n, k, block", [(300, 5, 16), (300, 3, 64), (7, 5, 4), (1, 5, 4)])
def test_equals_all_pairs(spark, n, k, block):
    rng = random.Random(n + k)
    rows = [(f"E{i}", *[rng.randint(0, 6) + 20 * (i % 4) for _ in range(4)]) for i in range(n)]  # many ties
    df = spark.createDataFrame(rows, "Country string, a int, b int, c int, d int").repartition(5)
    want = {e: v for e, v in _brute(rows, k).items() if v}
    assert _found(nb.nearest_entities(df, k, block_rows=block)) == want


def test_clusters_are_pruned_and_nulls_take_no_part(spark):
    rng = np.random.default_rng(3)
    rows = [(f"E{i}", *[float(v) for v in rng.normal(50 * (i % 10), 1, 3)]) for i in range(1000)]
    df = spark.createDataFrame(rows + [(None, 1.0, 1.0, 1.0), ("N", None, 1.0, 1.0)], "Country string, a double, b double, c double")
    done, every = nb.compared_pairs(df, 5, block_rows=32)
    assert every == 1002 ** 2 and done < 0.15 * every
    got = _found(nb.nearest_entities(df, 5, block_rows=32))
    want = _brute(rows, 5)
    assert {e: [n for n, _ in v] for e, v in got.items()} == {e: [n for n, _ in v] for e, v in want.items()}
    assert nb.nearest_entities(df.limit(0)).count() == 0


def test_agrees_with_the_baseline_comparison(spark):
    feats = op.feature_table(fx.customer_reports(spark, SF001), P.CUSTOMER_BANDS).cache()
    got = _found(nb.nearest_entities(feats))
    diffs = op.similar_entities(op.baseline_diff(feats, P.BASELINE), "abs").where("category = 'most_similar'")
    assert sorted(got[P.BASELINE]) == sorted((r["Country"], r["abs_total_diff"]) for r in diffs.collect())
    same = feats.withColumn("days_1_to_100", F.lit(1).cast("bigint"))
    assert len(_found(nb.nearest_entities(same.select("Country", "days_1_to_100")))) == feats.count()  # all equal


def test_curve_places_interleave_bins():
    edges = [np.arange(1, 16, dtype=float)] * 2
    away = np.array([[0.0, 0.0], [15, 0], [0, 15], [15, 15], [1, 0]])
    assert nb.curve_place(away, edges).tolist() == [0, 0b10101010, 0b01010101, 0b11111111, 0b10]


def test_pivots_lie_apart():
    x = np.array([[0.0, 0], [0, 1], [10, 0], [10, 1], [5, 9]])
    got = nb.spread_pivots(x, 3)
    assert len({tuple(p) for p in got}) == 3 and len(nb.spread_pivots(np.ones((4, 2)), 3)) == 1


def test_equal_vectors_are_not_searched(spark):
    rows = [(f"E{i:04}", float(i % 50), float(i % 25), 0.0 if i % 2 else -0.0) for i in range(2000)]
    df = spark.createDataFrame(rows, "Country string, a double, b double, c double").repartition(7)
    assert nb.compared_pairs(df, 5, block_rows=16) == (0, 2000 ** 2)
    assert _found(nb.nearest_entities(df, 5, block_rows=16)) == _brute(rows, 5)


@pytest.mark.parametrize("copies, k", [(2, 5), (5, 5), (6, 5), (3, 1)])
def test_few_equal_rows_count_as_neighbours(spark, copies, k):
    rng = random.Random(copies)
    rows = [(f"E{i}", *[rng.choice([0.1, 0.7, 2.5, 40.0]) + i // copies % 9 for _ in range(3)]) for i in range(0, 240, copies)]
    rows = [(f"{e}x{c}", *x) for e, *x in rows for c in range(copies)] + [("far", 1e6, 0.0, 0.0), ("odd", float("inf"), 0.0, 0.0)]
    df = spark.createDataFrame(rows, "Country string, a double, b double, c double").repartition(5)
    want = _brute([r for r in rows if r[0] != "odd"], k)
    got = _found(nb.nearest_entities(df, k, block_rows=8))
    assert {e: [n for n, _ in v] for e, v in got.items()} == {e: [n for n, _ in v] for e, v in want.items()}
