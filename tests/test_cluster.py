import math

import pytest
from pyspark.sql import functions as F

from epitrend import operators as op
from epitrend.plans import params as P
from epitrend.sources import fixtures as fx
from tests.conftest import SF001


@pytest.fixture(scope="module")
def assembled(spark):
    feats = op.feature_table(fx.customer_reports(spark, SF001), P.CUSTOMER_BANDS)
    return op.assemble_features(feats, op.band_columns(P.CUSTOMER_BANDS)).cache()


def test_split_is_a_partition_and_layout_free(assembled):
    s1 = {r["Country"]: r["split"] for r in op.hash_split(assembled).collect()}
    s2 = {r["Country"]: r["split"] for r in op.hash_split(assembled.repartition(7)).collect()}
    assert s1 == s2 and set(s1.values()) <= {"train", "test"}
    train, test = op.train_test(assembled)
    tr = {r["Country"] for r in train.collect()}
    te = {r["Country"] for r in test.collect()}
    assert not (tr & te) and (tr | te) == set(s1)


def _sqdist(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def test_kmeans_invariants(assembled):
    train, test = op.train_test(assembled)
    model = op.kmeans_fit(train, k=5)
    centers = model.clusterCenters()
    pred = op.kmeans_assign(model, assembled).collect()
    assert len(pred) == assembled.count()
    for r in pred:
        assert 0 <= r["prediction"] < len(centers)
        d = [_sqdist(r["features"], c) for c in centers]
        assert d[r["prediction"]] == pytest.approx(min(d))


def test_kmeans_same_fit_for_any_input_layout(assembled):
    train, _ = op.train_test(assembled)
    costs = {round(op.kmeans_fit(train.repartition(n), k=3).summary.trainingCost, 6)
             for n in (1, 3, 9)}
    assert len(costs) == 1


def test_silhouette_range_and_single_cluster(spark, assembled):
    model = op.kmeans_fit(assembled, k=3)
    s = op.silhouette(op.kmeans_assign(model, assembled))
    assert s is not None and -1.0 <= s <= 1.0
    one = op.kmeans_assign(model, assembled).withColumn("prediction", F.lit(0))
    assert op.silhouette(one) is None


def test_fewer_points_than_k(spark):
    df = spark.createDataFrame([("A", 1.0, 1.0), ("B", 1.0, 1.0), ("C", 5.0, 5.0)],
                               "Country string, x double, y double")
    model = op.kmeans_fit(op.assemble_features(df, ["x", "y"]), k=5)
    assert op.n_centers(model) <= 2


def test_k_sweep_rows(assembled):
    train, test = op.train_test(assembled)
    sweep = op.k_sweep(train, test, [2, 3]).collect()
    assert [r["k"] for r in sweep] == [2, 3]
    for r in sweep:
        assert r["training_cost"] >= 0 and 1 <= r["n_centers"] <= r["k"]
        assert r["silhouette"] is None or -1 <= r["silhouette"] <= 1
        assert not (isinstance(r["silhouette"], float) and math.isnan(r["silhouette"]))


def test_sweep_matches_single_fits(assembled):
    train, test = op.train_test(assembled)
    sweep = {r["k"]: r for r in op.k_sweep(train, test, [2, 4]).collect()}
    serial = {r["k"]: r for r in op.k_sweep(train, test, [2, 4], parallelism=1).collect()}
    for k in (2, 4):
        # tree aggregation sums partial costs in task-completion order, so
        # the last digit may differ between any two runs
        assert sweep[k]["n_centers"] == serial[k]["n_centers"]
        assert sweep[k]["training_cost"] == pytest.approx(serial[k]["training_cost"], rel=1e-12)
        assert sweep[k]["silhouette"] == pytest.approx(serial[k]["silhouette"])
    for k in (2, 4):
        model = op.kmeans_fit(train, k=k)
        assert sweep[k]["training_cost"] == pytest.approx(model.summary.trainingCost)


def _brute_silhouette(points, labels):
    import numpy as np

    x = np.asarray(points, dtype=float)
    y = np.asarray(labels)
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)  # squared Euclidean
    scores = []
    for i in range(len(x)):
        own = y == y[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, y == c].mean() for c in set(y.tolist()) if c != y[i])
        scores.append((b - a) / max(a, b))
    return float(np.mean(scores))


def test_silhouette_equals_brute_force(assembled):
    for k in (2, 3, 5):
        pred = op.kmeans_assign(op.kmeans_fit(assembled, k=k), assembled).collect()
        want = _brute_silhouette([r["features"].toArray() for r in pred],
                                 [r["prediction"] for r in pred])
        got = op.silhouette(op.kmeans_assign(op.kmeans_fit(assembled, k=k), assembled))
        assert got == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_training_cost_equals_brute_force(assembled):
    train, _ = op.train_test(assembled)
    model = op.kmeans_fit(train, k=4)
    centers = model.clusterCenters()
    want = sum(min(_sqdist(r["features"], c) for c in centers) for r in train.collect())
    assert model.summary.trainingCost == pytest.approx(want, rel=1e-9)


def test_direct_silhouette_equals_brute_force(assembled):
    for k in (2, 5):
        pred = op.kmeans_assign(op.kmeans_fit(assembled, k=k), assembled)
        rows = pred.collect()
        want = _brute_silhouette([r["features"].toArray() for r in rows], [r["prediction"] for r in rows])
        assert op.silhouette_direct(pred) == pytest.approx(want, rel=1e-9)
    assert op.silhouette_direct(pred.withColumn("prediction", F.lit(0))) is None


def test_broken_labels_are_noticed(assembled):
    model = op.kmeans_fit(assembled, k=3)
    pred = op.kmeans_assign(model, assembled)
    good = op.label_facts(model, pred)
    assert good.where("label_ok and nearest_ok").count() == assembled.count() > 0
    turned = pred.withColumn("prediction", (F.col("prediction") + 1) % 3)
    assert op.label_facts(model, turned).where("nearest_ok").count() < assembled.count() / 2
    outside = pred.withColumn("prediction", F.lit(7))
    assert op.label_facts(model, outside).where("label_ok or nearest_ok").count() == 0


def test_fine_ratios_and_empty_sides(spark, assembled):
    df = spark.range(20000).select(F.col("id").cast("string").alias("Country"))
    for ratio, low, high in ((0.999, 1, 60), (0.004, 19840, 19980)):
        n = op.hash_split(df, ratio).where("split = 'test'").count()
        assert low <= n <= high
    with pytest.raises(ValueError, match="no training rows"):
        op.kmeans_fit(assembled.limit(0), k=2)
    with pytest.raises(ValueError, match="no training rows"):
        op.k_sweep(assembled.limit(0), assembled, [2])


def test_layout_follows_the_rows():
    assert [op.layout_partitions(n) for n in (0, 1, 50_000, 50_001, 1_000_000)] == [1, 1, 1, 2, 20]
