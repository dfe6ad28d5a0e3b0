"""Whitening, nearest neighbours and hard negatives against brute force."""

import numpy as np
import pytest

from epitrend.llm import hilbert, negatives, vectors, whitening
from tests.conftest import SF01

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def _frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def _rows(n, dim=6, seed=1, labels=3):
    rng = np.random.Generator(np.random.PCG64(seed))
    x = rng.standard_normal((n, dim)).astype(np.float32)
    return [(i, [float(c) for c in x[i]], int(i % labels)) for i in range(n)]


BAD = [(900, None, 1), (901, [], 1), (902, [NAN] * 6, 1), (903, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
       (904, [INF, 0.0, 0.0, 0.0, 0.0, 0.0], 1)]


# ---- whitening ------------------------------------------------------------

def _white(out):
    return {(r["vec_id"], r["component"]): r for r in out.collect()}


def test_whitening_equals_numpy_on_repeated_rows(spark):
    rows = _rows(60) + [(100 + i, _rows(60)[i % 3][1], 0) for i in range(90)] + BAD
    got = _white(whitening.whiten(_frame(spark, rows), components=4))
    good = [r for r in rows if r[0] < 900]
    x = np.floor(np.array([r[1] for r in good], np.float64) * 1024) + 100000
    n, s = len(x), x.sum(axis=0)
    v = (x - s / n).T @ (x - s / n) / n
    e, axes = np.linalg.eigh(v)
    z = (x - s / n) @ axes[:, ::-1][:, :4] / np.sqrt(e[::-1][:4])
    assert len(got) == 4 * n
    for k in range(4):
        mine = np.array([got[r[0], k + 1]["whitened"] for r in good])
        assert min(np.abs(mine - z[:, k]).max(), np.abs(mine + z[:, k]).max()) < 1e-9
        assert abs(got[0, k + 1]["explained"] - e[::-1][k] / np.trace(v)) < 1e-12
    for i, r in enumerate(good):
        one = got[r[0], 1]
        assert one["n"] == n and one["deviation"] == int(((n * x[i] - s) ** 2).sum()) and one["identity_error"] < 1e-9


def test_whitening_weights_of_one_fit_the_distinct_vectors(spark):
    rows = _rows(40)
    copies = rows + [(100 + i, rows[0][1], 0) for i in range(500)]
    once = _white(whitening.whiten(_frame(spark, rows), components=2))
    ones = _white(whitening.whiten(_frame(spark, copies), components=2, weights="one"))
    assert len(ones) == 2 * len(copies)
    for i in range(40):
        for k in (1, 2):
            assert ones[i, k]["n"] == 40 and abs(ones[i, k]["whitened"] - once[i, k]["whitened"]) < 1e-9
    assert all(abs(ones[100 + i, 1]["whitened"] - once[0, 1]["whitened"]) < 1e-9 for i in range(500))


def test_whitening_without_variance_or_rows(spark):
    flat = [(i, [1.0, float(i), 2.0], 0) for i in range(5)]
    got = _white(whitening.whiten(_frame(spark, flat)))
    assert len(got) == 15
    assert [got[0, k]["whitened"] is None for k in (1, 2, 3)] == [False, True, True]
    assert got[0, 1]["explained"] == pytest.approx(1.0) and got[0, 1]["identity_error"] < 1e-9
    same = _white(whitening.whiten(_frame(spark, [(i, [0.5, 0.5], 0) for i in range(4)])))
    assert len(same) == 8 and all(r["whitened"] is None and r["deviation"] == 0 and r["identity_error"] is None
                                  for r in same.values())
    assert whitening.whiten(_frame(spark, BAD)).collect() == []
    assert whitening.whiten(_frame(spark, [])).collect() == []


def test_whitening_null_ids_lengths_and_other_columns(spark):
    rows = [(None, [1.0, 2.0], 0, b"x", 1), (1, [2.0, 1.0], 0, b"x", 2), (1, [2.0, 1.0], 0, b"y", 3),
            (2, [1.0, 2.0, 3.0], 0, b"x", 4), (3, [4.0, 2.0, 9.0], 0, b"x", 5), (4, [2.0 ** 60, 1.0], 0, b"x", 6)]
    out = whitening.whiten(_frame(spark, rows, SCHEMA + ", key binary, w int")).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"], r["component"], r["n"]) for r in out if r["vec_id"] is not None) == sorted(
        [(False, 1, k, 3) for k in (1, 2)] * 2 + [(False, i, k, 2) for i in (2, 3) for k in (1, 2, 3)])
    assert sum(r["vec_id"] is None for r in out) == 2


def test_deviations_beyond_doubles_are_exact():
    n, sums = 3_000_000_019, [300_000_001_900_000_007, -5]
    x = np.array([[100_000_123, 7], [99_999_999, -1]])
    want = [sum((n * int(c) - s) ** 2 for c, s in zip(r, sums)) for r in x]
    assert whitening._deviations(x, n, sums) == [w if w < 1 << 63 else None for w in want]


def test_hot_keys_are_joined_without_a_shuffle_of_their_rows(spark):
    rows = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id as string)) as key")
    table = rows.groupBy("key").count().withColumnsRenamed({"count": "w"}).selectExpr("key", "w", "length(key) as size")
    out = vectors.spread_join(rows, table, "key", "w", 3000)
    assert sorted(out.columns) == ["id", "key", "size"] and out.count() == 3000
    assert out.where("size <> length(key)").count() == 0
    assert "BroadcastHashJoin" in out._jdf.queryExecution().toString()


# ---- neighbours -----------------------------------------------------------

@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 5), (3, 3), (6, 2)])
def test_hilbert_keys_visit_every_cell_by_unit_steps(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    keys = hilbert.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(1 << bits * dims))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def _nearest(rows, every=100, k=10):
    good = {(r[0], tuple(r[1])) for r in rows if r[0] is not None and r[1] and None not in r[1]
            and np.isfinite(r[1]).all() and np.any(r[1])}
    want = []
    for q, x in good:
        if q % every == 0:
            found = sorted((float(np.sqrt(((np.array(x) - np.array(y)) ** 2).sum())), i) for i, y in good
                           if i != q and len(x) == len(y))
            want += [(q, r + 1, i, d) for r, (d, i) in enumerate(found[:k])]
    return sorted(want)


def _equal(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=0, atol=1e-12)


def test_small_tables_are_searched_whole(spark):
    rows = _rows(300) + BAD + [(None, _rows(1)[0][1], 0), (905, [0.0] * 6, 0)]
    rows += rows[:50] + [(1000 + i, [float(i), 1.0], 0) for i in range(4)]  # repeated rows, another length
    df = _frame(spark, rows)
    _equal(sorted(tuple(r) for r in hilbert.search(df).collect()), _nearest(rows))


def test_copies_and_ties_go_by_the_smaller_id(spark):
    x = [1.0, 0.0]
    rows = [(i, x, 0) for i in range(400)] + [(1000 + i, [1.0, 1.0 if i % 2 else -1.0], 0) for i in range(30)]
    _equal(sorted(tuple(r) for r in hilbert.search(_frame(spark, rows)).collect()), _nearest(rows))


def test_few_rows_and_none(spark):
    _equal(sorted(tuple(r) for r in hilbert.search(_frame(spark, _rows(4))).collect()), _nearest(_rows(4)))
    assert hilbert.search(_frame(spark, _rows(1))).collect() == []
    assert hilbert.search(_frame(spark, BAD)).collect() == []
    df = _frame(spark, [(*r, b"z", 7) for r in _rows(5)], SCHEMA + ", cid binary, rank int")
    assert hilbert.search(df).columns == ["query_id", "rank", "vec_id", "score"] and hilbert.search(df).count() == 4


def test_distances_do_not_overflow(spark):
    rows = [(0, [1e200, 0.0], 0), (1, [-1e200, 0.0], 0), (2, [1e200, 1e199], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = [tuple(r) for r in hilbert.search(df).collect()]
    assert [(g[1], g[2]) for g in sorted(got)] == [(1, 2), (2, 1)] and got[0][3] < got[1][3] < INF


def test_calibrated_windows_reach_the_recall(spark, monkeypatch):
    """Blocks and windows far smaller than the table."""
    monkeypatch.setattr(hilbert, "BLOCK", 128)
    monkeypatch.setattr(hilbert, "LEAST", 64)
    rng = np.random.Generator(np.random.PCG64(5))
    centre = rng.standard_normal((60, 16))
    x = centre[rng.integers(0, 60, 3000)] + 0.2 * rng.standard_normal((3000, 16))
    rows = [(i, [float(c) for c in x[i]], 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(r) for r in hilbert.search(df).collect())
    want = _nearest(rows)
    assert len(got) == len(want) == 300
    hits = {g[:1] + g[2:3] for g in got} & {w[:1] + w[2:3] for w in want}
    assert len(hits) >= 0.9 * len(want)
    exact = {(q, i): d for q, _, i, d in want}
    assert all(abs(exact[g[0], g[2]] - g[3]) < 1e-12 for g in got if (g[0], g[2]) in exact)


# ---- hard negatives -------------------------------------------------------

def _negatives(rows):
    good = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and None not in v and np.isfinite(v).all():
            label = (label + 1) % 10 if i % 7 == 0 else label
            good[i, label, tuple(np.floor(np.array(v, float) * 256).astype(int).tolist())] = None
    want = []
    for a, la, x in good:
        if a % 100:
            continue
        scored = sorted((-int(np.dot(x, y)), i, label) for i, label, y in good if i != a and len(x) == len(y))
        for p, i, _ in [s for s in scored if s[2] == la][:5]:
            fit = [(n, j) for n, j, label in scored if label != la and 80 * -p <= 100 * -n <= 100 * -p]
            want += [(a, i, r + 1, j, -p, -n) for r, (n, j) in enumerate(fit[:5])]
    return sorted(want)


def _mined(df):
    return sorted(tuple(r) for r in negatives.mine(df).collect())


def test_negatives_equal_brute_force(spark):
    rows = _rows(700, labels=4) + BAD + [(None, _rows(1)[0][1], 0), (950, _rows(1)[0][1], None)] + _rows(20, labels=4)
    rows += [(2000 + i, [c * 3 for c in _rows(30, seed=3)[i][1]], i % 4) for i in range(30)]  # longer rows
    rows += [(3000 + i, [1.0, float(i)], i % 2) for i in range(6)]  # another length
    want = _negatives(rows)
    assert len(want) > 100 and _mined(_frame(spark, rows)) == want


def test_negatives_with_ties_copies_zeros_and_none(spark):
    same = [(i, [0.5, 0.5], i % 2) for i in range(300)]
    assert _mined(_frame(spark, same)) == _negatives(same) != []
    zeros = [(i, [0.0, 0.0], i % 2) for i in range(12)] + [(100, [-1.0, 0.5], 1), (200, [0.001, 0.001], 0)]
    assert _mined(_frame(spark, zeros)) == _negatives(zeros) != []
    one = [(i, [1.0, float(i)], 2) for i in range(1, 7)] + [(100, [1.0, 1.0], 2)]
    assert _mined(_frame(spark, one)) == _negatives(one)
    assert _mined(_frame(spark, [])) == [] and _mined(_frame(spark, BAD)) == []
    extra = _frame(spark, [(*r, 1, b"") for r in _rows(200)], SCHEMA + ", part int, x binary")
    assert _mined(extra) == _negatives(_rows(200))


def test_candidates_hold_every_row_that_scores_enough():
    rng = np.random.Generator(np.random.PCG64(2))
    pruned = total = 0
    for trial in range(60):
        dim = int(rng.integers(1, 9))
        x = np.floor(rng.standard_normal((200, dim)) * rng.integers(1, 300)).astype("<i8")
        orders = np.argsort(negatives._units(x), axis=0, kind="stable").astype(np.int16).T
        longest = float(np.sqrt((x.astype(float) ** 2).sum(axis=1)).max())
        b = negatives._Bucket(np.arange(200).astype("<i8").tobytes(), x.tobytes(), np.ascontiguousarray(orders).tobytes(), dim, longest)
        q = x[trial] if np.any(x[trial]) else np.ones(dim, np.int64)
        s = x @ q
        for least in (1, int(np.quantile(s, 0.9)), int(s.max()), int(s.max()) + 1):
            hit = set(np.flatnonzero(s >= least).tolist())
            got = set(b.candidates(q, least).tolist())
            assert hit <= got
            pruned, total = pruned + 200 - len(got), total + 200
    assert pruned > 0.4 * total


def test_whole_tables_of_the_smallest_scales(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    assert _mined(df) == _negatives(rows)
