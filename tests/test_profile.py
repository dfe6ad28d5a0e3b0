"""Column profiles and falls against plain counts."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from epitrend.operators import profile as pf

DAY0 = dt.date(2020, 1, 1)


def _frame(spark, n=20_000):
    rng = random.Random(1)
    rows = [(f"r{i % 7}", rng.choice([None, *map(str, range(3000))]), rng.gauss(0, 10) if i % 9 else None,
             rng.randint(0, 50), float("nan") if i % 1000 == 0 else 1.0) for i in range(n)]
    return rows, spark.createDataFrame(rows, "report string, name string, x double, k int, `odd col` double").repartition(6)


def test_profile_is_exact_in_counts_and_within_the_bounds(spark):
    rows, df = _frame(spark)
    path = tempfile.mkdtemp(prefix="epitrend-p-") + "/partials"
    pf.profile_partials(df, "report").write.parquet(path)  # stored, then merged without the data
    got = {r["column"]: r for r in pf.finish_profile(spark.read.parquet(path)).collect()}
    assert set(got) == {"name", "x", "k", "odd col"}
    for at, c in ((1, "name"), (2, "x"), (3, "k")):
        values = [r[at] for r in rows if r[at] is not None]
        assert (got[c]["n"], got[c]["nulls"]) == (len(rows), len(rows) - len(values))
        assert abs(got[c]["distinct"] / len(set(values)) - 1) <= pf.DISTINCT_ERROR
        if c != "name":
            assert (got[c]["low_number"], got[c]["high_number"]) == (min(values), max(values))
            for p, q in ((0.25, "q0_25"), (0.5, "q0_5"), (0.75, "q0_75")):
                below, upto = sum(v < got[c][q] for v in values), sum(v <= got[c][q] for v in values)
                assert below / len(values) - pf.RANK_ERROR <= p <= upto / len(values) + pf.RANK_ERROR
        else:
            assert got[c]["low_number"] is None and got[c]["q0_5"] is None
            assert (got[c]["low"], got[c]["high"]) == (min(values), max(values))
    assert got["odd col"]["high_number"] == 1.0 and got["odd col"]["distinct"] == 2


def test_merging_in_any_order_gives_one_profile(spark):
    _, df = _frame(spark, 3000)
    parts = pf.profile_partials(df, "report")
    one = pf.finish_profile(pf.profile_partials(df.drop("report"))).drop("q0_25", "q0_5", "q0_75")
    halves = pf.merge_profiles(parts.where("key < 'r3'")).unionByName(pf.merge_profiles(parts.where("key >= 'r3'")))
    two = pf.finish_profile(halves).drop("q0_25", "q0_5", "q0_75")
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)
    empty = pf.finish_profile(pf.profile_partials(df.limit(0), "report"))
    assert empty.count() == 0


@pytest.mark.parametrize("spans", [1, 2, 9, 40])
def test_falls_of_any_cut_of_the_calendar(spark, spans):
    rng = random.Random(spans)
    rows = [(DAY0 + dt.timedelta(days=d), f"E{e}", float(rng.randint(0, 5)) if rng.random() < 0.9 else None)
            for e in range(5) for d in range(40) if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "Date date, Country string, v double")
    want = {}
    for e in {r[1] for r in rows}:
        s = [v for _, c, v in sorted(rows, key=lambda r: r[0]) if c == e and v is not None]
        want[e] = (s[0], s[-1], sum(b < a for a, b in zip(s, s[1:])))
    size = -(-40 // spans)
    cut = df.withColumn("span", F.floor(F.date_diff("Date", F.lit(DAY0)) / size))
    got = pf.merge_falls(pf.fall_states(cut, "v", span="span"))
    assert {r["Country"]: (r["first"], r["last"], r["falls"]) for r in got.collect()} == want
    plain = pf.fall_states(df, "v")
    assert {r["Country"]: (r["first"], r["last"], r["falls"]) for r in plain.collect()} == want


def test_falls_shuffle_the_rows_once(spark):
    rows = [(DAY0 + dt.timedelta(days=d), f"E{e}", float(d % 3)) for e in range(3) for d in range(9)]
    df = spark.createDataFrame(rows, "Date date, Country string, v double").withColumn("span", F.trunc("Date", "week"))
    plan = pf.merge_falls(pf.fall_states(df, "v", span="span"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("span", [None, "span"])
def test_falls_with_null_dates(spark, span):
    rows = [(DAY0, "A", 3.0, 1), (None, "A", 9.0, 2), (DAY0 + dt.timedelta(days=1), "A", 1.0, 1), (None, "B", 4.0, 2),
            (DAY0, None, 2.0, 1), (DAY0 + dt.timedelta(days=1), None, 1.0, 1), (DAY0, "C", None, 1)]
    df = spark.createDataFrame(rows, "Date date, Country string, v double, span int")
    got = pf.merge_falls(pf.fall_states(df, "v", span=span)).collect()
    # The value without a date is a row before the dated ones of its span.
    assert {r["Country"]: (r["since"], r["first"], r["last"], r["falls"]) for r in got} == {
        "A": (DAY0, 3.0, 1.0, 1 if span else 2), "B": (None, None, None, 0), None: (DAY0, 2.0, 1.0, 1)}
