import datetime as dt
import random

from epitrend import operators as op
from epitrend.config import band_column

BANDS = ((1, 10), (1, 100), (5, 20), (20, 50), (50, 60))
SCHEMA = "Date date, Country string, Confirmed double"
START = dt.date(2020, 1, 1)


def _series_df(spark, series):
    rows = [(START + dt.timedelta(days=i), name, float(v))
            for name, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)


def _reference_rule(values, lo, up):
    """The band rule step by step: positive rows in date order; keep rows >= lo;
    first row below up and first row at or above up; the earlier one is the
    lower limit, the later one the upper limit; days = position of the upper
    value - position of the lower value + 1, positions found by value in the
    whole list (first occurrence, 1-based)."""
    pos_values = [v for v in values if v > 0]
    kept = [(i, v) for i, v in enumerate(pos_values) if v >= lo]
    first_in = next(((i, v) for i, v in kept if v < up), None)
    first_over = next(((i, v) for i, v in kept if v >= up), None)
    firsts = sorted(x for x in (first_in, first_over) if x is not None)
    if len(firsts) < 2:
        return None
    lower, upper = firsts[0][1], firsts[1][1]
    position = {}
    for i, v in enumerate(pos_values):
        position.setdefault(v, i + 1)
    return position[upper] - position[lower] + 1


def _random_series(rng, n):
    if rng.random() < 0.5:
        x, out = 0, []
        for _ in range(n):
            x += rng.choice([0, 0, 1, 2, 5, 13])
            out.append(x)
        return out
    return [max(0, int(rng.gauss(30, 25))) for _ in range(n)]


def test_days_in_bands_equals_step_by_step_rule(spark):
    rng = random.Random(7)
    series = {f"E{i}": _random_series(rng, rng.randint(1, 40)) for i in range(300)}
    out = {r["Country"]: r for r in op.days_in_bands(_series_df(spark, series), BANDS).collect()}
    mismatches = []
    for name, values in series.items():
        for lo, up in BANDS:
            want = _reference_rule(values, lo, up)
            got = out[name][band_column(lo, up)] if name in out else None
            if want != got:
                mismatches.append((name, lo, up, want, got))
    assert not mismatches, mismatches[:5]


def test_band_crossed_before_entering(spark):
    # reaches 60 on day 2, falls back into [20, 50) on day 4: |4 - 2| + 1 = 3 rows
    df = _series_df(spark, {"X": [0, 10, 60, 55, 30]})
    row = op.days_in_bands(df, [(20, 50)]).collect()[0]
    assert row[band_column(20, 50)] == 3


def test_feature_table_drops_incomplete(spark):
    df = _series_df(spark, {"A": [0, 1, 5, 12, 30, 70], "B": [0, 1, 2, 3]})
    out = op.feature_table(df, [(1, 10), (10, 50)]).collect()
    assert [r["Country"] for r in out] == ["A"]
    assert out[0]["FirstDay"] == START + dt.timedelta(days=1)
    assert out[0][band_column(1, 10)] == 3 and out[0][band_column(10, 50)] == 3


def test_first_day_next_value_and_crossing(spark):
    df = _series_df(spark, {"A": [0, 0, 3, 120, 150]})
    assert op.first_day(df).collect()[0]["FirstDay"] == START + dt.timedelta(days=2)
    nxt = {r["Date"]: r["next_Confirmed"] for r in op.next_value(df).collect()}
    assert nxt[START] == 0.0 and nxt[START + dt.timedelta(days=4)] is None
    c = op.first_crossing(df, 100).collect()[0]
    assert (c["below_index"], c["above_index"]) == (1, 2)
    assert c["above_date"] == START + dt.timedelta(days=3)


def test_series_list_and_array_index(spark):
    rows = [(START + dt.timedelta(days=i), "A", float(v)) for i, v in enumerate([0, 4, 100, 90, 130])]
    rows.reverse()  # arrival order must not matter
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    s = op.series_list(df)
    assert s.collect()[0]["series"] == [4.0, 100.0, 90.0, 130.0]
    idx = op.array_index(s, 95).collect()[0]
    assert (idx["value"], idx["position"]) == (100.0, 2)
    none = op.array_index(s, 1000).collect()[0]
    assert none["value"] is None and none["position"] is None
