"""Mergeable band states against ``days_in_bands``."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from epitrend import operators as op
from epitrend.operators import band_state as bs
from epitrend.sources.parquet import read_clean, write_clean

BANDS = ((1, 5), (1, 10), (5, 10), (10, 20), (0.5, 2.5))
DAY0 = dt.date(2020, 1, 1)


def _clean(spark, rows):
    return spark.createDataFrame([(DAY0 + dt.timedelta(days=d), c, float(v)) for d, c, v in rows],
                                 "Date date, Country string, Confirmed double")


def _random_rows(seed, days=60, entities=6):
    rng = random.Random(seed)
    out = []
    for e in range(entities):
        v = 0
        for d in range(days):
            v = max(0, v + rng.choice((-3, 0, 0, 1, 1, 2, 4)))
            if rng.random() < 0.8:
                out.append((d, f"E{e}", v))
    return out


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_any_cut_of_the_calendar_gives_the_same_days(spark, seed):
    rng = random.Random(seed)
    df = _clean(spark, _random_rows(seed)).cache()
    want = _rows(op.days_in_bands(df, BANDS, first=True))
    cuts = sorted(rng.sample(range(1, 60), rng.choice((1, 5, 30)))) if seed else []
    starts = [DAY0 + dt.timedelta(days=c) for c in [0, *cuts]]
    span = F.array_max(F.filter(F.array(*map(F.lit, starts)), lambda s: s <= F.col("Date")))
    states = bs.band_states(df.withColumn("span", span), BANDS).cache()
    assert _rows(bs.finish_band_states(states, BANDS, first=True)) == want
    # Associative: merged in two steps, grouped at random borders.
    borders = [starts[0], *sorted(rng.sample(starts, min(3, len(starts))))]
    group = F.array_max(F.filter(F.array(*map(F.lit, borders)), lambda s: s <= F.col("span")))
    halves = bs.merge_band_states(states.withColumn("half", group), BANDS, into="half")
    assert _rows(bs.finish_band_states(halves, BANDS, first=True)) == want


def _stored(d):
    return {n: sorted((f, os.stat(os.path.join(d, n, f)).st_mtime_ns) for f in os.listdir(os.path.join(d, n)))
            for n in os.listdir(d) if n.startswith("span=")}


def test_extension_reads_only_the_new_days(spark):
    rows = _random_rows(7, days=100)
    want = _rows(op.days_in_bands(_clean(spark, rows), BANDS))
    table, state = tempfile.mkdtemp(prefix="epitrend-t-"), tempfile.mkdtemp(prefix="epitrend-s-")
    write_clean(_clean(spark, [r for r in rows if r[0] < 45]), table, ["Date"])
    bs.extend_band_state(read_clean(spark, table), state, BANDS)
    old = _stored(state)
    for name in os.listdir(table):  # the old days can no longer be read
        for f in os.listdir(os.path.join(table, name)) if name.startswith("Date=") else []:
            with open(os.path.join(table, name, f), "wb") as fh:
                fh.write(b"gone")
    write_clean(_clean(spark, [r for r in rows if r[0] >= 45]), table + "/new", ["Date"])
    for name in os.listdir(table + "/new"):
        if name.startswith("Date="):
            os.rename(os.path.join(table, "new", name), os.path.join(table, name))
    clean = spark.read.schema("Country string, Confirmed double, Date date").parquet(table)
    written = bs.extend_band_state(clean, state, BANDS)
    assert min(written) == DAY0 + dt.timedelta(days=45)
    assert {n: f for n, f in _stored(state).items() if n in old} == old
    assert _rows(bs.finish_band_states(bs.read_band_state(spark, state, BANDS), BANDS)) == want
    assert bs.extend_band_state(clean, state, BANDS) == []


@pytest.mark.parametrize("length", ["week", "month", "year"])
def test_corrected_dates_write_their_spans_alone(spark, length):
    rows = _random_rows(3, days=120)
    state = tempfile.mkdtemp(prefix="epitrend-s-")
    bs.extend_band_state(_clean(spark, rows), state, BANDS, length=length)
    old = _stored(state)
    fixed = [(d, c, v + 7 if d == 40 else v) for d, c, v in rows if d != 41] + [(200, "E0", 3)]
    days = [DAY0 + dt.timedelta(days=d) for d in (40, 41, 200)]
    written = bs.extend_band_state(_clean(spark, fixed), state, BANDS, changed=days, length=length)
    kept = {n for n, f in _stored(state).items() if old.get(n) == f}
    assert len(kept) == len(old) - len([s for s in written if f"span={s}" in old]) and 2 <= len(written) <= 3
    got = bs.finish_band_states(bs.read_band_state(spark, state, BANDS), BANDS, first=True)
    assert _rows(got) == _rows(op.days_in_bands(_clean(spark, fixed), BANDS, first=True))


def test_spans_that_lose_all_rows_and_dates_before_the_first(spark):
    rows = [(40, "A", 3.0), (80, "A", 9.0), (81, "B", 2.0)]
    state = tempfile.mkdtemp(prefix="epitrend-s-")
    bs.extend_band_state(_clean(spark, rows), state, BANDS)
    fixed = [(2, "B", 1.0), (80, "A", 9.0), (81, "B", 2.0), (90, "A", 12.0)]
    days = [DAY0 + dt.timedelta(days=d) for d in (2, 40)]
    bs.extend_band_state(_clean(spark, fixed), state, BANDS, changed=days)
    want = _rows(op.days_in_bands(_clean(spark, fixed), BANDS, first=True))
    assert _rows(bs.finish_band_states(bs.read_band_state(spark, state, BANDS), BANDS, first=True)) == want
    gone = [(80, "A", 9.0), (81, "B", 2.0), (90, "A", 12.0)]
    bs.extend_band_state(_clean(spark, gone), state, BANDS, changed=days[:1])
    want = _rows(op.days_in_bands(_clean(spark, gone), BANDS, first=True))
    assert _rows(bs.finish_band_states(bs.read_band_state(spark, state, BANDS), BANDS, first=True)) == want
    assert _rows(bs.read_band_state(spark, tempfile.mkdtemp(), BANDS)) == []
    with pytest.raises(ValueError):
        bs.extend_band_state(_clean(spark, rows), state, BANDS, length="hour")
