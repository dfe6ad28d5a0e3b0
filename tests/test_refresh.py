"""The refreshed table against a full ingestion of the same folder."""

import os
import tempfile
import time

import pytest

from epitrend.plans import refresh as rf
from epitrend.plans.clean_table import ingest_directory

HEAD = "Country_Region,Last_Update,Confirmed,Deaths,Recovered\n"


def _write(d, name, rows, head=HEAD):
    path = os.path.join(d, name)
    with open(path, "w") as fh:
        fh.write(head + "".join(f"{c},{t},{n},0,1\n" for c, t, n in rows))
    later = time.time() + _write.ticks  # another time of modification each time
    _write.ticks += 1
    os.utime(path, (later, later))


_write.ticks = 0


def _batch(spark, src, **how):
    return sorted(tuple(r) for r in ingest_directory(spark, src, **how).collect())


def _table(spark, store):
    return sorted(tuple(r) for r in rf.read_refreshed(spark, store).collect())


def _parts(store, folder="table"):
    """Date -> its data files with their times."""
    root = os.path.join(store, folder)
    return {d: sorted((f, os.stat(os.path.join(root, d, f)).st_mtime_ns) for f in os.listdir(os.path.join(root, d)) if f.endswith(".parquet"))
            for d in os.listdir(root) if d.startswith("Date=")}


@pytest.fixture()
def folders():
    src, store = tempfile.mkdtemp(prefix="epitrend-src-"), tempfile.mkdtemp(prefix="epitrend-store-")
    _write(src, "01-22-2020.csv", [("Mexico", "1/22/2020 17:00", 1), ("Peru", "1/22/2020 17:00", 2)])
    _write(src, "01-23-2020.csv", [("Mexico", "2020-01-23 10:00:00", 3), ("Peru", "2020-01-24 10:00:00", 4)])
    _write(src, "01-25-2020.csv", [("Mexico", "2020-01-25T10:00:00", 5)])
    return src, store


def test_added_rewritten_and_deleted_files_give_the_batch_table(spark, folders):
    src, store = folders
    first = rf.refresh(spark, src, store)
    assert (first.added, first.rewritten, first.removed) == (3, 0, 0) and len(first.dates) == 4
    assert _table(spark, store) == _batch(spark, src) != []
    before = _parts(store), _parts(store, "daily")

    assert rf.refresh(spark, src, store).version == first.version  # nothing to do
    assert (_parts(store), _parts(store, "daily")) == before

    _write(src, "01-23-2020.csv", [("Mexico", "2020-01-23 10:00:00", 30), ("Chile", "2020-01-26 10:00:00", 9)])
    os.remove(os.path.join(src, "01-25-2020.csv"))
    _write(src, "01-27-2020.csv", [("Peru", "2020-01-27 10:00:00", 7), ("Peru", "2020-01-22 10:00:00", 100)])
    second = rf.refresh(spark, src, store)
    assert (second.added, second.rewritten, second.removed) == (1, 1, 1)
    assert [d.day for d in second.dates] == [22, 23, 24, 25, 26, 27]
    assert _table(spark, store) == _batch(spark, src)
    assert {d[-2:] for d in _parts(store)} == {"22", "23", "26", "27"}  # dates without rows are gone


def test_other_dates_keep_their_files(spark, folders):
    src, store = folders
    rf.refresh(spark, src, store)
    before = _parts(store)
    _write(src, "01-25-2020.csv", [("Mexico", "2020-01-25T10:00:00", 6)])
    assert len(rf.refresh(spark, src, store).dates) == 1
    after = _parts(store)
    changed = {d for d in before if before[d] != after[d]}
    assert changed == {"Date=2020-01-25"} and _table(spark, store) == _batch(spark, src)


def test_a_row_that_changes_the_date_pattern_moves_all_rows_of_its_report(spark):
    src, store = tempfile.mkdtemp(prefix="epitrend-src-"), tempfile.mkdtemp(prefix="epitrend-store-")
    os.makedirs(os.path.join(src, "r1"))
    _write(src, "r1/a.csv", [("Mexico", "2020-01-23 10:00:00", 1), ("Peru", "2020-01-24 10:00:00", 2)])
    how = {"report_level": "directory"}
    rf.refresh(spark, src, store, **how)
    assert len(_table(spark, store)) == 2
    _write(src, "r1/b.csv", [("Chile", "1/22/2020 17:00", 4)])  # now M-d-y is the report's pattern
    rf.refresh(spark, src, store, **how)
    assert _table(spark, store) == _batch(spark, src, **how) and [r[1] for r in _table(spark, store)] == ["Chile"]
    os.remove(os.path.join(src, "r1/b.csv"))
    rf.refresh(spark, src, store, **how)
    assert _table(spark, store) == _batch(spark, src, **how) and len(_table(spark, store)) == 2


@pytest.mark.parametrize("step", ["daily", "table", "files"])
def test_a_refresh_that_dies_is_done_again(spark, folders, monkeypatch, step):
    """Dies before or after a table is written; the file changes back meanwhile."""
    src, store = folders
    rf.refresh(spark, src, store)
    path = os.path.join(src, "01-25-2020.csv")
    old, times = open(path).read(), os.stat(path).st_mtime
    _write(src, "01-25-2020.csv", [("Mexico", "2020-01-28 10:00:00", 600)])
    real = rf._overwrite_dates

    def dying(spark, rows, target, dates):
        if step == "files" or not target.endswith(step):
            real(spark, rows, target, dates)
        if target.endswith(step) or (step == "files" and target.endswith("table")):
            raise RuntimeError("killed")

    monkeypatch.setattr(rf, "_overwrite_dates", dying)
    with pytest.raises(RuntimeError):
        rf.refresh(spark, src, store)
    monkeypatch.setattr(rf, "_overwrite_dates", real)
    with open(path, "w") as fh:
        fh.write(old)
    os.utime(path, (times, times))
    rf.refresh(spark, src, store)
    assert _table(spark, store) == _batch(spark, src)
    assert not os.path.exists(os.path.join(store, "pending"))


def test_many_changes_are_scanned_with_the_folder(spark, folders, monkeypatch):
    src, store = folders
    monkeypatch.setattr(rf, "MAX_PATHS", 1)
    _write(src, "odd %20+[1].csv", [("Mexico", "2020-02-01 10:00:00", 5)])
    rf.refresh(spark, src, store)
    assert _table(spark, store) == _batch(spark, src)


def test_odd_names_nulls_and_empty_folders(spark):
    src, store = tempfile.mkdtemp(prefix="epitrend-src-"), tempfile.mkdtemp(prefix="epitrend-store-")
    assert rf.refresh(spark, src, store).version == 0 and _table(spark, store) == []
    _write(src, "odd %20+[1].csv", [("Mexico", "2020-02-01 10:00:00", 5), ("", "2020-02-02 10:00:00", 1), ("Peru", "unknown", 1)])
    _write(src, "empty.csv", [], head="")
    rf.refresh(spark, src, store)
    assert _table(spark, store) == _batch(spark, src) and len(_table(spark, store)) == 1
    os.remove(os.path.join(src, "odd %20+[1].csv"))
    rf.refresh(spark, src, store)
    assert _table(spark, store) == []


def test_compaction_keeps_the_answer_and_drops_dead_sums(spark, folders):
    src, store = folders
    for n in range(3):
        _write(src, "01-25-2020.csv", [("Mexico", "2020-01-25T10:00:00", n)])
        rf.refresh(spark, src, store)
    batches = lambda: [n for n in os.listdir(os.path.join(store, "partials")) if n.startswith("batch=")]
    assert len(batches()) == 3
    parts, rows = _parts(store), _table(spark, store)
    rf.compact(spark, store)
    assert len(batches()) == 1 and _parts(store) == parts and _table(spark, store) == rows
    _write(src, "02-01-2020.csv", [("Peru", "2020-02-01T10:00:00", 1)])
    os.remove(os.path.join(src, "01-22-2020.csv"))
    rf.refresh(spark, src, store)
    assert _table(spark, store) == _batch(spark, src)
    assert rf.compact(spark, tempfile.mkdtemp(prefix="epitrend-store-")) == 0


def test_band_states_follow_a_refresh(spark, folders):
    """The dates that a refresh reports are all that the states read again."""
    from epitrend import operators as op

    src, store = folders
    state = tempfile.mkdtemp(prefix="epitrend-state-")
    bands = ((1, 3), (3, 30), (1, 100))
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    for step in range(3):
        if step == 1:
            _write(src, "01-23-2020.csv", [("Mexico", "2020-01-23 10:00:00", 30), ("Peru", "2020-02-26 10:00:00", 9)])
        if step == 2:
            os.remove(os.path.join(src, "01-22-2020.csv"))
            _write(src, "03-01-2020.csv", [("Mexico", "2020-03-01 10:00:00", 300)])
        done = rf.refresh(spark, src, store)
        clean = rf.read_refreshed(spark, store)
        op.extend_band_state(clean, state, bands, changed=done.dates)
        got = op.finish_band_states(op.read_band_state(spark, state, bands), bands, first=True)
        assert rows(got) == rows(op.days_in_bands(clean, bands, first=True)) != []
