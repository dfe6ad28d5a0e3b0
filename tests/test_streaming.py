import os
import tempfile

import pytest

from epitrend.plans.clean_table import ingest_directory
from epitrend.streaming import compact_epochs, read_rollup, report_stream, start_ingest

HEAD_A = "Province/State,Country/Region,Last Update,Confirmed,Deaths,Recovered\n"
HEAD_B = "Country_Region,Last_Update,Confirmed,Deaths,Recovered,Active\n"


def _write(d, name, text):
    with open(os.path.join(d, name), "w") as fh:
        fh.write(text)


def test_stream_ingests_new_files_incrementally(spark):
    src = tempfile.mkdtemp(prefix="epitrend-src-")
    out = tempfile.mkdtemp(prefix="epitrend-out-")
    ckpt = tempfile.mkdtemp(prefix="epitrend-ckpt-")
    _write(src, "01-22-2020.csv", HEAD_A + "p,Mexico,1/22/2020 17:00,1,0,0\nq,Mexico,1/22/2020 17:00,2,0,1\n")
    q = start_ingest(spark, src, out, ckpt)
    q.awaitTermination(120)
    first = {(r["Country"], r["Confirmed"]) for r in read_rollup(spark, out).collect()}
    assert first == {("Mexico", 3.0)}

    _write(src, "03-22-2020.csv", HEAD_B + "Mexico,2020-03-22 23:45:00,30,1,0,9\nPeru,2020-03-22 23:45:00,4,,,\n")
    q = start_ingest(spark, src, out, ckpt)   # restart from the checkpoint: only the new file
    q.awaitTermination(120)
    got = {(r["Country"], r["Date"].isoformat(), r["Active"]) for r in read_rollup(spark, out).collect()}
    assert got == {("Mexico", "2020-01-22", 2.0), ("Mexico", "2020-03-22", 29.0),
                   ("Peru", "2020-03-22", 4.0)}
    batch = {(r["Country"], r["Date"].isoformat(), r["Active"])
             for r in ingest_directory(spark, src).collect()}
    assert got == batch


def _split_report(src):
    """One report of three part files: only one row fits the first pattern."""
    os.makedirs(os.path.join(src, "r1"))
    for name, row in (("a", "Mexico,1/22/2020 17:00,1,0,0"), ("b", "Peru,2020-01-23 10:00:00,2,0,0"),
                      ("c [1]%20", "Chile,2020-01-23 10:00:00,4,0,0")):
        _write(os.path.join(src, "r1"), f"{name}.csv", "Country_Region,Last_Update,Confirmed,Deaths,Recovered\n" + row + "\n")


@pytest.mark.parametrize("cap", [1, 2, 1000])
def test_result_does_not_depend_on_the_trigger(spark, cap):
    src, out = tempfile.mkdtemp(prefix="epitrend-src-"), tempfile.mkdtemp(prefix="epitrend-out-")
    _split_report(src)
    start_ingest(spark, src, out, report_level="directory", max_files_per_trigger=cap).awaitTermination(240)
    want = sorted(tuple(r) for r in ingest_directory(spark, src, report_level="directory").collect())
    got = sorted(tuple(r) for r in read_rollup(spark, out).collect())
    assert got == want and [r[1] for r in got] == ["Mexico"]


def test_starting_again_changes_nothing(spark):
    src, out = tempfile.mkdtemp(prefix="epitrend-src-"), tempfile.mkdtemp(prefix="epitrend-out-")
    _split_report(src)
    _write(src, "x.csv", HEAD_B + "Mexico,2020-03-22 23:45:00,30,1,0,9\n")
    for cap in (1, 1000, 1000):
        start_ingest(spark, src, out, report_level="file", max_files_per_trigger=cap).awaitTermination(240)
        total = sum(r["Confirmed"] for r in read_rollup(spark, out).collect())
        assert total == 37.0


def _numbered(src, first, last):
    for i in range(first, last):
        _write(src, f"r{i:03d}.csv", HEAD_B + f"Mexico,2020-03-{1 + i % 28:02d} 23:45:00,{i},1,0,9\nPeru,2020-03-22,{i},,,\n")


def _epochs(out, name="partials"):
    return sorted(n for n in os.listdir(os.path.join(out, name)) if "=" in n) if os.path.isdir(os.path.join(out, name)) else []


def _same_as_batch(spark, src, out):
    want = sorted(tuple(r) for r in ingest_directory(spark, src).collect())
    return sorted(tuple(r) for r in read_rollup(spark, out).collect()) == want


def test_epochs_are_merged_and_the_files_read_stay_bounded(spark):
    src, out = tempfile.mkdtemp(prefix="epitrend-src-"), tempfile.mkdtemp(prefix="epitrend-out-")
    _numbered(src, 0, 17)
    start_ingest(spark, src, out, max_files_per_trigger=1, compact_every=4).awaitTermination(400)
    # Bases at epochs 4, 8, 12, 16, each up to the epoch before: the last two
    # are there, and the epochs that the last but one does not hold.
    assert _epochs(out, "base") == ["upto=11", "upto=15"]
    assert [int(n.split("=")[1]) for n in _epochs(out)] == [12, 13, 14, 15, 16]
    assert len(report_stream._sums(spark, out)[1]) == 2 and _same_as_batch(spark, src, out)
    _numbered(src, 17, 20)
    start_ingest(spark, src, out, max_files_per_trigger=1, compact_every=4).awaitTermination(400)
    assert _same_as_batch(spark, src, out)
    assert compact_epochs(spark, out) == 19 and compact_epochs(spark, out) is None
    assert len(report_stream._sums(spark, out)[1]) == 1 and _same_as_batch(spark, src, out)


@pytest.mark.parametrize("died", ["before the base is committed", "before anything is deleted"])
def test_a_compaction_that_dies_is_done_again(spark, monkeypatch, died):
    src, out = tempfile.mkdtemp(prefix="epitrend-src-"), tempfile.mkdtemp(prefix="epitrend-out-")
    _numbered(src, 0, 3)
    start_ingest(spark, src, out, max_files_per_trigger=1, compact_every=0).awaitTermination(400)
    compact_epochs(spark, out)
    _numbered(src, 3, 6)
    start_ingest(spark, src, out, max_files_per_trigger=1, compact_every=0).awaitTermination(400)
    if died == "before the base is committed":
        compact_epochs(spark, out)
        last = max(int(n.split("=")[1]) for n in _epochs(out, "base"))
        os.remove(os.path.join(out, "base", f"upto={last}", "_SUCCESS"))
        assert not _same_as_batch(spark, src, out) or len(_epochs(out)) >= 3
        # The epochs behind the base before it are still there.
        assert _same_as_batch(spark, src, out)
    else:
        def dying(*_):
            raise RuntimeError("killed")

        with monkeypatch.context() as m:
            m.setattr(report_stream, "delete_folder", dying)
            with pytest.raises(RuntimeError):
                compact_epochs(spark, out)
        assert _same_as_batch(spark, src, out)
    _numbered(src, 6, 8)
    start_ingest(spark, src, out, max_files_per_trigger=1, compact_every=1).awaitTermination(400)
    assert _same_as_batch(spark, src, out)


def test_nothing_to_compact(spark):
    out = tempfile.mkdtemp(prefix="epitrend-out-")
    assert compact_epochs(spark, out) is None and read_rollup(spark, out).count() == 0
