"""The header pass that opens files, against the pass over the text."""

import bz2
import gzip
import io
import os
import tempfile

import pytest

from epitrend.sources import csv_reports, headers
from epitrend.sources.csv_reports import file_headers, scan_reports

HEAD = "Country,Last Update,Confirmed,Deaths,Recovered\n"
ROW = "X,1/1/2020,7,0,0\n"


def _bytes(d, name, raw):
    with open(os.path.join(d, name), "wb") as fh:
        fh.write(raw)


def _scanned(spark, d, glob="*"):
    return {(r["file"], r["header"].lstrip("﻿")) for r in
            csv_reports._scanned_headers(csv_reports._lines(spark, [d], glob)).collect()}


def test_bytes_read_grow_with_files_not_with_bytes(spark):
    d = tempfile.mkdtemp(prefix="epitrend-head-")
    for i, rows in enumerate((1, 1000, 400_000)):
        _bytes(d, f"{i}.csv", (HEAD + ROW * rows).encode())
    got = headers.opened_headers(headers.list_files(spark, d)).collect()
    assert [r["header"] for r in got] == [HEAD.strip()] * 3
    assert sum(os.path.getsize(os.path.join(d, n)) for n in os.listdir(d)) > 6_000_000
    assert all(r["bytes"] <= headers.BLOCK_BYTES for r in got)


def test_both_passes_agree(spark):
    d = tempfile.mkdtemp(prefix="epitrend-head-")
    plain = (HEAD + ROW).encode()
    _bytes(d, "a.csv", plain)
    _bytes(d, "b %20+[x].csv", b"\n  \n\xef\xbb\xbf\n" + plain)
    _bytes(d, "c.csv", plain.replace(b"\n", b"\r"))
    _bytes(d, "d.csv", b"\xef\xbb\xbf" + plain.replace(b"\n", b"\r\n"))
    _bytes(d, "e.csv.gz", gzip.compress(b"\n" * 50_000 + plain))
    _bytes(d, "f.csv.bz2", bz2.compress(plain))
    _bytes(d, "g.csv", b"\n" * 40_000 + plain)
    _bytes(d, "h.csv", HEAD.strip().encode() + b"," + b"y" * 100_000)
    _bytes(d, "blank.csv", b" \n\n")
    _bytes(d, "empty.csv", b"")
    got = {(r["file"], r["header"].lstrip("﻿")) for r in file_headers(spark, d, "*").collect()}
    assert got == _scanned(spark, d) and len(got) == 8


def test_a_header_that_is_not_utf8_is_left_to_the_text_pass(spark):
    d = tempfile.mkdtemp(prefix="epitrend-head-")
    _bytes(d, "a.csv", HEAD.strip().encode() + b",Caf\xe9\n" + ROW.strip().encode() + b",1\n")
    _bytes(d, "b.csv", (HEAD + ROW).encode())
    assert [r["Confirmed"] for r in scan_reports(spark, d).collect()] == ["7", "7"]


@pytest.mark.parametrize("opens", [True, False])
def test_rows_after_thousands_of_blank_lines(spark, monkeypatch, opens):
    monkeypatch.setattr(csv_reports, "openable", lambda uri: opens)
    d = tempfile.mkdtemp(prefix="epitrend-head-")
    _bytes(d, "a.csv", b"\n" * 4000 + (HEAD + ROW * 2).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "1000"):  # one split, and a first one that is blank
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert scan_reports(spark, d).count() == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_first_line_of_long_lines_and_streams_end():
    assert headers.first_line(io.BytesIO(b"a" * 100_000 + b"\nb").read)[0] == "a" * 100_000
    assert headers.first_line(io.BytesIO(b"\r\r\n x").read)[0] == " x"
    assert headers.first_line(io.BytesIO(b"").read) == (None, 0, True)
    assert headers.first_line(io.BytesIO(b"\xff\n").read)[2] is False
    assert not headers.openable("viewfs://nowhere/a.csv")
