import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from epitrend import operators as op
from epitrend.operators.ingest import resolve_header
from epitrend.sources.csv_reports import discover_headers, scan_reports


def test_resolve_header_first_country_last_last():
    names = ["FIPS", "Country_Region", "Country_Code", "Last_Update", "Last Update",
             "Confirmed", "Deaths", "Recovered", "Active"]
    pos = resolve_header(names)
    assert pos["Country"] == 1          # first name starting with Country
    assert pos["last_update"] == 4      # last name starting with Last
    assert (pos["Confirmed"], pos["Deaths"], pos["Recovered"]) == (5, 6, 7)


def test_resolve_header_measures_ignore_case():
    pos = resolve_header(["Country", "Last Update", "confirmed", "DEATHS", "Recovered"])
    assert (pos["Confirmed"], pos["Deaths"]) == (2, 3)


def test_resolve_header_bom_and_exact_country():
    pos = resolve_header(["﻿Country", "Last Update", "Confirmed", "Deaths", "Recovered"])
    assert pos["Country"] == 0


def test_resolve_header_missing_country_is_clear_error():
    with pytest.raises(ValueError, match="Country"):
        resolve_header(["Province", "Last Update", "Confirmed", "Deaths", "Recovered"])


def test_normalize_headers_unions_variants_by_name(spark):
    a = spark.createDataFrame([("X", "1/2/2020 10:00", "1", "0", "0")],
                              ["Country/Region", "Last Update", "Confirmed", "Deaths", "Recovered"])
    b = spark.createDataFrame([("2", "2020-01-03T01:00:00", "0", "Y", "9", "1")],
                              ["Confirmed", "Last_Update", "Deaths", "Country_Region", "Active",
                               "Recovered"])
    out = op.normalize_headers([a, b])
    assert out.columns == ["Country", "last_update", "Confirmed", "Deaths", "Recovered"]
    rows = {r["Country"]: r for r in out.collect()}
    assert rows["Y"]["Confirmed"] == "2" and rows["Y"]["Recovered"] == "1"


def _raw(spark, rows):
    return spark.createDataFrame(rows, "source_file string, Country string, last_update string, "
                                       "Confirmed string, Deaths string, Recovered string")


def test_detect_dates_file_mode_drops_minority_format(spark):
    rows = [("f", "A", "1/22/2020 17:00", "1", "0", "0"),
            ("f", "A", "2020-01-23 10:00:00", "2", "0", "0"),
            ("f", "A", "2020-01-24 10:00:00", "3", "0", "0")]
    out = op.detect_dates(_raw(spark, rows)).collect()
    # M-d-y fits one row of the file, so that format wins and the rest is dropped
    assert [(r["Date"]) for r in out] == [dt.date(2020, 1, 22)]


def test_detect_dates_two_digit_year_falls_through(spark):
    rows = [("g", "A", "1/22/20 23:33", "1", "0", "0"), ("g", "A", "1/23/20 1:00", "1", "0", "0")]
    out = sorted(r["Date"] for r in op.detect_dates(_raw(spark, rows)).collect())
    assert out == [dt.date(2020, 1, 22), dt.date(2020, 1, 23)]


def test_detect_dates_iso_keeps_unparsed_as_null(spark):
    rows = [("h", "A", "2020-02-03T20:53:02", "1", "0", "0"), ("h", "A", "unknown", "1", "0", "0")]
    out = op.detect_dates(_raw(spark, rows)).collect()
    assert sorted(out, key=lambda r: r["last_update"])[0]["Date"] == dt.date(2020, 2, 3)
    assert sum(r["Date"] is None for r in out) == 1
    assert op.rejected_dates(op.detect_dates(_raw(spark, rows))).count() == 1


def test_detect_dates_is_per_source(spark):
    rows = [("a", "A", "1/22/2020 17:00", "1", "0", "0"),
            ("b", "B", "2020-01-23 10:00:00", "1", "0", "0")]
    out = {r["source_file"]: r["Date"] for r in op.detect_dates(_raw(spark, rows)).collect()}
    assert out == {"a": dt.date(2020, 1, 22), "b": dt.date(2020, 1, 23)}


def test_detect_dates_row_mode_keeps_everything(spark):
    rows = [("f", "A", "1/22/2020 17:00", "1", "0", "0"),
            ("f", "A", "2020-01-23 10:00:00", "2", "0", "0")]
    out = sorted(r["Date"] for r in op.detect_dates(_raw(spark, rows), mode="row").collect())
    assert out == [dt.date(2020, 1, 22), dt.date(2020, 1, 23)]


def test_coerce_measures_order_of_rules(spark):
    d = dt.date(2020, 1, 1)
    df = spark.createDataFrame([
        (d, "A", "10", "1", "2"),        # kept, Active = 7
        (d, "A", None, None, None),      # all three null: dropped
        (d, "A", "junk", "", None),      # all three null after the cast: dropped
        (d, "A", "5", None, "x"),        # nulls become 0
        (d, None, "1", "1", "1"),        # no Country: dropped
    ], "Date date, Country string, Confirmed string, Deaths string, Recovered string")
    out = sorted(tuple(r) for r in op.coerce_measures(df).collect())
    assert out == [(d, "A", 5.0, 0.0, 0.0, 5.0), (d, "A", 10.0, 1.0, 2.0, 7.0)]


def _write(dirpath, name, text):
    with open(os.path.join(dirpath, name), "w") as fh:
        fh.write(text)


def test_scan_reports_groups_files_by_header(spark):
    d = tempfile.mkdtemp(prefix="epitrend-csv-")
    _write(d, "01-22-2020.csv",
           "Province/State,Country/Region,Last Update,Confirmed,Deaths,Recovered\n"
           "P,Mexico,1/22/2020 17:00,1,0,0\nQ,Peru,1/22/2020 17:00,2,,\n")
    _write(d, "03-22-2020.csv",
           "FIPS,Admin2,Province_State,Country_Region,Last_Update,Lat,Long_,Confirmed,Deaths,"
           "Recovered,Active,Combined_Key\n"
           '1,a,b,Mexico,2020-03-22 23:45:00,1,2,30,1,0,99,"a, b, Mexico"\n')
    _write(d, "04-01-2020.csv",
           "FIPS,Admin2,Province_State,Country_Region,Last_Update,Lat,Long_,Confirmed,Deaths,"
           "Recovered,Active,Combined_Key\n"
           '2,c,d,Peru,2020-04-01 23:45:00,1,2,40,2,1,99,"c, d, Peru"\n')
    _write(d, "notes.txt", "not a report\n")
    assert sorted(n for _, n in discover_headers(spark, d)) == [1, 2]
    out = scan_reports(spark, d)
    assert out.count() == 4
    rows = {(r["Country"], r["Confirmed"]) for r in out.collect()}
    assert rows == {("Mexico", "1"), ("Peru", "2"), ("Mexico", "30"), ("Peru", "40")}
    clean = op.coerce_measures(op.detect_dates(out))
    got = {(r["Country"], r["Date"].isoformat(), r["Active"]) for r in clean.collect()}
    assert ("Mexico", "2020-03-22", 29.0) in got and ("Peru", "2020-01-22", 2.0) in got


def test_scan_reports_missing_country_names_files(spark):
    d = tempfile.mkdtemp(prefix="epitrend-csv-")
    _write(d, "bad.csv", "Region,Last Update,Confirmed,Deaths,Recovered\nX,1/1/2020,1,1,1\n")
    with pytest.raises(ValueError, match="bad.csv"):
        scan_reports(spark, d)


def test_discovery_reads_quoted_header_and_crlf(spark):
    d = tempfile.mkdtemp(prefix="epitrend-csv-")
    _write(d, "q.csv", '"Country, or Region",Last_Update,Confirmed,Deaths,Recovered\r\n'
                       '"Korea, South",2020-03-01 10:00:00,5,0,1\r\n')
    (names, files), = discover_headers(spark, d)
    assert names[0] == "Country, or Region" and names[-1] == "Recovered" and files == 1
    row = scan_reports(spark, d).collect()[0]
    assert (row["Country"], row["Confirmed"], row["Recovered"]) == ("Korea, South", "5", "1")


def test_scan_reports_empty_directory(spark):
    d = tempfile.mkdtemp(prefix="epitrend-csv-")
    _write(d, "readme.txt", "x\n")
    assert scan_reports(spark, d).count() == 0


def test_guarded_parse_equals_plain_parse(spark):
    import random

    from epitrend.functions.dates import parse_date

    rng = random.Random(3)
    alphabet = "0123456789" * 3 + "---+ T:a"
    texts = ["012-5-2024", "1-5-+2024", "1-5-24", "1-5-024", "+2024-1-5", "2024-001-05",
             "20240-01-05", "1-5-20241", "1-5-0", "2-30-2024", "13-5-2024", "0-5-2024",
             "00012-0031-1999", "", "1-5-2024 ", "1--5-2024"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12)))
              for _ in range(3000)]
    texts += [f"{rng.randint(0, 14)}-{rng.randint(0, 33)}-{rng.randint(0, 2100)}"
              for _ in range(2000)]
    texts += [f"{rng.randint(0, 2100)}-{rng.randint(0, 14)}-{rng.randint(0, 33)}"
              for _ in range(2000)]
    # the guard differs only for years of more than 5 significant digits
    long_year = r"[0-9]*[1-9][0-9]{5}"
    texts = [t for t in texts if not __import__("re").search(long_year, t)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for p in ("M-d-y", "M-d-yy", "y-M-d"):
        plain = F.try_to_date("t", p).cast("string")
        guarded = parse_date(F.col("t"), p).cast("string")
        diff = df.where(~plain.eqNullSafe(guarded)).select("t").limit(5).collect()
        assert not diff, (p, diff)


def test_long_years_are_unparsable_not_a_failed_job(spark):
    from epitrend.functions.dates import parse_date

    df = spark.createDataFrame([("1-5-999999",), ("999999-1-5",), ("1-5-002024",)], "t string")
    got = [r[0] for r in df.select(parse_date(F.col("t"), "M-d-y").cast("string")).collect()]
    assert got == [None, None, "2024-01-05"]
    assert df.select(parse_date(F.col("t"), "y-M-d")).collect()[1][0] is None


def _reference_file_rule(texts):
    """The per-file date rule step by step, in plain Python, for texts in the
    formats M/d/yyyy H:mm, M/d/yy H:mm, yyyy-MM-dd HH:mm:ss, yyyy-MM-ddTHH:mm:ss
    or junk. Returns the kept (index, date) pairs."""
    def cut(t):
        return t.replace("/", "-").split(" ")[0].split("T")[0]

    def mdy(t, two_digit):
        parts = cut(t).split("-")
        if len(parts) != 3 or not all(p.isdigit() for p in parts):
            return None
        m, d, y = (int(p) for p in parts)
        if two_digit:
            if len(parts[2]) != 2:
                return None
            y += 2000
        if len(parts[0]) > 2 or not (1 <= m <= 12):
            return None
        try:
            return dt.date(y, m, d) if y > 0 else None
        except ValueError:
            return None

    def ymd(t):
        parts = cut(t).split("-")
        if len(parts) != 3 or not all(p.isdigit() for p in parts) or len(parts[0]) != 4:
            return None
        try:
            return dt.date(*(int(p) for p in parts))
        except ValueError:
            return None

    first = [mdy(t, False) for t in texts]
    first = [d if d is not None and str(d.year).startswith("2") and d.year >= 1000 else None
             for d in first]
    if any(first):
        return [(i, d) for i, d in enumerate(first) if d is not None]
    second = [mdy(t, True) for t in texts]
    if any(second):
        return [(i, d) for i, d in enumerate(second) if d is not None]
    return [(i, ymd(t)) for i, t in enumerate(texts)]


def test_detect_dates_file_rule_against_brute_force(spark):
    import random

    rng = random.Random(5)
    rows, expected = [], set()
    for f in range(40):
        weights = [rng.random() for _ in range(5)]
        texts = []
        for _ in range(rng.randint(1, 12)):
            d = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 900))
            kind = rng.choices(range(5), weights)[0]
            texts.append([f"{d.month}/{d.day}/{d.year} 10:05",
                          f"{d.month}/{d.day}/{d.year % 100:02d} 7:00",
                          f"{d.isoformat()} 23:45:00",
                          f"{d.isoformat()}T20:53:02",
                          "unknown"][kind])
        for i, t in enumerate(texts):
            rows.append((f"file{f}", f"{f}:{i}", t, "1", "0", "0"))
        for i, d in _reference_file_rule(texts):
            expected.add((f"{f}:{i}", d))
    df = _raw(spark, rows)
    got = {(r["Country"], r["Date"]) for r in op.detect_dates(df).collect()}
    assert got == expected


PLAIN = "Country,Last Update,Confirmed,Deaths,Recovered\n"


def _confirmed(df):
    return sorted((r["Country"], r["Confirmed"]) for r in df.collect())


@pytest.mark.parametrize("name", ["sp ace/a b.csv", "a%20b.csv", "a[1].csv", "x{1,2}.csv", "c+d.csv", "q?e*.csv", "é.csv"])
def test_scan_reports_any_path(spark, name):
    from epitrend.sources.csv_reports import literal_path

    d = tempfile.mkdtemp(prefix="epitrend-csv-")
    os.makedirs(os.path.dirname(os.path.join(d, name)), exist_ok=True)
    _write(d, name, PLAIN + "X,1/1/2020,7,0,0\n")
    assert _confirmed(scan_reports(spark, d)) == [("X", "7")]
    one = scan_reports(spark, literal_path(os.path.join(d, name)), glob=None)
    assert _confirmed(one) == [("X", "7")]


@pytest.mark.parametrize("text", [
    PLAIN.replace("\n", "\r") + "X,1/1/2020,7,0,0\rY,1/1/2020,8,0,0\r",
    PLAIN.replace("\n", "\r\n") + "X,1/1/2020,7,0,0\r\nY,1/1/2020,8,0,0",
    "\ufeff" + PLAIN + "X,1/1/2020,7,0,0\nY,1/1/2020,8,0,0\n",
    "\n  \n" + PLAIN + "X,1/1/2020,7,0,0\n\nY,1/1/2020,8,0,0\n",
    " Country , Last Update, Confirmed ,Deaths, Recovered\nX,1/1/2020,7,0,0\nY,1/1/2020,8,0,0\n",
    PLAIN + "X,1/1/2020,7,0,0\n" + PLAIN + "Y,1/1/2020,8,0,0,more,fields\n",
])
def test_scan_reports_line_ends_and_odd_headers(spark, text):
    d = tempfile.mkdtemp(prefix="epitrend-csv-")
    with open(os.path.join(d, "a.csv"), "w", newline="", encoding="utf-8") as fh:
        fh.write(text)
    _write(d, "b.csv", "Confirmed,Deaths,Recovered,Last_Update,Country_Region\n9,0,0,2020-01-01,Z\n")
    assert _confirmed(scan_reports(spark, d)) == [("X", "7"), ("Y", "8"), ("Z", "9")]


def test_scan_reports_reads_gzip_and_short_rows(spark):
    import gzip

    d = tempfile.mkdtemp(prefix="epitrend-csv-")
    with gzip.open(os.path.join(d, "a.csv.gz"), "wt") as fh:
        fh.write(PLAIN + "X,1/1/2020,7\n")
    rows = scan_reports(spark, d, glob="*.csv*").collect()
    assert [(r["Confirmed"], r["Deaths"]) for r in rows] == [("7", None)]


def test_keep_matches_padded_headers(spark):
    d = tempfile.mkdtemp(prefix="epitrend-csv-")
    _write(d, "a.csv", "Country,Last Update,Confirmed,Deaths,Recovered, event_id\nX,1/1/2020,1,0,0,77\n")
    assert scan_reports(spark, d, keep=["event_id", "gone"]).select("event_id", "gone").collect()[0][:] == ("77", None)


def test_no_file_list_in_the_driver(spark):
    """The plan holds no path of a single file, however many there are."""
    import contextlib
    import io

    d = tempfile.mkdtemp(prefix="epitrend-csv-")
    for i in range(12):
        _write(d, f"report{i}.csv", PLAIN + f"X,1/1/2020,{i},0,0\n")
    df = scan_reports(spark, d)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("extended")
    assert "report3.csv" not in buf.getvalue() and df.count() == 12


def test_null_sources_keep_their_rows(spark):
    rows = [(None, "A", "1/22/2020 17:00", "1", "0", "0"), (None, "A", None, "1", "0", "0"),
            ("f", "B", "2020-01-23 10:00:00", "2", "0", "0")]
    df = _raw(spark, rows)
    out = {(r["Country"], r["Date"]) for r in op.detect_dates(df).collect()}
    assert out == {("A", dt.date(2020, 1, 22)), ("B", dt.date(2020, 1, 23))}
    assert [(r["last_update"], r["reason"]) for r in op.rejected_rows(df).collect()] == [(None, "minority_format")]


def test_rejected_rows_name_both_reasons(spark):
    rows = [("f", "A", "1/22/2020 17:00", "1", "0", "0"), ("f", "A", "2020-01-23 10:00:00", "2", "0", "0"),
            ("g", "A", "2020-01-24", "2", "0", "0"), ("g", "A", "unknown", "2", "0", "0"), ("g", "A", "999999-1-5", "2", "0", "0")]
    got = sorted((r["last_update"], r["reason"]) for r in op.rejected_rows(_raw(spark, rows)).collect())
    assert got == [("2020-01-23 10:00:00", "minority_format"), ("999999-1-5", "unparsed"), ("unknown", "unparsed")]
    lost = op.rejected_rows(_raw(spark, rows), mode="row").collect()
    assert {r["last_update"] for r in lost} == {"unknown", "999999-1-5"}


@pytest.mark.parametrize("mode", ["file", "row"])
def test_partials_equal_the_row_operators(spark, mode):
    import random

    rng = random.Random(8)
    texts = ["1/22/2020 17:00", "1/23/20 1:00", "2020-01-24 10:00:00", "2020-01-25T1:00", "unknown", None]
    rows = [(rng.choice(["f", "g", "h", None]), rng.choice(["A", "B", None]), rng.choice(texts),
             *[rng.choice(["1", "2.5", "junk", "", None]) for _ in range(3)]) for _ in range(400)]
    df = _raw(spark, rows)
    long = op.coerce_measures(op.detect_dates(df, mode=mode)).where("Date is not null")
    want = sorted(tuple(r) for r in op.daily_rollup(long).collect())
    whole = op.finish_partials(op.report_partials(df), mode)
    assert sorted(tuple(r) for r in whole.collect()) == want
    parts = None
    for i in range(5):  # rows of one report may fall into different parts
        p = op.report_partials(_raw(spark, rows[i::5]))
        parts = p if parts is None else parts.unionByName(p)
    merged = op.finish_partials(op.merge_partials(parts), mode)
    assert sorted(tuple(r) for r in merged.collect()) == want
