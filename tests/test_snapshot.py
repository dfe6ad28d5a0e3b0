import datetime as dt

from epitrend import operators as op

D1, D2, D3 = dt.date(2020, 5, 2), dt.date(2020, 5, 3), dt.date(2020, 5, 4)
SCHEMA = "Date date, Country string, Confirmed double, Deaths double, Recovered double, Active double"


def _rows(spark, rows):
    return spark.createDataFrame([(d, c, x, 0.0, 0.0, x) for d, c, x in rows], SCHEMA)


def test_daily_rollup_sums(spark):
    df = _rows(spark, [(D1, "A", 1.0), (D1, "A", 2.0), (D2, "A", 5.0)])
    out = {(r["Date"], r["Confirmed"]) for r in op.daily_rollup(df).collect()}
    assert out == {(D1, 3.0), (D2, 5.0)}


def test_qualify_needs_rows_and_value_on_date(spark):
    rows = [(D1, "A", 400.0), (D2, "A", 400.0), (D3, "A", 500.0),   # qualifies
            (D1, "B", 400.0), (D3, "B", 900.0),                      # no row on D2
            (D1, "C", 1.0), (D2, "C", 350.0), (D3, "C", 999.0)]      # 350 is not > 350
    out = op.qualify_entities(_rows(spark, rows), min_rows=3, on=D2, gt=350)
    assert {r["Country"] for r in out.collect()} == {"A"}
    out2 = op.qualify_entities(_rows(spark, rows), min_rows=4, on=D2, gt=350)
    assert out2.count() == 0


def test_latest_snapshot_absent_entity(spark):
    df = _rows(spark, [(D1, "A", 1.0), (D2, "A", 2.0), (D1, "B", 3.0)])
    out = op.latest_snapshot(df).collect()
    assert [(r["Country"], r["Date"]) for r in out] == [("A", D2)]
    assert {r["Country"] for r in op.as_of_snapshot(df, "2020-05-02").collect()} == {"A", "B"}


def test_top_bottom_ties_and_overlap(spark):
    df = _rows(spark, [(D1, "D", 5.0), (D1, "C", 5.0), (D1, "B", 1.0), (D1, "A", 9.0)])
    out = [(r["side"], r["Country"], r["Confirmed"]) for r in
           op.top_bottom(df, "Confirmed", k=3).collect()]
    top = [x for x in out if x[0] == "top"]
    bottom = [x for x in out if x[0] == "bottom"]
    assert [c for _, c, _ in top] == ["A", "C", "D"]
    assert [c for _, c, _ in bottom] == ["B", "C", "D"]
    assert len(out) == 6  # fewer than 2k entities: both sides keep their rows


def test_country_codes_normalised_key(spark):
    df = _rows(spark, [(D1, "Korea, South", 1.5), (D1, "Atlantis", 2.0)])
    aliases = spark.createDataFrame([("korea south", "KOR"), ("KOREA  SOUTH", "KOX")],
                                    "alias string, code string")
    out = {r["Country"]: r for r in op.country_codes(df, aliases).collect()}
    assert out["Korea, South"]["Country_clean"] == "KOR"
    assert out["Atlantis"]["Country_clean"] is None
    assert isinstance(out["Atlantis"]["Confirmed"], int)


def test_rename_entities_before_rollup(spark):
    df = _rows(spark, [(D1, "Mainland China", 1.0), (D1, "China", 2.0), (D1, "Peru", 4.0)])
    aliases = spark.createDataFrame([("mainland china", "China")], "alias string, name string")
    out = {r["Country"]: r["Confirmed"] for r in
           op.daily_rollup(op.rename_entities(df, aliases)).collect()}
    assert out == {"China": 3.0, "Peru": 4.0}


def test_qualify_against_brute_force(spark):
    import random

    rng = random.Random(9)
    rows, expected = [], set()
    on = dt.date(2020, 5, 3)
    for e in range(120):
        days = rng.sample(range(-20, 20), rng.randint(0, 12))
        values = {d: float(rng.randint(300, 400)) for d in days}
        for d, v in values.items():
            rows.append((on + dt.timedelta(days=d), f"E{e}", v))
        if len(days) >= 6 and values.get(0, 0.0) > 350:
            expected.add(f"E{e}")
    out = op.qualify_entities(_rows(spark, rows), min_rows=6, on=on, gt=350)
    got_rows = out.collect()
    assert {r["Country"] for r in got_rows} == expected
    assert len(got_rows) == sum(1 for r in rows if r[1] in expected)


def test_iso_codes_of_real_names(spark):
    import datetime as dt

    from epitrend import operators as op

    names = {"Mexico": "MEX", "Korea, South": "KOR", "united kingdom": "GBR", "US": "USA", "Cote d'Ivoire": "CIV",
             "Guinea-Bissau": "GNB", "Diamond Princess": None, "Others": None}
    df = spark.createDataFrame([(dt.date(2020, 5, 3), n, 1.0, 0.0, 0.0, 1.0) for n in names],
                               "Date date, Country string, Confirmed double, Deaths double, Recovered double, Active double")
    got = {r["Country"]: r["Country_clean"] for r in op.country_codes(df, op.iso_aliases(spark)).collect()}
    assert got == names
    codes = [r["code"] for r in op.iso_aliases(spark).collect()]
    assert all(len(c) == 3 and c.isupper() for c in codes) and len(set(codes)) == 249
