"""Names matched to aliases, against all pairs."""

import random
import string

import pytest
from pyspark.sql import functions as F

from epitrend import operators as op
from epitrend.operators.geo import iso_aliases, listed_aliases
from epitrend.operators.matching import match_names, name_grams


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


def _brute(names, aliases, most=3, share=4):
    known = {}
    for a, c in aliases:
        known[a] = min(c, known.get(a, c))
    out = {}
    for n in set(names):
        if n is None:
            out[n] = (None, "unmatched", None)
        elif n in known:
            out[n] = (known[n], "exact", 0)
        else:
            found = sorted((d, c) for a, c in known.items() if (d := _edits(n, a)) <= min(most, len(n) // share))
            codes = {c for d, c in found if d == found[0][0]}
            out[n] = (codes.pop(), "approximate", found[0][0]) if len(codes) == 1 else \
                (None, "ambiguous" if codes else "unmatched", found[0][0] if found else None)
    return out


def _matched(spark, names, aliases, **how):
    n = spark.createDataFrame([(x,) for x in names], "Country string")
    a = spark.createDataFrame(aliases, "alias string, code string")
    return {r["Country"]: (r["code"], r["status"], r["distance"]) for r in match_names(n, a, **how).collect()}


@pytest.mark.parametrize("letters", ["ab", string.ascii_lowercase[:6]])
def test_blocking_loses_no_pair(spark, letters):
    rng = random.Random(len(letters))
    word = lambda lo, hi: "".join(rng.choice(letters) for _ in range(rng.randint(lo, hi)))
    aliases = [(word(1, 16), f"C{i % 40}") for i in range(150)]
    names = [None, ""]
    for _ in range(400):
        w = list(rng.choice(aliases)[0])
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(w))
            w[at:at + rng.choice((0, 1))] = rng.choice(("", rng.choice(letters)))
        names.append("".join(w))
    assert _matched(spark, names, aliases) == _brute(names, aliases)


def test_misspelt_countries_are_resolved(spark):
    aliases = listed_aliases()
    got = _matched(spark, ["Mexcio", "Colombiaa", "Untied Kingdom", "Austrlia", "MS Zaandam", "Cote d'Ivoire",
                           "West Bank an Gaza", "Burma", "UK", None], aliases)
    assert got["Mexcio"][1] == "unmatched"  # a swap is two edits, six letters allow one
    assert got["Colombiaa"] == ("COL", "approximate", 1)
    assert got["Untied Kingdom"] == ("GBR", "approximate", 2)
    assert got["Austrlia"] == (None, "ambiguous", 1)
    assert got["MS Zaandam"][1] == got[None][1] == "unmatched"
    assert got["Cote d'Ivoire"][:2] == ("CIV", "exact") and got["Burma"] == ("MMR", "exact", 0)
    assert got["West Bank an Gaza"] == ("PSE", "approximate", 1)
    assert got["UK"] == ("GBR", "exact", 0)


def test_no_all_pairs_and_numbered_grams(spark):
    one = spark.createDataFrame([("banana", ), ("aaaa",)], "k string").select(name_grams(F.col("k")).alias("g"))
    assert [r["g"] for r in one.collect()] == [
        ["^^b#1", "^ba#1", "ban#1", "ana#1", "nan#1", "ana#2", "na$#1", "a$$#1"],
        ["^^a#1", "^aa#1", "aaa#1", "aaa#2", "aa$#1", "a$$#1"]]
    names = spark.createDataFrame([("Colombiaa",)], "Country string")
    plan = match_names(names, iso_aliases(spark))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    with pytest.raises(ValueError):
        match_names(names, iso_aliases(spark), share=3)


def test_approximate_codes_keep_rows_and_columns(spark):
    df = spark.createDataFrame([("Colombiaa", 1), ("Peru", 2), (None, 3), ("Nowhere", 4), ("Peru", 5)], "Country string, code int")
    out = op.approximate_codes(df, iso_aliases(spark))
    assert out.columns == ["Country", "code", "Country_clean"]
    assert sorted((r[1], r[2]) for r in out.collect()) == [(1, "COL"), (2, "PER"), (3, None), (4, None), (5, "PER")]
    assert op.approximate_codes(df.limit(0), iso_aliases(spark)).count() == 0


def test_every_iso_code_has_a_name(spark):
    rows = iso_aliases(spark).collect()
    codes = {r["code"] for r in rows}
    assert len(codes) == 249 and {"PSE", "VAT", "HKG", "GRL", "PRI"} <= codes
    snap = spark.createDataFrame([("West Bank and Gaza", 1.0), ("Mainland China", 1.0), ("Diamond Princess", 1.0)],
                                 "Country string, Confirmed double")
    got = {r["Country"]: r["Country_clean"] for r in op.country_codes(snap, iso_aliases(spark)).collect()}
    assert got == {"West Bank and Gaza": "PSE", "Mainland China": "CHN", "Diamond Princess": None}
