"""The physical plans keep the properties the design relies on at scale."""

import contextlib
import datetime as dt
import io
import re

import pytest

from epitrend import operators as op
from epitrend.plans import queries as Q
from epitrend.session import scratch_path
from epitrend.sources import fixtures as fx
from epitrend.sources.parquet import read_clean, write_clean
from tests.conftest import SF001


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main_plan(text: str) -> str:
    return text.split("===== Subqueries =====")[0]


@pytest.fixture(scope="module")
def clean(spark):
    path = write_clean(fx.reports(spark, SF001), scratch_path(spark, "shape"))
    return read_clean(spark, path)


def test_latest_snapshot_pushes_subquery_to_scan(clean):
    p = plan(op.latest_snapshot(clean))
    assert re.search(r"PushedFilters: \[.*EqualTo\(Date,ScalarSubquery", p)
    assert "Join" not in p


def test_top_bottom_is_distributed_top_k(clean):
    p = main_plan(plan(op.top_bottom(op.latest_snapshot(clean), "Confirmed")))
    assert p.count("TakeOrderedAndProject") >= 2 and "Sort " not in p


def test_band_features_shuffle_the_clean_table_once(clean):
    p = plan(op.feature_table(clean))
    assert len(re.findall(r"^\(\d+\) Exchange", p, re.M)) == 1
    assert re.search(r"ReadSchema: struct<Date:date,Country:string,Confirmed:double>", p)
    assert "GreaterThan(Confirmed,0.0)" in p


def test_baseline_row_is_one_subquery_with_pushed_entity(clean):
    p = plan(op.baseline_diff(op.feature_table(clean), "NATION_0"))
    assert len(re.findall(r"^Subquery:\d+", p, re.M)) == 1
    assert "EqualTo(Country,NATION_0)" in p and "Join" not in main_plan(p)


def test_qualify_broadcasts_entities_and_keeps_table_unshuffled(clean):
    p = plan(op.qualify_entities(clean, min_rows=30, on="1998-06-01", gt=1))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p
    assert not re.search(r"^\(\d+\) Exchange", p, re.M)


def test_per_report_dates_never_shuffle_raw_rows(spark):
    p = plan(Q._dated(spark, SF001))
    assert "BroadcastHashJoin" in p
    assert not re.search(r"^\(\d+\) Exchange", p, re.M)


def test_rollup_has_partial_aggregate_before_shuffle(spark):
    p = plan(op.daily_rollup(fx.report_rows(spark, SF001)))
    assert "partial_sum" in p


def test_whole_stage_codegen_and_no_python_in_features(clean):
    df = op.feature_table(clean)
    df.collect()  # AQE shows codegen spans in the final plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    assert "*(" in text                     # whole-stage codegen spans
    assert "Python" not in text and "ArrowEval" not in text


def test_similar_entities_sides_share_the_feature_shuffle(clean):
    diffs = op.baseline_diff(op.feature_table(clean), "NATION_0")
    df = op.similar_entities(diffs, "abs")
    df.collect()  # reuse is decided in the final (AQE) plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    assert "ReusedExchange" in text and "ReusedSubquery" in text


def test_customer_reports_are_dealt_by_customer_once(spark, tmp_path):
    day = lambda n: dt.datetime(2000, 1, n)
    lines = [(1, day(1), 2.0, "R"), (1, day(1), 3.0, "A"), (2, day(1), 5.0, "N"), (2, day(2), None, "R"), (3, day(2), 7.0, None),
             (1, day(3), 1.0, "A"), (4, day(1), None, "N"), (9, day(1), 1.0, "R"), (None, day(1), 1.0, "R"), (3, None, 4.0, "A"),
             (3, None, 6.0, "R"), (5, None, 1.0, "N")]
    spark.createDataFrame(lines, "l_orderkey long, l_shipdate timestamp, l_quantity double, l_returnflag string") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, 12), (5, 13), (None, 14), (6, 15)], "o_orderkey long, o_custkey long") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    df = fx.customer_reports(spark, str(tmp_path))
    got = {(r["Country"][9:], r["Date"] and r["Date"].day): tuple(r)[2:] for r in df.collect()}
    assert got == {("10", 1): (10.0, 2.0, 3.0, 5.0), ("10", 2): (10.0, 2.0, 3.0, 5.0), ("10", 3): (11.0, 2.0, 4.0, 5.0),
                   ("11", None): (10.0, 6.0, 4.0, 0.0), ("11", 2): (17.0, 6.0, 4.0, 7.0),
                   ("12", 1): (None, 0.0, 0.0, None), ("13", None): (1.0, 0.0, 0.0, 1.0)}
    assert len(got) == df.count()
    text = fx.customer_reports(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(o_custkey") == 1 and "Exchange hashpartitioning(Date" not in text
    assert "Aggregate" not in text


def test_customers_are_not_broadcast_whatever_their_files_size(spark):
    p = main_plan(plan(fx.reports(spark, SF001)))
    assert re.search(r"SortMergeJoin.*\nLeft keys \[1\]: \[o_custkey", p)
    assert len(re.findall(r"^\(\d+\) BroadcastExchange", p, re.M)) == 1  # nation
