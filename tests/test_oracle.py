"""Every registered query against its DuckDB SQL on sf0.01, as the driver does."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF001, SF01
from tools.oracle_check import TABLES, value_hash

QUERIES = entry_mod.queries()
SQL = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF01)
    srows = [tuple(r) for r in df.collect()]
    duck.execute(f"CREATE OR REPLACE VIEW oracle_view AS {SQL[name]}")
    cur = duck.execute("SELECT * FROM oracle_view")
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert value_hash(srows, df.columns) == value_hash(drows, dcols)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["side", "Country", "Confirmed"]
    assert df.count() >= 0


# The training-data queries without SQL have brute-force tests of their own.
@pytest.mark.parametrize("name", sorted(n for n in set(QUERIES) - set(SQL) if n not in entry_mod.LLM_QUERIES))
def test_non_sql_queries_run(spark, name):
    assert QUERIES[name](spark, SF001).count() > 0


def test_feature_queries_have_rows_at_the_smallest_scale(spark):
    for name in ("feature_table", "baseline_diff", "similar_by_abs", "kmeans_k5", "k_sweep"):
        assert QUERIES[name](spark, SF001).count() > 0
