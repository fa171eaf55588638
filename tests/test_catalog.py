"""Driver contract at sf0.001: every query runs; every SQL twin agrees with DuckDB."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import digest, type_diff  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in E.catalog.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10 and df.columns[0] == "r_name"


def test_every_query_has_a_callable_and_known_oracles():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    orows, ocols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert type_diff(df.schema, cur.description) == []
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, ocols)[0]


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF).count() >= 0


ORDERED = ["flagship_profile", "group_percentiles", "global_quantiles", "summary_long", "global_row_number",
           "durbin_watson", "durbin_watson_grouped", "breusch_godfrey", "eda_capital_by_size"]


@pytest.mark.parametrize("name", ORDERED)
def test_ordered_queries_do_not_depend_on_exchange_reuse(spark, duck, name):
    saved = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = E.queries()[name](spark, SF)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.exchange.reuse", saved)
    cur = duck.execute(E.oracle_sql()[name])
    assert digest(rows, df.columns)[0] == digest(cur.fetchall(), [d[0] for d in cur.description])[0]
