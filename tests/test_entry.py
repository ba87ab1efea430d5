"""Registered queries run and keep to their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as e

SF = "/root/testdata/sf0.001"
CHECKED = ["w1_gaps", "w2_tiles", "b3_latest", "f1_pending", "c12_coverage", "t2_ranking", "g10_audit", "j12_parse"]


def test_entry(spark):
    assert e.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("events", "lineitem", "documents", "part", "pages"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(e.oracle_sql()[name])
    got = e.queries()[name](spark, SF)
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = lambda rows: sorted((tuple(str(v).lower() for v in r) for r in rows))
    assert key(got.select(cols).collect()) == key(want.select(", ".join(cols)).fetchall())
