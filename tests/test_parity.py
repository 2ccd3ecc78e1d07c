"""Every query of the engine against its SQL on DuckDB."""

import math

import duckdb
import pytest

from featherline.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return str(v)


def rows(columns, found):
    order = sorted(columns)
    at = [list(columns).index(c) for c in order]
    return order, sorted(tuple(plain(r[i]) for i in at) for r in found)


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, small, duck, name):
    df = catalog.queries()[name](spark, small)
    want = duck.sql(catalog.oracle_sql()[name])
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_gives_rows(spark, small, name):
    assert catalog.queries()[name](spark, small).count() > 0


def test_filters_and_columns_reach_the_scan(spark, small):
    plan = catalog.queries()["range_filter"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity)" in plan and "l_comment" not in plan and "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_discount:double>" in plan
