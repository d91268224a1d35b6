"""The registered queries over the driver's smallest tables, those with SQL against DuckDB."""

import os
from decimal import Decimal

import pytest

import __spark_entry__ as entry
from tessera.plans import queries as plans

FOLDER = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(plans.QUERIES) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", plans.ORACLES)
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{f}'")
    df = plans.QUERIES[name](spark, FOLDER)
    cur = con.execute(plans.ORACLES[name])
    names = [x[0] for x in cur.description]
    assert sorted(df.columns) == sorted(names)
    show = lambda v: f"{float(v):.9g}" if isinstance(v, (float, Decimal)) else str(v)
    assert sorted(tuple(map(show, r)) for r in df.select(*names).collect()) == sorted(tuple(map(show, r)) for r in cur.fetchall())
