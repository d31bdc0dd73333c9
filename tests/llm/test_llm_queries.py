"""Every query of the subpackage runs over the smallest tables and agrees with its SQL where there is one."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from lagline.llm.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    rel = con.sql(ORACLES[name])
    order = sorted(df.columns)
    assert order == sorted(rel.columns)
    rows = lambda cols, found: sorted((tuple(r[cols.index(c)] for c in order) for r in found), key=repr)
    assert rows(df.columns, df.collect()) == rows(rel.columns, rel.fetchall())


def test_registered():
    names = entry_module.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
