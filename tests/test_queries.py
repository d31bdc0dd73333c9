"""Every query with SQL agrees with it on the smallest data; the others give rows."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from lagline.plans import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
ORACLES = catalog.ORACLES
# Model queries that are checked by their own tests and only need to give rows here.
ROWS = ["sp_sample", "sp_split", "sink_parquet_sample", "sv_logrank_suite", "sv_hr_table", "ml_forecast", "ml_shap_importance"]


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    return v.replace(tzinfo=None) if getattr(v, "tzinfo", None) is not None else v


def table(cols, rows, order):
    return sorted((tuple(plain(r[cols.index(c)]) for c in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, sf, con, name):
    df = entry_module.queries()[name](spark, sf)
    rel = con.sql(ORACLES[name])
    order = sorted(df.columns)
    assert order == sorted(rel.columns)
    got, want = table(df.columns, df.collect(), order), table(rel.columns, rel.fetchall(), order)
    assert len(got) == len(want)
    assert got == want


@pytest.mark.parametrize("name", ROWS)
def test_query_gives_rows(spark, sf, name):
    assert entry_module.queries()[name](spark, sf).count() > 0


def test_contract(spark):
    queries = entry_module.queries()
    assert set(ORACLES) <= set(queries) and len(queries) > 150
    assert entry_module.entry(spark).count() == 8


def test_filled_and_skipped_slots_share_a_forest(spark, sf, monkeypatch):
    from lagline.plans import catalog_models

    catalog_models._forecaster.cache_clear()
    fitted = []
    monkeypatch.setattr(catalog_models.learning, "train", lambda stages, rows, real=catalog_models.learning.train: fitted.append(rows) or real(stages, rows))
    assert entry_module.queries()["ml_forecast_slots"](spark, sf).count() == 4
    assert len(fitted) == 2  # one a city
    assert set(fitted[0].columns) == {"incident_datetime", "delay_indicator", *catalog_models.learning.FORECAST_FEATURES}
