"""What plans may cost: every given table is read once, and few exchanges place exact percentiles."""

import pytest

import __spark_entry__ as entry_module
from lagline.operators import aggregates
from lagline.plans import inputs


def nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


@pytest.fixture
def cost(spark, sf, monkeypatch):
    """Scans of given tables in all plans of a query, and the shuffles of its last plan."""
    scans = []

    def look(df):
        found = list(nodes(df._jdf.queryExecution().executedPlan()))
        scans.extend(n for n in found if n.nodeName().startswith("Scan parquet") and f"{sf}/" in n.relation().location().rootPaths().mkString())
        return sum(n.nodeName() == "Exchange" for n in found)

    def written(df, purpose, real=aggregates.written):
        look(df)
        return real(df, purpose)

    def count(name):
        shuffles = look(entry_module.queries()[name](spark, sf))
        return len(scans), shuffles

    for module in (aggregates, inputs):
        monkeypatch.setattr(module, "written", written)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield count
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", [
    "ag_percentiles", "ag_hourly", "ag_response_summary", "ag_exact_percentile", "ag_iqr_outliers", "ag_area_perf", "ag_risk_score",
    "ag_box_stats", "ag_histogram", "ag_top_categories_abs", "ag_p10_p90", "ag_location_features",
])
def test_tables_are_read_once(cost, name):
    scans, shuffles = cost(name)
    assert scans == 2  # one a city
    assert shuffles <= 9  # without the run-time planner, which broadcasts small sides instead
