import json
import os

import pytest
from pyspark.sql import functions as F

from lagline.operators.dedup import keep_first_within
from lagline.plans import medallion
from lagline.plans.catalog_sources import dispatch_raw, station_raw
from lagline.session import work_dir
from lagline.sources import files, sinks, tables
from lagline.streaming import bronze, checked


def test_ingest_continues_from_its_checkpoint(spark, sf):
    landing, target, check = (work_dir(spark, n) for n in ("landing", "bronze", "progress"))
    raw = station_raw(spark, sf)
    first, second = raw.filter("_id < 400"), raw.filter("_id >= 400")
    options = {"header": "true", "quote": '"', "escape": '"'}
    first.write.options(**options).csv(landing)
    assert bronze.ingest_station(spark, landing, target, check).count() == first.count()
    second.write.mode("append").options(**options).csv(landing)
    rows = bronze.ingest_station(spark, landing, target, check)
    assert rows.count() == raw.count()
    assert rows.exceptAll(raw).count() == 0 and raw.exceptAll(rows).count() == 0


def test_rescue_keeps_what_does_not_fit(spark, tmp_path):
    path = str(tmp_path / "in")
    os.makedirs(path)
    with open(path + "/a.csv", "w", encoding="ISO-8859-1") as f:
        f.write('id,at,n\nx\xe9,01/02/2024 03:04:05 PM,5\ny,never,5.5x\nz,,\n')
    schema = files.schema_of("id string, at timestamp, n int")
    options = {"header": "true", "encoding": "ISO-8859-1", "timestampFormat": "MM/dd/yyyy hh:mm:ss a"}
    rows = {r["id"]: r for r in files.read_rescued(spark, path, schema, options).collect()}
    assert str(rows["xé"]["at"]) == "2024-01-02 15:04:05" and rows["xé"][files.RESCUED] is None
    assert rows["y"]["at"] is None and rows["y"]["n"] is None
    assert rows["y"][files.RESCUED] == '{"at":"never","n":"5.5x"}'
    assert rows["z"][files.RESCUED] is None


def test_streaming_dedup_within_watermark(spark, sf):
    path, target, check = (work_dir(spark, n) for n in ("events", "out", "progress"))
    rows = tables.load(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts")).coalesce(1)
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    files.drain(keep_first_within(stream, ["user_id"], "ts", "60 days"), target, check)
    assert spark.read.parquet(target).count() == rows.select("user_id").distinct().count()


def test_silver_rules_hold(spark, sf):
    silver = medallion.dispatch_silver(dispatch_raw(spark, sf))
    for rule in medallion.DISPATCH_RULES.values():
        assert silver.filter(f"NOT coalesce({rule}, false)").count() == 0
    assert silver.groupBy("STARFIRE_INCIDENT_ID").count().filter("count > 1").count() == 0
    summary = medallion.station_summary(medallion.station_silver(station_raw(spark, sf)))
    assert summary.agg(F.sum("total_incidents")).first()[0] == medallion.station_silver(station_raw(spark, sf)).count()


def test_combined_years_and_partitioned_table(spark, sf):
    station = medallion.station_model(medallion.station_gold(medallion.station_silver(station_raw(spark, sf))))
    dispatch = medallion.dispatch_model(medallion.dispatch_gold(medallion.dispatch_silver(dispatch_raw(spark, sf))))
    both = medallion.combined({"station": station, "dispatch": dispatch}, years=(1999, 2024))
    assert both.columns == [*medallion.MODEL_COLUMNS, "city"]
    path = work_dir(spark, "model")
    sinks.save_parquet(both, path, ["city", "year"])
    back = spark.read.parquet(path).filter("city = 'dispatch' AND year = 1999")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(city" in plan
    assert back.count() == dispatch.filter("year = 1999").count() > 0


def test_metadata_row(spark):
    report = spark.createDataFrame([(10,)], "rows_final bigint")
    path = work_dir(spark, "meta")
    sinks.save_json(sinks.run_metadata(report, {"penalty": 0.1, "numeric": ["a", "b"]}), path)
    r = spark.read.json(path).first()
    assert r["rows_final"] == 10 and r["parameters"]["penalty"] == 0.1 and r["parameters"]["numeric"] == ["a", "b"]


class FakeSession:
    """A session of a cluster that may or may not name a shared folder."""

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": "yarn", "getCheckpointDir": lambda _: None})()


def test_work_dir_needs_a_shared_folder_on_clusters():
    assert work_dir(FakeSession("/shared/folder"), "x").startswith("/shared/folder/x-")
    with pytest.raises(ValueError):
        work_dir(FakeSession(None), "x")


def test_sql_dataset(spark, sf):
    out = tables.sql_dataset(spark, {"ev": tables.load(spark, sf, "events")}, "SELECT count(*) AS n FROM ev")
    assert out.first()["n"] == tables.load(spark, sf, "events").count()
    with pytest.raises(Exception):
        tables.catalog_table(spark, "no_such_table").count()


def test_rescue_keeps_columns_outside_the_schema(spark, tmp_path):
    rows = spark.createDataFrame([("x", "1", None), ("y", "two", "more")], "note string, id string, extra string")
    rows.coalesce(1).write.option("header", "true").csv(f"{tmp_path}/in")
    schema = files.schema_of("id int, at timestamp")
    got = files.read_rescued(spark, f"{tmp_path}/in", schema, {"header": "true"})
    assert got.columns == ["id", "at", files.RESCUED]
    kept = sorted((r["id"] or 0, r["at"], json.loads(r[files.RESCUED])) for r in got.collect())
    assert kept == [(0, None, {"note": "y", "extra": "more", "id": "two"}), (1, None, {"note": "x"})]


def test_published_versions(spark):
    """Readers have the old version until the new one is whole; a write that fails changes nothing; schemas are recorded."""
    path = work_dir(spark, "published")
    with pytest.raises(ValueError, match="no version"):
        sinks.published(spark, path)
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    assert sinks.publish(old, path) == 1
    reader = sinks.published(spark, path)
    broken = spark.range(1000).select("id", F.raise_error(F.concat(F.lit("lost "), F.col("id").cast("string"))).cast("string").alias("name"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish(broken, path)
    assert sorted(map(tuple, sinks.published(spark, path).collect())) == [(1, "a"), (2, "b")]
    new = spark.createDataFrame([(3, 0.5, "x")], "id int, score double, part string")
    assert sinks.publish(new, path, ["part"]) == 2
    assert sorted(map(tuple, reader.collect())) == [(1, "a"), (2, "b")]  # a reader that began before the swap
    assert sinks.published(spark, path).collect() == [(3, 0.5, "x")]
    assert sorted(map(tuple, sinks.published(spark, path, 1).collect())) == [(1, "a"), (2, "b")]
    assert [r.changed for r in sinks.manifest(spark, path).orderBy("version").collect()] == [[], ["id", "name", "part", "score"]]
    assert sinks.publish(new.limit(0), path) == 3 and sinks.published(spark, path).count() == 0


def test_interrupted_stream(spark, sf):
    """Each event once and each batch counted once, though a run failed between the rows and the counts of a batch."""
    from lagline.plans import catalog_sources

    target = catalog_sources._drained(spark, sf)
    rows = checked.rows(spark, target)
    events = tables.load(spark, sf, "events").count()
    assert rows.count() == rows.select("event_id").distinct().count() == events and rows.select("batch").distinct().count() == 3
    assert {r["rows"] for r in checked.report(spark, target).collect()} == {events}
