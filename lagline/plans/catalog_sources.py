"""Registered sources, sinks and the medallion pipelines, on raw files written from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lagline.functions import expressions as x
from lagline.functions import taxonomy
from lagline.operators import aggregates as agg
from lagline.operators.dedup import keep_first_within
from lagline.plans import medallion
from lagline.plans.catalog_scalars import (
    CODE_SOURCE_SQL, PHRASE_SOURCE_SQL, normal_sql,
    _CLASS_SAMPLES, _CODE_SAMPLES, _CODED_SAMPLES, _LEVEL_SAMPLES, _PHRASE_SAMPLES, _sql_rules, _sql_text,
)
from lagline.plans.inputs import CITIES, INC_SQL, MODEL_SQL, freight_model_ready, incidents, web_model_ready
from lagline.plans.registry import query
from lagline.session import work_dir
from lagline.sources import files, sinks, tables
from lagline.sources.tables import load
from lagline.streaming import bronze, checked


def _pick(number, samples, default):
    return x.cases([(number == i, t) for i, t in samples], F.lit(default))


def dispatch_raw(spark, d):
    """lineitem as a raw dispatch file: typed values in the declared column order."""
    at = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(
        F.lit(0), (F.col("l_partkey") % 24).cast("int"), (F.col("l_suppkey") % 60).cast("int")
    )
    seconds = F.when(F.col("l_discount") < 0.085, F.floor(F.col("l_extendedprice") / 100.0).cast("int"))
    given = {
        "STARFIRE_INCIDENT_ID": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "INCIDENT_DATETIME": at,
        "ALARM_BOX_NUMBER": (F.col("l_suppkey") % 50).cast("int"),
        "INCIDENT_BOROUGH": F.concat(F.lit("area "), F.lower("l_returnflag")),
        "ZIPCODE": F.when(F.col("l_linestatus") == "F", F.col("l_suppkey").cast("string")).when(
            F.col("l_returnflag") != "R", F.lit("10001")
        ),
        "ALARM_SOURCE_DESCRIPTION_TX": _pick(F.col("l_partkey") % 13, _CODE_SAMPLES, None),
        "ALARM_LEVEL_INDEX_DESCRIPTION": _pick(F.col("l_partkey") % 12, _LEVEL_SAMPLES, None),
        "HIGHEST_ALARM_LEVEL": F.when(F.col("l_linenumber") > 2, F.lit("First Alarm")),
        "INCIDENT_CLASSIFICATION": _pick(F.col("l_suppkey") % 25, _CLASS_SAMPLES, "Service call"),
        "INCIDENT_CLASSIFICATION_GROUP": F.lit("Group"),
        "INCIDENT_CLOSE_DATETIME": at + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_linenumber") * 10 - 12),
        "VALID_DISPATCH_RSPNS_TIME_INDC": F.when(F.col("l_linenumber") < 5, F.lit("y ")).otherwise(F.lit("N")),
        "VALID_INCIDENT_RSPNS_TIME_INDC": F.when(F.col("l_linenumber") < 3, F.lit("Y")).when(F.col("l_linenumber") < 6, F.lit("N")),
        "INCIDENT_RESPONSE_SECONDS_QY": seconds,
    }
    rows = load(spark, d, "lineitem")
    return rows.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in files.DISPATCH_SCHEMA.fields]
    )


DISPATCH_RAW_SQL = f"""
draw AS (SELECT concat_ws('-', l_orderkey, l_linenumber) AS id, l_shipdate + to_hours(l_partkey % 24) + to_minutes(l_suppkey % 60) AS happened,
  CAST(l_suppkey % 50 AS INTEGER) AS box, 'area ' || lower(l_returnflag) AS borough,
  CASE WHEN l_linestatus = 'F' THEN CAST(l_suppkey AS VARCHAR) WHEN l_returnflag <> 'R' THEN '10001' END AS zip,
  CASE l_partkey % 13 {" ".join(f"WHEN {i} THEN {_sql_text(t)}" for i, t in _CODE_SAMPLES)} END AS source,
  CASE l_partkey % 12 {" ".join(f"WHEN {i} THEN {_sql_text(t)}" for i, t in _LEVEL_SAMPLES)} END AS level,
  CASE l_suppkey % 25 {" ".join(f"WHEN {i} THEN {_sql_text(t)}" for i, t in _CLASS_SAMPLES)} ELSE 'Service call' END AS class,
  CASE WHEN l_discount < 0.085 THEN CAST(floor(l_extendedprice / 100.0::DOUBLE) AS INTEGER) END AS secs,
  l_linenumber, l_partkey, l_suppkey, l_orderkey, l_shipdate + to_hours(l_partkey % 24) + to_minutes(l_suppkey % 60 + l_linenumber * 10 - 12) AS closed
FROM lineitem)
"""


def station_raw(spark, d):
    """events as a raw station file: times as text in four formats, JSON text in one column."""
    ts = F.col("ts").cast("timestamp")
    k = F.regexp_extract("props", r"([0-9]+)", 1).cast("int")
    seconds = F.floor(F.col("value") * 6).cast("int")
    arrival = ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds - 30)
    clear = ts + F.make_dt_interval(F.lit(0), F.lit(1), F.lit(0), seconds)
    kind = F.col("event_type")

    def text(t, formats=x.TIMESTAMP_FORMATS):
        names = ("click", "view", "signup", "purchase")
        return x.cases([(kind == n, F.date_format(t, f)) for n, f in zip(names, formats)], F.lit("unknown"))

    given = {
        "_id": F.col("event_id"),
        "INCIDENT_NUMBER": F.concat(F.lit("F"), (F.col("event_id") / 2).cast("bigint")),
        "Final_Incident_Type": _pick(k % 30, _CODED_SAMPLES, "99 - other, with comma"),
        "Event_Alarm_Level": k % 8 - 1,
        "Call_Source": _pick(k % 12, _PHRASE_SAMPLES, None),
        "Incident_Station_Area": F.col("user_id"),
        "TFS_Alarm_Time": text(ts),
        "TFS_Arrival_Time": F.when(k < 90, text(arrival)),
        "Last_TFS_Unit_Clear_Time": text(clear),
        "Persons_Rescued": F.when(k > 95, k - 95).otherwise(0),
        "geometry": F.when(k != 50, F.col("props")),
    }
    rows = load(spark, d, "events")
    return rows.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in files.STATION_SCHEMA.fields])


def _write_csv(df, path, **options):
    df.write.mode("overwrite").options(header="true", **options).csv(path)


@query(
    "src_csv_stream",
    "WITH " + DISPATCH_RAW_SQL + """SELECT id AS "STARFIRE_INCIDENT_ID", happened AS "INCIDENT_DATETIME", box AS "ALARM_BOX_NUMBER",
      zip AS "ZIPCODE", class AS "INCIDENT_CLASSIFICATION", secs AS "INCIDENT_RESPONSE_SECONDS_QY", CAST(NULL AS VARCHAR) AS "_rescued_data" FROM draw""",
)
def src_csv_stream(spark, d):
    landing, target, check = (work_dir(spark, n) for n in ("landing", "bronze", "progress"))
    _write_csv(dispatch_raw(spark, d), landing, encoding="ISO-8859-1", timestampFormat="MM/dd/yyyy hh:mm:ss a")
    rows = bronze.ingest_dispatch(spark, landing, target, check)
    return rows.select(
        "STARFIRE_INCIDENT_ID", F.col("INCIDENT_DATETIME").cast("timestamp_ntz").alias("INCIDENT_DATETIME"), "ALARM_BOX_NUMBER",
        "ZIPCODE", "INCIDENT_CLASSIFICATION", "INCIDENT_RESPONSE_SECONDS_QY", "_rescued_data",
    )


STATION_RAW_SQL = f"""
ev AS (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k, CAST(floor(value * 6) AS INTEGER) AS sec FROM events),
sraw AS (SELECT CAST(event_id AS INTEGER) AS id, 'F' || CAST(event_id // 2 AS VARCHAR) AS number, k, user_id, event_type, sec,
  CASE k % 30 {" ".join(f"WHEN {i} THEN {_sql_text(t)}" for i, t in _CODED_SAMPLES)} ELSE '99 - other, with comma' END AS final_type,
  CASE k % 12 {" ".join(f"WHEN {i} THEN {_sql_text(t)}" for i, t in _PHRASE_SAMPLES)} END AS source,
  k % 8 - 1 AS level, CASE WHEN k > 95 THEN k - 95 ELSE 0 END AS rescued, CASE WHEN k <> 50 THEN props END AS geometry,
  CASE WHEN event_type IN ('click', 'view', 'signup') THEN date_trunc('second', ts)
    WHEN event_type = 'purchase' THEN date_trunc('minute', ts) END AS alarm_time,
  CASE WHEN k >= 90 THEN NULL WHEN event_type IN ('click', 'view', 'signup') THEN date_trunc('second', ts + to_seconds(sec - 30))
    WHEN event_type = 'purchase' THEN date_trunc('minute', ts + to_seconds(sec - 30)) END AS arrival_time,
  CASE WHEN event_type IN ('click', 'view', 'signup') THEN date_trunc('second', ts + to_seconds(3600 + sec))
    WHEN event_type = 'purchase' THEN date_trunc('minute', ts + to_seconds(3600 + sec)) END AS clear_time
  FROM ev)
"""


@query(
    "src_csv_quoted",
    "WITH " + STATION_RAW_SQL + """SELECT id AS _id, number AS "INCIDENT_NUMBER", final_type AS "Final_Incident_Type",
    level AS "Event_Alarm_Level", rescued AS "Persons_Rescued", geometry FROM sraw""",
)
def src_csv_quoted(spark, d):
    landing, target, check = (work_dir(spark, n) for n in ("landing", "bronze", "progress"))
    _write_csv(station_raw(spark, d), landing, quote='"', escape='"')
    rows = bronze.ingest_station(spark, landing, target, check)
    return rows.select("_id", "INCIDENT_NUMBER", "Final_Incident_Type", "Event_Alarm_Level", "Persons_Rescued", "geometry")


_RESCUE_SCHEMA = files.schema_of("event_id bigint, at timestamp, kind string, seconds int")


@query(
    "src_rescued",
    """SELECT event_id, CASE WHEN event_type <> 'view' THEN date_trunc('second', ts) END AS at, event_type AS kind,
      CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS INTEGER) END AS seconds,
      CASE event_type WHEN 'error' THEN '{"seconds":"n/a"}' WHEN 'view' THEN '{"at":"yesterday"}' END AS _rescued_data FROM events""",
)
def src_rescued(spark, d):
    fmt = "MM/dd/yyyy hh:mm:ss a"
    kind = F.col("event_type")
    raw = load(spark, d, "events").select(
        F.col("event_id").cast("string"),
        F.when(kind == "view", "yesterday").otherwise(F.date_format("ts", fmt)).alias("at"),
        kind.alias("kind"),
        F.when(kind == "error", "n/a").otherwise(F.floor("value").cast("string")).alias("seconds"),
    )
    landing = work_dir(spark, "landing")
    _write_csv(raw, landing)
    rows = files.read_rescued(spark, landing, _RESCUE_SCHEMA, {"header": "true", "timestampFormat": fmt})
    return rows.withColumn("at", F.col("at").cast("timestamp_ntz"))


@query("src_table", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def src_table(spark, d):
    name = f"orders_{uuid.uuid4().hex}"
    load(spark, d, "orders").createOrReplaceTempView(name)
    return tables.catalog_table(spark, name).select("o_orderkey", "o_custkey", "o_totalprice")


@query("src_sql_text", "SELECT event_type, count(*) AS n, max(value) AS max_value FROM events GROUP BY event_type")
def src_sql_text(spark, d):
    name = f"events_{uuid.uuid4().hex}"
    text = f"SELECT event_type, count(*) AS n, max(value) AS max_value FROM {name} GROUP BY event_type"
    return tables.sql_dataset(spark, {name: load(spark, d, "events")}, text)


@query(
    "src_local_rows",
    INC_SQL + """SELECT city, threshold, label, count(*) FILTER (response_minutes > threshold) AS n_over FROM inc,
      (VALUES (5, 'strict'), (8, 'service'), (10, 'late')) t(threshold, label) GROUP BY ALL""",
)
def src_local_rows(spark, d):
    """Three literal rows joined to the per-city counts over each threshold."""
    limits = spark.createDataFrame([(5, "strict"), (8, "service"), (10, "late")], "threshold int, label string")
    counts = agg.threshold_risk(incidents(spark, d), ["city"], (5, 8, 10)).withColumn("threshold", F.col("threshold_min").cast("int"))
    return counts.join(F.broadcast(limits), "threshold").select("city", "threshold", "label", F.col("n_exceed").alias("n_over"))


@query(
    "src_upstream",
    "WITH " + STATION_RAW_SQL + """, s1 AS (SELECT * FROM sraw QUALIFY row_number() OVER (PARTITION BY number, alarm_time ORDER BY id) = 1),
    silver AS (SELECT *, CAST(epoch(arrival_time) - epoch(alarm_time) AS BIGINT) AS s FROM s1)
    SELECT id AS _id, number AS "INCIDENT_NUMBER", alarm_time, s AS response_time_seconds, s / 60 AS m,
      CASE WHEN s / 60 < 5 THEN 'Excellent (<5 min)' WHEN s / 60 < 10 THEN 'Good (5-10 min)' WHEN s / 60 < 15 THEN 'Fair (10-15 min)'
        ELSE 'Poor (>15 min)' END AS response_time_category
    FROM silver WHERE level BETWEEN 0 AND 5 AND geometry IS NOT NULL AND (s IS NULL OR s >= 0)""",
)
def src_upstream(spark, d):
    """Silver as a function of bronze: the raw rows go through parsing, dedup, derivation and rules."""
    rows = medallion.station_silver(station_raw(spark, d))
    return rows.select(
        "_id", "INCIDENT_NUMBER", F.col("alarm_time").cast("timestamp_ntz").alias("alarm_time"), "response_time_seconds",
        (F.col("response_time_seconds") / 60).alias("m"), "response_time_category",
    )


@query(
    "plan_station_model",
    "WITH " + STATION_RAW_SQL + f""", s1 AS (SELECT * FROM sraw QUALIFY row_number() OVER (PARTITION BY number, alarm_time ORDER BY id) = 1),
    s2 AS (SELECT *, CAST(epoch(arrival_time) - epoch(alarm_time) AS BIGINT) AS s, CAST(epoch(alarm_time) AS BIGINT) AS sec0 FROM s1),
    silver AS (SELECT *, """ + normal_sql("source") + f""" AS t FROM s2 WHERE level BETWEEN 0 AND 5 AND geometry IS NOT NULL AND (s IS NULL OR s >= 0))
    SELECT number AS incident_id, s > 480 AS late, CAST(month(alarm_time) AS INTEGER) AS month,
      CASE WHEN month(alarm_time) IN (12, 1, 2) THEN 'winter' WHEN month(alarm_time) IN (3, 4, 5) THEN 'spring'
        WHEN month(alarm_time) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season,
      {_sql_rules('upper(final_type)', taxonomy.CODED_LABELS, taxonomy.ASSISTANCE)} AS incident_category,
      CASE WHEN level = 0 THEN 1 WHEN level IN (1, 2) THEN 2 WHEN level >= 3 THEN 3 END AS unified_alarm_level,
      {PHRASE_SOURCE_SQL} AS unified_call_source,
      CAST(user_id AS VARCHAR) AS location_area,
      CAST(count(*) OVER (PARTITION BY user_id ORDER BY sec0 RANGE BETWEEN 1800 PRECEDING AND CURRENT ROW) - 1 AS BIGINT) AS calls_past_30min,
      CAST(count(*) OVER (PARTITION BY user_id ORDER BY sec0 RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) - 1 AS BIGINT) AS calls_past_60min
    FROM silver""",
)
def plan_station_model(spark, d):
    """Raw station rows through silver, gold and harmonisation."""
    rows = medallion.station_model(medallion.station_gold(medallion.station_silver(station_raw(spark, d))))
    return rows.select(
        "incident_id", (F.col("delay_indicator") == 1).alias("late"), "month", "season", "incident_category",
        "unified_alarm_level", "unified_call_source", "location_area", "calls_past_30min", "calls_past_60min",
    )


@query(
    "plan_dispatch_model",
    "WITH " + DISPATCH_RAW_SQL + """,
    d1 AS (SELECT * FROM draw QUALIFY row_number() OVER (PARTITION BY id ORDER BY happened, box, borough, zip, source, level, class, closed, secs) = 1),
    d2 AS (SELECT * FROM d1 QUALIFY row_number() OVER (PARTITION BY happened, box, upper(trim(borough)) ORDER BY id) = 1),
    silver AS (SELECT *, CAST(epoch(happened) AS BIGINT) AS s, """ + normal_sql("coalesce(source, 'UNKNOWN')") + """ AS t FROM d2 WHERE zip IS NOT NULL AND closed >= happened)
    SELECT id AS incident_id, happened AS incident_datetime, CASE WHEN secs IS NULL THEN NULL WHEN secs > 480 THEN 1 ELSE 0 END AS delay_indicator,
      CAST(secs IS NOT NULL AS INTEGER) AS event_indicator, CAST(hour(happened) AS INTEGER) AS hour, upper(borough) AS location_area,
      """ + CODE_SOURCE_SQL + """ AS unified_call_source,
      CAST(count(*) OVER (ORDER BY s RANGE BETWEEN 1800 PRECEDING AND 1 PRECEDING) AS BIGINT) AS calls_past_30min,
      CAST(count(*) OVER (ORDER BY s RANGE BETWEEN 3600 PRECEDING AND 1 PRECEDING) AS BIGINT) AS calls_past_60min
    FROM silver""",
)
def plan_dispatch_model(spark, d):
    """Raw dispatch rows through silver, gold and harmonisation."""
    rows = medallion.dispatch_model(medallion.dispatch_gold(medallion.dispatch_silver(dispatch_raw(spark, d))))
    return rows.select(
        "incident_id", F.col("incident_datetime").cast("timestamp_ntz").alias("incident_datetime"), "delay_indicator",
        "event_indicator", "hour", "location_area", "unified_call_source", "calls_past_30min", "calls_past_60min",
    )


@query(
    "plan_station_warnings",
    "WITH " + STATION_RAW_SQL + """, s1 AS (SELECT * FROM sraw QUALIFY row_number() OVER (PARTITION BY number, alarm_time ORDER BY id) = 1),
    silver AS (SELECT *, epoch(arrival_time) - epoch(alarm_time) AS s FROM s1)
    SELECT count(*) AS rows, 'alarm_time_parsed' AS rule, count(*) - count(alarm_time) AS violations FROM silver
    WHERE level BETWEEN 0 AND 5 AND geometry IS NOT NULL AND (s IS NULL OR s >= 0)""",
)
def plan_station_warnings(spark, d):
    """Rows of the station silver table that break a rule which only warns."""
    return medallion.station_warnings(medallion.station_silver(station_raw(spark, d)))


@query(
    "plan_combined",
    MODEL_SQL + "SELECT city, year, incident_id, response_minutes, unified_call_source, calls_past_60min FROM mr",
)
def plan_combined(spark, d):
    """Both cities in one schema, written by city and year and read back. The given tables share no year to limit them to."""
    models = dict(zip(CITIES, (web_model_ready(spark, d), freight_model_ready(spark, d))))
    path = work_dir(spark, "combined")
    sinks.save_parquet(medallion.combined(models), path, ["city", "year"])
    return spark.read.parquet(path).select("city", "year", "incident_id", "response_minutes", "unified_call_source", "calls_past_60min")


_COUNTS_SQL = INC_SQL + "SELECT city, year, incident_category, count(*) AS n FROM inc GROUP BY ALL"


def _counts(spark, d):
    return incidents(spark, d).groupBy("city", "year", "incident_category").agg(F.count("*").alias("n"))


_COUNTS_SCHEMA = files.schema_of("city string, year int, incident_category string, n bigint")


@query("sink_table", INC_SQL + "SELECT incident_id, city, year, response_minutes FROM inc")
def sink_table(spark, d):
    """A partitioned table that is published twice, the second time with another schema; readers have one version or the other."""
    path = work_dir(spark, "table")
    rows = incidents(spark, d).select("incident_id", "response_minutes", "city", "year")
    sinks.publish(rows.drop("response_minutes"), path, ["city", "year"])
    sinks.publish(rows, path, ["city", "year"])
    return sinks.published(spark, path)


def _arrivals(spark, d):
    """Events as they arrive: in several folders of files, most events twice, the second time in a later folder."""
    rows = load(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    return rows, [rows.where("event_id % 4 < 2"), rows.where("event_id % 4 IN (1, 2)"), rows.where("event_id % 4 <> 1")]


EVENT_RULES = {"value_given": "value IS NOT NULL", "value_above_one": "value > 1", "known_user": "user_id % 10 <> 3"}


def _drained(spark, d):
    """The deduplicated stream and its expectation counts, after a run that failed in its second batch and went on later."""
    landing, target, check = (work_dir(spark, n) for n in ("arrivals", "unique", "progress"))
    rows, parts = _arrivals(spark, d)
    for i, part in enumerate(parts[:2]):
        part.coalesce(1).write.parquet(f"{landing}/{i}")

    def stream():
        arriving = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(landing)
        return keep_first_within(arriving, ["event_id"], "ts", "3650 days")

    try:
        checked.drain(stream(), EVENT_RULES, target, check, fail_at=1)
        raise AssertionError("the run should have been interrupted")
    except checked.Interrupted:
        pass
    parts[2].coalesce(1).write.parquet(f"{landing}/2")
    checked.drain(stream(), EVENT_RULES, target, check)
    return target


@query("dd_stream", "SELECT event_id, user_id, value FROM events")
def dd_stream(spark, d):
    """Repeats dropped by a state store across batches, and across an interruption: every event once."""
    return checked.rows(spark, _drained(spark, d)).select("event_id", "user_id", "value")


@query(
    "dq_stream",
    "SELECT unnest(['value_given', 'value_above_one', 'known_user']) AS rule, count(*) AS rows, unnest([count(*) FILTER (value IS NULL), "
    "count(*) FILTER ((value > 1) IS NOT TRUE), count(*) FILTER (user_id % 10 = 3 OR user_id IS NULL)]) AS violations FROM events",
)
def dq_stream(spark, d):
    """Expectations counted batch by batch, each batch once however often it was tried."""
    return checked.report(spark, _drained(spark, d))


@query("sink_csv", _COUNTS_SQL)
def sink_csv(spark, d):
    path = work_dir(spark, "export")
    sinks.save_csv(_counts(spark, d), path)
    return files.read_result_csv(spark, path, _COUNTS_SCHEMA)


@query("src_result_csv", _COUNTS_SQL)
def src_result_csv(spark, d):
    return sink_csv(spark, d).select("city", "year", "incident_category", "n")


@query("src_result_json", _COUNTS_SQL)
def src_result_json(spark, d):
    path = work_dir(spark, "export")
    sinks.save_json(_counts(spark, d), path)
    return files.read_result_json(spark, path, _COUNTS_SCHEMA)


@query(
    "sink_parquet_sample",
    INC_SQL + """SELECT * FROM inc ORDER BY md5('42|' || city || '|' || CAST(incident_id AS VARCHAR)), city, incident_id LIMIT 1000""",
)
def sink_parquet_sample(spark, d):
    path = work_dir(spark, "sample")
    sinks.save_sample(incidents(spark, d), path, 1000, ["city", "incident_id"])
    return spark.read.parquet(path).withColumn("incident_datetime", F.col("incident_datetime").cast("timestamp_ntz"))
