"""The given tables read as incident data: two differently coded cities in one model-ready schema.

City `web` takes its incidents from `events`, city `freight` from `lineitem`. Both derivations are stated twice,
as DataFrame code here and as SQL text for the equivalence check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline.functions import expressions as x
from lagline.operators import demand
from lagline.operators.reshape import union_tagged
from lagline.session import written
from lagline.sources.tables import load

CITIES = ("web", "freight")
COLUMNS = (
    "incident_id", "incident_datetime", "response_minutes", "delay_indicator", "event_indicator", "hour",
    "day_of_week", "month", "season", "year", "incident_category", "unified_alarm_level", "unified_call_source",
    "location_area",
)


def _finish(df: DataFrame) -> DataFrame:
    parts = x.time_parts("incident_datetime")
    return df.select(
        "incident_id",
        "incident_datetime",
        "response_minutes",
        x.delay_indicator("response_minutes").alias("delay_indicator"),
        x.event_indicator("response_minutes").alias("event_indicator"),
        *[c.alias(n) for n, c in parts.items() if n != "year"],
        x.season(parts["month"]).alias("season"),
        parts["year"].alias("year"),
        "incident_category",
        "unified_alarm_level",
        "unified_call_source",
        "location_area",
    )


def web_incidents(spark: SparkSession, folder: str) -> DataFrame:
    k = F.regexp_extract("props", r"([0-9]+)", 1).cast("int")
    source = x.cases([(k < 25, "Public"), (k < 50, "EMS / Medical"), (k < 75, "Alarm System")], "Other / System")
    return _finish(
        load(spark, folder, "events").select(
            F.col("event_id").cast("string").alias("incident_id"),
            F.col("ts").cast("timestamp").alias("incident_datetime"),
            F.when(F.col("event_type") != "error", F.col("value")).alias("response_minutes"),
            F.col("event_type").alias("incident_category"),
            x.cases([(k < 60, 1), (k < 90, 2), (k < 95, 3)]).cast("int").alias("unified_alarm_level"),
            source.alias("unified_call_source"),
            F.col("user_id").cast("string").alias("location_area"),
        )
    )


def freight_incidents(spark: SparkSession, folder: str) -> DataFrame:
    at = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(
        F.lit(0), (F.col("l_partkey") % 24).cast("int"), (F.col("l_suppkey") % 60).cast("int")
    )
    tax = F.round(F.col("l_tax") * 100).cast("int")
    source = x.cases(
        [(F.col("l_linenumber") <= 3, "Public"), (F.col("l_linenumber") <= 5, "EMS / Medical")], "Alarm System"
    )
    return _finish(
        load(spark, folder, "lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("incident_id"),
            at.alias("incident_datetime"),
            F.when(F.col("l_discount") < 0.085, F.floor(F.col("l_extendedprice") / 10.0) / 100.0).alias("response_minutes"),
            F.concat("l_returnflag", "l_linestatus").alias("incident_category"),
            x.cases([(tax == 0, 1), (tax <= 2, 2), (tax >= 3, 3)]).cast("int").alias("unified_alarm_level"),
            source.alias("unified_call_source"),
            F.col("l_suppkey").cast("string").alias("location_area"),
        )
    )


def incidents(spark: SparkSession, folder: str) -> DataFrame:
    """Both cities in one schema, tagged with `city`."""
    return union_tagged({"web": web_incidents(spark, folder), "freight": freight_incidents(spark, folder)})


def web_model_ready(spark: SparkSession, folder: str) -> DataFrame:
    return demand.citywide_calls(web_incidents(spark, folder), "incident_datetime")


def freight_model_ready(spark: SparkSession, folder: str) -> DataFrame:
    return demand.area_calls(freight_incidents(spark, folder), "incident_datetime", "location_area")


def model_ready(spark: SparkSession, folder: str) -> DataFrame:
    """Incidents with demand intensity: citywide for `web`, per area for `freight`."""
    return union_tagged({"web": web_model_ready(spark, folder), "freight": freight_model_ready(spark, folder)})


def counted_model_ready(spark: SparkSession, folder: str, columns: tuple[str, ...]) -> DataFrame:
    """`model_ready` as counted rows: one row per city, second and values of `columns`, `n` being their number.

    The counts are written, so that demand and everything else derived from them read each table once. `columns` has
    `location_area`.
    """

    def counted(rows: DataFrame) -> DataFrame:
        second = F.date_trunc("second", "incident_datetime").alias("incident_datetime")
        return written(rows.groupBy(second, *columns).agg(F.count("*").alias("n")), "seconds")

    web = demand.citywide_calls(counted(web_incidents(spark, folder)), "incident_datetime", weight="n")
    freight = demand.area_calls(counted(freight_incidents(spark, folder)), "incident_datetime", "location_area", weight="n")
    return union_tagged({"web": web, "freight": freight})


_FINISH_SQL = """
  CAST(response_minutes > 8 AS INTEGER) AS delay_indicator,
  CAST(response_minutes IS NOT NULL AS INTEGER) AS event_indicator,
  CAST(hour(incident_datetime) AS INTEGER) AS hour,
  CAST(dayofweek(incident_datetime) + 1 AS INTEGER) AS day_of_week,
  CAST(month(incident_datetime) AS INTEGER) AS month,
  CASE WHEN month(incident_datetime) IN (12, 1, 2) THEN 'winter' WHEN month(incident_datetime) IN (3, 4, 5) THEN 'spring'
       WHEN month(incident_datetime) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season,
  CAST(year(incident_datetime) AS INTEGER) AS year,
  incident_category, unified_alarm_level, unified_call_source, location_area
"""

WEB_SQL = f"""
web AS (SELECT incident_id, incident_datetime, response_minutes, {_FINISH_SQL} FROM (
  SELECT CAST(event_id AS VARCHAR) AS incident_id, ts AS incident_datetime,
    CASE WHEN event_type <> 'error' THEN value END AS response_minutes, event_type AS incident_category,
    CASE WHEN k < 60 THEN 1 WHEN k < 90 THEN 2 WHEN k < 95 THEN 3 END AS unified_alarm_level,
    CASE WHEN k < 25 THEN 'Public' WHEN k < 50 THEN 'EMS / Medical' WHEN k < 75 THEN 'Alarm System'
         ELSE 'Other / System' END AS unified_call_source,
    CAST(user_id AS VARCHAR) AS location_area
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)))
"""

FREIGHT_SQL = f"""
freight AS (SELECT incident_id, incident_datetime, response_minutes, {_FINISH_SQL} FROM (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS incident_id,
    l_shipdate + to_hours(l_partkey % 24) + to_minutes(l_suppkey % 60) AS incident_datetime,
    CASE WHEN l_discount < 0.085 THEN floor(l_extendedprice / 10.0::DOUBLE) / 100.0::DOUBLE END AS response_minutes,
    l_returnflag || l_linestatus AS incident_category,
    CASE WHEN round(l_tax * 100) = 0 THEN 1 WHEN round(l_tax * 100) <= 2 THEN 2
         WHEN round(l_tax * 100) >= 3 THEN 3 END AS unified_alarm_level,
    CASE WHEN l_linenumber <= 3 THEN 'Public' WHEN l_linenumber <= 5 THEN 'EMS / Medical'
         ELSE 'Alarm System' END AS unified_call_source,
    CAST(l_suppkey AS VARCHAR) AS location_area
  FROM lineitem))
"""

INC_SQL = f"""
WITH {WEB_SQL}, {FREIGHT_SQL},
inc AS (SELECT *, 'web' AS city FROM web UNION ALL SELECT *, 'freight' AS city FROM freight)
"""

WEB_CALLS_SQL = """
web_calls AS (SELECT *, CAST(count(*) OVER (ORDER BY s RANGE BETWEEN 1800 PRECEDING AND 1 PRECEDING) AS BIGINT) AS calls_past_30min,
    CAST(count(*) OVER (ORDER BY s RANGE BETWEEN 3600 PRECEDING AND 1 PRECEDING) AS BIGINT) AS calls_past_60min
  FROM (SELECT *, CAST(floor(epoch(incident_datetime)) AS BIGINT) AS s FROM web))
"""

FREIGHT_CALLS_SQL = """
freight_calls AS (SELECT *,
    CAST(count(*) OVER (PARTITION BY location_area ORDER BY s RANGE BETWEEN 1800 PRECEDING AND CURRENT ROW) - 1 AS BIGINT) AS calls_past_30min,
    CAST(count(*) OVER (PARTITION BY location_area ORDER BY s RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) - 1 AS BIGINT) AS calls_past_60min
  FROM (SELECT *, CAST(floor(epoch(incident_datetime)) AS BIGINT) AS s FROM freight))
"""

MODEL_SQL = f"""
WITH {WEB_SQL}, {FREIGHT_SQL}, {WEB_CALLS_SQL}, {FREIGHT_CALLS_SQL},
mr AS (SELECT * EXCLUDE (s), 'web' AS city FROM web_calls UNION ALL SELECT * EXCLUDE (s), 'freight' AS city FROM freight_calls)
"""
