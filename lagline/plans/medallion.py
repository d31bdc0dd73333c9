"""Bronze to silver to gold per source, and harmonisation into the model-ready schema.

Each step is a function of the previous step's DataFrame, so a pipeline is plain composition and only written
tables are materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.functions import expressions as x
from lagline.functions import taxonomy
from lagline.operators import demand
from lagline.operators.aggregates import gold_summary
from lagline.operators.dedup import keep_first
from lagline.operators.quality import expect_or_drop, expectation_report
from lagline.operators.reshape import union_tagged

# Named row rules of the two sources.
DISPATCH_RULES = {
    "valid_incident_date": "INCIDENT_DATETIME IS NOT NULL",
    "valid_zipcode": "ZIPCODE IS NOT NULL",
    "positive_response_time": "INCIDENT_RESPONSE_SECONDS_QY IS NULL OR INCIDENT_RESPONSE_SECONDS_QY >= 0",
    "logical_time_flow": "INCIDENT_CLOSE_DATETIME IS NULL OR INCIDENT_CLOSE_DATETIME >= INCIDENT_DATETIME",
}
STATION_RULES = {
    "valid_incident_number": "INCIDENT_NUMBER IS NOT NULL",
    "valid_alarm_level": "Event_Alarm_Level BETWEEN 0 AND 5",
    "has_geometry": "geometry IS NOT NULL",
    "non_negative_response_time": "response_time_seconds IS NULL OR response_time_seconds >= 0",
}
STATION_WARNINGS = {"alarm_time_parsed": "alarm_time IS NOT NULL"}
MODEL_COLUMNS = (
    "incident_id", "incident_datetime", "response_minutes", "event_indicator", "delay_indicator", "hour", "day_of_week",
    "month", "season", "year", "incident_category", "unified_alarm_level", "unified_call_source", "location_area",
    "calls_past_30min", "calls_past_60min",
)


def dispatch_silver(bronze: DataFrame) -> DataFrame:
    flags = ("VALID_DISPATCH_RSPNS_TIME_INDC", "VALID_INCIDENT_RSPNS_TIME_INDC")
    clean = (
        x.fill_defaults(bronze, {"ALARM_SOURCE_DESCRIPTION_TX": "UNKNOWN", "HIGHEST_ALARM_LEVEL": "0"})
        .withColumns({f: x.yes_no(f) for f in flags})
        .withColumn("INCIDENT_BOROUGH", x.upper_trim("INCIDENT_BOROUGH"))
    )
    single = keep_first(clean, ["STARFIRE_INCIDENT_ID"], ["INCIDENT_DATETIME"])
    single = keep_first(single, ["INCIDENT_DATETIME", "ALARM_BOX_NUMBER", "INCIDENT_BOROUGH"], ["STARFIRE_INCIDENT_ID"])
    return expect_or_drop(single, DISPATCH_RULES)


def dispatch_gold(silver: DataFrame) -> DataFrame:
    parts = x.time_parts("INCIDENT_DATETIME")
    minutes = x.to_minutes("INCIDENT_RESPONSE_SECONDS_QY")
    rows = silver.select(
        F.col("STARFIRE_INCIDENT_ID").alias("incident_id"),
        F.col("INCIDENT_DATETIME").alias("incident_datetime"),
        minutes.alias("response_minutes"),
        x.delay_indicator(minutes).alias("delay_indicator"),
        x.event_indicator("INCIDENT_RESPONSE_SECONDS_QY").alias("event_indicator"),
        *[c.alias(n) for n, c in parts.items()],
        x.season(parts["month"]).alias("season"),
        *[
            F.col(c).alias(c.lower())
            for c in (
                "INCIDENT_CLASSIFICATION", "INCIDENT_CLASSIFICATION_GROUP", "ALARM_LEVEL_INDEX_DESCRIPTION",
                "ALARM_SOURCE_DESCRIPTION_TX", "INCIDENT_BOROUGH",
            )
        ],
    )
    return demand.citywide_calls(rows, "incident_datetime")


def dispatch_model(gold: DataFrame) -> DataFrame:
    return gold.withColumns(
        {
            "incident_id": F.col("incident_id").cast("string"),
            "incident_category": taxonomy.class_category("incident_classification"),
            "unified_alarm_level": taxonomy.level_from_text("alarm_level_index_description"),
            "unified_call_source": taxonomy.source_from_code("alarm_source_description_tx"),
            "location_area": F.col("incident_borough"),
        }
    ).select(*MODEL_COLUMNS)


def station_silver(bronze: DataFrame) -> DataFrame:
    """Times parsed, one row per incident and alarm time, response and total duration derived, rules applied."""
    times = {
        "alarm_time": "TFS_Alarm_Time", "arrival_time": "TFS_Arrival_Time", "clear_time": "Last_TFS_Unit_Clear_Time",
    }
    parsed = bronze.withColumns({n: x.parse_timestamp(c) for n, c in times.items()}).drop(
        "Ward_At_Event_Dispatch", *times.values()
    )
    single = keep_first(parsed, ["INCIDENT_NUMBER", "alarm_time"], ["_id"])
    timed = single.withColumns(
        {
            "response_time_seconds": x.seconds_between("alarm_time", "arrival_time"),
            "incident_duration_minutes": x.to_minutes(x.seconds_between("alarm_time", "clear_time")),
        }
    ).withColumn("response_time_minutes", x.to_minutes("response_time_seconds"))
    banded = timed.withColumn("response_time_category", x.response_band("response_time_minutes"))
    return expect_or_drop(banded, STATION_RULES)


def station_warnings(silver: DataFrame) -> DataFrame:
    """Rows seen and rows violating, per rule that does not drop rows."""
    return expectation_report(silver, STATION_WARNINGS)


def station_gold(silver: DataFrame) -> DataFrame:
    parts = x.time_parts("alarm_time")
    rows = silver.select(
        F.col("INCIDENT_NUMBER").alias("incident_id"),
        F.col("alarm_time").alias("incident_datetime"),
        F.col("response_time_minutes").alias("response_minutes"),
        x.delay_indicator("response_time_minutes").alias("delay_indicator"),
        x.event_indicator("response_time_minutes").alias("event_indicator"),
        *[c.alias(n) for n, c in parts.items()],
        F.initcap(x.season(parts["month"])).alias("season"),
        "Final_Incident_Type", "Event_Alarm_Level", "Call_Source", "Incident_Station_Area",
    )
    return demand.area_calls(rows, "incident_datetime", "Incident_Station_Area")


def station_summary(silver: DataFrame, decimals: int = 2) -> DataFrame:
    """Aggregate gold table by weekday, time of day and response band."""
    rows = silver.select(
        F.date_format("alarm_time", "EEEE").alias("day_of_week"),
        x.quarter_of_day(F.hour("alarm_time"), x.TIME_OF_DAY).alias("time_of_day"),
        x.is_weekend(F.dayofweek("alarm_time")).alias("is_weekend"),
        "response_time_category", "response_time_minutes", "incident_duration_minutes",
        F.col("Persons_Rescued").alias("persons_rescued"),
    )
    return gold_summary(rows, decimals)


def station_model(gold: DataFrame) -> DataFrame:
    return gold.withColumns(
        {
            "season": F.lower("season"),
            "incident_category": taxonomy.coded_category("Final_Incident_Type"),
            "unified_alarm_level": taxonomy.level_from_number("Event_Alarm_Level"),
            "unified_call_source": taxonomy.source_from_phrase("Call_Source"),
            "location_area": F.col("Incident_Station_Area"),
        }
    ).select(*MODEL_COLUMNS)


def combined(models: dict[str, DataFrame], years: tuple[int, ...] | None = None) -> DataFrame:
    """Model-ready tables of several cities in one, limited to overlapping years if given."""
    parts = {c: df.drop("city").filter(F.col("year").isin(*years)) if years is not None else df.drop("city") for c, df in models.items()}
    return union_tagged(parts)
