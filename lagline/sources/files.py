"""CSV and JSON files: raw incident schemas, readers, mismatch rescue, result tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

_TYPES = {
    "string": StringType(), "int": IntegerType(), "bigint": LongType(), "double": DoubleType(), "timestamp": TimestampType(),
}


def schema_of(text: str) -> StructType:
    """Schema from "name type, ..." text; unlike a DDL parse it needs no running session."""
    pairs = (part.split() for part in text.split(","))
    return StructType([StructField(name, _TYPES[kind], True) for name, kind in pairs])


# Declared columns of the two raw sources and their reader options.
DISPATCH_SCHEMA = schema_of(
    """STARFIRE_INCIDENT_ID string, INCIDENT_DATETIME timestamp, ALARM_BOX_BOROUGH string, ALARM_BOX_NUMBER int,
    ALARM_BOX_LOCATION string, INCIDENT_BOROUGH string, ZIPCODE string, POLICEPRECINCT int, CITYCOUNCILDISTRICT int,
    COMMUNITYDISTRICT int, COMMUNITYSCHOOLDISTRICT int, CONGRESSIONALDISTRICT int, ALARM_SOURCE_DESCRIPTION_TX string,
    ALARM_LEVEL_INDEX_DESCRIPTION string, HIGHEST_ALARM_LEVEL string, INCIDENT_CLASSIFICATION string,
    INCIDENT_CLASSIFICATION_GROUP string, DISPATCH_RESPONSE_SECONDS_QY int, FIRST_ASSIGNMENT_DATETIME timestamp,
    FIRST_ACTIVATION_DATETIME timestamp, FIRST_ON_SCENE_DATETIME timestamp, INCIDENT_CLOSE_DATETIME timestamp,
    VALID_DISPATCH_RSPNS_TIME_INDC string, VALID_INCIDENT_RSPNS_TIME_INDC string, INCIDENT_RESPONSE_SECONDS_QY int,
    INCIDENT_TRAVEL_TM_SECONDS_QY int, ENGINES_ASSIGNED_QUANTITY int, LADDERS_ASSIGNED_QUANTITY int,
    OTHERS_UNITS_ASSIGNED_QUANTITY int"""
)
DISPATCH_OPTIONS = {"header": "true", "encoding": "ISO-8859-1", "timestampFormat": "MM/dd/yyyy hh:mm:ss a"}
STATION_SCHEMA = schema_of(
    """_id int, INCIDENT_NUMBER string, Initial_CAD_Event_Type string, Initial_CAD_Event_Call_Type string,
    Final_Incident_Type string, Event_Alarm_Level int, Call_Source string, Incident_Station_Area string,
    Incident_Ward int, Ward_At_Event_Dispatch string, Intersection string, TFS_Alarm_Time string,
    TFS_Arrival_Time string, Last_TFS_Unit_Clear_Time string, Persons_Rescued int, geometry string"""
)
STATION_OPTIONS = {"header": "true", "mode": "PERMISSIVE", "quote": '"', "escape": '"'}
RESCUED = "_rescued_data"


def read_csv(spark: SparkSession, folder: str, schema: StructType, options: Mapping[str, str]) -> DataFrame:
    return spark.read.schema(schema).options(**options).csv(folder)


def stream_csv(spark: SparkSession, folder: str, schema: StructType, options: Mapping[str, str]) -> DataFrame:
    """Incremental scan of a folder of CSV files; the schema is declared, never inferred."""
    return spark.readStream.schema(schema).options(**options).csv(folder)


def _as_text(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields])


def rescue(raw: DataFrame, schema: StructType, timestamp_format: str) -> DataFrame:
    """Typed columns from text columns; values that do not fit become NULL and are kept as JSON in one column.

    So are the values of columns that the schema does not have; one that only the schema has is NULL.
    """
    typed, failed = [], []
    for name in raw.columns:
        if name not in schema.fieldNames():
            failed += [F.lit(name), F.col(f"`{name}`")]
    for f in schema.fields:
        if f.name not in raw.columns:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        text = F.col(f.name)
        if isinstance(f.dataType, StringType):
            typed.append(text)
            continue
        value = (
            F.try_to_timestamp(text, F.lit(timestamp_format))
            if isinstance(f.dataType, TimestampType)
            else text.try_cast(f.dataType)
        )
        typed.append(value.alias(f.name))
        failed += [F.lit(f.name), F.when(value.isNull(), text)]
    kept = F.map_filter(F.create_map(*failed), lambda _, v: v.isNotNull()) if failed else F.lit(None)
    lost = F.when(F.size(kept) > 0, F.to_json(kept)) if failed else F.lit(None).cast("string")
    return raw.select(*typed, lost.alias(RESCUED))


def read_rescued(spark: SparkSession, folder: str, schema: StructType, options: Mapping[str, str]) -> DataFrame:
    """Files with a header are read by its names, so that no column is lost or mistaken for another."""
    text = _as_text(schema)
    if options.get("header") == "true":
        names = spark.read.options(**options).csv(folder).columns  # reads one line
        text = StructType([StructField(n, StringType(), True) for n in names])
    return rescue(read_csv(spark, folder, text, options), schema, options.get("timestampFormat", "yyyy-MM-dd HH:mm:ss"))


def stream_rescued(spark: SparkSession, folder: str, schema: StructType, options: Mapping[str, str]) -> DataFrame:
    raw = stream_csv(spark, folder, _as_text(schema), options)
    return rescue(raw, schema, options.get("timestampFormat", "yyyy-MM-dd HH:mm:ss"))


def read_result_csv(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(folder)


def read_result_json(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(folder)


def drain(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Ingest everything that has arrived and stop; the checkpoint makes the next run continue from there."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
