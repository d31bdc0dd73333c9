"""Bronze ingest: CSV folders streamed into parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lagline.sources import files


def ingest_dispatch(spark: SparkSession, landing: str, target: str, checkpoint: str) -> DataFrame:
    """Dispatch source: typed with rescue of mismatching values."""
    stream = files.stream_rescued(spark, landing, files.DISPATCH_SCHEMA, files.DISPATCH_OPTIONS)
    files.drain(stream, target, checkpoint)
    return spark.read.parquet(target)


def ingest_station(spark: SparkSession, landing: str, target: str, checkpoint: str) -> DataFrame:
    """Station source: quoted text, times kept as text for the silver step."""
    stream = files.stream_csv(spark, landing, files.STATION_SCHEMA, files.STATION_OPTIONS)
    files.drain(stream, target, checkpoint)
    return spark.read.parquet(target)
