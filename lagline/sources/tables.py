"""Catalog and parquet table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan one parquet table. Dates are read as wall-clock times in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a table registered in the session catalog."""
    return spark.table(name)


def sql_dataset(spark: SparkSession, frames: dict[str, DataFrame], text: str) -> DataFrame:
    """Evaluate a SQL text over named DataFrames."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return spark.sql(text)
