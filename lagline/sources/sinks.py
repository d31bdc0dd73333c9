"""Result tables, exports and saved models."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lagline.operators.sampling import fixed_size_sample


def save_table(df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a catalog table, which replaces its schema; partition columns let readers prune."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def save_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


MANIFEST = "version bigint, folder string, table_schema string, changed array<string>, written_at timestamp"


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Write a table as a folder of its own and then point to it: the new version.

    The pointer is one row that is appended to the table's manifest when all data are in place, so readers have the old
    version or the new one, and a write that fails changes nothing. `changed` lists the columns that came, went, or
    changed their type against the version before.
    """
    spark = df.sparkSession
    before = _latest(spark, path)
    version, folder = (before.version + 1 if before else 1), f"versions/{uuid.uuid4().hex}"
    writer = df.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/{folder}")
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    old = {f.name: f.dataType.simpleString() for f in StructType.fromJson(json.loads(before.table_schema))} if before else kinds
    changed = sorted(c for c in kinds.keys() | old.keys() if kinds.get(c) != old.get(c))
    row = spark.createDataFrame([(version, folder, df.schema.json(), changed)], MANIFEST.replace(", written_at timestamp", ""))
    row.withColumn("written_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return version


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """All versions of a published table, the empty table before the first one."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def _latest(spark: SparkSession, path: str) -> Row | None:
    return manifest(spark, path).orderBy(F.desc("version"), F.desc("written_at"), "folder").first()


def published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The latest version of a published table, or an earlier one."""
    rows = manifest(spark, path) if version is None else manifest(spark, path).where(F.col("version") == version)
    row = rows.orderBy(F.desc("version"), F.desc("written_at"), "folder").first()
    if row is None:
        raise ValueError(f"no version of a table at {path}")
    return spark.read.schema(StructType.fromJson(json.loads(row.table_schema))).parquet(f"{path}/{row.folder}")


def save_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_sample(df: DataFrame, path: str, n: int, keys: Sequence[str]) -> None:
    """A value sample of at most n rows."""
    fixed_size_sample(df, n, keys).write.mode("overwrite").parquet(path)


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


def run_metadata(report: DataFrame, parameters: dict[str, object]) -> DataFrame:
    """A report row with the run's parameters and time, ready for JSON."""
    fixed = F.struct(*[
        (F.array(*map(F.lit, v)) if isinstance(v, (list, tuple)) else F.lit(v)).alias(k) for k, v in parameters.items()
    ])
    return report.withColumn("parameters", fixed).withColumn("created_at", F.current_timestamp())
