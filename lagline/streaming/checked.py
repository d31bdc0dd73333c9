"""Streams whose rows are written batch by batch beside the counts of broken expectations.

A batch is a folder of its own that is overwritten when the batch is tried again, so that rows and counts of an interrupted
run are neither lost nor doubled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline.operators.quality import expectation_report

INTERRUPTION = "interrupted on purpose"


class Interrupted(RuntimeError):
    """A run that `fail_at` ended."""


def drain(stream: DataFrame, rules: Mapping[str, str], target: str, checkpoint: str, fail_at: int | None = None) -> None:
    """Write what has arrived and stop; the next call goes on from the checkpoint.

    fail_at: the number of a batch that fails between its rows and its counts, to try a recovery.
    """

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            kept.write.mode("overwrite").parquet(f"{target}/rows/batch={number}")
            if number == fail_at:
                raise RuntimeError(INTERRUPTION)
            counts = expectation_report(kept, rules)
            counts.coalesce(1).write.mode("overwrite").parquet(f"{target}/counts/batch={number}")
        finally:
            kept.unpersist()

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except StreamingQueryException as e:
        if INTERRUPTION in str(e):
            raise Interrupted(INTERRUPTION) from None
        raise


def rows(spark: SparkSession, target: str) -> DataFrame:
    """All rows that were let through, with the number of their `batch`."""
    return spark.read.parquet(f"{target}/rows")


def report(spark: SparkSession, target: str) -> DataFrame:
    """Rows seen and rows that break each rule, over all batches."""
    counts = spark.read.parquet(f"{target}/counts")
    return counts.groupBy("rule").agg(F.sum("rows").alias("rows"), F.coalesce(F.sum("violations"), F.lit(0)).alias("violations"))
