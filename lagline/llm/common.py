"""What the operators of this subpackage share: tables, written intermediate results, batch sizes, text arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline.session import work_dir

BATCH_BYTES = 8 << 20

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query of this subpackage, with the SQL it must agree with if there is one."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result to the cluster's shared folder and read it back, so that no later failure recomputes it."""
    path = work_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Let a batch that goes to Python hold few bytes, however long the texts are."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key)
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


class Once:
    """A function whose results each task keeps. It travels by value and without what it has kept."""

    def __init__(self, make: Callable):
        self.make, self.kept = make, {}

    def __call__(self, *key):
        if key not in self.kept:
            self.kept[key] = self.make(*key)
        return self.kept[key]

    def __reduce__(self):
        return Once, (self.make,)


def full_text(column: str = "text") -> Column:
    """The whole text; a null is the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_key(column: str = "text") -> Column:
    """16 bytes that name a text: equal texts share them, so that copies are worked on once and rows need no own id."""
    return F.substring(F.unhex(F.sha2(full_text(column), 256)), 1, 16)


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow array, and the n + 1 places where texts begin and end. Nulls are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else pa.binary()
    array = array.cast(kind).fill_null(b"")
    width = np.int64 if kind == pa.large_binary() else np.int32
    ends = np.frombuffer(array.buffers()[1], width)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def carried(docs: DataFrame) -> Column:
    """A whole row as one column `_row`, so that columns of any name can pass through an operator."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def restored(df: DataFrame, names: list[str], *new: str | Column) -> DataFrame:
    """The carried columns again, with `new` ones; a carried column of the name of a new one gives way."""
    made = df.select(*new).columns if new else []
    # new columns come first, under names of their own: beside carried ones a name in them might mean one of those
    columns = [(F.col(c) if isinstance(c, str) else c).alias(f"_new{i}") for i, c in enumerate(new)]
    kept = [F.col("_row").getField(c).alias(c) for c in names if c not in made]
    return df.select("_row", *columns).select(*kept, *[F.col(f"_new{i}").alias(c) for i, c in enumerate(made)])
