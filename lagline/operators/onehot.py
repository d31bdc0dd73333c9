"""One-hot encoding of categories of any number of levels: levels are numbered by a distributed sort and joined to the rows.

The vectors are those of Spark's indexer, encoder and assembler, but no name or number of a level passes the driver, where
those stages keep attributes of every slot in each schema. The rows are written, and read back as vectors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lagline.session import hold, shuffles_freed, work_dir, written


@dataclass
class OneHot:
    """A slot per level of each category, the most frequent first, then the numbers."""

    categorical: list[str]
    numeric: list[str]
    slots: DataFrame  # number of the column, level, slot
    parts: list[DataFrame]  # `slots` by column, kept
    width: int

    def names(self) -> list[str]:
        """Names of the slots, as Spark's assembler makes them; as many rows as the vector is wide."""
        return [f"{self.categorical[r[0]]}_vec_{r[1]}" for r in self.slots.orderBy("slot").collect()] + self.numeric

    def vectors(self, rows: DataFrame, keep: Sequence[str], output: str) -> DataFrame:
        """Kept columns and the vector; levels that no training row had have no slot."""
        for i, (c, part) in enumerate(zip(self.categorical, self.parts)):
            one = part.select(F.col("level").alias("__level"), F.col("slot").alias(f"__s{i}"))
            rows = rows.withColumn("__level", F.col(c).cast("string")).join(one, "__level", "left").drop("__level")
        first = self.width - len(self.numeric)
        places = [*[F.col(f"__s{i}") for i in range(len(self.categorical))], *[F.lit(first + i) for i in range(len(self.numeric))]]
        values = [*[F.lit(1.0)] * len(self.categorical), *[F.col(c).cast("double") for c in self.numeric]]
        entries = F.array(*[F.struct(s.cast("int").alias("s"), v.alias("v")) for s, v in zip(places, values)])
        found = rows.select(*keep, F.filter(entries, lambda e: e["s"].isNotNull() & (e["v"] != 0)).alias("__e"))
        path = work_dir(rows.sparkSession, "vectors")
        with shuffles_freed(rows.sparkSession):
            found.select(*keep, self._vector(F.col("__e")).alias(output)).write.parquet(path)
        fields = [*[found.schema[c] for c in keep], StructField(output, VectorUDT())]
        return rows.sparkSession.read.schema(StructType(fields)).parquet(path)

    def _vector(self, entries: Column) -> Column:
        """A vector as it is stored, sparse where that is shorter, as Spark's assembler decides."""
        slots, values = F.transform(entries, lambda e: e["s"]), F.transform(entries, lambda e: e["v"])
        sparse = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(self.width).alias("size"), slots.alias("indices"), values.alias("values"))
        if self.width > 1.5 * (len(self.categorical) + len(self.numeric) + 1):
            return sparse
        every = F.sequence(F.lit(0), F.lit(self.width - 1))
        full = F.transform(every, lambda i: F.coalesce(F.get(F.transform(F.filter(entries, lambda e: e["s"] == i), lambda e: e["v"]), F.lit(0)), F.lit(0.0)))
        none = F.lit(None).cast("array<int>")
        dense = F.struct(F.lit(1).cast("tinyint").alias("type"), F.lit(None).cast("int").alias("size"), none.alias("indices"), full.alias("values"))
        return F.when(1.5 * (F.size(entries) + 1) < self.width, sparse).otherwise(dense)


class OneHotStage(Transformer):
    """A fitted encoding as the first stage of a pipeline; every row keeps its columns."""

    def __init__(self, fitted: OneHot, output: str):
        super().__init__()
        self.fitted, self.output = fitted, output

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.vectors(dataset, dataset.columns, self.output)


def fit(rows: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> OneHot:
    """Levels by frequency, equally frequent ones by name. Missing values are no level."""
    items = F.inline(F.array(*[F.struct(F.lit(i).alias("number"), F.col(c).cast("string").alias("level")) for i, c in enumerate(categorical)]))
    counts = rows.select(items).where("level IS NOT NULL").groupBy("number", "level").agg(F.count("*").alias("n"))
    placed = counts.orderBy("number", F.desc("n"), "level").select("number", "level").rdd.zipWithIndex()
    slots = written(placed.map(lambda x: (*x[0], x[1])).toDF("number int, level string, slot bigint"), "slots")
    parts = [hold(slots.where(F.col("number") == i)) for i in range(len(categorical))]
    # Counted, so that joins know their sizes and broadcast the small ones.
    return OneHot(list(categorical), list(numeric), slots, parts, sum(part.count() for part in parts) + len(numeric))
