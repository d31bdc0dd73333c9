"""Categories of any number of levels as one number each: the mean target of a level, smoothed towards the group's mean.

Training rows get the mean of the other folds, so that a row's own target does not leak into its feature; rows that are
not trained on get the mean over all folds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.session import hold, settle

FOLDS = 5
SMOOTHING = 20.0  # rows that the group's mean counts as
WHOLE = -1  # the fold of rows that are not trained on
ABSENT = "\0"  # the level of missing values


def level_means(
    train: DataFrame, by: Sequence[str], columns: Sequence[str], target: str, key: Sequence[str], folds: int = FOLDS, smoothing: float = SMOOTHING
) -> DataFrame:
    """Per group, column and level one row per fold and one for `WHOLE`: `value`. One aggregate over all columns."""
    fold = F.pmod(F.xxhash64(*key), F.lit(folds)).cast("int").alias("fold")
    items = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit(ABSENT)).alias("level")) for c in columns]))
    part = train.select(*by, fold, F.col(target).cast("double").alias("y"), items).groupBy(*by, "column", "level", "fold").agg(
        F.sum("y").alias("s"), F.count("y").alias("n")
    )
    level = part.groupBy(*by, "column", "level").agg(
        F.sum("s").alias("sum"), F.sum("n").alias("rows"), F.collect_list(F.struct("fold", "s", "n")).alias("folds")  # one entry a fold
    )
    mean = part.where(F.col("column") == columns[0]).groupBy(*by).agg((F.sum("s") / F.sum("n")).alias("mean"))
    level = level.join(mean, list(by)) if by else level.crossJoin(F.broadcast(mean))  # a single row
    whole = F.array(F.struct(F.lit(WHOLE).alias("fold"), F.lit(0.0).alias("s"), F.lit(0).cast("bigint").alias("n")))
    each = level.select(*by, "column", "level", "sum", "rows", "mean", F.inline(F.concat("folds", whole)))
    value = (F.col("sum") - F.col("s") + smoothing * F.col("mean")) / (F.col("rows") - F.col("n") + smoothing)
    return each.select(*by, "column", "level", "fold", value.alias("value"))


def known_means(train: DataFrame, by: Sequence[str], columns: Sequence[str], target: str, key: Sequence[str]) -> dict[str, DataFrame]:
    """`level_means` by column, kept. Each one's size is known then, so that joins broadcast those that are small, and only those.

    Kept as one, a column of many levels would have all rows shuffled by the few levels of the others, too.
    """
    means = settle(level_means(train, by, columns, target, key))
    parts = {c: hold(means.where(F.col("column") == c)) for c in columns}
    for part in parts.values():
        part.count()
    return parts


def encoded(
    rows: DataFrame, means: DataFrame | Mapping[str, DataFrame], by: Sequence[str], columns: Sequence[str], key: Sequence[str], trained: str | None = None, folds: int = FOLDS
) -> DataFrame:
    """The rows with `enc_<column>`, null for a level that no training row had.

    means: `level_means`, or `known_means`. trained: a boolean column of training rows.
    """
    fold = F.pmod(F.xxhash64(*key), F.lit(folds)).cast("int")
    rows = rows.withColumn("__fold", F.when(F.col(trained), fold).otherwise(WHOLE) if trained else F.lit(WHOLE))
    for c in columns:
        one = (means[c] if isinstance(means, Mapping) else means.where(F.col("column") == c)).select(
            *by, F.col("level").alias("__level"), F.col("fold").alias("__fold"), F.col("value").alias(f"enc_{c}")
        )
        rows = rows.withColumn("__level", F.coalesce(F.col(c).cast("string"), F.lit(ABSENT))).join(one, [*by, "__level", "__fold"], "left").drop("__level")
    return rows.drop("__fold")
