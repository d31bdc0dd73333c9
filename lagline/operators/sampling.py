"""Samples and splits. The hash-based forms give the same rows on every run and under every partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.session import hold, stored

# Fixed value: seed of all samples, splits and models.
SEED = 42


def hash_text(keys: Sequence[str], seed: int = SEED) -> Column:
    """MD5 of the seed and the keys as texts, which other engines compute alike; NULL counts as the empty text."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))


def hash_fraction(keys: Sequence[str], seed: int = SEED) -> Column:
    """A number in [0, 1), a multiple of 2 ** -52, that depends on the key columns only."""
    return F.conv(F.substring(hash_text(keys, seed), 1, 13), 16, 10).cast("bigint") / F.lit(2.0**52)


def sample_fraction(df: DataFrame, fraction: float, keys: Sequence[str], seed: int = SEED) -> DataFrame:
    return df.filter(hash_fraction(keys, seed) < fraction)


def split_train_test(
    df: DataFrame, keys: Sequence[str], train: float = 0.8, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    h = hash_fraction(keys, seed)
    return df.filter(h < train), df.filter(h >= train)


def kept_split(df: DataFrame, keys: Sequence[str], train: float = 0.8, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """`split_train_test` of rows that are kept: the hash is worked out once, not by every job that reads a side.

    What does not fit into memory is read from the shared folder again, so the disk has the rows once.
    """
    rows = stored(df.withColumn("__train", hash_fraction(keys, seed) < train), "split")
    if not rows.is_cached:
        rows = hold(rows, StorageLevel.MEMORY_ONLY)
    return rows.filter("__train").drop("__train"), rows.filter("NOT __train").drop("__train")


def balanced_sample(
    df: DataFrame, label: str, keys: Sequence[str], max_per_class: int | None = None, seed: int = SEED
) -> DataFrame:
    """The larger class thinned to about the size of the smaller one, of which all rows stay, without order bias.

    max_per_class: thins both to that size, where the caller's contract says so.
    """
    sizes = {r[0]: r[1] for r in df.filter(F.col(label).isin(0, 1)).groupBy(label).count().collect()}
    if len(sizes) < 2:
        raise ValueError(f"training data has one class only: {sizes}")
    target = min(*sizes.values(), *([] if max_per_class is None else [max_per_class]))
    h = hash_fraction(keys, seed)
    zero, one = (target / sizes[c] for c in (0, 1))
    return df.filter(((F.col(label) == 0) & (h < zero)) | ((F.col(label) == 1) & (h < one)))


def fixed_size_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = SEED) -> DataFrame:
    """At most n rows, chosen by hash order: each task keeps its n smallest before the merge."""
    return df.orderBy(hash_text(keys, seed), *keys).limit(n)
