"""Data-quality operators: expectations, missingness, duplicates, ranges, reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _holds(predicate: str) -> Column:
    return F.coalesce(F.expr(predicate), F.lit(False))


def expect_or_drop(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Keep rows meeting every named predicate; an undecided (NULL) predicate counts as a violation."""
    for predicate in rules.values():
        df = df.filter(_holds(predicate))
    return df


def expect(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """All rows unchanged, and the table of violations per rule beside them.

    A table and not an observation: sessions that held one can no longer ship fitted classifiers to tasks.
    """
    return df, expectation_report(df, rules)


def expectation_report(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule: rows seen, rows violating."""
    wide = df.agg(F.count("*").alias("rows"), *[F.sum((~_holds(p)).cast("long")).alias(n) for n, p in rules.items()])
    return wide.unpivot("rows", list(rules), "rule", "violations")


def missing_percent(df: DataFrame, decimals: int = 2) -> DataFrame:
    """Missing count and share per column, long form, from one pass over the table."""
    counts = df.agg(F.count("*").alias("__n"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    return counts.unpivot("__n", df.columns, "column_name", "missing_count").select(
        "column_name",
        "missing_count",
        F.round(F.col("missing_count") / F.col("__n") * 100, decimals).alias("missing_pct"),
    )


def null_or_blank(df: DataFrame, columns: Sequence[str], decimals: int = 2) -> DataFrame:
    """Per text column: rows that are NULL or blank, and their share."""
    blank = {c: F.col(c).isNull() | (F.trim(c) == "") for c in columns}
    wide = df.agg(F.count("*").alias("__n"), *[F.count(F.when(b, 1)).alias(c) for c, b in blank.items()])
    return wide.unpivot("__n", list(columns), "column_name", "empty_count").select(
        "column_name", "empty_count", F.round(F.col("empty_count") / F.col("__n") * 100, decimals).alias("empty_pct")
    )


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_totals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows. Grouping first keeps NULL keys and avoids a distinct expansion."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(
            F.sum("n").alias("total_rows"),
            F.count("*").alias("distinct_keys"),
            F.sum(F.col("n") - 1).alias("surplus_rows"),
        )
    )


def duplicate_sample(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of the first duplicated key (smallest key, so the choice is repeatable)."""
    first = duplicate_groups(df, keys).orderBy(*keys).limit(1).select(*keys)
    names = [f"__k{i}" for i in range(len(keys))]
    on = F.lit(True)
    for k, n in zip(keys, names):  # the first key may be NULL
        on = on & F.col(k).eqNullSafe(F.col(n))
    return df.join(F.broadcast(first.toDF(*names)), on, "left_semi")


def value_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """min, max and number of negative values per numeric column, long form."""
    stats = []
    for c in columns:
        v = F.col(c).cast("double")
        stats.append(F.struct(F.lit(c).alias("column_name"), F.min(v).alias("min_value"), F.max(v).alias("max_value"),
                              F.count(F.when(v < 0, 1)).alias("negative_count")).alias(c))
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def reconcile(df: DataFrame, category: str) -> DataFrame:
    """Total rows beside the sum of the per-category counts."""
    per = df.groupBy(category).agg(F.count("*").alias("n")).agg(F.sum("n").alias("category_sum"))
    total = df.agg(F.count("*").alias("total_rows"))
    both = total.unionByName(per, allowMissingColumns=True)
    return both.agg(F.max("total_rows").alias("total_rows"), F.max("category_sum").alias("category_sum")).withColumn(
        "reconciled", F.col("total_rows") == F.col("category_sum")
    )


def unmapped(df: DataFrame, raw: str, mapped: str) -> DataFrame:
    """Raw values that the mapping left NULL, most frequent first."""
    return df.filter(F.col(mapped).isNull()).groupBy(raw).agg(F.count("*").alias("n")).orderBy(F.desc("n"), raw)


def require_two_classes(df: DataFrame, label: str) -> DataFrame:
    """Label distribution; raises when fewer than two classes are present."""
    dist = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    classes = [r[0] for r in dist.select(label).orderBy(label).limit(3).collect()]
    if len(classes) < 2:
        raise ValueError(f"{label} has a single class: {classes}")
    return dist
