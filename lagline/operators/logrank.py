"""Log-rank tests over any number of groups and levels, for many tests at once.

Rows are counted per time and level. What a test needs of the risk sets are prefix sums over the distinct times: expected
events and variances are sums of counts with such a sum. Covariances are added up in ranges of times of bounded numbers of
counts, from the range's own counts and the numbers at risk behind it; ranges add up as one row per level.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagline.functions.distributions import chi2_tail
from lagline.functions.expressions import CENSOR_MINUTES, DAY_LEVELS, HOUR_LEVELS, SEASON_LEVELS, p_value_text
from lagline.operators.aggregates import join_groups
from lagline.operators.survival import DURATION, EVENT
from lagline.session import settle

# Stratification columns, their labels and their levels.
STRATA = (
    ("hour_group", "Hour", HOUR_LEVELS),
    ("season", "Season", SEASON_LEVELS),
    ("day_of_week_name", "Day of Week", DAY_LEVELS),
)


def strata_rows(view: DataFrame, keys: Sequence[str], strata: Sequence[tuple] = STRATA) -> DataFrame:
    """Each row once per stratification, so that all tests share one grouped pass."""
    items = [F.struct(F.lit(label).alias("stratification"), F.lit(c).alias("group_col"), F.col(c).alias("level")) for c, label, _ in strata]
    return view.select(*keys, DURATION, EVENT, F.inline(F.array(*items)))


RANGE = 50_000  # counts of a range of times
TIMES = 256  # times that are worked on together


def event_counts(view: DataFrame, keys: Sequence[str], group: str, resolution: int | None = None) -> DataFrame:
    """Events and rows per (keys, time, level): the only pass over the rows, combined before the shuffle."""
    t = F.col(DURATION) if resolution is None else F.round(DURATION, resolution)
    rows = view.filter(F.col(group).isNotNull())
    return rows.groupBy(*keys, t.alias("time"), F.col(group).cast("string").alias("level")).agg(
        F.sum(EVENT).cast("double").alias("d"), F.count("*").cast("double").alias("m")
    )


def with_risk(counts: DataFrame, keys: Sequence[str], size: int = RANGE) -> DataFrame:
    """The counts with prefix sums `expected` and `spread`, the time's factor `c` of products, and a `range` of times.

    Per time with n at risk and d events: d / n, v / n and v / n^2, v being d (n - d) / (n - 1).
    """
    per = counts.groupBy(*keys, "time").agg(F.sum("d").alias("all_d"), F.sum("m").alias("all_m"), F.count("*").alias("cells"))
    later = Window.partitionBy(*keys).orderBy(F.desc("time")).rowsBetween(Window.unboundedPreceding, 0)
    so_far = Window.partitionBy(*keys).orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("n", F.sum("all_m").over(later))
    v = F.when(F.col("n") > 1, F.col("all_d") * (F.col("n") - F.col("all_d")) / (F.col("n") - 1)).otherwise(0.0)
    per = per.withColumn("v", v).select(
        *keys, "time", F.sum(F.col("all_d") / F.col("n")).over(so_far).alias("expected"), F.sum(F.col("v") / F.col("n")).over(so_far).alias("spread"),
        (F.col("v") / F.col("n") / F.col("n")).alias("c"), F.floor((F.sum("cells").over(so_far) - 1) / size).cast("int").alias("range"),
    )
    return join_groups(counts, per, [*keys, "time"])


def level_sums(placed: DataFrame, keys: Sequence[str], horizon: float = CENSOR_MINUTES) -> DataFrame:
    """Per level: rows, events, expected events, `variance` before products are taken off, and the share that survives the horizon."""
    mine = Window.partitionBy(*keys, "level").orderBy(F.desc("time")).rowsBetween(Window.unboundedPreceding, 0)
    left = F.when(F.col("time") <= horizon, 1 - F.col("d") / F.col("at_risk")).otherwise(1.0)
    rows = placed.withColumn("at_risk", F.sum("m").over(mine)).withColumn("left", left)
    alive = F.when(F.min("left") <= 0, 0.0).otherwise(F.exp(F.sum(F.log(F.greatest("left", F.lit(1e-300))))))
    return rows.groupBy(*keys, "level").agg(
        F.sum("m").alias("rows"), F.sum("d").alias("events"), F.sum(F.col("m") * F.col("expected")).alias("expected"),
        F.sum(F.col("m") * F.col("spread")).alias("variance"), alive.alias("tail"),
    )


def products(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums over times of c times the products of the levels' numbers at risk: per level one row of `others` and `sums`."""
    by = list(keys)
    kinds = dict(placed.dtypes)
    per_range = placed.groupBy(*by, "level", "range").agg(F.sum("m").alias("m"))
    last = per_range.groupBy(*by).agg(F.max("range").alias("last"))
    # every level in every range up to the last one of the test, with what is at risk behind the range
    each = per_range.groupBy(*by, "level").agg(F.collect_list(F.struct("range", "m")).alias("found"))
    each = join_groups(each, last, by) if by else each.crossJoin(F.broadcast(last))  # a single row
    each = each.select(*by, "level", "found", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("range"))
    behind = F.aggregate(F.filter("found", lambda x: x["range"] > F.col("range")), F.lit(0.0), lambda n, x: n + x["m"])
    behind = each.select(*by, "range", "level", F.lit(None).cast("double").alias("time"), behind.alias("m"), F.lit(0.0).alias("c"))
    rows = behind.union(placed.select(*by, "range", "level", "time", "m", "c"))
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in by], "level string, others array<string>, sums array<double>"])

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        levels, at = np.unique(pdf["level"].to_numpy().astype(str), return_inverse=True)
        m, time, c = (pdf[x].to_numpy(dtype=float) for x in ("m", "time", "c"))
        first = np.isnan(time)
        risk, total = np.zeros(len(levels)), np.zeros((len(levels), len(levels)))
        risk[at[first]] = m[first]
        order = np.flatnonzero(~first)[np.argsort(-time[~first], kind="stable")]
        heads = np.flatnonzero(np.r_[True, np.diff(time[order]) != 0]) if len(order) else np.zeros(0, int)
        ends = np.r_[heads[1:], len(order)]
        for lo in range(0, len(heads), TIMES):
            a, b = heads[lo], ends[min(lo + TIMES, len(heads)) - 1]
            rows_ = order[a:b]
            nth = np.searchsorted(heads, np.arange(a, b), side="right") - 1 - lo
            block = np.zeros((nth[-1] + 1, len(levels)))
            np.add.at(block, (nth, at[rows_]), m[rows_])
            block = risk + np.cumsum(block, axis=0)
            total += block.T @ (c[order[heads[lo : lo + TIMES]]][:, None] * block)
            risk = block[-1]
        out = {k: [pdf[k].iloc[0]] * len(levels) for k in by}
        return pd.DataFrame({**out, "level": levels.tolist(), "others": [levels.tolist()] * len(levels), "sums": list(total)})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total: dict[str, float] = {}
        for others, sums in zip(pdf["others"], pdf["sums"]):
            for g, x in zip(others, sums):
                total[g] = total.get(g, 0.0) + float(x)
        names = sorted(total)
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in by}, "level": [pdf["level"].iloc[0]], "others": [names], "sums": [[total[g] for g in names]]})

    return rows.groupBy(*by, "range").applyInPandas(part, schema).groupBy(*by, "level").applyInPandas(add, schema)


def _run(counts: DataFrame, keys: Sequence[str], extra: str, one: Callable[..., dict], horizon: float = CENSOR_MINUTES) -> DataFrame:
    """One row per test, from one row per level and what its products are: as many numbers as the covariance has.

    `one` gets levels, observed minus expected events, their covariance, sizes, events, and the levels' tail survival.
    """
    by = list(keys) or ["__all"]
    rows = counts if keys else counts.withColumn("__all", F.lit(0))
    placed = settle(with_risk(rows, by))
    levels = join_groups(level_sums(placed, by, horizon), products(placed, by), [*by, "level"])
    types = dict(levels.dtypes)

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("level")
        names = pdf["level"].tolist()
        v = np.diag(pdf["variance"].to_numpy()) - np.array([[dict(zip(o, q)).get(g, 0.0) for g in names] for o, q in zip(pdf["others"], pdf["sums"])])
        events = pdf["events"].to_numpy()
        found = one(names, events - pdf["expected"].to_numpy(), v, pdf["rows"].to_numpy(), events, dict(zip(names, pdf["tail"])))
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in by}, **found}])

    schema = ", ".join(f"`{c}` {types[c]}" for c in by) + ", " + extra
    return levels.groupBy(*by).applyInPandas(test, schema).drop("__all")


def logrank(
    view: DataFrame, keys: Sequence[str], group: str, alpha: float = 0.05, horizon: float = CENSOR_MINUTES, resolution: int | None = None,
) -> DataFrame:
    """k-sample test per key: statistic, degrees of freedom, p, and the level with most tail risk if significant."""

    def one(levels: list, z: np.ndarray, v: np.ndarray, sizes: np.ndarray, events: np.ndarray, tail: dict) -> dict:
        df = len(levels) - 1
        stat = float(z[:-1] @ np.linalg.pinv(v[:-1, :-1]) @ z[:-1]) if df else 0.0
        p = chi2_tail(stat, df) if df else 1.0
        return {
            "test_statistic": stat, "df": df, "p_value": p, "significant": p < alpha,
            "higher_risk_group_tail": min(levels, key=lambda g: (-round(tail[g], 12), g)) if p < alpha else None,
        }

    schema = "test_statistic double, df int, p_value double, significant boolean, higher_risk_group_tail string"
    return _run(event_counts(view, keys, group, resolution), keys, schema, one, horizon)


def two_sample(view: DataFrame, keys: Sequence[str], group: str, a: str, b: str, resolution: int | None = None) -> DataFrame:
    """Two-sample test with group sizes and event counts."""

    def one(levels: list, z: np.ndarray, v: np.ndarray, sizes: np.ndarray, events: np.ndarray, tail: dict) -> dict:
        at = [levels.index(g) if g in levels else None for g in (a, b)]
        size, event = ([int(x[i]) if i is not None else 0 for i in at] for x in (sizes, events))
        stat = float(z[0] ** 2 / v[0, 0]) if len(levels) == 2 and v[0, 0] > 0 else 0.0
        return {
            "group_a": a, "group_b": b, "test_statistic": stat, "p_value": chi2_tail(stat, 1),
            "n_a": size[0], "n_b": size[1], "events_a": event[0], "events_b": event[1],
        }

    schema = (
        "group_a string, group_b string, test_statistic double, p_value double, "
        "n_a bigint, n_b bigint, events_a bigint, events_b bigint"
    )
    rows = view.filter(F.col(group).isin(a, b))
    return _run(event_counts(rows, keys, group, resolution), keys, schema, one).withColumn("p_value_text", p_value_text("p_value"))


def logrank_suite(
    view: DataFrame, keys: Sequence[str], strata: Sequence[tuple] = STRATA, alpha: float = 0.05,
    horizon: float = CENSOR_MINUTES, resolution: int | None = None,
) -> DataFrame:
    """All stratifications within every key: test result and, where significant, the stratum with most tail risk."""
    by = [*keys, "stratification", "group_col"]
    return logrank(strata_rows(view, keys, strata), by, "level", alpha, horizon, resolution)
