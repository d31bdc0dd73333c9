"""Cox proportional hazards with Efron ties and a ridge penalty, fitted by distributed Newton steps.

Rows are collapsed to distinct (time, event, covariates) with a weight, range partitioned by time, and cached. A Newton
step is two narrow passes (see `risk_scan`): totals per partition, then likelihood, gradient and Hessian inside the
partitions. What reaches the driver does not depend on the number of distinct times. The driver solves a system as wide
as the model.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lagline.functions.distributions import chi2_tail, normal_two_sided
from lagline.functions.expressions import CENSOR_MINUTES, quarter_of_day
from lagline.operators.aggregates import join_groups
from lagline.operators.curves import on_grid
from lagline.operators.risk_scan import RiskScan, Value, efron_sums  # noqa: F401
from lagline.operators.survival import DURATION, EVENT, RESOLUTION, admin_censoring_report, censor_columns, valid_rows
from lagline.session import settle, written

# Default covariates, pruning limits of rare indicator columns, penalties tried.
NUMERIC = ("calls_past_30min", "calls_past_60min")
CATEGORICAL = ("day_of_week", "season", "incident_category", "unified_alarm_level", "time_bin")
MIN_FREQ_RATE = 0.001
MIN_FREQ_ABS = 50
MIN_VAR = 1e-8
PENALTIES = (0.1, 0.5, 1.0)
PART_ROWS = 200_000  # counted rows of a partition, about: a step holds some 60 bytes of each, and products of a few at a time
DEMAND = ("calls_past_30min", "calls_past_60min")


# ---------------------------------------------------------------- design


def cox_rows(
    df: DataFrame, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL,
    horizon: float = CENSOR_MINUTES, keep: Sequence[str] = (), resolution: int | None = None,
) -> DataFrame:
    """Valid rows with a time bin, censored at the horizon, without missing predictors. Times may be rounded."""
    rows = valid_rows(df).filter(F.col("hour").isNotNull()).withColumn("time_bin", quarter_of_day("hour"))
    c = censor_columns(horizon)
    time = c[DURATION] if resolution is None else F.round(c[DURATION], resolution)
    rows = rows.select(
        *keep, time.alias("time"), c[EVENT].alias("event"), *numeric,
        *[F.col(x).cast("string").alias(x) for x in categorical],
    )
    return rows.na.drop(subset=[*numeric, *categorical])


def level_counts(
    rows: DataFrame, keys: Sequence[str], categorical: Sequence[str] = CATEGORICAL, weight: str | None = None
) -> DataFrame:
    """Rows per level of every categorical column, with the group size, in one pass."""
    extra, size = ([weight], F.sum(weight)) if weight else ([], F.count("*"))
    items = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("level")) for c in categorical]))
    counts = rows.select(*keys, *extra, items).groupBy(*keys, "column_name", "level").agg(size.alias("ones"))
    total = counts.groupBy(*keys, "column_name").agg(
        F.sum("ones").alias("n"),
        F.min(F.struct((-F.col("ones")).alias("o"), F.col("level").alias("l"))).alias("__r"),
    )
    total = total.select(*keys, "column_name", "n", F.col("__r.l").alias("reference"))
    return join_groups(counts, total, [*keys, "column_name"])


def indicator_report(
    counts: DataFrame, min_rate: float = MIN_FREQ_RATE, min_abs: int = MIN_FREQ_ABS, min_var: float = MIN_VAR
) -> DataFrame:
    """Each level as reference, kept indicator, or dropped for its frequency or variance.

    The sample variance of an indicator follows from its count, so no further pass over the rows is needed.
    """
    n, ones = F.col("n"), F.col("ones")
    need = F.greatest(F.lit(min_abs).cast("bigint"), F.floor(n * min_rate))
    share = ones / n
    return counts.select(
        *[c for c in counts.columns if c not in ("n", "reference")],
        "n",
        F.concat_ws("_", "column_name", "level").alias("covariate"),
        (F.col("level") == F.col("reference")).alias("is_reference"),
        ((ones < need) | (ones > n - need)).alias("low_frequency"),
        (share * (1 - share) * n / (n - 1) < min_var).alias("low_variance"),
    )


def design_long(rows: DataFrame, keys: Sequence[str], row_id: str, categorical: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Sparse design: one row per incident and kept indicator that is 1.

    Rows are worked out once for counts and design. A column keeps levels of a thousandth of the rows at least, so there
    are a thousand at most, which are broadcast: the long rows are not shuffled.
    """
    rows = written(rows.select(*keys, row_id, *categorical), "design")
    report = indicator_report(level_counts(rows, keys, categorical)).filter(
        "NOT is_reference AND NOT low_frequency AND NOT low_variance"
    )
    items = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("level")) for c in categorical]))
    return rows.select(*keys, row_id, items).join(
        F.broadcast(report.select(*keys, "column_name", "level", "covariate")), [*keys, "column_name", "level"]
    ).select(*keys, row_id, "covariate")


def design_violations(
    rows: DataFrame, keys: Sequence[str], horizon: float = CENSOR_MINUTES, weight: str | None = None
) -> DataFrame:
    """Counts of rows breaking the rules a design must meet: all must be 0. `weight` holds counts of equal rows."""
    t, e = F.col("time"), F.col("event")
    one = F.col(weight) if weight else F.lit(1)
    count = lambda cond: F.coalesce(F.sum(F.when(F.coalesce(cond, F.lit(False)), one)), F.lit(0)).cast("bigint")
    return rows.groupBy(*keys).agg(
        count(t.isNull()).alias("null_duration"),
        count(t <= 0).alias("non_positive_duration"),
        count(~e.isin(0, 1) | e.isNull()).alias("event_not_binary"),
        count(t > horizon + 1e-9).alias("beyond_horizon"),
        # A duration recorded as exactly the horizon is a real event; one that was clipped must be censored.
        count((t == horizon) & (e == 1)).alias("event_at_horizon"),
    )


@dataclass
class Design:
    rows: DataFrame  # time, event, w, x0..xp
    names: list[str]
    references: dict[str, str]
    dropped: list[str]
    n: int
    horizon: float
    kept: DataFrame  # the persisted table behind `rows`
    numeric: int  # how many covariates are numbers; the others are indicators
    arrays: RiskScan | None = None

    @property
    def columns(self) -> list[str]:
        return [f"x{i}" for i in range(len(self.names))]

    def scan(self) -> RiskScan:
        """The rows as kept arrays."""
        if self.arrays is None:
            self.arrays = RiskScan(self.rows, self.columns, self.numeric)
        return self.arrays

    def release(self) -> None:
        self.kept.unpersist()
        if self.arrays is not None:
            self.arrays.release()


def build_design(
    df: DataFrame, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL,
    horizon: float = CENSOR_MINUTES, resolution: int | None = None, part_rows: int = PART_ROWS,
) -> Design:
    """Indicator columns against the most frequent level, rare and constant ones dropped.

    Equal rows are counted first: that table is the only one kept, levels are counted on it, and indicators are
    derived from it in the scan of each step. Rows that break
    the rules of a design raise ValueError.
    """
    rows = cox_rows(df, numeric, categorical, horizon, resolution=resolution)
    fields = ["event", *numeric, *categorical]
    counted = written(rows.groupBy("time", *fields).agg(F.count("*").alias("w")), "counted").withColumn("salt", F.xxhash64(*fields))
    # Time ranges keep the per-partition results short; the hash splits a time that holds most rows (the horizon).
    # Rows in order of time give each batch of a step few times to sum by.
    # Their number follows the rows, as partitions merged by bytes would hold millions of them, all at once in a task.
    parts = math.ceil(counted.count() / part_rows)
    number = [max(parts, df.sparkSession.sparkContext.defaultParallelism)] if parts > 1 else []
    counted = settle(counted.repartitionByRange(*number, "time", "salt").drop("salt").sortWithinPartitions("time"))
    broken = design_violations(counted, [], horizon, "w").first().asDict()
    broken = {k: v for k, v in broken.items() if v and k != "event_at_horizon"}  # an arrival at the very horizon is one
    if broken:
        raise ValueError(f"rows that no design may have: {broken}")
    report = indicator_report(level_counts(counted, [], categorical, "w")).orderBy("column_name", "level").collect()
    if not report:
        raise ValueError("no rows left for the design")
    names, columns, dropped, references = list(numeric), [F.col(c).cast("double") for c in numeric], [], {}
    for r in report:
        if r["is_reference"]:
            references[r["column_name"]] = r["level"]
        elif r["low_frequency"] or r["low_variance"]:
            dropped.append(r["covariate"])
        else:
            names.append(r["covariate"])
            columns.append((F.col(r["column_name"]) == r["level"]).cast("double"))
    wide = counted.select("time", "event", "w", *[c.alias(f"x{i}") for i, c in enumerate(columns)])
    return Design(wide, names, references, dropped, report[0]["n"], horizon, counted, len(numeric))


def drop_report(df: DataFrame, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Counters of the preparation: censoring reasons, lost rows, final size."""
    return admin_censoring_report(valid_rows(df).filter("hour IS NOT NULL"), [], [*numeric, *(c for c in categorical if c != "time_bin")])


# ---------------------------------------------------------------- fit


@dataclass
class CoxModel:
    names: list[str]
    coef: np.ndarray
    covariance: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    log_likelihood: float
    penalized: float
    n: int
    penalty: float
    horizon: float
    scan: RiskScan
    value: Value  # at the optimum, on the standardised scale

    @property
    def se(self) -> np.ndarray:
        return np.sqrt(np.diag(self.covariance))


def fit(
    design: Design, penalty: float = 0.1, start: CoxModel | None = None, tolerance: float = 1e-9, max_iter: int = 50
) -> CoxModel:
    """Maximise the partial likelihood minus n * penalty * |b|^2 / 2, b being coefficients of standardised covariates.

    A fit that does not converge raises ArithmeticError.
    """
    cols = design.columns
    w = F.col("w")
    row = design.rows.agg(
        F.sum(w).alias("n"),
        *[(F.sum(w * F.col(c)) / F.sum(w)).alias(f"m_{c}") for c in cols],
        *[(F.sum(w * F.col(c) * F.col(c)) / F.sum(w)).alias(f"q_{c}") for c in cols],
    ).first()
    n = int(row["n"])
    mean = np.array([row[f"m_{c}"] for c in cols])
    var = (np.array([row[f"q_{c}"] for c in cols]) - mean**2) * n / max(n - 1, 1)
    scale = np.where(var > 1e-12, np.sqrt(np.maximum(var, 1e-300)), 1.0)
    beta = np.zeros(len(cols)) if start is None else start.coef * scale
    scan = design.scan()
    at = scan.evaluate(beta, mean, scale)
    value = at.likelihood - n * penalty / 2 * float(beta @ beta)
    converged = False
    for _ in range(max_iter + 1):
        gp, hp = at.gradient - n * penalty * beta, at.hessian - n * penalty * np.eye(len(beta))
        step = np.linalg.solve(-hp, gp)
        if float(gp @ step) / 2 < tolerance * max(1.0, abs(value)) * 1e-3 or np.abs(step).max() < tolerance:
            converged = True
            break
        factor = 1.0
        while True:
            trial = beta + factor * step
            there = scan.evaluate(trial, mean, scale)
            value2 = there.likelihood - n * penalty / 2 * float(trial @ trial)
            if value2 >= value - 1e-12 * abs(value):
                break
            factor /= 2
            if factor < 1e-4:
                raise ArithmeticError("no step improves the partial likelihood")
        beta, at, value = trial, there, value2
    if not converged:
        raise ArithmeticError(f"no convergence after {max_iter} steps")
    covariance = np.linalg.inv(-(at.hessian - n * penalty * np.eye(len(beta)))) / np.outer(scale, scale)
    return CoxModel(
        design.names, beta / scale, covariance, mean, scale, at.likelihood, value, n, penalty, design.horizon, scan, at
    )


# ---------------------------------------------------------------- result tables


def hazard_ratios(spark: SparkSession, model: CoxModel) -> DataFrame:
    """Coefficient, standard error, hazard ratio with 95% limits and p per covariate, smallest p first."""
    z95 = 1.959963984540054
    rows = [
        (name, math.exp(b), math.exp(b - z95 * s), math.exp(b + z95 * s), normal_two_sided(b / s), float(b), float(s))
        for name, b, s in zip(model.names, map(float, model.coef), map(float, model.se))
    ]
    rows.sort(key=lambda r: r[4])
    return spark.createDataFrame(
        rows, "covariate string, hazard_ratio double, hr_lower_95 double, hr_upper_95 double, p double, coef double, se double"
    )


def fit_statistics(spark: SparkSession, model: CoxModel, concordance: float) -> DataFrame:
    """Penalised log-likelihood and AIC as the fit reports them, the plain log-likelihood, concordance and size."""
    row = (
        model.penalized, model.log_likelihood, -2 * model.penalized + 2 * len(model.names), concordance, model.n,
        model.penalty, model.horizon,
    )
    return spark.createDataFrame(
        [row],
        "log_likelihood double, unpenalized_log_likelihood double, partial_aic double, concordance_index double, n bigint, "
        "penalizer double, censor_time double",
    )


def baseline_hazard(spark: SparkSession, model: CoxModel) -> DataFrame:
    """Breslow increments at the covariate means, one row per distinct time."""
    return model.scan.hazards(model.value, model.coef * model.scale, model.mean, model.scale, spark)


def reference_profile(design: Design) -> DataFrame:
    """Median of every covariate, from the collapsed weighted rows. That of an indicator follows from how often it is 1."""
    numbers, marks = design.columns[: design.numeric], design.columns[design.numeric :]
    stats = [F.expr(f"percentile({c}, 0.5, w)").alias(c) for c in numbers]
    n = F.sum("w")
    for c in marks:
        ones = F.sum(F.col("w") * F.col(c)) * 2
        stats.append(F.when(ones > n, 1.0).when(ones == n, 0.5).otherwise(0.0).alias(c))
    wide = design.rows.agg(*stats)
    return wide.select(*[F.col(c).alias(n) for c, n in zip(design.columns, design.names)])


def coefficient_table(spark: SparkSession, model: CoxModel) -> DataFrame:
    """What a prediction needs besides the baseline: coefficient and centre of every covariate."""
    rows = [(n, float(b), float(s), float(m)) for n, b, s, m in zip(model.names, model.coef, model.se, model.mean)]
    return spark.createDataFrame(rows, "covariate string, coef double, se double, mean double")


def profile_curves(
    coefficients: DataFrame, baseline: DataFrame, profiles: dict[str, dict[str, float]], horizon: int
) -> DataFrame:
    """S(t) on the minute grid for named covariate profiles, from coefficient and baseline tables.

    Covariates left out of a profile are 0. Both tables are as long as the model is wide and the time axis is fine.
    """
    terms = coefficients.collect()
    score = {k: sum(r["coef"] * (x.get(r["covariate"], 0.0) - r["mean"]) for r in terms) for k, x in profiles.items()}
    scenarios = F.inline(F.array(*[
        F.struct(F.lit(k).alias("scenario"), F.lit(math.exp(v)).alias("relative_hazard")) for k, v in score.items()
    ]))
    h0 = baseline.select("time", "cumulative_hazard", scenarios)
    curve = h0.withColumn("survival", F.exp(-F.col("cumulative_hazard") * F.col("relative_hazard")))
    return on_grid(curve, ["scenario"], horizon).withColumn("delay_risk", F.col("survival"))


def scenario_curves(
    spark: SparkSession, model: CoxModel, profiles: dict[str, dict[str, float]], horizon: int | None = None
) -> DataFrame:
    """S(t) on the minute grid for named covariate profiles of a fitted model."""
    h0 = baseline_hazard(spark, model)
    return profile_curves(coefficient_table(spark, model), h0, profiles, int(horizon or model.horizon))


def save_tables(spark: SparkSession, model: CoxModel, folder: str) -> None:
    """A fitted model as two parquet tables that any later job can predict from."""
    coefficient_table(spark, model).write.mode("overwrite").parquet(f"{folder}/coefficients")
    baseline_hazard(spark, model).write.mode("overwrite").parquet(f"{folder}/baseline")


def saved_curves(spark: SparkSession, folder: str, profiles: dict[str, dict[str, float]], horizon: int) -> DataFrame:
    """Curves of a saved model, without refitting."""
    tables = [spark.read.parquet(f"{folder}/{t}") for t in ("coefficients", "baseline")]
    return profile_curves(*tables, profiles, horizon)


def ph_test(spark: SparkSession, model: CoxModel) -> DataFrame:
    """Scaled Schoenfeld residuals against the rank of event time, from the sums of the last Newton step.

    Tied events share their mean rank. All rows count; nothing is sampled.
    """
    v = model.value
    # every event of a time has the same centred rank, so residuals are summed per time; ranks are shares of the events
    u = (v.turned * model.scale) @ model.covariance * v.events
    # ranks of tied events differ in an untied ordering; the mean rank gives the matching spread
    stat = u**2 / (v.events * np.diag(model.covariance) * v.spread)
    rows = [(n, float(x), chi2_tail(float(x), 1)) for n, x in zip(model.names, stat)]
    rows.sort(key=lambda r: r[2])
    return spark.createDataFrame(rows, "covariate string, test_statistic double, p double")


# ---------------------------------------------------------------- concordance


def _count_inside(pdf: pd.DataFrame) -> tuple[float, float]:
    """Concordant and tied comparable pairs among the rows of one score block.

    u is twice the time index, plus 1 if censored; an event row i is comparable with j when u_j > u_i.
    """
    order = np.lexsort((pdf["u"].to_numpy(), pdf["score"].to_numpy()))
    s, u, m = (pdf[c].to_numpy()[order] for c in ("score", "u", "m"))
    m = m.astype(float)
    rank = np.cumsum(np.r_[0, s[1:] != s[:-1]]) if len(s) else np.array([], dtype=int)
    event = u % 2 == 0
    width = int(u.max()) + 2 if len(u) else 1
    tied = concordant = 0.0
    total = np.r_[0.0, np.cumsum(m)]

    def later(keys: np.ndarray, cum: np.ndarray, block: np.ndarray, ui: np.ndarray) -> np.ndarray:
        hi = np.searchsorted(keys, block * width + width - 1, side="right")
        lo = np.searchsorted(keys, block * width + ui, side="right")
        return cum[hi] - cum[lo]

    tied = float((m[event] * later(rank * width + u, total, rank[event], u[event])).sum())
    bits = int(rank[-1]).bit_length() if len(rank) else 0
    for bit in range(bits):
        block, right = rank >> (bit + 1), (rank >> bit) & 1 == 1
        left_keys = block[~right] * width + u[~right]
        by = np.argsort(left_keys, kind="stable")
        cum = np.r_[0.0, np.cumsum(m[~right][by])]
        pick = right & event
        concordant += float((m[pick] * later(left_keys[by], cum, block[pick], u[pick])).sum())
    return concordant, tied


def _comparable(cells: DataFrame) -> float:
    """All comparable pairs, from the row counts per u: at most two per distinct time."""
    later = Window.orderBy(F.desc("u")).rowsBetween(Window.unboundedPreceding, -1)
    per = cells.groupBy("u").agg(F.sum("m").cast("double").alias("m")).withColumn("after", F.sum("m").over(later))
    return per.agg(F.sum(F.when(F.col("u") % 2 == 0, F.col("m") * F.col("after")))).first()[0] or 0.0


def _across_blocks(placed: DataFrame) -> float:
    """Concordant pairs of an event in one score block and a later row in a lower block.

    Every block is spread over all values of u (two per distinct time), so each u can add up the lower blocks.
    """
    hist = placed.groupBy("block", "u").agg(F.sum("m").cast("double").alias("m"))
    us = np.array(sorted(r[0] for r in placed.select("u").distinct().collect()))

    def spread(pdf: pd.DataFrame) -> pd.DataFrame:
        m = np.zeros(len(us))
        m[np.searchsorted(us, pdf["u"].to_numpy())] = pdf["m"].to_numpy()
        after = m[::-1].cumsum()[::-1] - m
        return pd.DataFrame({"block": pdf["block"].iloc[0], "u": us, "events": m * (us % 2 == 0), "after": after})

    dense = hist.groupBy("block").applyInPandas(spread, "block int, u bigint, events double, after double")
    lower = Window.partitionBy("u").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return dense.select((F.col("events") * F.sum("after").over(lower)).alias("c")).agg(F.sum("c")).first()[0] or 0.0


def concordance(scored: DataFrame, block_rows: int = 200_000) -> float:
    """Exact concordance of a risk score (higher means earlier) over columns time, event, score, w.

    Equal (score, time, event) rows are counted first. Score ranges form blocks of about `block_rows`: pairs inside a
    block are counted by its task, pairs across blocks follow from per-block counts by time. There are two blocks at least.
    """
    counted = scored.groupBy("score", "time", "event").agg(F.sum("w").alias("m"))
    u = (F.round(F.col("time") * 10**RESOLUTION).cast("bigint") * 2 + (1 - F.col("event"))).alias("u")
    cells = settle(counted.select(F.col("score").cast("double").alias("score"), u, "m"))
    try:
        blocks = max(2, math.ceil(cells.count() / block_rows))
        cuts = cells.approxQuantile("score", [i / blocks for i in range(1, blocks)], min(0.001, 0.25 / blocks))
        splits = [-math.inf, *(sorted(set(cuts)) or [0.0]), math.inf]
        bucket = Bucketizer(splits=splits, inputCol="score", outputCol="block")
        placed = bucket.transform(cells).withColumn("block", F.col("block").cast("int"))

        def inside(pdf: pd.DataFrame) -> pd.DataFrame:
            c, t = _count_inside(pdf)
            return pd.DataFrame({"concordant": [c], "tied": [t]})

        within = placed.groupBy("block").applyInPandas(inside, "concordant double, tied double")
        concordant, tied = (v or 0.0 for v in within.agg(F.sum("concordant"), F.sum("tied")).first())
        concordant += _across_blocks(placed)
        comparable = _comparable(cells)
    finally:
        cells.unpersist()
    return (concordant + tied / 2) / comparable if comparable else float("nan")


def scored_rows(design: Design, model: CoxModel) -> DataFrame:
    """Linear risk score per collapsed row, as a column expression so equal covariates score equally."""
    score = sum(
        (F.lit(float(b)) * F.col(c) for b, c in zip(model.coef, design.columns)), F.lit(0.0)
    )
    return design.rows.select("time", "event", "w", score.alias("score"))
