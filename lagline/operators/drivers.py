"""Comparison of risk drivers: strength by bucket, importance ranks, cross-city tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagline.functions.expressions import CENSOR_MINUTES, cases, finite_number, hazard_reading
from lagline.operators.ranking import rank_within

# Driver buckets by covariate prefix, and the demand features.
BUCKETS = (
    ("Demand", ("calls_past",)),
    ("Temporal", ("time_bin", "hour_group", "day_of_week", "season")),
    ("Incident/Severity", ("incident_category", "unified_alarm_level")),
)
DEMAND_FEATURES = ("calls_past_30min", "calls_past_60min")


def bucket_of(covariate: str | Column) -> Column:
    c = F.col(covariate) if isinstance(covariate, str) else covariate
    rules = [(c.rlike("^(" + "|".join(p) + ")"), name) for name, p in BUCKETS]
    return cases(rules, "Other")


def effects(hr: DataFrame, alpha: float | None = 0.05) -> DataFrame:
    """Usable hazard ratios with their bucket and their distance from 1 as a ratio of at least 1."""
    rows = hr if alpha is None or "p" not in hr.columns else hr.filter(F.col("p") < alpha)
    ratio = finite_number("hazard_ratio")
    return (
        rows.withColumn("hazard_ratio", ratio)
        .filter(F.col("hazard_ratio") > 0)
        .withColumn("bucket", bucket_of("covariate"))
        .withColumn("effect_size", F.greatest(F.col("hazard_ratio"), 1 / F.col("hazard_ratio")))
    )


def bucket_stats(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys, "bucket").agg(
        F.count("*").alias("count"),
        F.max("effect_size").alias("max_effect"),
        F.expr("percentile(effect_size, 0.5)").alias("median_effect"),
    )


def bucket_top_mean(rows: DataFrame, keys: Sequence[str], top_k: int = 5) -> DataFrame:
    order = [F.desc("effect_size"), F.col("covariate")]
    best = rank_within(rows, [*keys, "bucket"], order, "__r").filter(F.col("__r") <= top_k)
    return best.groupBy(*keys, "bucket").agg(F.avg("effect_size").alias(f"top{top_k}_mean"))


def driver_strength(hr: DataFrame, keys: Sequence[str], alpha: float | None = 0.05, top_k: int = 5) -> DataFrame:
    """Count, maximum, median and top-k mean effect per bucket of significant covariates."""
    rows = effects(hr, alpha)
    return bucket_stats(rows, keys).join(bucket_top_mean(rows, keys, top_k), [*keys, "bucket"], "left")


def feature_importance(hr: DataFrame, keys: Sequence[str], top: int | None = None) -> DataFrame:
    """Absolute coefficient (or absolute log hazard ratio without one), ranked within each key."""
    strength = F.abs("coef") if "coef" in hr.columns else F.abs(F.log("hazard_ratio"))
    ranked = rank_within(hr.withColumn("importance", strength), keys, [F.desc("importance"), F.col("covariate")])
    return ranked if top is None else ranked.filter(F.col("rank") <= top)


def demand_hazards(
    hr: DataFrame, stats: DataFrame, keys: Sequence[str], features: Sequence[str] = DEMAND_FEATURES,
    horizon: float = CENSOR_MINUTES,
) -> DataFrame:
    """Hazard ratios of the demand features with fit statistics and a text reading."""
    return (
        hr.filter(F.col("covariate").isin(*features))
        .join(stats, list(keys))
        .withColumn("censor_time", F.lit(float(horizon)))
        .withColumn("interpretation", hazard_reading("hazard_ratio"))
    )


def feature_presence(
    coefficients: DataFrame, attributions: DataFrame, key: str, features: Sequence[str] = DEMAND_FEATURES
) -> DataFrame:
    """Yes/No per key and feature: is it among the survival covariates, is it among the attributed features."""
    norm = F.lower(F.trim(F.col("f")))
    tagged = coefficients.select(key, F.col("covariate").alias("f"), F.lit("survival").alias("side")).unionByName(
        attributions.select(key, F.col("feature").alias("f"), F.lit("predictive").alias("side"))
    )
    yes = lambda f, side: F.when(
        F.max(((norm == f) & (F.col("side") == side)).cast("int")) == 1, F.lit("Yes")
    ).otherwise(F.lit("No"))
    return tagged.groupBy(key).agg(
        *[yes(f, side).alias(f"{f}_in_{side}") for side in ("survival", "predictive") for f in features]
    )


def clean_ranking(df: DataFrame) -> DataFrame:
    """Feature names normalised, numbers coerced, incomplete rows dropped."""
    return df.select(
        F.lower(F.trim("feature")).alias("feature"),
        finite_number("mean_abs").alias("mean_abs"),
        F.col("rank").try_cast("int").alias("rank"),
    ).na.drop()


def driver_table(a: DataFrame, b: DataFrame, a_name: str, b_name: str, top_n: int = 10) -> DataFrame:
    """Every feature in either top-N with ranks, importances, differences and where it belongs."""
    left = clean_ranking(a).select("feature", F.col("mean_abs").alias("va"), F.col("rank").alias("ra"))
    right = clean_ranking(b).select("feature", F.col("mean_abs").alias("vb"), F.col("rank").alias("rb"))
    in_a, in_b = F.coalesce(F.col("ra") <= top_n, F.lit(False)), F.coalesce(F.col("rb") <= top_n, F.lit(False))
    va, vb = F.coalesce("va", F.lit(0.0)), F.coalesce("vb", F.lit(0.0))
    category = cases([(in_a & in_b, "common"), (in_a, f"{a_name}_specific")], f"{b_name}_specific")
    return left.join(right, "feature", "full_outer").filter(in_a | in_b).select(
        category.alias("category"),
        "feature",
        F.col("ra").alias(f"{a_name}_rank"),
        F.col("rb").alias(f"{b_name}_rank"),
        va.alias(f"{a_name}_mean_abs"),
        vb.alias(f"{b_name}_mean_abs"),
        (F.col("ra") - F.col("rb")).alias("rank_diff"),
        F.abs(va - vb).alias("abs_importance_diff"),
        ((va - vb) / (vb + 1e-9) * 100).alias("importance_gap_pct"),
        in_a.alias(f"in_{a_name}_top"),
        in_b.alias(f"in_{b_name}_top"),
    )


def driver_classes(table: DataFrame, a_name: str, b_name: str) -> DataFrame:
    """Shared and dominant drivers, and the one feature with the widest absolute gap."""
    gap = F.col("importance_gap_pct")
    kind = cases(
        [(F.abs("rank_diff") <= 1, "shared"), (gap > 50, f"{a_name}_dominant"), (gap < -20, f"{b_name}_dominant")]
    )
    w = Window.orderBy(F.desc("abs_importance_diff"), "feature")
    return table.select(
        "feature", kind.alias("driver_class"), "importance_gap_pct", "abs_importance_diff",
        (F.row_number().over(w) == 1).alias("top_divergence"),
    )


def named_feature_ranks(importance: DataFrame, key: str, features: Sequence[str] = DEMAND_FEATURES) -> DataFrame:
    """Rank and importance of the named features per key, with absent ones marked No."""
    wanted = F.explode(F.array(*[F.lit(f) for f in features])).alias("feature")
    rows = importance.select(key).distinct().select(key, wanted)
    return rows.join(importance.select(key, "feature", "rank", "mean_abs"), [key, "feature"], "left").withColumn(
        "present", F.when(F.col("rank").isNotNull(), F.lit("Yes")).otherwise(F.lit("No"))
    )
