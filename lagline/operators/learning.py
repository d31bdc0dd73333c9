"""Delay classifiers and response-time regressors on Spark ML, with their evaluation tables."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, FeatureHasher, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagline.operators.forest import SparseForest
from lagline.operators.sampling import SEED, balanced_sample
from lagline.session import settle, stored

# Label, feature columns and model sizes.
LABEL = "delay_indicator"
CATEGORICAL = ("incident_category", "season", "unified_call_source", "location_area")
NUMERIC = ("hour", "day_of_week", "month", "year", "unified_alarm_level", "calls_past_30min", "calls_past_60min")
TAIL_FEATURES = ("hour", "day_of_week", "calls_past_30min", "unified_alarm_level")
FORECAST_FEATURES = ("hour", "day_of_week", "unified_alarm_level", "calls_past_30min", "calls_past_60min")
HASH_SIZE = 512
MISSING = -1


def present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns that exist, in their order."""
    return [c for c in wanted if c in df.columns]


def keep_missing(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Unknown numbers as a value of their own below all others: trees can split them off, and no row is lost."""
    return df.fillna(MISSING, subset=list(numeric))


def bins_for(rows: DataFrame, categorical: Sequence[str], least: int = 64) -> int:
    """Split bins of a forest: enough for each level of every indexed category, and for unknown ones."""
    sizes = rows.agg(*[F.countDistinct(c).alias(c) for c in categorical]).first() if categorical else ()
    return max([least, *[n + 2 for n in sizes]])


def onehot_scaled(categorical: Sequence[str], numeric: Sequence[str]) -> list:
    """Index (unknown levels kept), one-hot encode, assemble, scale."""
    index = StringIndexer(inputCols=list(categorical), outputCols=[f"{c}_index" for c in categorical], handleInvalid="keep")
    encode = OneHotEncoder(inputCols=index.getOutputCols(), outputCols=[f"{c}_vec" for c in categorical])
    assemble = VectorAssembler(
        inputCols=[*encode.getOutputCols(), *numeric], outputCol="unscaled_features", handleInvalid="error"
    )
    return [index, encode, assemble, scaler()]


def scaler() -> StandardScaler:
    return StandardScaler(inputCol="unscaled_features", outputCol="features")


def hashed(categorical: Sequence[str], numeric: Sequence[str], invalid: str = "keep", size: int = HASH_SIZE) -> list:
    """Hash categories into a fixed number of columns and append the numbers; NULLs per `invalid`."""
    if not categorical:
        return [VectorAssembler(inputCols=list(numeric), outputCol="features", handleInvalid=invalid)]
    return [
        FeatureHasher(inputCols=list(categorical), outputCol="categorical_features", numFeatures=size),
        VectorAssembler(inputCols=[*numeric, "categorical_features"], outputCol="features", handleInvalid=invalid),
    ]


def logistic(label: str = LABEL) -> LogisticRegression:
    return LogisticRegression(labelCol=label, featuresCol="features", maxIter=100)


def forest(label: str = LABEL, trees: int = 50, depth: int = 5) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, seed=SEED)


def wide_forest(label: str = LABEL, trees: int = 50, depth: int = 5) -> SparseForest:
    """`forest` on sparse vectors of any width: its rows cost as much as they have non-zero slots."""
    return SparseForest(label, trees, depth)


def boosted(target: str = "response_minutes", weight: str | None = None) -> GBTRegressor:
    found = GBTRegressor(labelCol=target, featuresCol="features", maxIter=20, seed=SEED)
    return found.setWeightCol(weight) if weight else found


def collapsed(rows: DataFrame, features: Sequence[str], target: str, weight: str = "n") -> DataFrame:
    """One row per distinct features: the target's mean, weighted by the number of rows.

    Squared error tells the same splits and leaves from these as from all rows: what rows of equal features differ by is
    the same on both sides of every split.
    """
    return rows.groupBy(*features).agg(F.avg(target).alias(target), F.count(target).cast("double").alias(weight))


def train(stages: Sequence, rows: DataFrame) -> PipelineModel:
    return Pipeline(stages=list(stages)).fit(rows)


def confusion(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    return predictions.groupBy(label, "prediction").agg(F.count("*").alias("n"))


def ranking_quality(predictions: DataFrame, label: str = LABEL) -> dict[str, float]:
    """Areas under the ROC and precision-recall curves."""
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction")
    return {
        n: ev.setMetricName(m).evaluate(predictions) for n, m in (("auc_roc", "areaUnderROC"), ("auc_pr", "areaUnderPR"))
    }


def class_quality(predictions: DataFrame, label: str = LABEL) -> dict[str, float]:
    """Accuracy, weighted precision, recall and F1, and the positive rate, all from one count of label pairs."""
    cells = [(float(r[0]), float(r[1]), r[2]) for r in confusion(predictions, label).collect()]
    n = sum(c for _, _, c in cells)
    out = {"accuracy": sum(c for a, p, c in cells if a == p) / n, "weighted_precision": 0.0, "weighted_recall": 0.0, "f1": 0.0}
    for k in {a for a, _, _ in cells}:
        hit = sum(c for a, p, c in cells if a == p == k)
        actual = sum(c for a, _, c in cells if a == k)
        called = sum(c for _, p, c in cells if p == k)
        precision, recall = (hit / called if called else 0.0), hit / actual
        out["weighted_precision"] += precision * actual / n
        out["weighted_recall"] += recall * actual / n
        out["f1"] += (2 * precision * recall / (precision + recall) if hit else 0.0) * actual / n
    out["test_positive_rate"] = sum(c for a, _, c in cells if a == 1) / n
    return out


def regression_quality(predictions: DataFrame, target: str = "response_minutes") -> DataFrame:
    """RMSE, MAE and R2 in one pass."""
    e = F.col(target) - F.col("prediction")
    return predictions.agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (1 - F.sum(e * e) / (F.var_pop(target) * F.count(target))).alias("r2"),
    )


def tail_comparison(predictions: DataFrame, target: str = "response_minutes") -> DataFrame:
    """Mean and P90 of the target beside the P90 of its prediction."""
    return predictions.sparkSession.sql(
        f"SELECT avg({target}) AS actual_mean, percentile_approx({target}, 0.9) AS actual_p90, "
        "percentile_approx(prediction, 0.9) AS predicted_p90 FROM {rows}", rows=predictions,
    )


def positive_probability(column: str = "probability"):
    return vector_to_array(F.col(column))[1]


def roc_curve(predictions: DataFrame, label: str = LABEL, blocks: int = 200) -> DataFrame:
    """ROC points of scored rows at every score that occurs, from (0, 0) to (1, 1).

    Scores are counted; blocks of about equally many scores, wherever these lie, are added up, and running sums go on
    inside a block.
    """
    score = positive_probability()
    counts = settle(predictions.groupBy(score.alias("threshold")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("p"), F.count(F.when(F.col(label) == 0, 1)).alias("q")
    ))
    cuts = counts.approxQuantile("threshold", [i / blocks for i in range(1, blocks)], 0.25 / blocks)
    splits = [-math.inf, *(sorted(set(cuts)) or [0.5]), math.inf]
    counts = Bucketizer(splits=splits, inputCol="threshold", outputCol="block").transform(counts)
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)  # of `blocks` rows
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = counts.groupBy("block").agg(F.sum("p").alias("bp"), F.sum("q").alias("bq")).select(
        "block", *[F.coalesce(F.sum(f"b{c}").over(above), F.lit(0)).alias(f"{c}_above") for c in "pq"],
        *[F.sum(f"b{c}").over(every).alias(f"{c}_all") for c in "pq"],
    )
    inside = Window.partitionBy("block").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    points = counts.join(totals, "block").select(
        "threshold", *[((F.sum(c).over(inside) + F.col(f"{c}_above")) / F.col(f"{c}_all")).alias(n) for c, n in (("q", "fpr"), ("p", "tpr"))]
    )
    origin = predictions.sparkSession.range(1).selectExpr("1.0D AS threshold", "0.0D AS fpr", "0.0D AS tpr")
    return points.unionByName(origin)


def sparse_vector(column: str = "features", decimals: int | None = None):
    """A vector column as a struct of its size, the slots that are not 0 and their values."""
    v = F.unwrap_udt(F.col(column))
    dense = v["type"] == 1
    slots = F.when(dense, F.sequence(F.lit(0), F.size(v["values"]) - 1)).otherwise(v["indices"])
    indices = F.filter(slots, lambda _, i: F.get(v["values"], i) != 0)
    values = F.filter(v["values"], lambda x: x != 0)
    if decimals is not None:
        values = F.transform(values, lambda x: F.round(x, decimals))
    return F.struct(F.when(dense, F.size(v["values"])).otherwise(v["size"]).alias("size"), indices.alias("indices"), values.alias("values"))


def feature_names(transformed: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's slots from its attributes, so encoded columns keep their own name."""
    meta = transformed.schema[column].metadata.get("ml_attr", {})
    named = {a["idx"]: a.get("name", str(a["idx"])) for group in meta.get("attrs", {}).values() for a in group}
    return [named.get(i, f"{column}_{i}") for i in range(meta.get("num_attrs", len(named)))]


def importance_table(model, transformed: DataFrame, column: str = "features") -> DataFrame:
    """Importance per vector slot of a tree model, largest first."""
    return ranked_importance(transformed.sparkSession, model, feature_names(transformed, column))


def ranked_importance(spark, model, names: Sequence[str]) -> DataFrame:
    values = model.featureImportances.toArray().tolist()
    rows = sorted(zip(names, values), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(
        [(f, v, i + 1) for i, (f, v) in enumerate(rows)], "feature string, importance double, rank int"
    )


def comparison(results: Mapping[str, Mapping[str, float]], spark, decimals: int = 3) -> DataFrame:
    """One row per model, metrics rounded."""
    rows = [(m, *[round(float(r[c]), decimals) for c in ("auc_roc", "weighted_precision", "weighted_recall")]) for m, r in results.items()]
    return spark.createDataFrame(rows, "model string, auc_roc double, precision double, recall double")


def transfer(train_rows: DataFrame, test_rows: DataFrame, train_city: str, test_city: str, keys: Sequence[str]) -> DataFrame:
    """Train on one city's balanced sample, test on all of the other, on the columns both have."""
    categorical = sorted(set(present(train_rows, CATEGORICAL)) & set(present(test_rows, CATEGORICAL)))
    numeric = sorted(set(present(train_rows, NUMERIC)) & set(present(test_rows, NUMERIC)))
    if not categorical and not numeric:
        raise ValueError("no common feature columns")
    wanted = list(dict.fromkeys([*keys, LABEL, *categorical, *numeric]))
    labelled = [keep_missing(df.filter(F.col(LABEL).isNotNull()), numeric).select(*wanted) for df in (train_rows, test_rows)]
    sample = stored(balanced_sample(stored(labelled[0], "labelled"), LABEL, keys), "sample")
    model = train([*hashed(categorical, numeric, "keep"), forest()], sample)
    scored = stored(model.transform(labelled[1]).select(LABEL, "rawPrediction", "prediction"), "scored")
    row = {"train_city": train_city, "test_city": test_city, **ranking_quality(scored), **class_quality(scored)}
    kept = ("train_city", "test_city", "auc_roc", "auc_pr", "accuracy", "f1", "test_positive_rate")
    return train_rows.sparkSession.createDataFrame(
        [tuple(row[k] for k in kept)],
        "train_city string, test_city string, auc_roc double, auc_pr double, accuracy double, f1 double, test_positive_rate double",
    )


def forecast(model: PipelineModel, slots: DataFrame, last_training, version: str = "RF_v1.0") -> DataFrame:
    """Delay probability per future slot."""
    return model.transform(slots).select(
        "forecast_timestamp",
        "hour",
        positive_probability().alias("delay_risk_probability"),
        F.lit(version).alias("model_version"),
        F.current_timestamp().alias("forecast_generated_at"),
        F.lit(last_training).alias("last_training_timestamp"),
    )
