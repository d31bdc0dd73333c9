"""Quantile regression: boosted trees with pinball loss, and a forest whose leaves keep quantiles (Meinshausen, 2006)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.operators import boosting, encoding
from lagline.operators.learning import bins_for, train
from lagline.operators.sampling import SEED
from lagline.session import settle

# Quantiles modelled and the target cap in minutes.
QUANTILES = (0.9, 0.95)
CAP_MINUTES = 180.0


@dataclass
class QuantileForest:
    pipeline: PipelineModel
    tables: dict[float, list[list[float]]]  # per quantile: tree, leaf -> value


def capped(df: DataFrame, target: str = "response_minutes", cap: float = CAP_MINUTES) -> DataFrame:
    return df.filter(F.col(target).isNotNull() & (F.col(target) > 0) & (F.col(target) <= cap))


def fit_quantile_forest(
    rows: DataFrame, categorical: Sequence[str], numeric: Sequence[str], target: str = "response_minutes",
    quantiles: Sequence[float] = QUANTILES, trees: int = 20, depth: int = 6, accuracy: int = 10_000,
) -> QuantileForest:
    """Grow the forest, then sketch the target's quantiles per (tree, leaf).

    The leaf table has at most trees * 2^depth rows; sketches are combined before the shuffle, so a leaf that holds
    most rows is no bottleneck.
    """
    index = StringIndexer(inputCols=list(categorical), outputCols=[f"{c}_index" for c in categorical], handleInvalid="keep")
    assemble = VectorAssembler(inputCols=[*index.getOutputCols(), *numeric], outputCol="features", handleInvalid="keep")
    forest = RandomForestRegressor(
        labelCol=target, featuresCol="features", numTrees=trees, maxDepth=depth, maxBins=bins_for(rows, categorical), seed=SEED, leafCol="leaves"
    )
    pipeline = train([index, assemble, forest], rows)
    leaves = pipeline.transform(rows).select(
        F.posexplode(vector_to_array("leaves")).alias("tree", "leaf"), F.col(target).alias("y")
    )
    table = leaves.groupBy("tree", F.col("leaf").cast("int").alias("leaf")).agg(
        F.percentile_approx("y", list(quantiles), accuracy).alias("q")
    )
    found = table.collect()
    out = {}
    for i, q in enumerate(quantiles):
        per = [[float("nan")] * (1 + max((r["leaf"] for r in found if r["tree"] == t), default=0)) for t in range(trees)]
        for r in found:
            per[r["tree"]][r["leaf"]] = float(r["q"][i])
        out[q] = per
    return QuantileForest(pipeline, out)


def predict_quantiles(model: QuantileForest, rows: DataFrame) -> DataFrame:
    """Rows with one prediction column per quantile, the mean over trees of the leaf's value.

    The leaf table travels with the tasks, so that the plan does not grow with the forest; leaves that no training row
    reached are skipped.
    """
    names = [f"pred_p{round(q * 100)}" for q in model.tables]
    depth = max(len(leaf) for t in model.tables.values() for leaf in t)
    tables = np.array([[leaf + [np.nan] * (depth - len(leaf)) for leaf in t] for t in model.tables.values()])

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def look_up(leaves: pd.Series) -> pd.DataFrame:
        at = np.stack(leaves.to_numpy()).astype(int) if len(leaves) else np.zeros((0, tables.shape[1]), int)
        found = tables[:, np.arange(tables.shape[1]), at]
        return pd.DataFrame(np.nanmean(found, axis=2).T, columns=names)

    scored = model.pipeline.transform(rows).select(*rows.columns, look_up(vector_to_array("leaves")).alias("__q"))
    return scored.select(*rows.columns, "__q.*")


def boosted_quantiles(
    train_rows: DataFrame, rows: DataFrame, by: Sequence[str], categorical: Sequence[str], numeric: Sequence[str], target: str, key: Sequence[str],
    quantiles: Sequence[float] = QUANTILES, **settings,
) -> DataFrame:
    """Rows with one prediction column per quantile, of boosted trees per group of `by`, all grown together.

    Categories are encoded by their levels' means of the target, whatever their number. Predictions of a row are put in
    order, so that no quantile is below a smaller one.
    """
    known, fresh, names = train_rows, rows, [*[f"enc_{c}" for c in categorical], *numeric]
    if categorical:
        means = encoding.known_means(train_rows, by, categorical, target, key)
        known = encoding.encoded(train_rows.withColumn("__own", F.lit(True)), means, by, categorical, key, "__own")
        known = settle(known.select(*[c for c in known.columns if c in {*by, target, *names}]))
        fresh = encoding.encoded(rows, means, by, categorical, key)
    order = sorted(quantiles)
    outputs = [f"pred_p{round(q * 100)}" for q in order]
    model = boosting.fit(known, by, names, target, [boosting.Pinball(q) for q in order], **settings)
    scored = boosting.predict(model, fresh, by, [f"__{o}" for o in outputs])
    ranked = F.array_sort(F.array(*[F.col(f"__{o}") for o in outputs]))
    return scored.select(*rows.columns, *[ranked[i].alias(o) for i, o in enumerate(outputs)])


def pinball(actual: str | Column, predicted: str | Column, q: float) -> Column:
    """Mean pinball loss of a quantile prediction."""
    a = F.col(actual) if isinstance(actual, str) else actual
    d = a - (F.col(predicted) if isinstance(predicted, str) else predicted)
    return F.avg(F.greatest(F.lit(q) * d, F.lit(q - 1) * d))


def quantile_quality(predictions: DataFrame, target: str = "response_minutes", quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Loss, absolute error and coverage per quantile, beside observed and predicted tails, in one pass."""
    y = F.col(target)
    items = []
    for q in quantiles:
        p = F.col(f"pred_p{round(q * 100)}")
        items.append(F.struct(
            F.lit(q).alias("quantile"), pinball(target, p, q).alias("pinball_loss"), F.avg(F.abs(y - p)).alias("mae"),
            F.avg((y <= p).cast("int")).alias("coverage"), F.avg(y).alias("observed_mean"),
            F.percentile_approx(y, q).alias("observed_quantile"), F.avg(p).alias("predicted_mean"),
        ))
    return predictions.agg(F.array(*items).alias("r")).select(F.inline("r"))
