"""Location clusters on standardised features."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.operators.ranking import top_k_within
from lagline.operators.sampling import SEED

# Clusters of the report and the range tried for the elbow.
CLUSTERS = 4
ELBOW = range(2, 8)


def standardise(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Vector of z-scores with the population deviation; constant features become 0."""
    stats = df.agg(*[f(c).alias(f"{n}_{c}") for c in features for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    z = [
        ((F.col(c) - stats[f"m_{c}"]) / stats[f"s_{c}"] if stats[f"s_{c}"] else F.lit(0.0)).cast("double").alias(f"z_{c}")
        for c in features
    ]
    return VectorAssembler(inputCols=[f"z_{c}" for c in features], outputCol="z", handleInvalid="skip").transform(
        df.select("*", *z)
    ).drop(*[f"z_{c}" for c in features])


def kmeans(z: DataFrame, k: int = CLUSTERS) -> DataFrame:
    return KMeans(k=k, seed=SEED, featuresCol="z", predictionCol="cluster").fit(z).transform(z)


def elbow(z: DataFrame, ks: Sequence[int] = ELBOW) -> DataFrame:
    """Within-cluster sum of squares per k."""
    rows = [
        (k, float(KMeans(k=k, seed=SEED, featuresCol="z", predictionCol="cluster").fit(z).summary.trainingCost)) for k in ks
    ]
    return z.sparkSession.createDataFrame(rows, "k int, inertia double")


def principal_components(z: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Coordinates on two components, and the loadings; each component's largest loading is positive."""
    model = PCA(k=2, inputCol="z", outputCol="pc").fit(z)
    loading = model.pc.toArray()
    sign = np.sign(loading[np.abs(loading).argmax(axis=0), [0, 1]])
    pc = vector_to_array("pc")
    coords = model.transform(z).withColumns({f"pc{i + 1}": pc[i] * float(sign[i]) for i in range(2)}).drop("pc")
    table = [(f, *map(float, loading[i] * sign)) for i, f in enumerate(features)]
    return coords, z.sparkSession.createDataFrame(table, "feature string, pc1 double, pc2 double")


def cluster_profile(clustered: DataFrame, features: Sequence[str], decimals: int = 2) -> DataFrame:
    return clustered.groupBy("cluster").agg(
        F.count("*").alias("locations"), *[F.round(F.avg(f), decimals).alias(f) for f in features]
    )


def cluster_top(clustered: DataFrame, keys: Sequence[str], k: int = 5) -> DataFrame:
    """The k locations with the longest tail per cluster."""
    order = [F.desc("p90_response"), *[F.col(c) for c in keys]]
    return top_k_within(clustered, ["cluster"], order, k).select(
        "cluster", *keys, "p90_response", "mean_response", "call_volume"
    )
