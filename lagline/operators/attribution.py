"""Per-row attribution of tree models (path-dependent Shapley values, Lundberg et al., 2018): forests and boosted trees.

The trees travel with the tasks; rows never leave their partition. A leaf pays its value times a product over the
features of its path, each factor 1 or 0 for a seen feature and the share of training rows that go on for an unseen one.
The Shapley weights of the numbers of seen features are integrals of t^k (1 - t)^(m - 1 - k), so a feature's part is one
integral of a product of linear terms, which a few Gauss-Legendre nodes give exactly: the work grows with the square of
the depth, not with the number of patterns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.operators.boosting import Ensemble, Tree
from lagline.operators.learning import CATEGORICAL, LABEL, MISSING, NUMERIC, bins_for, forest, keep_missing, train
from lagline.session import work_dir

SHAP_CATEGORICAL = CATEGORICAL
SHORT = 8  # features of a path whose patterns are all worked out: a row's pattern is a byte then


@dataclass
class Leaf:
    value: float
    features: list[int]
    # per feature: the conditions (threshold or category set, must go left) collected along the path
    conditions: list[list[tuple[object, bool]]]
    zeros: np.ndarray  # per feature: share of the training rows at its splits that go on towards the leaf
    weight: float  # share of training rows: the leaf's part of the base value


def forest_nodes(model, folder: str, spark) -> dict[int, dict[int, object]]:
    """Nodes per tree of a fitted Spark forest, read back from its saved form (a few thousand rows at most)."""
    model.write().overwrite().save(folder)
    rows = spark.read.parquet(f"{folder}/data").select("treeID", "nodeData.*").collect()
    trees: dict[int, dict[int, object]] = {}
    for r in rows:
        trees.setdefault(r["treeID"], {})[r["id"]] = r
    return trees


def path_parts(value: float, zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Contributions of a leaf's m features for n rows. ones: n x m, whether a row meets a feature's conditions."""
    m = len(zeros)
    nodes, weights = np.polynomial.legendre.leggauss(m // 2 + 1)
    t = (nodes + 1) / 2
    # n x m x nodes: what a feature contributes to the product at each node, never 0 inside the interval
    terms = zeros[:, None] * (1 - t) + ones[:, :, None] * t
    whole = terms.prod(axis=1, keepdims=True)
    return value * (ones - zeros) * ((whole / terms) @ (weights / 2))


def leaves_of(nodes: dict[int, object]) -> list[Leaf]:
    """Leaves of one tree with their path conditions and contribution tables."""
    cover = {i: float(sum(n["impurityStats"])) for i, n in nodes.items()}
    out: list[Leaf] = []

    def walk(i: int, path: dict[int, tuple[list, float]]) -> None:
        n = nodes[i]
        if n["leftChild"] < 0:
            features = list(path)
            zeros = np.array([path[f][1] for f in features])
            value = n["impurityStats"][1] / cover[i]
            out.append(Leaf(value, features, [path[f][0] for f in features], zeros, float(np.prod(zeros)) if features else 1.0))
            return
        split = n["split"]
        f = split["featureIndex"]
        test = split["leftCategoriesOrThreshold"]
        rule = frozenset(test) if split["numCategories"] != -1 else float(test[0])
        for child, left in ((n["leftChild"], True), (n["rightChild"], False)):
            conditions, ratio = path.get(f, ([], 1.0))
            walk(child, {**path, f: ([*conditions, (rule, left)], ratio * cover[child] / cover[i])})

    walk(0, {})
    return out


def base_value(trees: Sequence[Sequence[Leaf]]) -> float:
    return float(np.mean([sum(leaf.value * leaf.weight for leaf in t) for t in trees]))


def contributions(trees: Sequence[Sequence[Leaf]], x: np.ndarray) -> np.ndarray:
    """Attributions of a batch of feature rows."""
    phi = np.zeros(x.shape)
    met: dict[tuple, np.ndarray] = {}

    def holds(f: int, rule, left: bool) -> np.ndarray:
        if (f, rule) not in met:
            met[f, rule] = np.isin(x[:, f], list(rule)) if isinstance(rule, frozenset) else x[:, f] <= rule
        return met[f, rule] if left else ~met[f, rule]

    for tree in trees:
        for leaf in tree:
            if not leaf.features:
                continue
            ones = np.ones((len(x), len(leaf.features)), dtype=bool)
            for j, (f, conditions) in enumerate(zip(leaf.features, leaf.conditions)):
                for rule, left in conditions:
                    ones[:, j] &= holds(f, rule, left)
            phi[:, leaf.features] += _by_pattern(leaf.value, leaf.zeros, ones)
    return phi / len(trees)


def _by_pattern(value: float, zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """`path_parts` of rows, worked out once for rows that meet the same conditions."""
    if ones.shape[1] > 62:
        return path_parts(value, zeros, ones.astype(float))
    code = ones @ (1 << np.arange(ones.shape[1], dtype=np.int64))
    _, first, at = np.unique(code, return_index=True, return_inverse=True)
    return path_parts(value, zeros, ones[first].astype(float))[at]


# ---------------------------------------------------------------- boosted trees


def boosted_leaves(tree: Tree) -> list[tuple[float, list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """Leaves of a boosted tree: value, features of the path, codes above which and up to which a row goes on, and shares."""
    out = []

    def walk(node: int, path: dict[int, tuple[int, int, float]]) -> None:
        f = int(tree.feature[node])
        if f < 0:
            features = list(path)
            low, high, zeros = (np.array([path[x][i] for x in features]) for i in range(3))
            out.append((float(tree.value[node]), features, low, high, zeros.astype(float)))
            return
        low, high, share = path.get(f, (-1, 1 << 30, 1.0))
        cut = int(tree.cut[node])
        for child, bounds in ((2 * node, (low, min(high, cut))), (2 * node + 1, (max(low, cut), high))):
            walk(child, {**path, f: (*bounds, share * tree.cover[child] / tree.cover[node])})

    walk(1, {})
    return out


@dataclass
class BoostedExplainer:
    """The first loss of an ensemble, in margin space, with one base value per group."""

    model: Ensemble
    leaves: list[list[list[tuple]]]  # per group and tree
    base: list[float]

    @staticmethod
    def of(model: Ensemble) -> BoostedExplainer:
        leaves = [[boosted_leaves(t) for t in own[0]] for own in model.trees]
        base = [
            float(model.start[g, 0]) + sum(value * float(np.prod(zeros)) for tree in trees for value, _, _, _, zeros in tree)
            for g, trees in enumerate(leaves)
        ]
        return BoostedExplainer(model, leaves, base)

    def contributions(self, group: int, codes: np.ndarray) -> np.ndarray:
        columns, phi = np.ascontiguousarray(codes.T), np.zeros(codes.shape[::-1])
        for tree in self.leaves[group]:
            for value, features, low, high, zeros in tree:
                if not features:
                    continue
                met = [(columns[f] > int(a)) & (columns[f] <= int(b)) for f, a, b in zip(features, low, high)]
                if len(features) > SHORT:
                    phi[features] += _by_pattern(value, zeros, np.stack(met, axis=1)).T
                    continue
                pattern = np.zeros(len(codes), np.uint8)
                for j, one in enumerate(met):
                    pattern |= one.view(np.uint8) << j
                every = np.arange(1 << len(features))[:, None] >> np.arange(len(features)) & 1
                for f, part in zip(features, path_parts(value, zeros, every.astype(float)).T):
                    phi[f] += part[pattern]
        return phi.T


def attribute_margin(explainer: BoostedExplainer, rows: DataFrame, by: Sequence[str], keep: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Kept columns, `margin`, `probability`, `base_value` and `phi_<name>` per feature; the parts add up to the margin.

    names: what to call the model's features, in their order. Rows of a group that was not trained are left out.
    """
    model = explainer.model
    number = {g: i for i, g in enumerate(model.groups)}
    phis = [f"phi_{n}" for n in names]
    raw = [F.col(n).cast("double").alias(f"__x{i}") for i, n in enumerate(model.names)]
    keys = [F.col(c).alias(f"__g{i}") for i, c in enumerate(by)]

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[[f"__x{i}" for i in range(len(model.names))]].to_numpy(dtype=float)
            own = list(zip(*[pdf[f"__g{i}"] for i in range(len(by))])) if by else [()] * len(pdf)
            group = np.array([number.get(k, -1) for k in own], int)
            for g in np.unique(group[group >= 0]):
                mine = group == g
                codes = model.codes(g, x[mine])
                margin = model.margins(g, codes)[0]
                out = pdf.loc[mine, list(keep)].reset_index(drop=True)
                out["margin"], out["probability"], out["base_value"] = margin, 1 / (1 + np.exp(-margin)), explainer.base[g]
                yield pd.concat([out, pd.DataFrame(explainer.contributions(g, codes), columns=phis)], axis=1)

    kinds = dict(rows.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], "margin double, probability double, base_value double", *[f"{p} double" for p in phis]])
    return rows.select(*keep, *keys, *raw).mapInPandas(explain, schema)


# ---------------------------------------------------------------- forests


@dataclass
class Explainer:
    pipeline: PipelineModel
    names: list[str]
    trees: list[list[Leaf]]

    @property
    def base(self) -> float:
        return base_value(self.trees)


def fit_explainer(
    rows: DataFrame, categorical: Sequence[str] = SHAP_CATEGORICAL, numeric: Sequence[str] = NUMERIC, trees: int = 50, depth: int = 5
) -> Explainer:
    """Forest on indexed categories and numbers, so each feature keeps one slot and one attribution.

    Unknown numbers are a value of their own, here and in the rows that are explained, so that none is left out.
    """
    rows = keep_missing(rows.filter(F.col(LABEL).isNotNull()), numeric)
    spark = rows.sparkSession
    index = StringIndexer(inputCols=list(categorical), outputCols=[f"{c}_index" for c in categorical], handleInvalid="keep")
    assemble = VectorAssembler(inputCols=[*index.getOutputCols(), *numeric], outputCol="features", handleInvalid="error")
    grown = forest(trees=trees, depth=depth).setMaxBins(bins_for(rows, categorical))
    pipeline = train([index, assemble, grown], rows)
    nodes = forest_nodes(pipeline.stages[-1], work_dir(spark, "forest"), spark)
    return Explainer(pipeline, [*categorical, *numeric], [leaves_of(nodes[t]) for t in sorted(nodes)])


def attribute(explainer: Explainer, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Kept columns, predicted probability, base value and one attribution column phi_<feature> per feature."""
    names, trees, base = explainer.names, explainer.trees, explainer.base
    numeric = [n for n in names if n in NUMERIC]
    known = [F.coalesce(F.col(n), F.lit(MISSING)).alias(n) if n in numeric else F.col(n) for n in rows.columns]
    scored = explainer.pipeline.transform(rows.select(*known)).select(
        *keep, vector_to_array("probability")[1].alias("probability"), vector_to_array("features").alias("__x")
    )

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                phi = contributions(trees, np.stack(pdf["__x"].to_numpy()))
                out = pdf.drop(columns="__x")
                yield pd.concat(
                    [out.assign(base_value=base).reset_index(drop=True), pd.DataFrame(phi, columns=[f"phi_{n}" for n in names])],
                    axis=1,
                )

    schema = ", ".join(f"`{c}` {t}" for c, t in scored.dtypes if c != "__x")
    schema += ", base_value double, " + ", ".join(f"phi_{n} double" for n in names)
    return scored.mapInPandas(explain, schema)


def riskiest_case(explained: DataFrame, names: Sequence[str], keep: Sequence[str], outputs: Sequence[str] = ("probability", "base_value")) -> DataFrame:
    """Base value and contributions of the attributed row with the highest probability, largest effect first."""
    top = explained.orderBy(F.desc("probability"), *keep).limit(1)
    long = top.unpivot([*keep, *outputs], [f"phi_{n}" for n in names], "feature", "contribution")
    return long.withColumn("feature", F.expr("substring(feature, 5)")).orderBy(F.desc(F.abs("contribution")), "feature")


def dependence(explained: DataFrame, feature: str, colour: str) -> DataFrame:
    """(value, attribution, colour value) rows of one feature."""
    return explained.select(
        F.lit(feature).alias("feature"), F.col(feature).cast("string").alias("value"),
        F.col(f"phi_{feature}").alias("attribution"), F.col(colour).cast("string").alias("colour"),
    )
