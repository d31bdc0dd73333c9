"""Gradient boosting with histograms per task, for several groups and losses at a time.

Features become codes of at most 64 bins. Rows lie in blocks of codes, targets and margins, kept in memory; a level of all
trees (one per group and loss) is one pass: tasks add up gradients per node, feature and bin, and sums are reduced in
Spark, so that the driver sees as many numbers as the level has cells, whatever the rows and tasks are. Blocks are
rewritten with new margins after every round. Leaves of a quantile loss get the quantile of their residuals, from summaries
that are merged the same way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 64
TREES = 12
DEPTH = 4
RATE = 0.2
LEAST = 20  # rows of a leaf, at least
RIDGE = 1.0
LINEAGE = 10  # rounds after which the blocks are checkpointed, if as many are to come
FEW = 32  # partitions whose sums go to the driver without another stage
SUMMARY = 1024  # points of a quantile summary
BLOCK = 65_536  # rows of a block


@dataclass(frozen=True)
class Logistic:
    """Log loss of a label 0 or 1; margins are log odds."""

    least: int = LEAST  # rows of a leaf

    def start(self, mean: float, quantiles: dict[float, float]) -> float:
        p = min(max(mean, 1e-6), 1 - 1e-6)
        return float(np.log(p / (1 - p)))

    def gradients(self, y: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-f))
        return p - y, p * (1 - p)


@dataclass(frozen=True)
class Pinball:
    """Loss of a quantile; margins are the predicted quantile."""

    q: float

    @property
    def least(self) -> int:
        """Ten rows beyond the quantile."""
        return max(LEAST, math.ceil(10 / min(self.q, 1 - self.q)))

    def start(self, mean: float, quantiles: dict[float, float]) -> float:
        return quantiles[self.q]

    def gradients(self, y: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, None]:
        return np.where(y > f, -self.q, 1 - self.q), None


@dataclass
class Tree:
    """Nodes in heap order from 1: children of i are 2i (code <= cut) and 2i + 1. A leaf has feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        size = 2 << depth
        return Tree(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size), np.zeros(size))

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        """The leaf, or the deepest node so far, of each row."""
        at = np.ones(len(codes), np.int64)
        rows = np.arange(len(codes))
        while True:
            f = self.feature[at]
            go = f >= 0
            if not go.any():
                return at
            at = np.where(go, 2 * at + (codes[rows, np.maximum(f, 0)] > self.cut[at]), at)


@dataclass
class Ensemble:
    """Models per group and loss, and how raw features become codes."""

    names: list[str]
    groups: list[tuple]
    losses: list
    cuts: list[list[np.ndarray]]  # per group and feature
    start: np.ndarray  # group, loss
    trees: list[list[list[Tree]]] = field(default_factory=list)  # group, loss, tree

    def codes(self, group: int, x: np.ndarray) -> np.ndarray:
        """Bins of raw features; unknown values (NaN) are below all others."""
        out = np.zeros(x.shape, np.uint8)
        for j, cuts in enumerate(self.cuts[group]):
            known = ~np.isnan(x[:, j])
            out[known, j] = np.searchsorted(cuts, x[known, j]) + 1
        return out

    def margins(self, group: int, codes: np.ndarray) -> np.ndarray:
        """Per loss the margin of each row."""
        out = np.repeat(self.start[group][:, None], len(codes), axis=1)
        for k, trees in enumerate(self.trees[group]):
            for tree in trees:
                out[k] += tree.value[tree.nodes(codes)]
        return out


def compressed(values: np.ndarray, weights: np.ndarray, size: int = SUMMARY) -> tuple[np.ndarray, np.ndarray]:
    """A summary of sorted weighted values by at most `size` of them, each for an equal share of the weight."""
    if len(values) <= size:
        return values, weights
    total = weights.sum()
    at = np.searchsorted(np.cumsum(weights), (np.arange(size) + 0.5) * total / size)
    return values[np.minimum(at, len(values) - 1)], np.full(size, total / size)


def merged(a: dict, b: dict) -> dict:
    """Sums of histograms, and merged summaries, by key."""
    for key, value in b.items():
        if key not in a:
            a[key] = value
        elif isinstance(value, tuple):
            values, weights = np.concatenate((a[key][0], value[0])), np.concatenate((a[key][1], value[1]))
            order = np.argsort(values, kind="stable")
            a[key] = compressed(values[order], weights[order])
        else:
            a[key] = a[key] + value
    return a


def summary_quantile(summary: tuple[np.ndarray, np.ndarray], q: float) -> float:
    values, weights = summary
    reach = np.cumsum(weights)
    return float(values[min(np.searchsorted(reach, q * reach[-1] - 1e-9), len(values) - 1)])


def _with_margins(block: tuple, trees: list[list[Tree]]) -> tuple:
    """A block after a round: its margins and one more tree per loss."""
    group, codes, y, margin = block
    steps = [tree.value[tree.nodes(codes)] for tree in trees[group]]
    return group, codes, y, margin + np.array(steps)


def _histograms(blocks: Iterator[tuple], losses: list, growing: list[list[Tree]], level: int) -> Iterator[dict]:
    """Sums of gradient, curvature and rows per (group, loss): node of the level, feature, bin."""
    out: dict = {}
    first, width = 1 << level, BINS + 1
    for group, codes, y, margin in blocks:
        for k, loss in enumerate(losses):
            node = growing[group][k].nodes(codes) - first
            here = node >= 0  # others stand in a leaf above
            if not here.any():
                continue
            whole = here.all()
            at, mine, target, at_margin = (node, codes, y, margin[k]) if whole else (node[here], codes.T[:, here].T, y[here], margin[k][here])
            g, h = loss.gradients(target, at_margin)
            size = first * width
            sums = np.empty((3, codes.shape[1], size))
            at = at * width
            for j in range(codes.shape[1]):
                cell = at + mine[:, j]
                sums[0, j], sums[2, j] = np.bincount(cell, g, size), np.bincount(cell, minlength=size)
                sums[1, j] = sums[2, j] if h is None else np.bincount(cell, h, size)
            merged(out, {(group, k): sums.reshape(3, codes.shape[1], first, width)})
    yield out


def _residuals(blocks: Iterator[tuple], losses: list, growing: list[list[Tree]]) -> Iterator[dict]:
    """Summaries of the residuals per (group, loss, leaf)."""
    out: dict = {}
    for group, codes, y, margin in blocks:
        for k, loss in enumerate(losses):
            if isinstance(loss, Pinball):
                node, rest = growing[group][k].nodes(codes), y - margin[k]
                order = np.argsort(rest)
                order = order[np.argsort(node[order].astype(np.uint16 if len(growing[group][k].feature) <= 1 << 16 else node.dtype), kind="stable")]
                node, rest = node[order], rest[order]
                heads = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
                for a, b in zip(heads, np.r_[heads[1:], len(node)]):
                    merged(out, {(group, k, int(node[a])): compressed(rest[a:b], np.ones(b - a))})
    yield out


def _split(sums: np.ndarray, least: int, ridge: float) -> tuple[float, int, int]:
    """The best split of a node from its cells (3, feature, bin): gain, feature and last bin of the left side."""
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    total = sums.sum(axis=2)[:, :, None]
    right = total - left
    score = lambda s: s[0] ** 2 / (s[1] + ridge)
    gain = score(left) + score(right) - score(total)
    gain = np.where((left[2] >= least) & (right[2] >= least), gain, -1.0)
    at = int(gain.argmax())
    return float(gain.flat[at]), at // gain.shape[1], at % gain.shape[1]


def cut_points(rows: DataFrame, by: Sequence[str], names: Sequence[str], quantiles: Sequence[float], target: str, bins: int = BINS) -> list[dict]:
    """Per group the features' inner bin edges, the target's mean and its quantiles: one aggregate, a few numbers a group.

    A group's columns are summed up in tasks of their own, as summaries of all partitions meet there.
    """
    shares, last = [i / bins for i in range(1, bins)], len(names)
    items = F.inline(F.array(*[F.struct(F.lit(i).alias("__i"), F.col(n).cast("double").alias("__v")) for i, n in enumerate([*names, target])]))
    summed = rows.select(*by, items).groupBy(*by, "__i").agg(
        F.percentile_approx("__v", [*shares, *quantiles], 10_000).alias("q"), F.avg(F.when(F.col("__i") == last, F.col("__v"))).alias("mean")
    )
    found: dict[tuple, dict] = {}
    for r in summed.collect():
        own = found.setdefault(tuple(r[c] for c in by), {c: r[c] for c in by})
        if r["__i"] == last:
            own |= {"mean": r["mean"], "q": r["q"] and r["q"][len(shares):]}
        else:
            own[f"c{r['__i']}"] = r["q"] and r["q"][: len(shares)]
    return sorted((r for r in found.values() if r["mean"] is not None), key=lambda r: [str(r[c]) for c in by])


def fit(
    rows: DataFrame, by: Sequence[str], names: Sequence[str], target: str, losses: Sequence, trees: int = TREES, depth: int = DEPTH,
    rate: float = RATE, ridge: float = RIDGE,
) -> Ensemble:
    """Boosted trees per group of `by` and loss, all grown together: a pass over the rows for each level of each round."""
    losses = list(losses)
    quantiles = [x.q for x in losses if isinstance(x, Pinball)]
    found = cut_points(rows, by, names, quantiles, target)
    groups = [tuple(r[c] for c in by) for r in found]
    cuts = [[np.unique(np.array(r[f"c{i}"] or [], float)) for i in range(len(names))] for r in found]
    start = np.array([[x.start(r["mean"], dict(zip(quantiles, r["q"]))) for x in losses] for r in found]).reshape(len(groups), len(losses))
    model = Ensemble(list(names), groups, losses, cuts, start, [[[] for _ in losses] for _ in groups])
    number = {g: i for i, g in enumerate(groups)}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pdf = batch.to_pandas()
            for key, part in pdf.groupby(list(by), dropna=False) if by else [((), pdf)]:
                x = part[[f"x{i}" for i in range(len(names))]].to_numpy(dtype=float)
                g = number[tuple(key)]
                yield pa.RecordBatch.from_pydict({
                    "g": pa.array([g], pa.int32()), "codes": pa.array([model.codes(g, x).tobytes("F")], pa.binary()),
                    "y": pa.array([part["y"].to_numpy(dtype=float).tobytes()], pa.binary()),
                })

    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:
        rows = rows.repartition(cores)  # others stay where they are
    raw = rows.select(*by, F.col(target).cast("double").alias("y"), *[F.col(n).cast("double").alias(f"x{i}") for i, n in enumerate(names)])
    width = len(names)

    def unpack(row) -> tuple:
        """A block as (group, codes, targets, margins); a feature's codes lie together, as sums are made by feature."""
        y = np.frombuffer(row["y"])
        return row["g"], np.frombuffer(row["codes"], np.uint8).reshape(width, len(y)).T, y, np.repeat(start[row["g"]][:, None], len(y), axis=1)

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCK))
    try:
        blocks = raw.mapInArrow(pack, "g int, codes binary, y binary").rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)
        blocks.count()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    shallow = 1 if blocks.getNumPartitions() <= FEW else 2
    before_last = None  # the blocks of the round before, until the first pass has read the new ones
    try:
        for round_ in range(trees):
            growing = [[Tree.empty(depth) for _ in losses] for _ in groups]
            for level in range(depth):
                job = blocks.mapPartitions(lambda it, growing=growing, level=level: _histograms(it, losses, growing, level))
                _grow(growing, job.treeReduce(merged, shallow), level, losses, ridge)
                if before_last is not None:
                    before_last.unpersist()
                    before_last = None
            if quantiles:
                job = blocks.mapPartitions(lambda it, growing=growing: _residuals(it, losses, growing))
                for (g, k, node), summary in job.treeReduce(merged, shallow).items():
                    growing[g][k].value[node] = summary_quantile(summary, losses[k].q)
            for g, own in enumerate(growing):
                for k, tree in enumerate(own):
                    tree.value *= rate
                    model.trees[g][k].append(tree)
            if round_ + 1 < trees:
                fresh = blocks.map(lambda b, growing=growing: _with_margins(b, growing)).persist(StorageLevel.MEMORY_AND_DISK)
                if (round_ + 1) % LINEAGE == 0 and trees - round_ > LINEAGE and spark.conf.get("spark.checkpoint.dir", None):
                    fresh.checkpoint()
                before_last, blocks = blocks, fresh
    finally:
        for kept in (blocks, before_last):
            if kept is not None:
                kept.unpersist()
    return model


def _grow(growing: list[list[Tree]], sums: dict, level: int, losses: list, ridge: float) -> None:
    """Split the nodes of a level; children get the values and row counts that their sides sum up to."""
    for (g, k), cells in sums.items():
        tree = growing[g][k]
        for i in range(1 << level):
            node, own = (1 << level) + i, cells[:, :, i]
            total = own[:, 0].sum(axis=1)
            if not total[2]:
                continue
            if level == 0:
                tree.value[1], tree.cover[1] = -total[0] / (total[1] + ridge), total[2]
            gain, feature, cut = _split(own, losses[k].least, ridge)
            if gain <= 1e-9:
                continue
            tree.feature[node], tree.cut[node] = feature, cut
            left = own[:, feature, : cut + 1].sum(axis=1)
            for child, side in ((2 * node, left), (2 * node + 1, total - left)):
                tree.value[child], tree.cover[child] = -side[0] / (side[1] + ridge), side[2]


def predict(model: Ensemble, rows: DataFrame, by: Sequence[str], outputs: Sequence[str]) -> DataFrame:
    """The rows with one margin column per loss; rows of a group that was not trained get nulls. The model travels with the tasks."""
    number = {g: i for i, g in enumerate(model.groups)}
    names = list(outputs)

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.full((len(pdf), len(names)), np.nan)
        x = pdf[model.names].to_numpy(dtype=float)
        keys = list(zip(*[pdf[c] for c in by])) if by else [()] * len(pdf)
        group = np.array([number.get(k, -1) for k in keys], int)
        for g in np.unique(group[group >= 0]):
            mine = group == g
            out[mine] = model.margins(g, model.codes(g, x[mine])).T
        return pd.DataFrame(out, columns=names)

    fields = [*[F.col(c) for c in by], *[F.col(n).cast("double").alias(n) for n in model.names]]
    found = rows.withColumn("__m", score(F.struct(*fields)))
    return found.select(*rows.columns, *[F.nanvl(F.col(f"__m.{n}"), F.lit(None).cast("double")).alias(n) for n in names])
