"""Random forests on wide sparse vectors: one-hot or hashed categories of any number of levels.

Spark's own trainer keeps a number per slot of every row, so its memory and time are rows times width. Here rows keep the bins
of their non-zero slots only, by slot, in blocks; a level of all trees is one pass over the blocks. Tasks add up class
counts of the slots that a node may split on, zeros follow from the node's total, and the best splits are found where a
tree's sums meet, so the driver sees one split a node. The rules are Spark's: Poisson bags, a square root of the slots per
node, split points from a sample of 10,000 rows, Gini gain, leaves of one class merged. The result is Spark's own model.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, Transformer
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.operators.sampling import SEED
from lagline.session import work_dir

BINS = 32
BLOCK = 65_536  # rows of a block, at most: row numbers take two bytes
SAMPLE = 10_000  # rows that split points are taken from, as Spark does
WAVES = 3  # tasks of a pass per core, at most
# Poisson(1) by a 16-bit number.
_POISSON = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]), (np.arange(65_536) + 0.5) / 65_536).astype(np.uint8)

NODE = (
    "treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,"
    "leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>"
)


def _ragged(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Labels, and (row, slot, value) of the non-zero entries; columns y, dense, indices, values."""
    y = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint8)
    values = batch.column(3)
    sizes = values.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(y)), sizes)
    dense = batch.column(1).to_numpy(zero_copy_only=False)[rows].astype(bool)
    value = values.flatten().to_numpy(zero_copy_only=False)
    slot = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # of a dense vector
    slot[~dense] = batch.column(2).flatten().to_numpy(zero_copy_only=False)
    some = value != 0
    return y, rows[some], slot[some], value[some]


def _of_size(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of `size`, the last one less, however Spark has cut them."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            held.append(batch.slice(0, size - n))
            batch, n = batch.slice(size - n), n + held[-1].num_rows
            if n == size:
                yield pa.concat_batches(held)
                held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def _flat(rows: DataFrame, label: str, column: str) -> DataFrame:
    vector = F.unwrap_udt(F.col(column))
    indices = F.coalesce(vector["indices"], F.array().cast("array<int>"))
    return rows.select(F.col(label).cast("double").alias("y"), (vector["type"] == 1).alias("dense"), indices.alias("i"), vector["values"].alias("v"))


def split_points(slot: np.ndarray, value: np.ndarray, sampled: int, width: int, bins: int = BINS) -> list[np.ndarray]:
    """Thresholds per slot from the non-zero entries of `sampled` rows: midpoints between values, or between shares of the rows."""
    none = np.zeros(0)
    found = [none] * width
    order = np.lexsort((value, slot))
    slot, value = slot[order], value[order]
    heads = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else []
    for a, b in zip(heads, np.r_[heads[1:], len(slot)] if len(slot) else []):
        own, n = np.unique(value[a:b], return_counts=True)
        zeros = sampled - (b - a)
        if zeros > 0:
            at = np.searchsorted(own, 0.0)
            own, n = np.insert(own, at, 0.0), np.insert(n, at, zeros)
        middles = (own[1:] + own[:-1]) / 2
        if len(middles) > bins - 1:
            reach = np.cumsum(n)
            wanted = reach[-1] * np.arange(1, bins) / bins
            middles = middles[np.unique(np.clip(np.abs(reach[:-1, None] - wanted).argmin(axis=0), 0, len(middles) - 1))]
        found[slot[a]] = middles
    return found


def _blocks(index: int, packed: Iterator, seed: int) -> Iterator[tuple]:
    """(seed of the block, labels, slots, first entries, rows, bins): entries in order of slots."""
    for number, r in enumerate(packed):
        y, slots, heads = np.frombuffer(r["y"], np.uint8), np.frombuffer(r["s"], np.int32), np.frombuffer(r["h"], np.int32)
        yield (seed, index, number), y, slots, heads, np.frombuffer(r["r"], np.uint16), np.frombuffer(r["b"], np.uint8)


def _bag(block: tuple, tree: int) -> np.ndarray:
    """How often a tree draws each row: the same in every pass."""
    return _POISSON[np.random.default_rng([*block[0], tree]).integers(0, 65_536, len(block[1]), np.uint16)]


def _walk(block: tuple, feature: np.ndarray, cut: np.ndarray, zero: np.ndarray, level: int) -> np.ndarray:
    """The node of each row (in heap order from 1) after `level` splits at most. zero: the bin of 0 per slot."""
    _, y, slots, heads, rows, bins = block
    at = np.ones(len(y), np.int32)
    for depth in range(level):
        nodes = np.flatnonzero(feature[1 << depth : 2 << depth] >= 0) + (1 << depth)
        if not len(nodes):
            break
        own = feature[nodes]
        after = np.arange(len(feature), dtype=np.int32)
        after[nodes] = 2 * nodes + (zero[own] > cut[nodes])
        there = after[at]
        place = np.minimum(np.searchsorted(slots, own), max(len(slots) - 1, 0))
        for node, f, p in zip(nodes, own, place):
            if len(slots) and slots[p] == f:
                a, b = heads[p], heads[p + 1]
                r, right = rows[a:b], bins[a:b] > cut[node]
                mine = at[r] == node
                there[r[mine]] = 2 * node + right[mine]
        at = there
    return at


def _entries(heads: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each head on, as many as its size says, one run after the other."""
    return np.arange(sizes.sum()) + np.repeat(heads - (np.cumsum(sizes) - sizes), sizes)


def _counts(blocks: Iterator[tuple], trees: list[tuple], width: int, sizes: np.ndarray, zero: np.ndarray, level: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per tree the class counts of its nodes, then of the non-zero bins of each (node, slot) that may split.

    trees: number, features and cuts so far, nodes and slots of the pairs.
    """
    first = 1 << level
    cells = {}
    for tree, _, _, nodes, slots in trees:
        starts = np.cumsum(sizes[slots]) - sizes[slots]
        cells[tree] = starts, np.zeros(2 * (first + int(sizes[slots].sum())), np.int64)
    place = np.full(first * width, -1, np.int32)
    used = np.zeros(width, bool)
    for block in blocks:
        _, y, slots, heads, rows, bins = block
        each = np.diff(heads)
        for tree, feature, cut, nodes, own in trees:
            starts, out = cells[tree]
            node = _walk(block, feature, cut, zero, level) - first  # below 0: in a leaf above
            bag = _bag(block, tree)
            here = node >= 0
            out[: 2 * first] += np.bincount(node[here] * 2 + y[here], bag[here], 2 * first).astype(np.int64)
            pairs = (nodes - first).astype(np.int64) * width + own
            place[pairs], used[own] = starts, True
            picked = np.flatnonzero(used[slots])
            some, slot = _entries(heads[picked], each[picked]), np.repeat(slots[picked], each[picked])
            r = rows[some]
            here = node[r] >= 0
            some, slot, r = some[here], slot[here], r[here]
            cell = place[node[r].astype(np.int64) * width + slot]
            hit = cell >= 0
            r = r[hit]
            cell = (cell[hit] + bins[some[hit]]) * 2 + y[r]
            out[2 * first :] += np.bincount(cell, bag[r], len(out) - 2 * first).astype(np.int64)
            place[pairs], used[own] = -1, False
    yield from ((tree, out) for tree, (_, out) in cells.items())


def _gini(counts: np.ndarray) -> np.ndarray:
    total = np.maximum(counts.sum(axis=-1), 1)
    return 1 - ((counts / total[..., None]) ** 2).sum(axis=-1)


def _splits(sums: np.ndarray, nodes: np.ndarray, slots: np.ndarray, sizes: np.ndarray, zero: np.ndarray, level: int) -> list[tuple]:
    """The best split of each node of a tree that has one: node, slot, last bin of the left side, gain, class counts of node and left side."""
    first = 1 << level
    totals, cells = sums[: 2 * first].reshape(-1, 2), sums[2 * first :].reshape(-1, 2)
    out = [(n, -1, 0, 0.0, totals[n - first], totals[n - first]) for n in np.unique(nodes)] if level == 0 else []
    if not len(cells):
        return out
    size = sizes[slots]
    starts = np.cumsum(size) - size
    pair = np.repeat(np.arange(len(slots)), size)
    whole = totals[nodes - first]
    cells = cells.copy()
    cells[starts + zero[slots]] += whole - np.add.reduceat(cells, starts, axis=0)  # rows without an entry
    run = np.cumsum(cells, axis=0)
    left = run - (run[starts] - cells[starts])[pair]
    right = whole[pair] - left
    l, r = left.sum(axis=1), right.sum(axis=1)
    n = np.maximum(l + r, 1)
    gain = _gini(whole)[pair] - l / n * _gini(left) - r / n * _gini(right)
    gain = np.where((l > 0) & (r > 0), gain, -1.0)
    for node in np.unique(nodes):
        own = np.flatnonzero(nodes[pair] == node)
        best = own[gain[own].argmax()]
        if gain[best] > 0:
            p = pair[best]
            out.append((node, int(slots[p]), int(best - starts[p]), float(gain[best]), whole[p], left[best]))
    return out


def _saved_nodes(tree: int, feature: np.ndarray, cut: np.ndarray, gain: np.ndarray, counts: np.ndarray, points: list[np.ndarray]) -> list[tuple]:
    """A tree as rows of a saved Spark model, in preorder; leaves of one parent that predict the same class are merged."""
    def kept(node: int):
        if feature[node] < 0:
            return node, None
        a, b = kept(2 * node), kept(2 * node + 1)
        if a[1] is None and b[1] is None and counts[a[0]].argmax() == counts[b[0]].argmax():
            return node, None
        return node, (a, b)

    out: list = []

    def put(item) -> int:
        node, sides = item
        number = len(out)
        out.append(None)
        children = [put(s) for s in sides] if sides else [-1, -1]
        f = int(feature[node]) if sides else -1
        split = (f, [float(points[f][cut[node]])], -1) if sides else (-1, [], -1)
        c = counts[node].astype(float)
        stats = [float(v) for v in c]
        own = (number, float(c.argmax()), float(_gini(c)), stats, int(c.sum()), float(gain[node]) if sides else -1.0, *children, split)
        out[number] = (tree, own)
        return number

    put(kept(1))
    return out


class SparseForest(Estimator):
    """Binary random forest on a vector column; `fit` returns Spark's RandomForestClassificationModel.

    After `on` it gets rows without that column.
    """

    def __init__(self, label: str, trees: int, depth: int, column: str = "features", bins: int = BINS, seed: int = SEED):
        super().__init__()
        self.label, self.trees, self.depth, self.column, self.bins, self.seed = label, trees, depth, column, bins, seed
        self.encoder: Transformer | None = None

    def on(self, encoder: Transformer) -> SparseForest:
        """This forest on rows of which `encoder` makes the vectors, row by row: only those sampled for split points are encoded twice."""
        self.encoder = encoder
        return self

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        trees, depth, seed = self.trees, self.depth, self.seed
        spark = dataset.sparkSession
        encode = self.encoder.transform if self.encoder else lambda rows: rows
        flat = _flat(encode(dataset), self.label, self.column)
        found = dataset.agg(F.count("*").alias("n"), F.min(self.label).alias("a"), F.max(self.label).alias("b")).first()
        if not found["n"]:
            raise ValueError("no rows to train on")
        if not {float(found["a"]), float(found["b"])} <= {0.0, 1.0}:
            raise ValueError(f"labels have to be 0 or 1, not {found['a']} to {found['b']}")
        width = encode(dataset.limit(1)).select(self.column).first()[0].size
        part = dataset.sample(SAMPLE / found["n"], seed) if found["n"] > SAMPLE else dataset
        batch = _flat(encode(part), self.label, self.column).toArrow().combine_chunks().to_batches()
        sampled = sum(b.num_rows for b in batch)
        entries = [_ragged(b)[2:] for b in batch] or [(np.zeros(0, int), np.zeros(0))]
        points = split_points(*(np.concatenate(x) for x in zip(*entries)), sampled, width, self.bins)
        ends = np.cumsum([0, *map(len, points)])
        edges = np.concatenate(points) if width else np.zeros(0)
        sizes = np.diff(ends) + 1
        zero = np.array([np.searchsorted(p, 0.0) for p in points], np.int32)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in _of_size(batches, BLOCK):
                y, rows, slot, value = _ragged(whole)
                order = np.argsort(slot, kind="stable")
                rows, slot, value = rows[order], slot[order], value[order]
                heads = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else np.zeros(0, int)
                bins = np.zeros(len(slot), np.uint8)
                few = ends[slot + 1] - ends[slot] == 1  # one-hot slots, most of all
                bins[few] = value[few] > edges[ends[slot[few]]]
                for i in np.flatnonzero(ends[slot[heads] + 1] - ends[slot[heads]] > 1):
                    h, b = heads[i], heads[i + 1] if i + 1 < len(heads) else len(slot)
                    bins[h:b] = np.searchsorted(edges[ends[slot[h]] : ends[slot[h] + 1]], value[h:b])
                arrays = (y, slot[heads].astype(np.int32), np.r_[heads, len(slot)].astype(np.int32), rows.astype(np.uint16), bins)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in arrays], list("yshrb"))

        packed = _on_all_cores(spark, flat).mapInArrow(pack, "y binary, s binary, h binary, r binary, b binary")
        blocks = packed.rdd.mapPartitionsWithIndex(lambda i, rows: _blocks(i, rows, seed)).persist(StorageLevel.MEMORY_AND_DISK)
        blocks.count()
        nodes = 2 << depth
        feature, cut = np.full((trees, nodes), -1, np.int32), np.zeros((trees, nodes), np.int32)
        gain, counts = np.full((trees, nodes), -1.0), np.zeros((trees, nodes, 2), np.int64)
        open_nodes = [[1] for _ in range(trees)]
        try:
            tasks = min(blocks.getNumPartitions(), WAVES * spark.sparkContext.defaultParallelism)
            for level in range(depth):
                growing = []
                for t, own in enumerate(open_nodes):
                    at, slots = [], []
                    for node in own:
                        picked = np.random.default_rng([seed, t, node]).choice(width, math.ceil(math.sqrt(width)), replace=False)
                        picked = np.sort(picked[sizes[picked] > 1])  # others have one bin
                        at.append(np.full(len(picked), node, np.int32))
                        slots.append(picked.astype(np.int32))
                    if own and (level == 0 or sum(map(len, slots))):
                        growing.append((t, feature[t].copy(), cut[t].copy(), np.concatenate(at), np.concatenate(slots)))
                if not growing:
                    break
                pairs = {t: (at, slots) for t, _, _, at, slots in growing}
                sums = blocks.coalesce(tasks).mapPartitions(lambda it: _counts(it, growing, width, sizes, zero, level)).reduceByKey(lambda a, b: a + b, min(trees, tasks))
                best = sums.map(lambda x: (x[0], x[1][:2], _splits(x[1], *pairs[x[0]], sizes, zero, level))).collect()
                open_nodes = [[] for _ in range(trees)]
                for t, total, splits in best:
                    if level == 0:
                        counts[t, 1] = total
                    for node, f, last, better, whole, left in splits:
                        if f < 0:
                            continue
                        feature[t, node], cut[t, node], gain[t, node] = f, last, better
                        for child, side in ((2 * node, left), (2 * node + 1, whole - left)):
                            counts[t, child] = side
                            if level + 1 < depth and (side > 0).all():
                                open_nodes[t].append(child)
        finally:
            blocks.unpersist()
        rows = [r for t in range(trees) for r in _saved_nodes(t, feature[t], cut[t], gain[t], counts[t], points)]
        return self._model(spark, rows, width)

    def _model(self, spark, nodes: list[tuple], width: int) -> RandomForestClassificationModel:
        """Spark's model with these nodes: the saved form of a small one, its nodes and width replaced."""
        two = spark.createDataFrame([(float(y), Vectors.dense(float(y))) for y in (0, 1)], [self.label, self.column])
        small = RandomForestClassifier(labelCol=self.label, featuresCol=self.column, numTrees=self.trees, maxDepth=self.depth, maxBins=self.bins, seed=self.seed)
        path = work_dir(spark, "forest")
        small.fit(two).save(path)
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0]) | {"numFeatures": width}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
        spark.createDataFrame(nodes, NODE).write.mode("overwrite").parquet(f"{path}/data")
        return RandomForestClassificationModel.load(path)


def _on_all_cores(spark, rows: DataFrame) -> DataFrame:
    """Inputs of few partitions are dealt out; others stay where they are."""
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows
