"""Exact top-k inner-product search: ball trees over shards of the vectors, searched by branch and bound.

Vectors are dealt to shards of bounded size, queries to blocks; every block visits every shard. A node of a shard's tree
knows the centre and the radius of its vectors, so query . centre + |query| * radius bounds what any of them can score.
Nodes are taken in the order of their bounds until the best one left is below the query's current k-th score. That score
is shared: a first wave of shards is searched from nothing, the k-th scores found there start the search of all others,
which return only what can still be among the best.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagline.llm.common import small_batches, stored

K = 10
SCALE = 1024
SHARD_ROWS = 8192
BLOCK_ROWS = 512
LEAF = 256


class Tree:
    """A ball tree over the rows of a matrix."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF):
        self.vectors = vectors
        self.nodes: list[tuple[np.ndarray, float, np.ndarray | None, tuple[int, int] | None]] = []
        self._build(np.arange(len(vectors)), leaf)
        self.centres = np.array([n[0] for n in self.nodes])
        self.radii = np.array([n[1] for n in self.nodes])

    def _build(self, rows: np.ndarray, leaf: int) -> int:
        own = self.vectors[rows]
        centre = own.mean(axis=0)
        far = own - centre
        away = np.sqrt((far * far).sum(axis=1))
        me = len(self.nodes)
        self.nodes.append((centre, float(away.max()), rows, None))
        if len(rows) > leaf and away.max() > 0:
            # along the line from the vector farthest from the centre to the one farthest from it
            a = own[away.argmax()]
            b = own[((own - a) ** 2).sum(axis=1).argmax()]
            order = np.argsort(own @ (b - a), kind="stable")
            half = len(rows) // 2
            sides = self._build(rows[order[:half]], leaf), self._build(rows[order[half:]], leaf)
            self.nodes[me] = (*self.nodes[me][:2], None, sides)
        return me

    def best(self, query: np.ndarray, keys: np.ndarray, own: np.ndarray, me: int, k: int, least: float) -> list[tuple[int, int]]:
        """The k best (score, -key) of at least `least`, without the row whose number in `own` is `me`."""
        # rounding may lower a bound; scores are whole numbers, so one unit and a relative margin are enough
        bounds = self.centres @ query + np.sqrt(query @ query) * self.radii
        bounds += 1 + 1e-9 * (np.abs(bounds) + np.sqrt(query @ query) * self.radii)
        heap = [(-bounds[0], 0)]
        found: list[tuple[int, int]] = []
        while heap and -heap[0][0] >= least:
            _, node = heapq.heappop(heap)
            _, _, rows, sides = self.nodes[node]
            if sides:
                for side in sides:
                    heapq.heappush(heap, (-bounds[side], side))
                continue
            scores = self.vectors[rows] @ query
            for r in np.flatnonzero(scores >= least).tolist():
                if own[rows[r]] == me:
                    continue
                entry = (int(scores[r]), -int(keys[rows[r]]))
                if len(found) < k:
                    heapq.heappush(found, entry)
                elif entry > found[0]:
                    heapq.heapreplace(found, entry)
            if len(found) == k:
                least = max(least, found[0][0])
        return found


def _search(k: int):
    def search(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(queries):
            matrix = np.array(vectors["vector"].to_list(), dtype=np.float64).reshape(len(vectors), -1)
            wanted = np.array(queries["query"].to_list(), dtype=np.float64).reshape(len(queries), -1)
            # whole numbers below 2**53 add up exactly; larger ones are Python's integers, scanned without a tree
            exact = np.abs(matrix).max(initial=0) * np.abs(wanted).max(initial=0) * max(1, matrix.shape[1]) < 2.0**53
            keys, numbers = vectors["own"].to_numpy(), vectors["own_row"].to_numpy()
            tree = Tree(matrix) if exact else None
            big = [[int(x) for x in row] for row in vectors["vector"]] if not exact else None
            for me, own, query, values, least in zip(queries["query_row"], queries["query_id"], wanted, queries["query"], queries["least"]):
                least = -np.inf if pd.isna(least) else float(least)
                if exact:
                    found = tree.best(query, keys, numbers, me, k, least)
                else:
                    q = [int(x) for x in values]
                    scored = ((sum(a * b for a, b in zip(q, row)), -int(key)) for key, number, row in zip(keys, numbers, big) if number != me)
                    found = heapq.nlargest(k, ((max(-(2**63), min(2**63 - 1, s)), key) for s, key in scored))
                out += [(me, own, -key, score) for score, key in found]
        return pd.DataFrame(out, columns=["query_row", "query_id", "vec_id", "score"]).astype("int64")

    return search


def whole(vector: Column, scale: int = SCALE) -> Column:
    """Components as whole numbers: floor(scale * x)."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Each query's k best candidates by inner product: `query_id`, `rank` (from 1), `vec_id`, `score`.

    Both have `vec_id`, `v`, whole numbers as doubles, and `row`, a number that is the row's own. A query's row is no
    candidate of its own; only vectors of its length are. Rows that share an id are candidates and queries of their own,
    so an id may have several lists. Ties go to the smaller id. Scores beyond 64 bits are set to the nearest 64-bit number.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    n = vectors.count()
    m = queries.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-m // block_rows))
    first = max(1, round(shards**0.5))
    # names of their own, as both may be parts of one table
    dealt = vectors.select(F.col("row").alias("own_row"), F.col("vec_id").alias("own"), F.col("v").alias("vector"))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("own_row"), F.lit(shards)).cast("int"))
    asked = queries.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("v").alias("query"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_row"), F.lit(blocks)).cast("int"))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")

    def wave(low: int, high: int, known: DataFrame | None) -> DataFrame:
        some = dealt.where((F.col("shard") >= low) & (F.col("shard") < high))
        some = some.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        own = asked.withColumn("least", F.lit(None).cast("long")) if known is None else asked.join(known, "query_row", "left")
        own = own.withColumn("shard", F.explode(F.sequence(F.lit(low), F.lit(high - 1))))
        keys = ["shard", "block", "size"]
        left = some.withColumn("size", F.size("vector")).groupBy(*keys)
        right = own.withColumn("size", F.size("query")).groupBy(*keys)
        return left.cogroup(right).applyInPandas(_search(k), "query_row long, query_id long, vec_id long, score long")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    found = stored(ranked(wave(0, first, None)), "wave")
    if first < shards:
        kth = found.where(F.col("rank") == k).select("query_row", F.col("score").alias("least"))
        rest = wave(first, shards, kth)
        found = ranked(found.drop("rank").unionByName(rest))
    return found.select("query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, every: int, k: int = K, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """The k best of all rows for each row whose id is divisible by `every`.

    Rows without an id, and vectors that are null or hold a component that is null, infinite or not a number, take no
    part. Rows that repeat an id, with the same vector or another, are rows of their own: each is a candidate of the others,
    and a query if its id is one.
    """
    good = F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.where(good & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("vec_id"), whole(F.col(vector)).alias("v"))
    # written with their numbers, which therefore stay the same whenever rows are read again
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    return top_k(rows, rows.where(F.col("vec_id") % every == 0), k)
