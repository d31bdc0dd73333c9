"""Near-duplicate texts by SimHash: covering-code anchors find the close fingerprints, labels spread over the links.

Fingerprints that differ in at most four bits differ in at most two bits in one of their halves. The anchors of a half
are the words whose low 31 bits are a Hamming codeword, a perfect code of covering radius one; the top bit is free. Two
words at distance two have a midpoint one bit from either; the anchor that covers the midpoint is therefore within
radius + 1 of both. So each fingerprint is copied to all anchors within distance two of either half, 17 a half at most,
and every close pair meets at an anchor, where pairs are compared in all 64 bits.

An anchor at which many different fingerprints meet (large groups of near copies) does not emit its pairs, as their
number is the square of the group. Its fingerprints are compared in bounded blocks that return spanning forests: other
links, the same reachability.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.llm.common import carried, full_text, restored, small_batches, stored, text_key

SHINGLE = 4
BITS = 4
CROWD = 16
BLOCK = 1024
SEED = 42


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """The 64-bit hashes of a text's word shingles, repeats included; of all its words where they are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, "<u8")
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())], dtype="<u8")


def fingerprint_of(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included; 0 for a text without words."""
    hashes = shingle_hashes(text, shingle)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << np.flatnonzero(2 * ones > len(hashes)).astype(np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The rows with a column `_fp` (long): the SimHash of the lower-cased words of a whole text (null: no words)."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint_of(x, shingle) for x in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return docs.withColumn("_fp", simhash(full_text(text)))


def _syndrome(half: Column) -> Column:
    """Which of the low 31 bits, counted from 1, must flip to give a codeword; 0 for a codeword."""
    parts = []
    for b in range(5):
        mask = sum(1 << (i - 1) for i in range(1, 32) if i >> b & 1)
        parts.append((F.bit_count(half.bitwiseAND(F.lit(mask))) % 2) * (1 << b))
    return sum(parts[1:], parts[0]).cast("int")


def anchor_masks() -> list[list[int]]:
    """For each syndrome, the changes of up to two bits of a 32-bit word that lead to an anchor."""
    masks = [[0, 1 << 31]]
    for s in range(1, 32):
        pairs = [(1 << (i - 1)) | (1 << (j - 1)) for i, j in combinations(range(1, 32), 2) if i ^ j == s]
        masks.append([1 << (s - 1), (1 << (s - 1)) | (1 << 31), *pairs])
    return masks


def replicas(prints: DataFrame) -> DataFrame:
    """Each distinct fingerprint at every anchor in reach of either half: columns `anchor`, `_fp`."""
    table = F.array(*[F.array(*[F.lit(m) for m in row]) for row in anchor_masks()])
    low = F.col("_fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned(F.col("_fp"), 32)
    frames = []
    for side, half in enumerate((low, high)):
        masks = F.element_at(table.cast("array<array<bigint>>"), _syndrome(half) + 1)
        near = prints.select("_fp", half.alias("half"), F.explode(masks).alias("mask"))
        frames.append(near.select((F.col("half").bitwiseXOR(F.col("mask")) + (side << 32)).alias("anchor"), "_fp"))
    return frames[0].unionByName(frames[1])


def forest(prints: np.ndarray) -> np.ndarray:
    """Links (row, row) that connect the distinct fingerprints as all their close pairs do; n - 1 at most."""
    n = len(prints)
    left = np.ones(n, bool)
    links = []
    while left.any():
        wave = np.flatnonzero(left)[:1]
        left[wave] = False
        while len(wave):  # a wave reaches the fingerprints close to any of the last ones
            rest = np.flatnonzero(left)
            close = np.bitwise_count(prints[wave][:, None] ^ prints[rest][None, :]) <= BITS
            hit = close.any(axis=0)
            links.append(np.stack([wave[close[:, hit].argmax(axis=0)], rest[hit]], axis=1))
            wave = rest[hit]
            left[wave] = False
    return np.concatenate(links) if links else np.zeros((0, 2), np.int64)


def _crowd_links(group: pd.DataFrame) -> pd.DataFrame:
    prints = group["_fp"].drop_duplicates().to_numpy()
    links = prints[forest(prints.view(np.uint64))]
    return pd.DataFrame({"u": links.min(axis=1), "v": links.max(axis=1)})


def close_pairs(prints: DataFrame, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """Links (`u` < `v`) between distinct fingerprints, whose components are those of all pairs within four bits.

    At anchors of at most `crowd` fingerprints every close pair is a row. At others each pair of blocks of about `block`
    fingerprints is one group that compares them all and returns a spanning forest of its links: groups stay bounded
    however many fingerprints meet, and the rows they return are no more than those they got.
    """
    at = stored(replicas(prints), "anchors")
    full = at.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = at.join(full.where(F.col("n") <= crowd).select("anchor"), "anchor").select("anchor", F.col("_fp").alias("u"))
    other = met.select("anchor", F.col("u").alias("v"))
    close = (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= BITS)
    pairs = met.join(other, "anchor").where(close).select("u", "v")

    dense = at.join(full.where(F.col("n") > crowd), "anchor")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("_fp"), blocks).cast("int")
    dense = dense.select("anchor", "_fp", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dense = dense.select("anchor", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "_fp")
    trees = dense.groupBy("anchor", "i", "j").applyInPandas(_crowd_links, "u long, v long")
    return pairs.unionByName(trees).distinct()


def components(links: DataFrame, purpose: str = "links") -> DataFrame:
    """Connected components of undirected links (`u`, `v`): columns `node`, `root`, the smallest node reachable.

    Alternating large-star and small-star steps: a node passes its neighbours on to the smallest one it knows of. Only
    minima are aggregated, no neighbourhood is gathered, and the steps grow with the logarithm of a chain's length.
    Each step is written to the shared folder.
    """
    edges = stored(links.where("u <> v").select("u", "v"), purpose)

    def state(frame: DataFrame):
        row = frame.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    def star(frame: DataFrame, large: bool) -> DataFrame:
        if large:  # all neighbours; the larger ones go to the smallest
            both = frame.union(frame.select("v", "u"))
        else:  # neighbours that are smaller; they and the node go to the smallest
            both = frame.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.join(low, "u")
        if large:
            moved = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        return moved.where("u <> v").distinct()

    before = state(edges)
    while before[0]:
        edges = stored(star(stored(star(edges, True), purpose), False), purpose)
        now = state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("root"))
    return roots.union(roots.select("root", "root")).distinct()


def _roots(prints: DataFrame, crowd: int) -> DataFrame:
    """Every distinct fingerprint with the smallest one reachable from it: `_fp`, `root`."""
    distinct = prints.select("_fp").distinct()
    linked = components(close_pairs(distinct, crowd))
    return distinct.join(linked, F.col("_fp") == F.col("node"), "left").select("_fp", F.coalesce("root", "_fp").alias("root"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", crowd: int = CROWD) -> DataFrame:
    """One row per document: `doc_id`, `fingerprint` (16 hex digits), `component_id`.

    The component id is the smallest non-null key among the documents whose fingerprints are reachable over links of
    at most four differing bits, null if all are null. Documents without words have fingerprint zero and are linked
    like any other. Rows that repeat, and rows with one key, are documents of their own. An empty table gives none.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    prints = stored(fingerprints(rows).select("doc_id", "_fp"), "prints")
    least = prints.groupBy("_fp").agg(F.min("doc_id").alias("least"))  # before any join: copies may be most of the rows
    of = stored(_roots(prints, crowd).join(least, "_fp"), "roots")
    smallest = of.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of.join(smallest, "root").select("_fp", "component_id")
    out = prints.join(named, "_fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, text: str = "text", key: str = "doc_id", crowd: int = CROWD) -> DataFrame:
    """The rows of one document of each group of near duplicates, the one with the smallest key.

    A null key comes last; of equal keys the smallest digest of the text decides, of equal texts any one row stays.
    """
    rows = docs.select(F.col(key).alias("id"), text_key(text).alias("tkey"), F.col(text).alias("text"))
    prints = stored(fingerprints(rows).select("id", "tkey", "_fp"), "prints")
    first = prints.groupBy("_fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tkey")).alias("first"))
    chosen = _roots(prints, crowd).join(first, "_fp").groupBy("root").agg(F.min("first").alias("first"))
    chosen = stored(chosen.select(F.col("first.id").alias("id"), F.col("first.tkey").alias("tkey")), "chosen")
    wide = docs.select(carried(docs), F.col(key).alias("_id"), text_key(text).alias("_tkey"))
    same = (F.col("_tkey") == F.col("tkey")) & F.col("_id").eqNullSafe(F.col("id"))
    one = wide.join(chosen, same, "left_semi").dropDuplicates(["_tkey", "_id"])
    return restored(one, docs.columns)
