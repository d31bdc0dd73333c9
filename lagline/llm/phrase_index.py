"""Benchmark decontamination with a positional inverted index.

The index is cut into shards of whole documents. A shard's rows are its terms, each with the ascending places at which it
occurs; a document's places follow those of the one before after a hole, so that no phrase crosses documents. One more
row, without a term, names the shard's documents. A phrase is found by intersecting the place lists of its words, each
moved back by the word's offset, starting from the word that is rarest in all of the corpus. Only the lists of words
that the benchmark holds are read and sent, and a shard's lists are bounded by its texts, however frequent the word is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.llm.common import small_batches, stored, utf8

WINDOW = 10
SHARD_BYTES = 16 << 20
BLOCK_WORDS = 1_000_000
NEAR_TERMS = 3
NEAR_SPAN = 30

# Fixed by the result's contract: which bytes belong to words once A-Z are lower case.
SEPARATORS = (*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))
_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[ord("A") : ord("Z") + 1] += 32
_WORD = np.ones(256, bool)
_WORD[list(SEPARATORS)] = False


def split_words(raw: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of several texts as one Arrow array of bytes, and how many words each text has."""
    low = _TABLE[raw]
    word = _WORD[low]
    borders = ends[1:-1]
    borders = borders[borders < len(raw)]
    before = np.concatenate(([False], word[:-1]))
    before[borders] = False
    begins = np.flatnonzero(word & ~before)
    after = np.concatenate((word[1:], [False]))
    after[borders[borders > 0] - 1] = False
    lengths = np.flatnonzero(word & ~after) + 1 - begins
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    data = pa.py_buffer(low[word].tobytes())
    if offsets[-1] < 2**31:
        words = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), data])
    else:
        words = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), data])
    counts = np.diff(np.searchsorted(begins, ends))
    return words, counts


def shard_rows(shard: int, ids: pa.Array, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    """The index rows of one shard: `shard`, `term`, `ids`, `places`.

    places are steps from the one before. The row without a term has the documents' ids and numbers of words.
    """
    raw, ends = utf8(texts)
    words, counts = split_words(raw, ends)
    first = pa.array([ids.to_pylist()], pa.list_(pa.int64()))
    sizes = pa.array([counts.astype(np.int32)], pa.list_(pa.int32()))
    number = lambda n: pa.array(np.full(n, shard, np.int64))
    names = ["shard", "term", "ids", "places"]
    yield pa.RecordBatch.from_arrays([number(1), pa.nulls(1, pa.binary()), first, sizes], names)
    if not len(words):
        return
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy()
    places = np.arange(len(codes), dtype=np.int64) + np.repeat(np.arange(len(counts)), counts)
    order = np.argsort(codes, kind="stable")
    places = places[order]
    bounds = np.concatenate(([0], np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))))
    steps = np.diff(places, prepend=0)
    steps[bounds[:-1]] = places[bounds[:-1]]
    lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(steps.astype(np.int32)))
    terms = coded.dictionary.cast(pa.binary())
    for at in range(0, len(terms), 1 << 14):
        some = terms.slice(at, 1 << 14)
        columns = [number(len(some)), some, pa.nulls(len(some), pa.list_(pa.int64())), lists.slice(at, 1 << 14)]
        yield pa.RecordBatch.from_arrays(columns, names)


def build_index(docs: DataFrame, text: str = "text", key: str = "doc_id", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index of all documents, written to the shared folder. Null and empty texts have no words but are listed."""
    small_batches(docs.sparkSession)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, size, n = [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in whole.columns]
            yield from shard_rows((part << 32) + n, *columns)

        for batch in batches:
            held.append(batch)
            size += batch.column(1).nbytes
            if size >= shard_bytes:
                yield from flush()
                held, size, n = [], 0, n + 1
        if held:
            yield from flush()

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").cast("binary").alias("text"))
    return stored(rows.mapInArrow(index, "shard long, term binary, ids array<long>, places array<int>"), "postings")


def item_words(items: DataFrame, text: str = "text", key: str = "item_id") -> DataFrame:
    """Columns `item` (the id as a string, `null` for none) and `words`; items without words are left out."""

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = split_words(*utf8(batch.column(1)))
            bounds = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
            lists = pa.ListArray.from_arrays(bounds, words.cast(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["item", "words"])

    rows = items.select(
        F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("item"), F.col(text).cast("string").cast("binary").alias("text")
    )
    return rows.distinct().mapInArrow(words_of, "item string, words array<binary>").where(F.size("words") > 0)


def intersect(lists: dict[bytes, np.ndarray], words: list[tuple[int, bytes]]) -> np.ndarray:
    """Places where the words stand at their offsets; words come rarest first."""
    starts = None
    for offset, word in words:
        places = lists.get(word)
        if places is None:
            return np.zeros(0, np.int64)
        if starts is None:
            starts = places - offset
            continue
        at = np.searchsorted(places, starts + offset)
        at[at == len(places)] = 0
        starts = starts[places[at] == starts + offset]
        if not len(starts):
            break
    return starts


def close_by(lists: dict[bytes, np.ndarray], words: list[bytes], span: int, base: np.ndarray) -> np.ndarray:
    """Places of the first word that have all the others within `span` words of the same document, in any order.

    base has where documents begin, ascending.
    """
    document = lambda places: np.searchsorted(base, places, side="right")
    starts = lists.get(words[0], np.zeros(0, np.int64))
    for word in words[1:]:
        places = lists.get(word)
        if places is None or not len(starts):
            return np.zeros(0, np.int64)
        at = np.searchsorted(places, starts)
        beside = np.zeros(len(starts), bool)
        for other in (places[np.minimum(at, len(places) - 1)], places[np.maximum(at - 1, 0)]):  # nearest on either side
            beside |= (np.abs(other - starts) <= span) & (document(other) == document(starts))
        starts = starts[beside]
    return starts


def _runs(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending occurrences of one length, merged where they touch or overlap."""
    new = np.concatenate(([True], starts[1:] > starts[:-1] + length))
    heads = np.flatnonzero(new)
    return starts[heads], starts[np.concatenate((heads[1:], [len(starts)])) - 1] + length


def _matcher(sent, near_span: int):
    """A function that matches one shard's lists against the phrases that were sent."""

    def match(group: pd.DataFrame) -> pd.DataFrame:
        phrases, near = sent.value
        lists, ids, sizes = {}, [], np.zeros(0, np.int64)
        for term, own, places in zip(group["term"], group["ids"], group["places"]):
            if term is None:
                ids, sizes = own, np.asarray(places, np.int64)
            else:
                lists[bytes(term)] = np.cumsum(places, dtype=np.int64)
        base = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
        found: dict[int, list] = {}
        nearby: dict[int, set] = {}
        by_item: dict[tuple[str, int], list] = {}
        for length, ordered, names in phrases:
            starts = intersect(lists, ordered)
            if len(starts):
                for name in names:
                    by_item.setdefault((name, length), []).append(starts)
        for (name, length), parts in by_item.items():
            begins, ends = _runs(np.unique(np.concatenate(parts)), length)
            docs = np.searchsorted(base, begins, side="right") - 1
            for d, b, e in zip(docs.tolist(), (begins - base[docs]).tolist(), (ends - base[docs]).tolist()):
                found.setdefault(d, []).append((name, b, e))
        for rare, names in near:
            for d in np.unique(np.searchsorted(base, close_by(lists, rare, near_span, base), side="right") - 1).tolist():
                nearby.setdefault(d, set()).update(names)
        n = len(ids)
        return pd.DataFrame({
            "shard": np.full(n, group["shard"].iloc[0]), "doc_no": np.arange(n), "doc_id": pd.array(list(ids), "Int64"),
            "n_words": sizes,
            "hits": [[{"item": i, "start": s, "end": e} for i, s, e in found.get(d, [])] for d in range(n)],
            "near_items": [sorted(nearby.get(d, ())) for d in range(n)],
        })

    return match


def find_phrases(
    index: DataFrame, items: DataFrame, window: int = WINDOW, near_terms: int = NEAR_TERMS, near_span: int = NEAR_SPAN,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: `shard`, `doc_no`, `doc_id`, `n_words`, `hits`, `near_items`.

    hits: array of (item, start, end), the runs of words inside occurrences of an item's windows of `window` words; an
    item of fewer words is one window. near_items: items whose `near_terms` rarest words, of those that documents have at
    all, stand within `near_span` words of the rarest; items of which fewer words than that are found have no such place.
    Items are taken in blocks of about `block_words` words, so that what a task is sent is bounded.
    """
    spark = index.sparkSession
    words = item_words(items).persist()
    total = words.agg(F.sum(F.size("words"))).first()[0] or 0
    n_blocks = -(-total // block_words) or 1
    blocked = words.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(n_blocks)))
    frames = []
    for block in range(n_blocks):
        mine = blocked.where(F.col("block") == block)
        terms = mine.select(F.explode("words").alias("term")).distinct()
        lists = stored(index.join(terms, "term", "left_semi").unionByName(index.where("term is null")), "lists")
        counts = lists.where("term is not null").groupBy("term").agg(F.sum(F.size("places").cast("long")).alias("n"))
        often = {bytes(r.term): r.n for r in counts.collect()}  # no more than the block's words
        windows: dict[tuple, set[str]] = {}
        near: dict[tuple, set[str]] = {}
        for row in mine.toLocalIterator():
            own = [bytes(w) for w in row.words]
            for at in range(max(1, len(own) - window + 1)):
                phrase = tuple(own[at : at + window])
                if all(w in often for w in phrase):
                    windows.setdefault(phrase, set()).add(row.item)
            rare = sorted({w for w in own if w in often}, key=lambda w: (often[w], w))
            if len(rare) >= min(near_terms, len(set(own))):
                near.setdefault(tuple(rare[:near_terms]), set()).add(row.item)
        phrases = [
            (len(p), sorted(enumerate(p), key=lambda x: (often[x[1]], x[0])), sorted(names)) for p, names in windows.items()
        ]
        sent = spark.sparkContext.broadcast((phrases, [(list(p), sorted(names)) for p, names in near.items()]))

        schema = "shard long, doc_no long, doc_id long, n_words long, hits array<struct<item:string,start:int,end:int>>, near_items array<string>"
        frames.append(lists.groupBy("shard").applyInPandas(_matcher(sent, near_span), schema))
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame)
    if n_blocks == 1:
        return rows
    return rows.groupBy("shard", "doc_no").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_distinct(F.flatten(F.collect_list("near_items"))).alias("near_items"),
    )


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, **options) -> DataFrame:
    """One row per document: `doc_id`, `n_words`, `n_hit`, `n_items`, `items_sha256`, `contaminated`, `n_near`.

    n_hit counts the document's words inside any occurrence of a window, n_near the items near to it without regard to
    order. Null and empty texts have no words and are never contaminated; rows that repeat are documents of their own;
    an empty benchmark contaminates nothing.
    """
    found = find_phrases(build_index(docs, text, key), items, window, **options)
    start = F.struct(F.lit(0).alias("reach"), F.lit(0).cast("long").alias("n"))
    runs = F.array_sort(F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"))))
    covered = F.aggregate(
        runs, start,
        lambda acc, h: F.struct(
            F.greatest(acc["reach"], h["end"]).alias("reach"),
            (acc["n"] + F.greatest(F.lit(0), h["end"] - F.greatest(acc["reach"], h["start"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    names = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item"])))
    return found.select(
        "doc_id", "n_words", covered.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near"),
    )
