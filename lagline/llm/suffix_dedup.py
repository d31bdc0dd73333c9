"""Removal of long repeated byte strings with suffix arrays.

A byte goes if a string of `length` bytes around it also starts anywhere else. Equal strings must meet in one suffix
array, so texts are not simply cut into shards. Every string of that length has an anchor, the place inside it where a
hash of ANCHOR bytes is smallest; equal strings have equal anchors at equal offsets. So:

1. Anchors are counted over all texts. A string whose anchor's hash occurs once does not repeat.
2. For other anchors, the bytes of all strings that chose them (a context of at most 2 * length bytes) are sent to the
   hash. Equal contexts are merged and counted before.
3. Contexts of an anchor stand in one shard, where induced sorting builds their suffix array and permuted common
   prefixes tell which strings have an equal neighbour.
4. Repeated places return to their texts, where the covered bytes are cut out.

An anchor with many different contexts (a frequent line in otherwise different texts) would make an unbounded group. Its
strings are split into classes by how far before the anchor they begin; a class is sent to the hash of the bytes that
all of its strings share, which tells apart more texts than the anchor alone. Classes are halved until groups are small;
a class of one beginning has equal contexts only, so this ends. Nothing is dropped on the way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.llm.common import small_batches, stored, text_key, utf8

LENGTH = 400
ANCHOR = 48
GROUP = 256
SHARD_BYTES = 2 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        both = []
        for base in (BASE, np.uint64(_inverse(int(BASE)))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _POWERS[size] = tuple(both)
    up, down = _POWERS[size]
    return up[:n], down[:n]


def window_hashes(raw: np.ndarray, width: int) -> np.ndarray:
    """A well-mixed 64-bit hash of the `width` bytes that begin at each place."""
    n = len(raw) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(raw))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)))
    h = (sums[width:] - sums[:n]) * down[:n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` hashes, the place of the one whose upper half is smallest (the first of equals)."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = (values & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(values), dtype=np.uint64)
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
    return (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


def anchors(raw: np.ndarray, length: int = LENGTH, width: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text: their hashes, their places, and the first and last begin of the strings that chose each."""
    if len(raw) < length:
        return np.zeros(0, np.int64), *(np.zeros(0, np.int32),) * 3
    hashes = window_hashes(raw, width)
    chosen = sliding_argmin(hashes, length - width + 1)
    first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    last = np.append(first[1:], len(chosen)) - 1
    at = chosen[first]
    return hashes[at].view(np.int64), at.astype(np.int32), first.astype(np.int32), last.astype(np.int32)


# --- suffix arrays by induced sorting ---------------------------------------------------------------------------------


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it. The end counts as smaller than any letter."""
    n = len(text)
    rises = text[:-1] < text[1:]
    differs = np.flatnonzero(text[:-1] != text[1:])
    out = np.zeros(n, bool)
    if len(differs):
        lengths = np.diff(np.concatenate(([-1], differs)))
        out[: differs[-1] + 1] = np.repeat(rises[differs], lengths)
    return out


def _induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, size: int) -> np.ndarray:
    """Order all suffixes, given the leftmost-smaller ones in order: larger suffixes forward, then smaller ones backward.

    Buckets of first letters are taken in order; all suffixes that a bucket holds induce the ones before them at once.
    A suffix that falls into the bucket in hand is induced from in the next round there.
    """
    n = len(text)
    counts = np.bincount(text, minlength=size)
    ends = np.cumsum(counts)
    begins = ends - counts
    order = np.full(n, -1, np.int32)
    head = begins.copy()
    seed_letters = text[seeds]
    seed_ends = np.searchsorted(seed_letters, np.arange(size), side="right")
    seed_begins = np.searchsorted(seed_letters, np.arange(size), side="left")
    letters = np.flatnonzero(counts)

    def put_larger(from_: np.ndarray) -> None:
        before = from_[from_ > 0] - 1
        before = before[~small[before]]
        if len(before):
            at = text[before]
            by = np.argsort(at, kind="stable")
            got = np.bincount(at, minlength=size)
            starts = np.cumsum(got) - got
            at = at[by]
            order[head[at] + np.arange(len(by)) - starts[at]] = before[by]
            np.add(head, got, out=head)

    put_last = text[n - 1]  # the whole text's last suffix comes from the end, which is smaller than all
    order[head[put_last]] = n - 1
    head[put_last] += 1
    for c in letters.tolist():
        done = begins[c]
        while done < head[c]:
            upto = head[c]
            put_larger(order[done:upto])
            done = upto
        put_larger(seeds[seed_begins[c] : seed_ends[c]])

    tail = ends.copy()

    def put_smaller(from_: np.ndarray) -> None:
        before = from_[from_ > 0] - 1
        before = before[small[before]]
        if len(before):
            at = text[before]
            by = np.argsort(at, kind="stable")
            got = np.bincount(at, minlength=size)
            starts = np.cumsum(got) - got
            at = at[by]
            order[tail[at] - 1 - (np.arange(len(by)) - starts[at])] = before[by]
            np.subtract(tail, got, out=tail)

    for c in letters[::-1].tolist():
        done = ends[c]
        while done > tail[c]:
            downto = tail[c]
            put_smaller(order[downto:done][::-1])
            done = downto
        put_smaller(order[begins[c] : head[c]][::-1])
    return order


def _order_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names: names of two, four, ... in a row are named in turn until all differ.

    Only suffixes that are still tied are looked at again, so that text without repeats costs one round or two.
    """
    n = len(names)
    order = np.argsort(names, kind="stable")
    ranked = names[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    heads = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    step = 1
    tied = np.flatnonzero(~(new & np.append(new[1:], True)))  # places in `order`
    while len(tied):
        own = order[tied]
        after = own + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        first = rank[own]
        by = np.lexsort((second, first))
        own, first, second = own[by], first[by], second[by]
        order[tied] = own
        new = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
        heads = np.flatnonzero(new)
        rank[own] = np.repeat(tied[heads], np.diff(np.append(heads, len(own))))
        single = new & np.append(new[1:], True)
        tied = tied[~single]
        step *= 2
    return order


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """The suffix array of a text of letters below `size`, by induced sorting.

    Suffixes are classified as larger or smaller than their next; the leftmost-smaller substrings are sorted by one
    induction, named, and their sequence is ordered by names of ever more of them; a second induction orders the rest.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int32)
    small = _types(text)
    left = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    left = left.astype(np.int32)
    if len(left) > 1:
        rough = left[np.argsort(text[left], kind="stable")]
        order = _induce(text, small, rough, size)
        is_left = np.zeros(n, bool)
        is_left[left] = True
        rough = order[is_left[order]]
        number = np.zeros(n, np.int32)
        number[left] = np.arange(len(left))
        ends = np.append(left[1:], n - 1)  # substrings end with the next one's first letter
        length = ends - left
        nth = number[rough]
        a, b = nth[:-1], nth[1:]
        same = length[a] == length[b]
        same &= (a != len(left) - 1) & (b != len(left) - 1)  # the last one reaches the end, which nothing else does
        left64 = left.astype(np.int64)
        open_ = np.flatnonzero(same)
        k = 0
        while len(open_):
            differ = text[left64[a[open_]] + k] != text[left64[b[open_]] + k]
            same[open_[differ]] = False
            open_ = open_[~differ]
            k += 1
            open_ = open_[length[a[open_]] >= k]
        names = np.empty(len(left), np.int64)
        names[nth] = np.concatenate(([0], np.cumsum(~same)))
        left = left[_order_names(names)]
    return _induce(text, small, left, size)


def permuted_prefixes(text: np.ndarray, order: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """For each place, how long a prefix its suffix shares with its predecessor in the array, up to `limit` there.

    Where a place and its predecessor's have the same letter before them, the value is one less than the place before
    has; only the others are compared, eight bytes at a time. limit: letters left before the next separator.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.arange(n, dtype=np.int64)
    fresh = np.ones(n, bool)
    inner = (place > 0) & (before > 0)
    fresh[inner] = text[place[inner] - 1] != text[before[inner] - 1]
    fresh[1:] |= limit[1:] != limit[:-1] - 1
    starts = np.flatnonzero(fresh)
    padded = np.concatenate((text.astype(np.uint8), np.zeros(16, np.uint8)))
    words = np.lib.stride_tricks.as_strided(padded, (n + 8, 8), (1, 1)).copy().view("<u8").ravel() if n else np.zeros(0, np.uint64)
    shared = np.zeros(len(starts), np.int64)
    own, other = starts, before[starts]
    cap = np.where(other >= 0, np.minimum(limit[starts], limit[other]), 0).astype(np.int64)
    open_ = np.flatnonzero(cap > 0)
    while len(open_):
        k = shared[open_]
        differ = words[own[open_] + k] ^ words[other[open_] + k]
        low = differ & (~differ + np.uint64(1))
        shared[open_] = k + np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)) >> 3)
        open_ = open_[(differ == 0) & (shared[open_] < cap[open_])]
    shared = np.minimum(shared, cap)
    run = np.cumsum(fresh) - 1
    return np.maximum(0, shared[run] + starts[run] - place)


def repeated_begins(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each of several different byte strings, the places where a string of `length` begins that also begins elsewhere
    among them. Contexts are separated by a letter below all bytes."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    text = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8).astype(np.uint16) + 1
    ends = np.cumsum(sizes + 1)
    text[ends - 1] = 0
    order = suffix_array(text, 257)
    remains = np.repeat(ends - 1, sizes + 1) - np.arange(len(text))
    shared = permuted_prefixes(text, order, remains)
    long_ = np.flatnonzero(shared[order] >= length)
    hit = np.zeros(len(text), bool)
    hit[order[long_]] = True
    hit[order[long_ - 1]] = True
    starts = ends - sizes - 1
    where = np.flatnonzero(hit)
    which = np.searchsorted(starts, where, side="right") - 1
    cuts = np.searchsorted(which, np.arange(len(contexts) + 1))
    return [where[a:b] - starts[i] for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]


# --- the distributed part ---------------------------------------------------------------------------------------------


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(text_key(text).alias("tkey"), F.col(text).cast("string").cast("binary").alias("text"))


def _flat(names: list[str], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)


def anchor_table(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """All anchors of all texts: `tkey`, `key` (the hash), `at`, `lo`, `hi`."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = utf8(batch.column(1))
            found = [anchors(raw[a:b], length) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            sizes = [len(f[0]) for f in found]
            which = pa.array(np.repeat(np.arange(len(found)), sizes))
            yield _flat(["tkey", "key", "at", "lo", "hi"], [batch.column(0).take(which), *(np.concatenate(c) for c in zip(*found))])

    return _texts(docs, text).mapInArrow(find, "tkey binary, key long, at int, lo int, hi int")


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def context_table(docs: DataFrame, wanted: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """The contexts of repeated anchors: `cid`, `key`, `a` (the anchor's place in it), `ctx`, `tkey`, `lo`, `hi`.

    wanted has `tkey` and `found`, an array of (at, lo, hi, key).
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = utf8(batch.column(1))
            data = raw.tobytes()
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            at, lo, hi, key = (c.to_numpy() for c in lists.flatten().flatten())
            begin = np.repeat(ends[:-1], sizes)
            which = np.repeat(np.arange(len(sizes)), sizes)
            for some in range(0, len(at), 8192):
                part = slice(some, some + 8192)
                bounds = zip((begin[part] + lo[part]).tolist(), (begin[part] + hi[part] + length).tolist())
                ctx = [data[x:y] for x, y in bounds]
                columns = [
                    pa.array([_digest(c) for c in ctx], pa.binary()), key[part], (at[part] - lo[part]).astype(np.int32),
                    pa.array(ctx, pa.binary()), batch.column(0).take(pa.array(which[part])), lo[part], hi[part],
                ]
                yield _flat(["cid", "key", "a", "ctx", "tkey", "lo", "hi"], columns)

    rows = _texts(docs, text).join(wanted, "tkey")
    return rows.select("tkey", "text", "found").mapInArrow(cut, "cid binary, key long, a int, ctx binary, tkey binary, lo int, hi int")


def _split(half: int, length: int):
    """Cut contexts into classes of `half` begins, counted back from the anchor, under a key of what a class shares."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for a, ctx, n, tkey, lo in zip(batch["a"], batch["ctx"], batch["n"], batch["tkey"], batch["lo"]):
                begins = len(ctx) - length + 1
                for c in range(max(0, a - begins + 1) // half, a // half + 1):
                    first, last = max(0, a - (c + 1) * half + 1), min(begins - 1, a - c * half)
                    if first > last:
                        continue
                    shared = ctx[a - c * half : a - (c + 1) * half + 1 + length]
                    key = int.from_bytes(_digest(bytes([c, half.bit_length()]) + shared)[:8], "little", signed=True)
                    part = ctx[first : last + length]
                    out.append((_digest(part), key, a - first, part, n, tkey, None if tkey is None else lo + first))
            frame = pd.DataFrame(out, columns=["cid", "key", "a", "ctx", "n", "tkey", "lo"])
            yield frame.astype({"lo": "Int32"})

    return split


def _sort_shards(length: int, shard_bytes: int):
    """Suffix arrays over runs of whole groups; gives each context that occurs once the runs of begins that repeat."""

    def resolve(held: list) -> pd.DataFrame:
        found = repeated_begins([ctx for ctx, _, _, _ in held], length)
        rows = []
        for (_, n, tkey, lo), places in zip(held, found):
            if n == 1 and len(places):
                new = np.flatnonzero(np.diff(places, prepend=-2) > 1)
                places = places + int(lo)
                rows.append((tkey, places[new].tolist(), places[np.append(new[1:], len(places)) - 1].tolist()))
        return pd.DataFrame(rows, columns=["tkey", "first", "last"])

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, last = [], 0, None
        for batch in batches:
            for key, *row in zip(batch["key"], batch["ctx"], batch["n"], batch["tkey"], batch["lo"]):
                if size >= shard_bytes and key != last:
                    yield resolve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[0])
                last = key
        if held:
            yield resolve(held)

    return sort


def _merged(contexts: DataFrame, n: Column) -> DataFrame:
    """Equal contexts as one row with their number and one of their places."""
    place = F.min(F.when(F.col("tkey").isNotNull(), F.struct("tkey", "lo"))).alias("place")
    rows = contexts.groupBy("cid", "key", "a", "ctx").agg(n.alias("n"), place)
    return stored(rows.select("cid", "key", "a", "ctx", "n", "place.tkey", "place.lo"), "groups")


def repeated_runs(docs: DataFrame, text: str = "text", length: int = LENGTH, group: int = GROUP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per text the begins of repeated strings: `tkey`, `runs`, an array of (first, last), inclusive.

    All begins of a context that occurs more than once repeat, wherever it stands. Contexts that occur once carry their
    place along; they are compared to all contexts of their anchor.
    """
    small_batches(docs.sparkSession)
    marks = stored(anchor_table(docs, text, length), "anchors")
    often = stored(marks.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "often")
    wanted = marks.join(often, "key").dropDuplicates(["tkey", "at"])
    wanted = wanted.groupBy("tkey").agg(F.collect_list(F.struct("at", "lo", "hi", "key")).alias("found"))
    table = stored(context_table(docs, wanted, text, length), "contexts")
    groups = _merged(table, F.count(F.lit(1)))
    again = groups.where("n > 1").select("cid")
    whole = table.select("cid", "tkey", "lo", "hi").distinct().join(again, "cid")
    runs = [whole.select("tkey", F.array("lo").alias("first"), F.array("hi").alias("last"))]
    half = 1 << (length - 1).bit_length()
    while True:
        sizes = groups.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
        small = sizes.where((F.col("size") > 1) & (F.col("size") <= group)).select("key")
        shards = groups.join(small, "key").repartition("key").sortWithinPartitions("key").select("key", "ctx", "n", "tkey", "lo")
        runs.append(shards.mapInPandas(_sort_shards(length, shard_bytes), "tkey binary, first array<int>, last array<int>"))
        crowded = sizes.where(F.col("size") > group).select("key")
        half //= 2
        if not half or crowded.isEmpty():
            break
        schema = "cid binary, key long, a int, ctx binary, n long, tkey binary, lo int"
        parts = groups.join(crowded, "key").select("a", "ctx", "n", F.when(F.col("n") == 1, F.col("tkey")).alias("tkey"), "lo")
        parts = stored(parts.mapInPandas(_split(half, length), schema), "classes")
        groups = _merged(parts, F.sum("n"))
        again = groups.where("n > 1").select("cid")
        met = parts.where("tkey is not null").select("cid", "tkey", "lo", F.length("ctx").alias("size")).join(again, "cid")
        runs.append(met.select("tkey", F.array("lo").alias("first"), F.array((F.col("lo") + F.col("size") - length).cast("int")).alias("last")))
    found = runs[0]
    for more in runs[1:]:
        found = found.unionByName(more)
    return found.groupBy("tkey").agg(F.flatten(F.collect_list(F.arrays_zip("first", "last"))).alias("runs"))


def without_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, keep_text: bool = True, **options) -> DataFrame:
    """One row per document: `doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`, and `kept`, the bytes that stay
    (null if not asked for).

    Texts are bytes in UTF-8, a null is empty. Strings are judged on the input; rows that repeat are documents of their
    own, so that a text that occurs twice loses all of its bytes if it has `length` of them. An empty table gives none.
    """
    runs = repeated_runs(docs, text, length, **options)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_key(text).alias("tkey"), F.col(text).cast("string").cast("binary").alias("text"))
    rows = rows.join(runs, "tkey", "left").select("doc_id", "text", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = utf8(batch.column(1))
            data = memoryview(raw.tobytes())
            found = batch.column(2).to_pylist()
            out = []
            for a, b, runs in zip(ends[:-1].tolist(), ends[1:].tolist(), found):
                own = data[a:b]
                if not runs:
                    out.append((b - a, 0, 0, hashlib.sha256(own).hexdigest(), bytes(own) if keep_text else None))
                    continue
                steps = np.zeros(b - a + 1, np.int32)
                np.add.at(steps, [r["first"] for r in runs], 1)
                np.add.at(steps, [r["last"] + length for r in runs], -1)
                gone = np.cumsum(steps[:-1]) > 0
                kept = raw[a:b][~gone].tobytes()
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((b - a, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            sizes, removed, spans, sums, kept = zip(*out)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sums, pa.string()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return rows.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
