"""Best-fit packing by linear grouping: documents as token sequences into as few sequences of bounded length as possible.

Lengths are whole numbers up to the capacity, so the table of how many pieces have each length is bounded, however many
pieces there are. All decisions are taken on that table:

1. Large lengths, longest first, are cut into groups of equal cardinality and rounded up to the longest of their group.
2. Sequences for the few rounded sizes are filled by configurations, each found as the fullest one that the remaining
   demand allows (a bounded knapsack) and used as often as the demand lasts.
3. The actual lengths take the places of the rounded ones. Their slack is known, as groups are used up in order.
4. Small lengths go, longest first, to the fullest sequence that still takes them.

Sequences that are alike are kept as one run. The plan says, for a range of the pieces of one length, where they go; the
pieces, numbered per length, look their place up. Nothing but the length table reaches the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagline.llm.common import Once, small_batches, stored, utf8

CAPACITY = 4096
END = 1
GROUPS = 32
LARGE = 8  # lengths over a LARGE-th of the capacity are rounded and arranged in configurations
TOKENIZER = "word_bpe_49k.json"
KNOWN_WORDS = 1 << 18  # stretches that a task remembers


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class Encoder:
    """A tokenizer with the ids of stretches of text that it has seen.

    The tokenizer never joins characters across blanks and line breaks, nor a letter and an ASCII mark other than the
    apostrophe, and takes no account of case. So texts are cut there, in lower case; each different stretch is encoded
    once and looked up after that. Only where the end of a special token stands, which may hold marks and needs its
    case, texts are cut at blanks and line breaks alone.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.begins = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)

    def learn(self, new: pa.Array) -> None:
        """Remember the ids of new stretches, which are none of those known."""
        words = new.to_pylist()
        ids: list[list[int]] = [[]] * len(words)
        others = []
        pieces = self.tok.model.tokenize
        for i, w in enumerate(words):
            # a word of Latin letters in composed lower case is one token of the splitting steps: the model takes it as it is
            if w.isascii() and w.isalpha() and w.islower():
                ids[i] = [t.id for t in pieces(w)]
            elif w.isalpha() and max(w) < "\u0250" and w == w.lower() and is_normalized("NFC", w):
                ids[i] = [t.id for t in pieces(w.encode().decode("latin-1").translate(BYTE_LETTERS))]
            else:
                others.append(i)
        # the rest in one text, blanks between them; its tokens are dealt out by where they begin
        got = self.tok.encode(" ".join(words[i] for i in others), add_special_tokens=False)
        starts = np.cumsum([0] + [len(words[i]) + 1 for i in others])
        where = np.searchsorted(starts, np.fromiter((a for a, _ in got.offsets), np.int64, len(got.ids)), side="right") - 1
        cuts = np.searchsorted(where, np.arange(len(others) + 1)).tolist()
        rest = got.ids
        for i, x, y in zip(others, cuts[:-1], cuts[1:]):
            ids[i] = rest[x:y]
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        begins = len(self.flat) + np.cumsum(sizes) - sizes
        self.known = pa.concat_arrays([self.known, new.cast(pa.large_string())])
        self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.begins = np.concatenate((self.begins, begins.astype(np.int32)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        raw, ends = utf8(texts)
        inside = (raw != 32) & (raw != 10)
        cut = np.zeros(len(raw), bool)  # a stretch begins here
        borders = ends[:-1]
        cut[borders[borders < len(raw)]] = True
        if len(raw):
            cut[1:] |= ~inside[:-1]
        if b"|>" not in raw.tobytes():
            kind = KINDS[raw]
            cut[1:] |= kind[1:] + kind[:-1] == 3  # a letter beside a mark
            raw = LOWER[raw]
        begins = np.flatnonzero(cut & inside)
        wide = len(raw) >= 2**31
        held = np.cumsum(inside.view(np.uint8), dtype=np.int64 if wide else np.int32)
        offsets = np.append(held[begins] - 1, held[-1:] if len(held) else 0)
        data = pa.py_buffer(raw[inside].tobytes())
        del held, cut
        kind = pa.large_string() if wide else pa.string()
        coded = pa.Array.from_buffers(kind, len(begins), [None, pa.py_buffer(offsets), data]).dictionary_encode()
        words = coded.dictionary.cast(pa.large_string())
        place = pc.index_in(words, value_set=self.known)
        new = words.filter(place.is_null())
        if len(new):
            if len(self.known) + len(new) > KNOWN_WORDS:  # forget all: what is still in use is encoded again
                self.forget()
                new = words
            for at in range(0, len(new), 1 << 14):
                self.learn(new.slice(at, 1 << 14))
            place = pc.index_in(words, value_set=self.known)
        place = place.to_numpy(zero_copy_only=False)[coded.indices.to_numpy()]
        many = self.sizes[place]
        steps = np.concatenate(([0], np.cumsum(many, dtype=np.int64)))
        per_text = np.diff(steps[np.searchsorted(begins, ends)])
        at = np.repeat(self.begins[place] - steps[:-1], many)
        at += np.arange(len(at))
        return self.flat[at], per_text


# Fixed: the letters that stand for bytes in byte-level vocabularies, printable bytes for themselves.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {b: 0x100 + n for n, b in enumerate(sorted(set(range(256)) - set(PRINTABLE)))}

# Kinds of bytes: 1 for ASCII letters, 2 for ASCII marks but the apostrophe, 4 for others, so that only 1 + 2 gives 3.
KINDS = np.full(256, 4, np.uint8)
KINDS[[*range(65, 91), *range(97, 123)]] = 1
KINDS[[b for b in range(33, 127) if not chr(b).isalnum() and b != 39]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


encoder = Once(Encoder)


def pieces_of(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Documents as pieces of at most `capacity` tokens, written to the shared folder.

    Columns `doc_id`, `piece`, `start`, `length`, `ids`, `ids_crc32`, and `part`, `nth`: the task that wrote the piece
    and the piece's number among those of its length in that task. Only longer documents are cut. A null or empty text
    is the end token alone.
    """
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            ids, sizes = encoder(path).encode(batch.column(1))
            ends = np.cumsum(sizes)
            ids = np.insert(ids, ends, END).astype("<u4")
            sizes = sizes + 1
            ends = np.cumsum(sizes)
            n = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(capacity, sizes[doc] - start)
            begin = (ends - sizes)[doc] + start
            order = np.argsort(length, kind="stable")
            ranks = np.empty(len(doc), np.int64)
            first = np.searchsorted(length[order], length[order], side="left")
            ranks[order] = np.arange(len(doc)) - first
            nth = seen[length] + ranks
            seen += np.bincount(length, minlength=capacity + 1)
            sums = [zlib.crc32(ids[a : a + b].tobytes()) for a, b in zip(begin.tolist(), length.tolist())]
            bounds = np.concatenate((begin, [len(ids)])).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32)))
            columns = [
                batch.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                lists, pa.array(sums, pa.int64()), pa.array(np.full(len(doc), part, np.int32)), pa.array(nth),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "part", "nth"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids array<int>, ids_crc32 long, part int, nth long"
    return stored(rows.mapInArrow(cut, schema), "pieces")


class Plan:
    """Where pieces go: rows (length, first, count, sequence, each, offset).

    Pieces `first` to `first + count` of a length are dealt to sequences from `sequence` on, `each` to one, the first of
    them at `offset` there.
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: int = LARGE):
        self.capacity = capacity
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0
        self.used = {length: 0 for length in counts}
        self.open: dict[int, list[tuple[int, int]]] = {}  # free tokens: runs (first sequence, how many)
        big = sorted((x for x in counts if x * large > capacity), reverse=True)
        self._arrange({x: counts[x] for x in big}, groups)
        self._fill({x: counts[x] for x in counts if x * large <= capacity})

    def _place(self, length: int, count: int, sequence: int, each: int, offset: int) -> None:
        self.rows.append((length, self.used[length], count, sequence, each, offset))
        self.used[length] += count

    def _arrange(self, counts: dict[int, int], groups: int) -> None:
        """Configurations of the rounded large lengths, with the actual lengths in their places."""
        total = sum(counts.values())
        size_of_group = -(-total // groups) or 1
        queues: list[list[list[int]]] = []  # per group: [length, pieces left], longest first
        room = 0
        for length, n in counts.items():
            while n:
                if not room:
                    queues.append([])
                    room = size_of_group
                some = min(n, room)
                queues[-1].append([length, some])
                n -= some
                room -= some
        sizes = [q[0][0] for q in queues]
        demand = [sum(n for _, n in q) for q in queues]
        while any(demand):
            pattern = self._fullest(sizes, demand)
            times = min(demand[g] // k for g, k in pattern.items())
            for g, k in pattern.items():
                demand[g] -= k * times
            while times:
                # so many sequences hold the same actual lengths
                heads = [(g, queues[g][0]) for g in pattern]
                same = min(min(times, head[1] // pattern[g]) for g, head in heads)
                filled = 0
                if same:
                    for g, head in heads:
                        self._place(head[0], same * pattern[g], self.sequences, pattern[g], filled)
                        filled += head[0] * pattern[g]
                        head[1] -= same * pattern[g]
                else:  # one sequence across the border of two lengths
                    same = 1
                    for g, _ in heads:
                        left = pattern[g]
                        while left:
                            head = queues[g][0]
                            some = min(left, head[1])
                            self._place(head[0], some, self.sequences, some, filled)
                            filled += head[0] * some
                            head[1] -= some
                            left -= some
                            if not head[1]:
                                queues[g].pop(0)
                for g in pattern:
                    if queues[g] and not queues[g][0][1]:
                        queues[g].pop(0)
                self._free(self.capacity - filled, self.sequences, same)
                self.sequences += same
                times -= same

    def _fullest(self, sizes: list[int], demand: list[int]) -> dict[int, int]:
        """The largest size in demand, with the multiset of others that fills the rest best; larger sizes preferred."""
        lead = next(g for g, n in enumerate(demand) if n)
        room = self.capacity - sizes[lead]
        reach = np.full(room + 1, -1, np.int32)  # the group last used to fill so many tokens
        reach[0] = len(sizes)
        for g in range(lead, len(sizes)):
            most = min(demand[g] - (g == lead), room // sizes[g])
            fresh = np.zeros(room + 1, np.int64)
            for total in range(sizes[g], room + 1) if most > 0 else ():
                if reach[total] < 0 and reach[total - sizes[g]] >= 0:
                    k = fresh[total - sizes[g]] + 1 if reach[total - sizes[g]] == g else 1
                    if k <= most:
                        reach[total], fresh[total] = g, k
        total = int(np.flatnonzero(reach >= 0)[-1])
        pattern = {lead: 1}
        while total:
            g = int(reach[total])
            pattern[g] = pattern.get(g, 0) + 1
            total -= sizes[g]
        return pattern

    def _free(self, free: int, sequence: int, n: int) -> None:
        if free > 0 and n:
            self.open.setdefault(free, []).append((sequence, n))

    def _fill(self, counts: dict[int, int]) -> None:
        """Best fit: the longest small length first, each piece to the fullest sequence that takes it."""
        for length in sorted(counts, reverse=True):
            left = counts[length]
            frees = [f for f in self.open if f >= length]
            heapify(frees)
            while left:
                while frees and not self.open.get(frees[0]):
                    heappop(frees)
                if not frees:
                    each = self.capacity // length
                    n = -(-left // each)
                    self._free(self.capacity, self.sequences, n)
                    self.sequences += n
                    heappush(frees, self.capacity)
                free = frees[0]
                sequence, n = self.open[free].pop()
                each = free // length
                whole = min(n, left // each)
                if whole:
                    self._place(length, whole * each, sequence, each, self.capacity - free)
                    left -= whole * each
                    self._free(free - each * length, sequence, whole)
                    sequence, n = sequence + whole, n - whole
                if left and n:  # fewer than fill one sequence are left
                    self._place(length, left, sequence, left, self.capacity - free)
                    self._free(free - left * length, sequence, 1)
                    sequence, n, left = sequence + 1, n - 1, 0
                self._free(free, sequence, n)


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """The pieces with `sequence_id` and `offset`, their place there; sequences have no gaps and hold up to `capacity`."""
    spark = pieces.sparkSession
    slim = pieces.drop("ids")
    per_task = slim.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    counts = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity at most
    plan = Plan(counts, capacity, groups)
    rows = np.array(sorted(plan.rows), np.int64).reshape(-1, 6)
    sent = spark.sparkContext.broadcast(rows)  # one row for a run of like sequences
    numbered = slim.join(offsets, ["part", "length"]).withColumn("rank", F.col("nth") + F.col("earlier"))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sent.value
        base = int(rows[:, 1].max(initial=0) + rows[:, 2].max(initial=0) + 1)
        wide = rows[:, 0].astype(object) * base + rows[:, 1] if capacity * base >= 2**62 else rows[:, 0] * base + rows[:, 1]
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            at = np.searchsorted(wide, (length.astype(wide.dtype) * base + rank), side="right") - 1
            row = rows[at]
            nth = rank - row[:, 1]
            batch["sequence_id"] = row[:, 3] + nth // row[:, 4]
            batch["offset"] = row[:, 5] + nth % row[:, 4] * length
            yield batch.drop(columns=["rank", "part", "nth"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "rank", "part", "nth"]
    return numbered.select(columns).mapInPandas(deal, schema)


def packed_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places in the sequences: `doc_id`, `piece`, `start`, `length`, `ids_crc32`,
    `sequence_id`, `offset`.

    A document is its token ids and the end token; a null or empty text is the end token alone. Rows that repeat are
    documents of their own. An empty table gives no pieces.
    """
    return pack(pieces_of(docs, path or tokenizer_path(), text, key, capacity), capacity)
