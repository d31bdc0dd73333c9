"""Spelling variant grouping: words that differ by one letter, by search schemes on FM-indexes of the vocabulary.

One error lies in one half of a word, so the other half is matched exactly. A word is read from its exact half towards the
other: right to left over the words as they are, left to right over the words reversed. The index is that of the
vocabulary between delimiters: ranks of suffixes, and for every row the letter before its suffix. Reading a letter turns
an interval of rows into another; where the interval still holds other words, one letter may be replaced, left out or
added. What is left when a word is read to its delimiters is a word of the vocabulary.

The vocabulary is dealt to shards by the halves that searches begin with: a word lies under the beginnings and ends that
neighbours of its length or one more or less would match exactly. A half that very many words share is split: words are
dealt to parts, searches to as many blocks, and each block meets each part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.llm.common import full_text, stored

# Fixed values of the result's contract.
LEAST = 7  # code points of a word
TWICE = 2  # occurrences of a word
EVERY = 31  # of so many occurrences one loses a letter
TIMES = 10  # a form is so many times as frequent
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SHARD = 100_000  # entries of a shard
CHUNK = 20_000  # words that are searched together
FEW = 32  # rows whose letters are read one by one


def vocabulary(docs: DataFrame, text: str = "text", key: str = "doc_id", every: int = EVERY, least: int = LEAST, twice: int = TWICE) -> DataFrame:
    """Words and how often they occur: `word`, `n`. A null text has no words, a null key is the empty text."""
    # a run that is too short stays so; the longer ones are taken whole, as runs are read greedily from their first letter
    runs = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
        F.explode(F.regexp_extract_all(full_text(text), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))).alias("run"),
    )
    runs = runs.select("key", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = runs.withColumn("h", F.crc32(F.concat("key", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= twice)


def entries(words: DataFrame) -> DataFrame:
    """A word under the halves by which it may be found: `side` (0: by its beginning, 1: by its end), `half`, `word`, `n`,
    `own` (the half that its own search begins with)."""
    size = F.length("word")
    short = F.floor((size - 1) / 2).cast("int")  # halves of words that are one letter shorter, as long, one longer
    # a beginning is the smaller half, an end the larger one
    begins = F.array_distinct(F.array(short, F.floor(size / 2).cast("int"), F.floor((size + 1) / 2).cast("int")))
    ends = F.array_distinct(F.array(F.floor(size / 2).cast("int"), F.floor((size + 1) / 2).cast("int"), F.floor((size + 2) / 2).cast("int")))
    both = F.concat(
        F.transform(begins, lambda k: F.struct(F.lit(0).alias("side"), F.left("word", k).alias("half"), (k == F.floor(size / 2)).alias("own"))),
        F.transform(ends, lambda k: F.struct(F.lit(1).alias("side"), F.right("word", k).alias("half"), (k == F.floor((size + 1) / 2)).alias("own"))),
    )
    return words.select("word", "n", F.explode(both).alias("e")).select("e.side", "e.half", "word", "n", "e.own")


def dealt(rows: DataFrame, size: int) -> DataFrame:
    """The entries with `shard`, `part`, `block`, `listed` and `asks`: where each is indexed, and where searched for.

    Crowded halves have shards of their own, with as many parts and blocks as bring each under `size` entries.
    """
    counts = stored(rows.groupBy("side", "half").agg(F.count(F.lit(1)).alias("many")), "halves")
    total = counts.agg(F.sum("many")).first()[0] or 0
    shards = max(1, -(-total // size))
    crowded = counts.where(F.col("many") > size).select("side", "half", F.ceil(F.col("many") / size).cast("int").alias("k"))
    rows = rows.join(crowded, ["side", "half"], "left")
    plain = rows.where("k is null").select(
        "side", F.pmod(F.xxhash64("side", "half"), F.lit(shards)).cast("string").alias("shard"), F.lit(0).alias("part"), F.lit(0).alias("block"),
        "word", "n", F.lit(True).alias("listed"), F.col("own").alias("asks"),
    )
    wide = rows.where("k is not null")
    mine = lambda salt: F.pmod(F.xxhash64(F.lit(salt), "word"), F.col("k")).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    name = F.concat(F.lit("half "), "half").alias("shard")
    lists = wide.select("side", name, mine(1).alias("part"), each.alias("block"), "word", "n", F.lit(True).alias("listed"), F.lit(False).alias("asks"))
    searches = wide.where("own").select("side", name, each.alias("part"), mine(2).alias("block"), "word", "n", F.lit(False).alias("listed"), F.lit(True).alias("asks"))
    return plain.union(lists).union(searches)


class Index:
    """The FM-index of words (arrays of letters, 1 and up; the delimiter is 0).

    Words are in the order of their letters and delimiters are told apart by it, so no suffix is compared beyond its
    delimiter. Words are a flat array and the n + 1 places where they begin and end.
    """

    def __init__(self, letters: np.ndarray, ends: np.ndarray):
        n = len(ends) - 1
        sizes = np.diff(ends)
        self.starts = ends[:-1] + np.arange(n)  # a delimiter follows each word
        text = np.zeros(len(letters) + n, np.int64)
        text[np.arange(len(letters)) + np.repeat(np.arange(n), sizes)] = letters
        stops = self.starts + sizes
        rank = text + n
        rank[stops] = np.arange(n)
        rows = np.argsort(rank, kind="stable")
        reach = 1
        while True:  # suffixes by twice as many letters each time
            ordered = rank[rows]
            rank[rows] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
            if rank[rows[-1]] == len(text) - 1:
                break
            after = np.full(len(text), -1, np.int64)
            after[:-reach] = rank[reach:]
            key = rank * (len(text) + 1) + after + 1
            rows = np.argsort(key, kind="stable")
            rank = key
            reach *= 2
        self.rows, self.text = rows, text
        self.before = text[rows - 1]  # before the first word is a delimiter, too: the last one
        self.width = len(text) + 1
        self.keys = np.sort(self.before * self.width + np.arange(len(text)))
        self.words = n
        self.firsts = np.flatnonzero(self.before == 0)  # rows whose suffix is a whole word

    def read(self, letter: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The rows that begin with a letter and go on like rows before the given one."""
        return np.searchsorted(self.keys, letter * self.width + row)

    def branches(self, low: np.ndarray, high: np.ndarray, letters: int) -> tuple[np.ndarray, np.ndarray]:
        """The letters that stand before the rows of each interval: (interval's number, letter)."""
        few = np.flatnonzero(high - low <= FEW)
        size = (high - low)[few]
        which = np.repeat(few, size)
        row = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + low[which]
        pairs = np.unique(which * (letters + 1) + self.before[row])
        pairs = pairs[pairs % (letters + 1) > 0]
        many = np.flatnonzero(high - low > FEW)
        pairs = np.concatenate((pairs, (many[:, None] * (letters + 1) + np.arange(1, letters + 1)).ravel()))
        return pairs // (letters + 1), pairs % (letters + 1)


def one_error(index: Index, letters: np.ndarray, ends: np.ndarray, exact: np.ndarray, listed: np.ndarray, alphabet: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (search's number, word's number) that differ by one letter which is not among the last `exact` ones of the search.

    listed: whether the searched word is itself in the index. Pairs may repeat.
    """
    sizes = np.diff(ends)
    who = np.arange(len(sizes))
    left, low, high = sizes.copy(), np.zeros(len(sizes), np.int64), np.full(len(sizes), index.words)
    late: list[tuple[np.ndarray, ...]] = []  # states with their error behind them
    while len(who):
        own = np.where(left > 0, letters[ends[who] + np.maximum(left, 1) - 1] if len(letters) else 0, 0)
        free = sizes[who] - left >= exact[who]
        if free.any():
            w, r, a, b, c = who[free], left[free], low[free], high[free], own[free]
            skip = r > 0
            late.append((w[skip], r[skip] - 1, a[skip], b[skip]))
            at, letter = index.branches(a, b, alphabet)
            other = letter != c[at]
            at, letter = at[other], letter[other]
            na, nb = index.read(letter, a[at]), index.read(letter, b[at])
            some = nb > na
            at, na, nb = at[some], na[some], nb[some]
            late.append((w[at], r[at], na, nb))  # added
            swap = r[at] > 0
            late.append((w[at][swap], r[at][swap] - 1, na[swap], nb[swap]))  # replaced
        go = left > 0
        who, left, low, high, own = who[go], left[go], low[go], high[go], own[go]
        low, high, left = index.read(own, low), index.read(own, high), left - 1
        more = high - low > listed[who]  # the searched word alone leads nowhere else
        who, left, low, high = who[more], left[more], low[more], high[more]
    if not late:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    who, left, low, high = (np.concatenate(x) for x in zip(*late))
    found_by, found = [], []
    while len(who):
        done = left == 0
        a, b = np.searchsorted(index.firsts, low[done]), np.searchsorted(index.firsts, high[done])
        hit = b > a  # words are distinct, so there is one at most
        found_by.append(who[done][hit])
        found.append(np.searchsorted(index.starts, index.rows[index.firsts[a[hit]]]))
        who, left, low, high = who[~done], left[~done], low[~done], high[~done]
        own = letters[ends[who] + left - 1] if len(who) else np.zeros(0, np.int64)
        low, high, left = index.read(own, low), index.read(own, high), left - 1
        more = high > low
        who, left, low, high = who[more], left[more], low[more], high[more]
    return np.concatenate(found_by), np.concatenate(found)


def _flat(words: list[str], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of all words, numbered from 1 in the order of an alphabet, the places between words, and the alphabet."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    alphabet = np.unique(points) if known is None else known
    ends = np.concatenate(([0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))))
    return np.searchsorted(alphabet, points).astype(np.int64) + 1, ends, alphabet


def neighbours(group: pd.DataFrame) -> pd.DataFrame:
    """Of a shard: per searched word how many of its words are near (`near`), and the most frequent of them (`best`, `best_n`).

    Pairs that both sides find are the beginning's.
    """
    side = int(group["side"].iloc[0])
    turn = (lambda w: w[::-1]) if side == 0 else (lambda w: w)
    indexed = group[group["listed"]].drop_duplicates("word")
    asking = group[group["asks"]].drop_duplicates("word")
    out: dict[str, list] = {"word": [], "near": [], "best": [], "best_n": []}
    if not len(indexed) or not len(asking):
        return _frame(out)
    pairs = sorted(zip(map(turn, indexed["word"]), indexed["n"]))
    names = [w for w, _ in pairs]
    counts = np.array([n for _, n in pairs], np.int64)
    searches = sorted(map(turn, asking["word"]), key=lambda w: w[::-1])  # words are read from their end: like intervals are met together
    _, _, alphabet = _flat(names + searches)
    flat, ends, _ = _flat(names, alphabet)
    index = Index(flat, ends)
    order = np.empty(len(names), np.int64)  # of the words as they are, for ties
    order[sorted(range(len(names)), key=lambda i: turn(names[i]))] = np.arange(len(names))
    known = set(names)
    for begin in range(0, len(searches), CHUNK):
        part = searches[begin : begin + CHUNK]
        letters, places, _ = _flat(part, alphabet)
        sizes = np.diff(places)
        exact = sizes // 2 if side == 0 else (sizes + 1) // 2
        listed = np.fromiter((w in known for w in part), np.int64, len(part))
        who, what = one_error(index, letters, places, exact, listed, len(alphabet))
        both = np.unique(who * len(names) + what)
        who, what = both // len(names), both % len(names)
        if side == 1:  # not those that share the beginning half
            half = sizes[who] // 2
            same = np.ones(len(who), bool)
            for j in range(int(half.max(initial=0))):
                inside = same & (j < half)
                same[inside] = flat[ends[what[inside]] + j] == letters[places[who[inside]] + j]
            who, what = who[~same], what[~same]
        best = np.lexsort((order[what], -counts[what], who))
        who, what = who[best], what[best]
        heads = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1]))) if len(who) else np.zeros(0, np.int64)
        out["word"] += [turn(part[i]) for i in who[heads].tolist()]
        out["near"] += np.diff(np.append(heads, len(who))).tolist()
        out["best"] += [turn(names[i]) for i in what[heads].tolist()]
        out["best_n"] += counts[what[heads]].tolist()
    return _frame(out)


def _frame(columns: dict[str, list]) -> pd.DataFrame:
    """Columns of plain values, empty ones included."""
    return pd.DataFrame({name: pd.Series(values, dtype="object" if name in ("word", "best") else "int64") for name, values in columns.items()})


def _roots(links: DataFrame) -> DataFrame:
    """From `word` and `form` the last form that is reached: `word`, `root`. Forms are ever more frequent, so chains are short."""
    links = stored(links, "links")
    roots = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("form").alias("next"))
        steps = stored(roots.select("root").distinct().join(onward, "root"), "steps")  # popular forms are looked up once
        if steps.isEmpty():
            return roots
        roots = stored(roots.join(steps, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def grouped(words: DataFrame, times: int = TIMES, shard: int = SHARD) -> DataFrame:
    """Per word of a vocabulary (`word`, `n`): `form`, `root`, `n_near`, `form_n`, as `variants` describes."""
    cells = dealt(entries(words), shard)
    found = cells.groupBy("side", "shard", "part", "block").applyInPandas(neighbours, "word string, near long, best string, best_n long")
    best = found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("form"))).alias("best"))
    rows = words.join(best, "word", "left")
    enough = -F.col("best.n") >= times * F.col("n")
    rows = rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.n")).alias("form_n"),
    )
    rows = stored(rows, "near")
    roots = _roots(rows.where("form is not null").select("word", "form"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, text: str = "text", key: str = "doc_id", shard: int = SHARD) -> DataFrame:
    """One row per word of the documents: `word`, `form`, `root`, `n`, `n_near`, `form_n`.

    Near words differ by one inserted, deleted or replaced code point. The form is the most frequent near word, of equal
    ones the first in code-point order, if it is ten times as frequent as the word, else null; the root is the last word
    that forms lead to. Empty tables and texts without words give no rows; repeated rows count as often as they stand there.
    """
    return grouped(stored(vocabulary(docs, text, key), "vocabulary"), shard=shard)
