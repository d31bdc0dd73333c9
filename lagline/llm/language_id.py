"""Language identification by rank-order profiles.

A profile is a list of the most frequent n-grams (one to three letters, words padded with blanks), the most frequent
first. A document's own profile is compared to each language's by the out-of-place distance: the sum of how far each of
its n-grams is from its rank there, with the profile's length for those that are missing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagline.llm.common import Once, full_text, small_batches

PROFILE = 300
SAMPLE = 3000  # documents of a language that its profile is learned from
UNKNOWN = "und"
BLANK = 0x20


@Once
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: its lower case (itself if that is no single letter), and whether it is a letter."""
    points = np.arange(0x110000, dtype=np.int64)
    lower = points.copy()
    letter = np.zeros(0x110000, bool)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            letter[i] = True
            low = c.lower()
            if len(low) == 1:
                lower[i] = ord(low)
    return lower, letter


def grams_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text, ascending, and how often each occurs. An n-gram is its letters' code points, 21 bits each."""
    lower, letter = _letters()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    known = letter[points]
    if not known.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    line = np.where(known, lower[points], BLANK)
    gap = line == BLANK
    line = np.concatenate(([BLANK], line[~(gap & np.concatenate(([True], gap[:-1])))], [BLANK]))
    if line[-2] == BLANK:
        line = line[:-1]
    a, b, c = line[:-2], line[1:-1], line[2:]
    inner = b != BLANK
    twos = (line[:-1] << 21) | line[1:]  # no two blanks stand together
    threes = ((a << 42) | (b << 21) | c)[inner]
    codes = np.sort(np.concatenate((b[inner], twos, threes)))
    heads = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[heads], np.diff(np.append(heads, len(codes)))


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams in order; ties by the smaller code."""
    if len(codes) > size:
        cut = np.partition(counts, len(counts) - size)[len(counts) - size]
        some = counts >= cut
        codes, counts = codes[some], counts[some]
    return codes[np.argsort(-counts, kind="stable")][:size]


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", size: int = PROFILE, sample: int = SAMPLE) -> dict[str, list[int]]:
    """A profile per language, from up to `sample` documents each, chosen by a hash of key and text.

    Rows without a language, and texts without letters, teach nothing. What returns is `size` numbers a language.
    """
    small_batches(docs.sparkSession)
    some = Window.partitionBy("lang").orderBy(F.xxhash64("key", "text"), "key", "text")
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"), F.col(key).cast("string").alias("key"))
    rows = rows.where("lang is not null and text is not null")
    limit = _sample_limits(rows, sample)
    if not limit:
        return {}
    chosen = rows.where(F.abs(F.xxhash64(F.lit(7), "key", "text") % 1_000_000) < _of(limit)) if limit else rows
    chosen = chosen.withColumn("nr", F.row_number().over(some)).where(F.col("nr") <= sample).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, texts in batch.groupby("lang")["text"]:
                found = [grams_of(x) for x in texts]
                codes, at = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
                sums = np.bincount(at, weights=np.concatenate([n for _, n in found]), minlength=len(codes))
                yield pd.DataFrame({"lang": name, "gram": codes, "n": sums.astype(np.int64)})

    counts = chosen.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= size)
    profiles: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "rank").collect():
        profiles.setdefault(row.lang, []).append(row.gram)
    return profiles


def _sample_limits(rows: DataFrame, sample: int) -> dict[str, int]:
    """Per language, the part of a million of its documents that is more than enough for the sample."""
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {name: min(1_000_000, -(-sample * 2_000_000 // n)) for name, n in counts.items()}


def _of(limits: dict[str, int]) -> Column:
    pairs = [F.lit(x) for item in limits.items() for x in item]
    return F.element_at(F.create_map(*pairs), F.col("lang"))


class Classifier:
    """Profiles arranged so that a document is compared to all of them at once."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.size = size
        self.names = sorted(profiles)
        self.codes = np.unique(np.concatenate([np.array(profiles[n], np.int64) for n in self.names]))
        self.ranks = np.full((len(self.codes) + 1, len(self.names)), -1, np.int64)
        for i, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.codes, profiles[name]), i] = np.arange(len(profiles[name]))

    def predict(self, text: str) -> tuple[str, float]:
        """The nearest language, ties by name, and how near it is: 1 for equal profiles, 0 for nothing in common."""
        own = ranked(*grams_of(text), self.size)
        if not len(own):
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, own)
        at[at == len(self.codes)] = 0
        rows = np.where((self.codes[at] == own)[:, None], self.ranks[at], -1)
        away = np.where(rows < 0, self.size, np.abs(rows - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(away.argmin())
        return self.names[best], float(1 - away[best] / (self.size * len(own)))


def identify(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text", size: int = PROFILE) -> DataFrame:
    """The rows with `lang_pred` and `score` (0 to 1). Null texts and texts without letters are `und` with score 0."""
    small_batches(docs.sparkSession)
    model = Classifier(profiles, size) if profiles else None

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = [model.predict(x) if model else (UNKNOWN, 0.0) for x in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    return docs.withColumn("_found", predict(full_text(text))).select("*", "_found.*").drop("_found")


def held_out(key: str = "doc_id") -> Column:
    """Fixed by the result's contract: the rows that teach nothing. A null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def language_report(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: `doc_id`, `held_out`, `lang_pred`, `score`. Without a row to learn from all are `und`."""
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out())
    profiles = learn(rows.where(~F.col("held_out")), sample=sample)
    return identify(rows.select("doc_id", "held_out", "text"), profiles).select("doc_id", "held_out", "lang_pred", "score")
