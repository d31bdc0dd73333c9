"""Quality and toxicity of documents by hierarchical empirical Bayes.

A document's own evidence is a log-odds from a classifier of its style and of telling words; it is fitted on a bounded
sample of labelled rows. Sites are judged over all documents: every host and every path of a host has a rate, the mean of
what its documents say, shrunk towards the level above (path to host, host to all) by a Beta prior whose strength follows
from how much the groups differ. A document's posterior combines its evidence with its path's rate in place of the
overall one; a path with few documents thus has hardly a say of its own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.llm.common import carried, full_text, restored, small_batches, stored

SAMPLE = 20_000  # labelled rows that the classifier is fitted on
LEXICON = 5_000  # telling words at most
PARTS = (4, 5, 6)  # lengths of word beginnings that count beside whole words
MARKS = "-.,;:!?*%$#&|\"'()[]{}<>"
SEEN = 8  # labelled texts that a telling word must be in
STRAY = 0.02  # at most, of texts without the label to texts with it
STYLES = 9


def telling_parts(text: str) -> set[str]:
    """Words of a text in lower case without marks around them, and their beginnings (a hyphen after those)."""
    words = {w.strip(MARKS) for w in set(text.lower().split())}
    parts = {f"{w[:n]}-" for n in PARTS for w in words if len(w) > n}
    return (words | parts) - {""}


def style(text: str, words: list[str]) -> list[float]:
    """Numbers that tell prose from junk: size, marks, capitals, digits, repetition, word length."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not words:
        return [0.0] * STYLES
    seen = np.bincount(raw, minlength=256)
    upper, lower, digits = seen[65:91].sum(), seen[97:123].sum(), seen[48:58].sum()
    blanks = seen[9:14].sum() + seen[32]
    marks = seen[33:128].sum() - upper - lower - digits
    n = len(words)
    counts = Counter(words)
    return [
        float(np.log1p(n)), marks / len(raw), upper / max(1, upper + lower), digits / len(raw),
        sum(map(eq, words, words[1:])) / n, 1 - len(counts) / n**0.95, max(counts.values()) / n**0.5,
        (len(raw) - blanks) / n / 10, float(any(len(w) > 100 for w in words)),
    ]


@dataclass
class Evidence:
    """A fitted document classifier. Without labelled rows it has no opinion."""

    lexicon: dict[str, float] = field(default_factory=dict)
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    rates: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.whole = {p for p in self.lexicon if not p.endswith("-")}
        self.begins = {n: {p[:-1] for p in self.lexicon if len(p) == n + 1 and p.endswith("-")} for n in PARTS}

    def found(self, text: str) -> list[str]:
        """The telling parts of a text that the lexicon has; no part is put together that it has not."""
        words = {w.strip(MARKS) for w in set(text.lower().split())}
        out = list(self.whole & words)
        for n, known in self.begins.items():
            if known:
                out += [f"{p}-" for p in {w[:n] for w in words if len(w) > n} & known]
        return out

    def features(self, text: str) -> list[float]:
        words = text.split()
        found = [self.lexicon[p] for p in sorted(self.found(text))] if self.lexicon else []
        n = max(1, len(words))
        return [*style(text, words), float(np.log1p(sum(found))), min(1.0, len(found) / n * 10), float(bool(found))]

    def log_odds(self, texts) -> dict[str, np.ndarray]:
        """Evidence per text, freed of the sample's rate: positive speaks for the label."""
        rows = np.array([self.features(x) for x in texts], np.float64).reshape(len(texts), STYLES + 3)
        out = {}
        for name in ("quality", "toxic"):
            if name in self.weights:
                logit = ((rows - self.mean) / self.scale) @ self.weights[name][1:] + self.weights[name][0]
                out[name] = np.clip(logit, -30, 30) - np.log(self.rates[name] / (1 - self.rates[name]))
            else:
                out[name] = np.zeros(len(rows))
        return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Penalised logistic regression by Newton steps; the first weight is the constant, which has no penalty."""
    x = np.column_stack([np.ones(len(x)), x])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - penalty * w
        bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text: str = "text", key: str = "doc_id") -> Evidence:
    """Fit the evidence on up to `sample` labelled documents, chosen by a hash of their keys.

    Of several labels of a document the smallest count; rows without a key or a label teach nothing.
    """
    spark = docs.sparkSession
    small_batches(spark)
    marks = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id")
    marks = marks.agg(F.min("quality").cast("double").alias("quality"), F.min("toxic").cast("double").alias("toxic"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col(key).alias("doc_id"), full_text(text).alias("text"))
    known = stored(rows.join(F.broadcast(marks), "doc_id").select("text", "quality", "toxic"), "labelled")  # `sample` rows

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with_, without = Counter(), Counter()  # bounded by the sample
        for batch in batches:
            for one, toxic in zip(batch["text"], batch["toxic"]):
                (with_ if toxic > 0.5 else without).update(telling_parts(one))
        for part in (with_, without):
            kind = float(part is with_)
            for at in range(0, len(part), 20_000):
                some = list(part.items())[at : at + 20_000]
                yield pd.DataFrame({"part": [p for p, _ in some], "toxic": kind, "n": [n for _, n in some]})

    totals = known.agg(F.count(F.lit(1)), F.sum("toxic"), F.sum("quality")).first()
    if not totals[0]:
        return Evidence()
    bad, good = float(totals[1]), float(totals[0] - totals[1])
    # near copies share their rarest, longest words; one of them is enough, or their words would all be telling
    words = F.array_distinct(F.split(F.lower("text"), r"\s+"))
    longest = F.slice(F.sort_array(F.transform(words, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))), asc=False), 1, 3)
    apart = known.withColumn("_longest", longest).dropDuplicates(["_longest", "toxic"])
    counts = apart.mapInPandas(count, "part string, toxic double, n long").groupBy("part").agg(
        F.sum(F.col("toxic") * F.col("n")).alias("a"), F.sum((1 - F.col("toxic")) * F.col("n")).alias("b")
    )
    odds = F.log((F.col("a") + 0.5) / (bad + 1) / ((F.col("b") + 0.5) / (good + 1)))
    strong = counts.withColumn("w", odds).withColumn("z", odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5)))
    strong = strong.where((F.col("a") >= SEEN) & (F.col("b") <= STRAY * F.col("a")))
    lexicon = {r.part: float(r.w) for r in strong.orderBy(F.desc("z"), "part").limit(LEXICON).collect()}
    model = Evidence(lexicon)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [model.features(x) for x in batch["text"]], "quality": batch["quality"], "toxic": batch["toxic"]})

    data = known.mapInPandas(describe, "x array<double>, quality double, toxic double").collect()  # `sample` rows
    x = np.array([r.x for r in data])
    fitted = Evidence(lexicon, x.mean(axis=0), x.std(axis=0) + 1e-9)
    for name in ("quality", "toxic"):
        y = np.array([r[name] for r in data])
        if 0 < y.mean() < 1:
            fitted.weights[name] = logistic((x - fitted.mean) / fitted.scale, y)
            fitted.rates[name] = float(y.mean())
    return fitted


def with_evidence(docs: DataFrame, model: Evidence, text: str = "text") -> DataFrame:
    """The rows with `_quality` and `_toxic`: log-odds that the text alone speaks for."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("_quality double, _toxic double")
    def weigh(texts: pd.Series) -> pd.DataFrame:
        found = model.log_odds(texts)
        return pd.DataFrame({"_quality": found["quality"], "_toxic": found["toxic"]})

    # a later filter on the evidence must not compute it a second time
    weighed = weigh.asNondeterministic()(full_text(text))
    return docs.withColumn("_evidence", weighed).select("*", "_evidence.*").drop("_evidence")


def host_of(source: Column) -> Column:
    return F.coalesce(F.substring_index(F.regexp_replace(source, r"^[a-z]+://", ""), "/", 1), F.lit(""))


def path_of(source: Column, section: Column) -> Column:
    """The first step of the path where a source has one, and the section of the site."""
    step = F.regexp_extract(F.coalesce(source, F.lit("")), r"^(?:[a-z]+://)?[^/]+/([^/?#]*)", 1)
    return F.concat_ws("/", step, F.coalesce(section, F.lit("")))


def site_rates(evidence: DataFrame, rates: dict[str, float]) -> DataFrame:
    """Shrunken rates per `_host` and `_path` over all documents: columns `_quality_rate`, `_toxic_rate`.

    evidence has `_host`, `_path`, `_quality` and `_toxic`. Groups are aggregated in tasks first, so a host may hold any
    part of the rows. Only the two levels' spreads reach the driver.
    """
    names = ("quality", "toxic")
    prior = {n: float(np.log(rates[n] / (1 - rates[n]))) if n in rates else 0.0 for n in names}
    chance = lambda n: 1 / (1 + F.exp(-(F.col(f"_{n}") + F.lit(prior[n]))))
    paths = evidence.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("n"), *[F.sum(chance(n)).alias(n) for n in names])
    paths = stored(paths, "paths")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("host_n"), *[F.sum(n).alias(f"host_{n}") for n in names])
    total = hosts.agg(F.sum("host_n").alias("n"), *[F.sum(f"host_{n}").alias(n) for n in names]).first()
    mean = {n: (total[n] or 0) / (total.n or 1) for n in names}
    spread = hosts.agg(*[_between(F.col(f"host_{n}"), F.col("host_n"), F.lit(mean[n])).alias(n) for n in names]).first()
    strength = {n: _strength(mean[n], spread[n]) for n in names}
    for n in names:
        shrunk = (F.col(f"host_{n}") + strength[n] * mean[n]) / (F.col("host_n") + strength[n])
        hosts = hosts.withColumn(f"host_{n}", shrunk)
    joined = paths.join(hosts.drop("host_n"), "_host")
    within = joined.agg(*[_between(F.col(n), F.col("n"), F.col(f"host_{n}")).alias(n) for n in names]).first()
    for n in names:
        k = _strength(mean[n], within[n])
        joined = joined.withColumn(f"_{n}_rate", (F.col(n) + k * F.col(f"host_{n}")) / (F.col("n") + k))
    return joined.select("_host", "_path", *[f"_{n}_rate" for n in names])


def _between(hits: Column, n: Column, level: Column) -> Column:
    """Variance of the groups' true rates around the level above: what chance alone does not explain, weighted by size."""
    away = (hits / n - level) * (hits / n - level)
    return F.sum(n * (away - level * (1 - level) / n)) / F.sum(n)


def _strength(mean: float, variance: float | None) -> float:
    """How many documents the prior counts as, from the moments of a Beta distribution."""
    noise = mean * (1 - mean)
    if not noise or variance is None:
        return 1.0
    return float(min(1e6, max(1.0, noise / max(variance, 1e-12) - 1)))


def judged(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text: str = "text", key: str = "doc_id", source: str = "source", section: str = "lang",
    keep_columns: list[str] | None = None,
) -> DataFrame:
    """The rows with `quality_prob`, `toxic_prob`, `quality_rate`, `toxic_rate` (of the path) and `keep`.

    keep: the quality's posterior is at least one half and the toxicity's below it. Null and empty texts have the
    evidence of an empty page; a null source or section is a site of its own. Without labelled rows the classifier has
    no opinion and all rows are kept.

    Rows are written with their evidence, so that rates and results read numbers and no text is weighed twice; of the
    rows' columns only those in `keep_columns` (all, if none are named) are carried along and returned.
    """
    model = fit(docs, labels, sample, text, key)
    names = docs.columns if keep_columns is None else keep_columns
    site = F.col(source).cast("string")
    rows = docs.select(carried(docs.select(*[f"`{c}`" for c in names])), full_text(text).alias("_text"), host_of(site).alias("_host"), path_of(site, F.col(section).cast("string")).alias("_path"))
    rows = stored(with_evidence(rows, model, "_text").drop("_text"), "evidence")
    rates = site_rates(rows.select("_host", "_path", "_quality", "_toxic"), model.rates)
    out = rows.join(rates, ["_host", "_path"], "left")
    odds = lambda p: F.log(F.greatest(p, F.lit(1e-6)) / F.greatest(1 - p, F.lit(1e-6)))
    post = {n: 1 / (1 + F.exp(-(F.col(f"_{n}") + odds(F.col(f"_{n}_rate"))))) for n in ("quality", "toxic")}
    keep = F.lit(True)
    if "quality" in model.weights:
        keep &= post["quality"] >= 0.5
    if "toxic" in model.weights:
        keep &= post["toxic"] < 0.5
    return restored(
        out, names, post["quality"].alias("quality_prob"), post["toxic"].alias("toxic_prob"),
        F.col("_quality_rate").alias("quality_rate"), F.col("_toxic_rate").alias("toxic_rate"), keep.alias("keep"),
    )
