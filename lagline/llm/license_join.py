"""License scans: an exact set-similarity join between text blocks and license notices.

A block is a run of consecutive words, twice as long as the longest notice; a new one begins after every length of that
notice, so that every notice stands whole in some block, however its lines are wrapped.

A block matches a notice if it holds at least a given share of the notice's distinct words. Words are put in one global
order, the least frequent of the corpus first. If a block shares `need` words with a notice, the first
size - need + 1 words of either side must have one in common, so only these prefixes are joined; the length filter asks
that a block has `need` words at all, the positional filter that enough words are left after the shared one. What passes
is verified exactly. Words that no notice holds can't be shared and are dropped from the blocks.

Only DataFrame functions are used. Notices are a small parameter; everything else grows with the texts.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.llm.common import full_text, stored, text_key

CONTAINMENT = 0.8

# Fixed values of the result's contract: what separates words, the phrases and their labels.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Usual short notices, by label.
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "Licensed under the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


def notice_words(text: str) -> list[str]:
    return sorted(set(re.findall(WORD, text.lower())))


def longest(notices=NOTICES) -> int:
    """Words of the longest notice, at which distance blocks begin."""
    return max((len(re.findall(WORD, text.lower())) for _, text in notices), default=1)


def lowered(text: Column) -> Column:
    """Lower case that gives ASCII letters for A-Z only: the Kelvin sign, whose lower case is k, is set apart first."""
    return F.lower(F.replace(text, F.lit("K"), F.lit("ĸ")))


def base_phrases(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`: places where the phrases' words stand."""
    # a text without these letters has none of the phrases; others are brought into one form, words between blanks
    low = lowered(full_text(text))
    likely = low.contains("cc") | low.contains("general") | low.contains("reserved")
    form = F.when(likely, F.concat(F.lit(" "), F.trim(F.regexp_replace(low, SEPARATOR, " ")), F.lit(" "))).otherwise("")
    out = docs.withColumn("_form", form)
    counts, firsts, lasts, labels = [], [], [], []
    blanks = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))
    for phrase, label in PHRASES.items():
        there = F.col("_form").contains(f" {phrase} ")
        counts.append(F.when(there, F.regexp_count("_form", F.lit(f" {phrase}(?= )"))).otherwise(0))
        first = F.locate(f" {phrase} ", F.col("_form"))
        back = F.locate(f" {phrase[::-1]} ", F.reverse("_form"))
        last = F.length("_form") - back + 1 - len(phrase) - 2
        firsts.append(F.when(there, blanks(F.substring("_form", F.lit(1), first - 1))))
        lasts.append(F.when(there, blanks(F.substring("_form", F.lit(1), last))))
        labels.append(F.when(there, F.lit(label)))
    return out.withColumns({
        "n_words": F.regexp_count(low, F.lit(WORD)).cast("long"),
        "n_base": sum(counts[1:], counts[0]).cast("long"), "first_word": F.least(*firsts).cast("long"),
        "last_word": F.greatest(*lasts).cast("long"), "base_labels": F.array_sort(F.array_compact(F.array(*labels))),
    }).drop("_form")


def notice_matches(texts: DataFrame, notices=NOTICES, share: float = CONTAINMENT) -> DataFrame:
    """Pairs of text and notice: `key`, `label`, `share`, for every block of a text that holds enough of a notice.

    texts has `key` and `text`.
    """
    spark = texts.sparkSession
    sets = [(n, label, notice_words(text)) for n, (label, text) in enumerate(notices)]
    needs = {n: math.ceil(share * len(words) - 1e-9) for n, _, words in sets}
    vocabulary = sorted({w for _, _, words in sets for w in words})
    known = F.array(*[F.lit(w) for w in vocabulary])
    step = longest(notices)
    words = texts.select("key", F.array_remove(F.split(lowered(F.col("text")), SEPARATOR), "").alias("words")).where(F.size("words") > 0)
    runs = F.transform(F.sequence(F.lit(1), F.size("words"), F.lit(step)), lambda i: F.array_intersect(F.slice("words", i, step), known))
    runs = words.select("key", runs.alias("runs"))
    pairs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("runs") - 1, F.lit(1))),
        lambda i: F.array_union(F.get("runs", i - 1), F.coalesce(F.get("runs", i), F.array().cast("array<string>"))),
    )
    blocks = runs.select("key", F.explode(pairs).alias("words")).where(F.size("words") > 0)
    blocks = stored(blocks, "blocks")

    often = {w: 0 for w in vocabulary}
    often |= {r.word: r.n for r in blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (often[w], w))
    place = {w: i for i, w in enumerate(order)}
    prefixes = []
    for n, label, words in sets:
        words = sorted(words, key=place.get)
        prefixes += [(w, j, n, label, words, needs[n]) for j, w in enumerate(words[: len(words) - needs[n] + 1])]
    heads = spark.createDataFrame(prefixes, "word string, j int, notice int, label string, own array<string>, need int")

    least = min(needs.values())
    ordered = F.array_intersect(F.array(*[F.lit(w) for w in order]), F.col("words"))  # in the order of the first array
    long_enough = blocks.where(F.size("words") >= least).select("key", ordered.alias("words"))
    first = long_enough.select("key", "words", F.posexplode(F.slice("words", F.lit(1), F.size("words") - least + 1)).alias("i", "word"))
    left = F.least(F.size("words") - F.col("i"), F.size("own") - F.col("j"))
    met = first.join(F.broadcast(heads), "word").where((F.size("words") >= F.col("need")) & (left >= F.col("need")))
    shared = F.size(F.array_intersect("words", "own"))
    return met.where(shared >= F.col("need")).select("key", "label", (shared / F.size("own")).alias("share"))


def license_report(docs: DataFrame, text: str = "text", key: str = "doc_id", notices=NOTICES, share: float = CONTAINMENT) -> DataFrame:
    """One row per document: `doc_id`, `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`, `labels`, `score`.

    score is the largest share of a notice that a block holds among those that match, 1 where a base phrase stands, else
    0. Null and empty texts have no labels; rows that repeat are reported once each.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    own = base_phrases(rows).select("doc_id", text_key().alias("key"), "n_words", "n_base", "first_word", "last_word", "base_labels")
    found = notice_matches(rows.select(text_key().alias("key"), full_text().alias("text")), notices, share)
    found = found.groupBy("key").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    out = own.join(found, "key", "left")
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.coalesce("more", F.array().cast("array<string>")))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0)))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), score.alias("score"),
    )
