"""Cleaning a corpus for training, stage by stage; every stage works on what the one before it kept.

Stages take (spark, docs, sf_dir) and return the columns of documents; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline.llm.common import carried, restored, stored, table
from lagline.llm.packing import packed_documents
from lagline.llm.phrase_index import build_index, find_phrases
from lagline.llm.quality_bayes import judged
from lagline.llm.secret_scan import redacted, scan
from lagline.llm.simhash import representatives


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose posterior speaks for low quality or toxicity. Without labels nothing is rejected."""
    rows = docs.select(carried(docs), "doc_id", "text", "source", "lang")
    return restored(judged(rows, table(spark, sf_dir, "labels"), keep_columns=["_row"]).where("keep"), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (SimHash as in op4) stays, the one with the smallest doc_id."""
    return representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Rows of one text share the decision."""
    keyed = docs.select(carried(docs), F.col("text").alias("_text")).withColumn("_key", F.xxhash64(F.coalesce("_text", F.lit(""))))
    found = find_phrases(build_index(keyed, "_text", "_key"), table(spark, sf_dir, "benchmark"))
    bad = stored(found.where(F.size("hits") > 0).select(F.col("doc_id").alias("_key")).distinct(), "contaminated")
    return restored(keyed.join(bad, "_key", "left_anti"), docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind, and n_chars is the new text's. Every document stays; nulls stay null."""
    rows = scan(docs.select(carried(docs), F.col("text").alias("_text")), "_text")
    changed = F.size("_spans") > 0
    rows = rows.withColumn("_clean", F.when(changed, redacted(F.col("_text"), F.col("_spans"))).otherwise(F.col("_text")))
    new = [F.col("_clean").alias("text")]
    if "n_chars" in docs.columns:
        size = F.when(changed, F.length("_clean")).otherwise(F.col("_row.n_chars"))
        new.append(size.cast(dict(docs.dtypes)["n_chars"]).alias("n_chars"))
    return restored(rows, docs.columns, *new).select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences and their places in sequences of up to 4096 tokens."""
    return packed_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact),
    ("best-fit packing", packed),
]

ORACLE_SQL = None  # classifier and tokenizer are beyond SQL; tests compare the stages with plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
