"""The queries of this subpackage and the SQL they must agree with."""

from __future__ import annotations

from lagline.llm import oracles
from lagline.llm.ball_tree import nearest
from lagline.llm.common import ORACLES, QUERIES, query, table  # noqa: F401
from lagline.llm.conversation_repair import conversation_report, damaged
from lagline.llm.language_id import language_report
from lagline.llm.license_join import license_report
from lagline.llm.packing import packed_documents
from lagline.llm.page_wrappers import main_texts
from lagline.llm.phrase_index import contamination
from lagline.llm.quality_bayes import judged
from lagline.llm.secret_scan import secret_report
from lagline.llm.simhash import near_duplicates
from lagline.llm.spelling_variants import variants
from lagline.llm.suffix_dedup import without_repeats
from lagline.llm.warc import archived_pages


@query("op1_decontamination", oracles.DECONTAMINATION)
def _decontamination(spark, folder):
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op2_licenses", oracles.LICENSES)
def _licenses(spark, folder):
    return license_report(table(spark, folder, "documents"))


@query("op3_suffix_dedup")
def _suffix_dedup(spark, folder):
    return without_repeats(table(spark, folder, "documents"), keep_text=False).drop("kept")


@query("op4_simhash")
def _simhash(spark, folder):
    return near_duplicates(table(spark, folder, "documents"))


@query("op5_top_k", oracles.TOP_K)
def _top_k(spark, folder):
    return nearest(table(spark, folder, "embeddings"), every=100)


@query("op6_language")
def _language(spark, folder):
    return language_report(table(spark, folder, "documents"))


@query("op7_quality")
def _quality(spark, folder):
    found = judged(table(spark, folder, "documents"), table(spark, folder, "labels"), keep_columns=["doc_id", "source"])
    return found.select("doc_id", "source", "quality_prob", "toxic_prob", "quality_rate", "toxic_rate", "keep")


@query("op8_packing")
def _packing(spark, folder):
    return packed_documents(table(spark, folder, "documents"))


@query("op9_warc", oracles.ARCHIVES)
def _warc(spark, folder):
    return archived_pages(table(spark, folder, "pages"))


@query("op10_secrets", oracles.SECRETS)
def _secrets(spark, folder):
    return secret_report(table(spark, folder, "documents"))


@query("op11_conversations", oracles.CONVERSATIONS)
def _conversations(spark, folder):
    rows = table(spark, folder, "conversations")
    return conversation_report(rows, damaged(rows))


@query("op12_spelling", oracles.SPELLING)
def _spelling(spark, folder):
    return variants(table(spark, folder, "documents"))


@query("op13_articles", oracles.ARTICLES)
def _articles(spark, folder):
    return main_texts(table(spark, folder, "pages"))
