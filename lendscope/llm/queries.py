"""One query per training-data operator, over whole tables with production settings."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lendscope.llm import (
    boosted_rules,
    filter_audit,
    fingerprints,
    language_crf,
    licenses,
    mixing,
    near_dedup,
    personal_data,
    pieces,
    prefix_trie,
    rule_quality,
    sql,
    token_counts,
    warc,
)
from lendscope.llm.common import fold, table

Run = Callable[[SparkSession, str], DataFrame]


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of the documents."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best segmentations of each document into pieces."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode(table(spark, sf_dir, "documents"), model)


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each document by rules learned from four fifths of the labels."""
    documents = table(spark, sf_dir, "documents")
    model = rule_quality.learn(
        documents, table(spark, sf_dir, "labels"), keep=fold("doc_id", 5) != 0
    )
    scored = rule_quality.score_quality(documents, model)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of each document."""
    documents = table(spark, sf_dir, "documents")
    trees = boosted_rules.learn(documents, table(spark, sf_dir, "labels"))
    return boosted_rules.judge(documents, trees)


def license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in the documents."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of each document, beside its edited text's and the next document's."""
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, learned from two thirds of them."""
    documents = table(spark, sf_dir, "documents")
    model = language_crf.learn(documents, keep=fold("doc_id", 3) != 1)
    found = language_crf.identify(documents, model)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer)


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixture of the sources of as many tokens as there are."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove at each step of each of their orders."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the conversations' shared beginnings."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in the documents and the words that disclose it."""
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


def queries() -> dict[str, tuple[Run, str | None]]:
    """Query name: (Spark query, SQL that gives the same, where SQL can)."""
    return {
        "op1_near_duplicates": (near_duplicates, sql.near_duplicates()),
        "op2_segmentations": (segmentations, None),
        "op3_quality": (quality, None),
        "op4_web_archives": (web_archives, sql.WEB_ARCHIVES),
        "op5_quality_rules": (quality_rules, None),
        "op6_license_notices": (license_notices, sql.license_notices()),
        "op7_fingerprints": (document_fingerprints, None),
        "op8_languages": (languages, None),
        "op9_token_counts": (tokens, None),
        "op10_source_mix": (source_mix, None),
        "op11_filter_audit": (filter_interaction, sql.FILTER_AUDIT),
        "op12_conversation_trie": (conversation_trie, sql.CONVERSATION_TRIE),
        "op13_personal_data": (personal, sql.personal_data()),
    }
