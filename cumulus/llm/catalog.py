"""The subpackage's queries: ``QUERIES[name](spark, sf_dir)`` and ``ORACLE``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cumulus.llm import (bytebpe, collocations, decontaminate, langid, licenses, linedup, manifest, minmax, passages,
                         quality, secrets, toxicity, warczip)
from cumulus.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups at 3-word shingles and Jaccard 0.85."""
    return minmax.near_duplicates(documents(spark, sf_dir), width=3, percent=85)


@query
def op2_bm25_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that each document leaks."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.leaked_items(documents(spark, sf_dir), items)


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and round trip of every text."""
    out = bytebpe.encode(documents(spark, sf_dir).select("doc_id", "text"),
                         public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left after repeated three-line windows are removed."""
    out = linedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the verdict of the quality rules."""
    out = quality.judged(documents(spark, sf_dir), carry=["doc_id"])
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "char_distance", "word_distance")


ORACLE["op6_line_dedup"] = linedup.ORACLE_SQL


@query
def op8_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages through ZIP-packaged WARC archives and back."""
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    return warczip.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op9_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text, with entropy spans."""
    return secrets.scan(documents(spark, sf_dir))


@query
def op1_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").select("doc_id", "toxic")
    return toxicity.score(documents(spark, sf_dir).select("doc_id", "text"), labels)


@query
def op7_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and blocks that match a licence template."""
    return licenses.scan(documents(spark, sf_dir))


ORACLE["op7_license_dice"] = licenses.oracle_sql()


@query
def op3_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat across documents."""
    return passages.repeated_passages(documents(spark, sf_dir))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and verdict after tampering."""
    return manifest.verification(documents(spark, sf_dir))


ORACLE["op11_merkle_manifest"] = manifest.ORACLE_SQL


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of every language."""
    return collocations.best_collocations(documents(spark, sf_dir))


ORACLE["op12_phrase_collocations"] = collocations.ORACLE_SQL


@query
def op13_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text and the number of its spans."""
    out = langid.identify(documents(spark, sf_dir))
    return out.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))
