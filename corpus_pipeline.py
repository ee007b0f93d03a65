"""Corpus cleaning pipeline: quality rules, line de-duplication, near-duplicate
removal, benchmark decontamination, tokenisation.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``; all but the last return
the columns that they were given. A stage defines null, empty, repeated and
clashing input as its operator does.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cumulus.llm import bytebpe, decontaminate, linedup, minmax, quality as rules
from cumulus.llm.common import documents, stored

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return rules.judged(docs).where("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows go; a document of
    which nothing is left goes with them, n_chars is counted again."""
    out = linedup.rewritten(docs).where((F.col("n_removed") == 0) | (F.col("text") != ""))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)) \
            .otherwise(F.col("row").getField("n_chars"))
    return out.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles,
    similarity 0.8)."""
    return minmax.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.without_leaks(docs, items)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining document."""
    out = bytebpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN)
    keep = [c for c in ("doc_id", "lang", "source") if c in out.columns]
    return out.select(*keep, "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [("quality_rules", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("byte_bpe", tokens)]

#: Shingle links, BM25 retrieval and merges by rank are beyond SQL; tests hold
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
