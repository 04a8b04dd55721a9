"""Corpus pipeline: stages over the documents table, each written as Parquet
and read again as the documents of the next. All but the last return the
columns of documents, without the rows they drop; the last returns a row per
document that is left: doc_id, n_tokens, ids_sha256, decoded_sha256.

Language identification drops texts without a language, exact and near copies
leave one document of each group, and documents with a benchmark window go.
Null texts have no language, so later stages see none; an empty table passes
through all stages empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import byte_bpe, decontaminate, exact_dedup, langid, ngram_join
from ledgerlens.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.drop_unidentified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs, exact_dedup.DigestIndex(spark))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_near_copies(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.roundtrip(docs)


STAGES = [("language_id", language), ("exact_dedup", exact_copies), ("ngram_join", near_copies),
          ("decontaminate", benchmark_leaks), ("byte_bpe", encode)]
ORACLE_SQL = None  # the first stage is a trained model and the last a tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
