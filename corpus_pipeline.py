"""From raw documents to token ids: quality rules, line and near-duplicate removal, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's documents. All but the last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rapproche.llm import bpe, line_dedup, minhash, mixing, quality
from rapproche.session import scratch_path

#: Share of the words that mixing keeps.
SHARE = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and their language's risk-controlled cutoffs."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that at least three of them share, which stay in the last one."""
    cleaned = line_dedup.dedup_lines(docs, scratch_path(spark, "pipeline-lines"))
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by shingles of five words."""
    return minhash.keep_one(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which sources, languages and topics have their target weights."""
    return mixing.sample(docs, SHARE)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of their decoded text."""
    model = bpe.BpeModel.load(str(public_tokenizers.path("word_bpe_49k.json")))
    return bpe.digests(docs, model, "doc_id", "source", "lang")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("MinHash near-dedup", near_deduplication),
    ("source mixing", source_mixing),
    ("BPE encoding", encoding),
]

#: Fitted cutoffs, merges of a vocabulary file and reachability over shingles are beyond one statement; see the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
