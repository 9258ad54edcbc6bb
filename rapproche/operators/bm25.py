"""BM25 term weights over a set of token lists, and document vectors weighted by them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapproche.operators.skew import SkewLimits, lookup_join
from rapproche.operators.vector_sums import vector_sums
from rapproche.session import stage

# Saturation, length normalisation, and the share of the mean idf that replaces a negative one.
K1 = 1.5
B = 0.75
EPSILON = 0.25

TERM_ROW_BYTES = 64


@dataclass(frozen=True)
class CorpusStats:
    """``idf(term, df, idf)``, the one-row ``totals(n_docs, avgdl)``, and the counted ``terms`` of the corpus ``docs``."""

    idf: DataFrame
    totals: DataFrame
    docs: DataFrame | None = None
    terms: DataFrame | None = None


def document_lengths(docs: DataFrame) -> DataFrame:
    return docs.select("id", F.size("tokens").cast("long").alias("doc_len"))


def term_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of each term in each document: (id, term, tf, doc_len)."""
    return (
        docs.select("id", F.size("tokens").cast("long").alias("doc_len"), F.explode("tokens").alias("term"))
        .groupBy("id", "doc_len", "term")
        .agg(F.count("*").alias("tf"))
    )


def corpus_totals(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count("*").alias("n_docs"), F.avg(F.size("tokens")).alias("avgdl"))


def raw_idf(df: Column, n_docs: Column) -> Column:
    return F.log(n_docs - df + 0.5) - F.log(df + 0.5)


def corpus_stats(docs: DataFrame) -> CorpusStats:
    """Document frequency and idf per term; terms in over half of the documents get a share of the mean idf.

    Terms and totals are counted once and written: frequencies, their mean and the weights of the same corpus read
    them again.
    """
    totals = stage(corpus_totals(docs), "totals")
    terms = stage(term_counts(docs), "term-counts")
    idf_column = raw_idf(F.col("df"), totals.select("n_docs").scalar())
    frequencies = terms.groupBy("term").agg(F.count("*").alias("df"))  # a row per document and term
    raw = stage(frequencies.withColumn("raw", idf_column), "terms")
    mean_idf = raw.agg(F.avg("raw").alias("mean_idf")).scalar()
    idf = F.when(F.col("raw") < 0, F.lit(EPSILON) * mean_idf).otherwise(F.col("raw"))
    return CorpusStats(raw.select("term", "df", idf.alias("idf")), totals, docs, terms)


def term_weight(idf: Column, tf: Column, doc_len: Column, avgdl: Column) -> Column:
    return idf * (K1 + 1.0) * tf / (K1 * (1.0 - B + B * doc_len / avgdl) + tf)


def weighted_terms(docs: DataFrame, stats: CorpusStats, limits: SkewLimits = SkewLimits()) -> DataFrame:
    """(id, term, tf, doc_len, weight) for every term of every document."""
    idf = stats.idf.select(F.col("term").alias("_term"), "idf")
    own = stats.terms if stats.terms is not None and docs is stats.docs else term_counts(docs)
    counts = lookup_join(own, idf, "term", "_term", TERM_ROW_BYTES, limits=limits)
    avgdl = stats.totals.select("avgdl").scalar()
    weight = term_weight(F.col("idf"), F.col("tf"), F.col("doc_len"), avgdl)
    return counts.select("id", "term", "tf", "doc_len", weight.alias("weight"))


def mean_vectors(terms: DataFrame, vectors: DataFrame, limits: SkewLimits = SkewLimits(), size: int = 100) -> DataFrame:
    """(id, vector): mean over token occurrences of token vector times weight.

    ``terms`` has (id, term, tf, doc_len, weight), ``vectors`` has (token, vector). Documents are dealt to blocks that get
    each vector once, so that the shuffle carries no vector per term. ``limits`` no longer steers it: no vector is
    broadcast here.
    """
    share = F.col("weight") * F.col("tf") / F.col("doc_len")
    pairs = terms.select(F.col("id").alias("key"), F.col("term").alias("token"), share.alias("share"))
    return vector_sums(pairs, vectors, size).select(F.col("key").alias("id"), "vector")


def plain_terms(docs: DataFrame) -> DataFrame:
    """Term counts with weight 1, for unweighted means."""
    return term_counts(docs).withColumn("weight", F.lit(1.0))
