"""Token embeddings that hold up under typing errors, and document vectors built from them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapproche.config import EmbeddingConfig
from rapproche.operators import bm25
from rapproche.operators.ngrams import character_ngrams
from rapproche.operators.skew import SkewLimits, fits_broadcast
from rapproche.operators.skipgram import train_vectors
from rapproche.operators.vector_sums import vector_sums
from rapproche.session import stage

#: Documents whose vectors are worked out at once.
DOCUMENTS = 2000


def vocabulary(docs: DataFrame, min_count: int = 1) -> DataFrame:
    """Tokens with at least ``min_count`` occurrences: (token, n)."""
    return (
        docs.select(F.explode("tokens").alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_count)
    )


def corpus_size(docs: DataFrame) -> DataFrame:
    """One row: number of token lists and of tokens."""
    return docs.agg(F.count("*").alias("corpus_count"), F.sum(F.size("tokens")).alias("corpus_total_words"))


def train_word_vectors(docs: DataFrame, config: EmbeddingConfig = EmbeddingConfig()) -> DataFrame:
    """Vectors of frequent tokens, trained with their n-grams: (token, vector)."""
    return train_vectors(docs, config)[0]


def _means(pairs: DataFrame, vectors: DataFrame, name: str) -> DataFrame:
    """(name, vector): mean of the vectors of the tokens that each key is paired with."""
    first = vectors.where("vector is not null").select(F.size("vector")).first()
    sums = vector_sums(pairs.withColumn("share", F.lit(1.0)), vectors, first[0] if first else 1)
    return sums.select(F.col("key").alias(name), F.transform("vector", lambda x: x / F.col("n")).alias("vector"))


def ngram_vectors(word_vectors: DataFrame, config: EmbeddingConfig = EmbeddingConfig()) -> DataFrame:
    """(ngram, vector): mean vector of the tokens that hold each character n-gram, for vectors trained without n-grams."""
    grams = F.explode(character_ngrams(F.col("token"), config.min_n, config.max_n)).alias("key")
    return _means(word_vectors.select("token").distinct().select(grams, "token"), word_vectors, "ngram")


def token_vectors(
    tokens: DataFrame, word_vectors: DataFrame, ngrams: DataFrame, config: EmbeddingConfig = EmbeddingConfig(),
    limits: SkewLimits = SkewLimits(),
) -> DataFrame:
    """(token, vector) for every distinct ``token``: the mean of its own vector, if it has one, and of its n-grams'.

    A token that shares no n-gram with the vocabulary has no row: it adds nothing to a mean. Words and n-grams are told
    apart by their first sign.
    """
    wanted = stage(tokens.select("token").distinct(), "wanted")
    gram = F.explode(character_ngrams(F.col("token"), config.min_n, config.max_n)).alias("_gram")
    pairs = wanted.select(F.col("token").alias("key"), F.concat(F.lit("w"), "token").alias("token")).unionByName(
        wanted.select(F.col("token").alias("key"), gram).select("key", F.concat(F.lit("n"), "_gram").alias("token"))
    )
    vectors = word_vectors.select(F.concat(F.lit("w"), "token").alias("token"), "vector").unionByName(
        ngrams.select(F.concat(F.lit("n"), "ngram").alias("token"), "vector")
    )
    return _means(pairs, vectors, "token")


def document_vectors(
    docs: DataFrame,
    vectors: DataFrame,
    stats: bm25.CorpusStats | None = None,
    size: int = 100,
    limits: SkewLimits = SkewLimits(),
) -> DataFrame:
    """(id, vector): mean of token vectors, weighted by BM25 when ``stats`` is given.

    When the token table fits the broadcast bound, as it does for a subword vocabulary, every document is worked out
    where it lies, without a shuffle; of a larger table, the documents' tokens may. Otherwise documents are dealt to blocks
    that get each vector once. Either way
    there is a row per document; one without a known token has the zero vector.
    """
    if not fits_broadcast(vectors, 8 * size + 128, limits):
        # most of a large table may be of tokens that no document has
        terms = stats.idf.select("term") if stats else docs.select(F.explode("tokens").alias("term"))
        used = terms.distinct()
        vectors = stage(vectors.hint("merge").join(used, vectors["token"] == used["term"], "left_semi"), "used-vectors")
    if not fits_broadcast(vectors, 8 * size + 128, limits):
        terms = bm25.weighted_terms(docs, stats, limits) if stats else bm25.plain_terms(docs)
        means = bm25.mean_vectors(terms, vectors, limits, size).withColumnRenamed("id", "_id")
        zero = F.array_repeat(F.lit(0.0), size)
        rows = docs.select("id").join(means, F.col("id") == F.col("_id"), "left")
        return rows.select("id", F.coalesce("vector", zero).alias("vector"))
    if stats is None:
        table, avgdl = vectors.select("token", F.lit(None).cast("double").alias("idf"), "vector"), 1.0
    else:
        table = vectors.join(stats.idf, vectors["token"] == stats.idf["term"]).select("token", "idf", "vector")
        avgdl = float(stats.totals.first()["avgdl"] or 1.0)
    return _vectors_in_place(docs, table, avgdl, size)


def _vectors_in_place(docs: DataFrame, table: DataFrame, avgdl: float, size: int) -> DataFrame:
    """Document vectors from a token table that was checked to be small."""
    rows = table.toPandas()
    matrix = np.array(rows["vector"].tolist(), dtype=np.float64).reshape(len(rows), size)
    idf = rows["idf"].to_numpy(dtype=np.float64)
    shared = docs.sparkSession.sparkContext.broadcast((pa.array(rows["token"], pa.string()), matrix, idf))
    k1, b = bm25.K1, bm25.B
    weighted = not np.isnan(idf).all()

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, vectors, weights = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, DOCUMENTS):
                part = batch.slice(first, DOCUMENTS)
                lists = part.column(1)
                length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                found = pc.index_in(lists.flatten(), known)
                held = np.asarray(found.is_valid())
                doc = np.repeat(np.arange(len(length)), length)[held]
                # each document's distinct tokens, and how often it has them
                pair, counts = np.unique(doc * len(known) + found.drop_null().to_numpy(), return_counts=True)
                doc, token = np.divmod(pair, max(1, len(known)))
                factor = counts / length[doc]
                if weighted:
                    factor = factor * weights[token] * (k1 + 1) * counts / (k1 * (1 - b + b * length[doc] / avgdl) + counts)
                out = np.zeros((len(length), size))
                start = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])[: len(doc)])
                if len(start):
                    out[doc[start]] = np.add.reduceat(vectors[token] * factor[:, None], start, axis=0)
                offsets = pa.array(np.arange(len(out) + 1, dtype=np.int32) * size)
                column = pa.ListArray.from_arrays(offsets, pa.array(out.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0), column], names=["id", "vector"])

    return docs.select("id", "tokens").mapInArrow(means, "id long, vector array<double>")
