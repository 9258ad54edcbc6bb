"""Duplicate passages by relative Lempel-Ziv parsing against all documents with smaller ids.

The index of reference blocks has two levels. Anchors are runs of ``ANCHOR`` words, chosen where their hash is the
smallest within a window, so two documents that share ``window`` words share an anchor. Around anchors that more than
one document holds, every window is posted with its hash; the index keeps the smallest document of each hash. Parsing
goes through a document from left to right: a factor starts at the first window whose smallest document comes before
this one, and grows word by word while the following windows are found in the same reference. Where the reference
changes a factor ends and the next begins; the windows across that boundary are looked up like all others, so a passage
that no single reference holds is not taken. Factors have ``window`` words at least, and their words are the duplicates.

Windows are compared by 96-bit hashes of their words, which are not folded. A document equal in all words to one with a
smaller id is a single factor and posts nothing.

Null text has no words. Rows without id are no reference and stay whole. Rows that repeat an id are one document: they
are no references of each other, and factors found in one of them are taken, at their places, out of all. Other columns are passed on; ``text`` is replaced, and so are ``n_words``, ``n_removed`` and ``factors``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rapproche.llm.batches import free_prefix
from rapproche.llm.words import Words, mix, slices
from rapproche.session import stage

ANCHOR = 20

WINDOWS = "doc_id long, start int, high long, low int"
FACTORS = T.ArrayType(
    T.StructType([T.StructField(n, T.LongType()) for n in ("start", "end", "reference")])
)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Distinct values that are the smallest of some ``width`` neighbours (of all, if there are fewer)."""
    if not len(values):
        return values
    width = min(width, len(values))
    return np.unique(np.lib.stride_tricks.sliding_window_view(values, width).min(1))


def outline(docs: DataFrame, window: int) -> DataFrame:
    """Number of words, 128-bit hash of all words, and anchors of each document that has a window."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in slices(batch.column(1)):
                words = Words(batch.column(1).slice(start, end - start))
                at, value = words.runs(ANCHOR)
                first = np.searchsorted(at, words.offset)
                rows: list[list] = [[], [], [], []]
                for i, n in enumerate(np.diff(words.offset).tolist()):
                    if n < window:
                        continue
                    own = words.hash[words.offset[i] : words.offset[i + 1]]
                    place = np.arange(n, dtype=np.uint64)
                    high, low = (int(mix(own + mix(place + np.uint64(k))).sum().view(np.int64)) for k in (1, 1 << 40))
                    anchors = _smallest(value[first[i] : first[i + 1]], window - ANCHOR + 1)
                    for column, x in zip(rows, (batch.column(0)[start + i].as_py(), high, low, anchors.view(np.int64)), strict=True):
                        column.append(x)
                kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["doc_id", "high", "low", "anchors"]
                )

    known = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    return known.mapInArrow(run, "doc_id long, high long, low long, anchors array<long>")


def posted_windows(texts: DataFrame, window: int) -> DataFrame:
    """Every window of (doc_id, text, anchors) that holds one of the anchors, with its hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in slices(batch.column(1)):
                part = batch.slice(start, end - start)
                words = Words(part.column(1))
                at, value = words.runs(ANCHOR)
                hits = np.zeros(len(words.hash) + 1, np.int64)  # running count of anchor starts
                ids = part.column(0).to_numpy(zero_copy_only=False)
                first = np.searchsorted(at, words.offset)
                for i in range(len(words)):
                    own = slice(first[i], first[i + 1])
                    anchors = np.asarray(part.column(2)[i].values.to_numpy()).view(np.uint64)
                    hits[at[own] + 1] = np.isin(value[own], anchors)
                hits = np.cumsum(hits)
                places, high = words.runs(window)
                if not len(places):
                    continue
                held = hits[places + window - ANCHOR + 1] > hits[places]
                low = words.runs(window, seed=1)[1][held]
                places, high = places[held], high[held]
                owner = np.searchsorted(words.offset, places, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[owner], pa.int64()),
                        pa.array((places - words.offset[owner]).astype(np.int32)),
                        pa.array(high.view(np.int64)),
                        pa.array((low >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                    ],
                    names=["doc_id", "start", "high", "low"],
                )

    return texts.mapInArrow(run, WINDOWS)


def parse(docs: DataFrame, window: int = 50) -> DataFrame:
    """Factors per document: (_doc, factors), an array of (start, end, reference) in order.

    A document that equals a smaller one has a single factor without end.
    """
    outlines = stage(outline(docs, window), "outlines")
    least = outlines.groupBy("high", "low").agg(F.min("doc_id").alias("least"))
    copies = outlines.select("doc_id", "high", "low").join(least, ["high", "low"]).where("doc_id > least")
    copies = stage(copies.select("doc_id", "least").distinct(), "copies")

    single = outlines.join(copies.select("doc_id"), "doc_id", "left_anti")
    anchors = single.select("doc_id", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = stage(shared.where("low < high").select("anchor"), "shared-anchors")
    per_doc = anchors.join(shared, "anchor").groupBy(F.col("doc_id").alias("_doc"))
    per_doc = stage(per_doc.agg(F.collect_set("anchor").alias("anchors")), "document-anchors")

    # merged at any size, so that what is shuffled grows as the texts do, and no table of few compressed bytes is broadcast
    texts = docs.select(F.col("doc_id").cast("long"), "text").hint("merge").join(per_doc, F.col("doc_id") == F.col("_doc"))
    texts = texts.select("doc_id", "text", "anchors")
    posted = stage(posted_windows(texts, window), "windows")
    index = posted.groupBy("high", "low").agg(F.min("doc_id").alias("reference"), F.max("doc_id").alias("last"))
    index = stage(index.where("reference < last").drop("last"), "index")  # written, so that Spark splits a hot passage
    found = posted.hint("merge").join(index, ["high", "low"]).where("doc_id > reference").select("doc_id", "start", "reference")
    # the greedy parse: a factor ends where the next window is not found, or found in another reference
    order = W.partitionBy("doc_id").orderBy("start", "reference")
    grows = (F.col("start") == F.lag("start").over(order) + 1) & (F.col("reference") == F.lag("reference").over(order))
    begun = found.distinct().withColumn("begins", F.when(F.coalesce(grows, F.lit(False)), 0).otherwise(1))
    numbered = begun.withColumn("factor", F.sum("begins").over(order.rowsBetween(W.unboundedPreceding, 0)))
    spans = numbered.groupBy("doc_id", "factor", "reference").agg(
        F.min("start").cast("long").alias("start"), (F.max("start") + window).cast("long").alias("end")
    )
    whole = copies.select("doc_id", F.lit(0).cast("long").alias("start"), F.lit(None).cast("long").alias("end"), F.col("least").alias("reference"))
    every = spans.select("doc_id", "start", "end", "reference").union(whole).groupBy(F.col("doc_id").alias("_doc"))
    return stage(every.agg(F.array_sort(F.collect_list(F.struct("start", "end", "reference"))).alias("factors")), "factors")


def remove_passages(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs`` with ``text`` reduced to the words outside all factors, joined by blanks, and the factors."""
    docs = docs.drop("n_words", "n_removed", "factors")
    own = free_prefix(docs)
    found = parse(docs, window).select(F.col("_doc").alias(f"{own}doc"), F.col("factors").alias(f"{own}factors"))
    joined = docs.hint("merge").join(found, F.col("doc_id") == F.col(f"{own}doc"), "left")
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("factors", FACTORS)]
    names = [*docs.columns, "n_words", "n_removed", "factors"]
    place = docs.columns.index("text")
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "end", "reference")]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        white = bytes([0x20, *range(0x09, 0x0E)]).decode()
        blanks = str.maketrans(dict.fromkeys(white, " "))
        for batch in batches:
            texts = batch.column(place)
            for first, last in slices(texts):
                part = batch.slice(first, last - first)
                kept, counts, removed, spans = [], [], [], []
                found = part.column(part.num_columns - 1)
                for i, text in enumerate(texts.slice(first, last - first)):
                    words = [w for w in (text.as_py() or "").translate(blanks).split(" ") if w]
                    own = [
                        (f["start"], len(words) if f["end"] is None else f["end"], f["reference"])
                        for f in found[i].as_py() or ()
                    ]
                    rest, end = [], 0
                    for f in own:
                        rest += words[end : max(end, f[0])]
                        end = max(end, f[1])
                    rest += words[end:]
                    kept.append(" ".join(rest))
                    counts.append(len(words))
                    removed.append(len(words) - len(rest))
                    spans.append([dict(zip(("start", "end", "reference"), f, strict=True)) for f in own])
                columns = list(part.columns[: len(names) - 3])
                columns[place] = pa.array(kept, pa.string())
                columns += [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    joined = joined.select(*docs.columns, f"{own}factors")
    return joined.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def digests(docs: DataFrame) -> DataFrame:
    cleaned = remove_passages(docs.select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
