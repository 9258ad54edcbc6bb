"""Near-duplicate documents by MinHash bands, odd sketches and an exact check.

A text's set of word shingles gives ``BANDS * ROWS`` MinHash samples. Documents that agree in all samples of a band are
candidates; a pair of similarity 0.8 agrees in no band with probability 1e-7. The samples are also folded into an odd
sketch, a bitmap that keeps the parity of the samples hashed to each bit. The bits in which two sketches differ estimate
the similarity; pairs estimated far below the threshold are dropped, the others are compared on their full sets.

Documents of equal sets are one class from the start. Inside a band's bucket each class is first compared with the
smallest one, the pivot, and the shingles in which it differs from the pivot are noted. What the stars link needs no more
pairs among itself; only pairs between different components that share a bucket are compared then:

* classes near the same pivot, in pairs of blocks, where the similarity of two classes follows exactly from their sizes
  and the overlap of their noted differences. The rows of the family's largest component meet only the other rows, and
  of what a block finds a class keeps one link per component, so no list of pairs is made;
* a class that is not near its bucket's pivot with each other class of the bucket, as a list of pairs.

So a group of copies costs its size and not its square as far as the stars link it, and no link between components is
left out.

Null text and text without words have an empty set and are linked with nothing. A text with fewer words than a shingle
is one shingle. Rows without id are compared with nothing and kept, with a null component. Rows that repeat an id are
taken one by one. Other columns are ignored by ``components_of``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapproche.llm.batches import arrow_rows, free_prefix
from rapproche.llm.components import components
from rapproche.llm.words import Words, mix, slices
from rapproche.session import stage

BANDS, ROWS = 69, 7
#: Bits of an odd sketch.
BITS = 1024
#: Pairs estimated this far below the threshold are dropped: five standard deviations of the differing bits at 0.8.
MARGIN = 0.15
#: A class whose estimate with a pivot is this far below the threshold is not near it.
NEAR_MARGIN = 0.45
#: Classes of a family that are compared with another such number at a time.
FAMILY_BLOCK = 512
#: Rows of texts that are sent to Python at a time.
TEXT_ROWS = 500
#: Ids up to which a table of them is broadcast to fetch texts.
BROADCAST_ROWS = 500_000

SIGNATURE = "doc_id long, n_shingles long, high long, low long, bands array<long>, sketch array<long>"

_seeds = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64))
FACTORS = (_seeds[: BANDS * ROWS] | np.uint64(1)).astype(np.uint32)
SHIFTS = _seeds[BANDS * ROWS :].astype(np.uint32)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text of a slice, A-Z in lower case."""
    words = Words(texts, lower=True)
    at, value = words.runs(size)
    first = np.searchsorted(at, words.offset)
    counts = np.diff(words.offset)
    for i in range(len(words)):
        if counts[i] >= size:
            yield np.unique(value[first[i] : first[i + 1]])
        elif counts[i]:
            whole = Words(texts.slice(i, 1), lower=True)
            yield whole.runs(int(counts[i]))[1]
        else:
            yield np.zeros(0, np.uint64)


def samples(shingles: np.ndarray) -> np.ndarray:
    """MinHash samples of one set."""
    least = np.full(len(FACTORS), 0xFFFFFFFF, np.uint32)
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(low), 2048):
        np.minimum(least, (low[i : i + 2048, None] * FACTORS + SHIFTS).min(0), out=least)
    return least


def odd_sketch(sample: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples, as 64-bit words."""
    numbered = sample.astype(np.uint64) + (np.arange(len(sample), dtype=np.uint64) << np.uint64(32))
    parity = np.bincount((mix(numbered) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def band_keys(sample: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in sample.reshape(BANDS, ROWS).T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """Set size, a 128-bit hash of the set, band keys and odd sketch per document; nulls for an empty set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for start, end in slices(texts):
                rows: list[list] = [[], [], [], [], []]
                for s in shingle_sets(texts.slice(start, end - start), size):
                    if not len(s):
                        row = [0, None, None, None, None]
                    else:
                        sample = samples(s)
                        high, low = (int(mix(s ^ np.uint64(k)).sum().view(np.int64)) for k in (1, 2))
                        row = [len(s), high, low, band_keys(sample), odd_sketch(sample)]
                    for column, x in zip(rows, row, strict=True):
                        column.append(x)
                kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        *[pa.array(c, k) for c, k in zip(rows, kinds, strict=True)],
                    ],
                    names=["doc_id", "n_shingles", "high", "low", "bands", "sketch"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SIGNATURE)


def promising(pairs: DataFrame, classes: DataFrame, threshold: int, margin: float = MARGIN) -> DataFrame:
    """Of pairs (a, b) of classes, those whose estimate is no further than ``margin`` below the threshold (in percent).

    With the usual margin, set sizes must leave the threshold possible as well.
    """
    sizes = classes.select("doc_id", "n_shingles", "sketch")
    left = sizes.toDF("a", "n_a", "sketch_a")
    right = sizes.toDF("b", "n_b", "sketch_b")
    both = pairs.join(left, "a").join(right, "b")
    differing = sum(F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in range(BITS // 64))
    # estimate = 1 + bits / (4 samples) * ln(1 - 2 differing / bits)
    most = BITS / 2 * (1 - np.exp((threshold / 100 - margin - 1) * 4 * BANDS * ROWS / BITS))
    possible = 100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b") if margin == MARGIN else F.lit(True)
    return both.where(possible & (differing <= F.lit(float(most)))).select("a", "b")


def compared(pairs: DataFrame, docs: DataFrame, size: int, threshold: int) -> DataFrame:
    """Pairs (a, b) by their full shingle sets: ``linked`` where 100 * intersection >= threshold * union, the sizes of
    both sets, and a's differences from b: the shingles that b alone has, and those that a alone has, marked apart."""
    pairs = stage(pairs, "pairs")
    wanted = stage(pairs.select(F.col("a").alias("_id")).union(pairs.select("b")).distinct(), "pair-ids")
    small = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(
        F.broadcast(wanted) if small else wanted, F.col("doc_id") == F.col("_id"), "left_semi"
    )
    texts = stage(texts, "pair-texts")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for i in range(batch.num_rows):
                (a,) = shingle_sets(batch.column(2).slice(i, 1), size)
                text = batch.column(3).slice(i, 1)
                if last is None or not last.equals(text):
                    last = text
                    (held,) = shingle_sets(text, size)
                missing = np.setdiff1d(held, a, assume_unique=True)
                extra = np.setdiff1d(a, held, assume_unique=True)
                common = len(a) - len(extra)
                linked = 100 * common >= threshold * (len(a) + len(held) - common)
                differences = np.concatenate([mix(missing), mix(extra ^ np.uint64(1))]).view(np.int64)
                for column, x in zip(rows, (linked, len(held), len(missing), differences), strict=True):
                    column.append(x)
            kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, k) for c, k in zip(rows, kinds, strict=True)]],
                names=["a", "b", "linked", "n_b", "n_missing", "differences"],
            )

    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(
        run, "a long, b long, linked boolean, n_b long, n_missing long, differences array<long>"
    )


def _incidence(lists: pa.Array, items: np.ndarray) -> np.ndarray:
    """A row per list, a column per item (sorted): one where the list holds it."""
    flat = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(lists)), pa.compute.list_value_length(lists).to_numpy())
    place = np.minimum(np.searchsorted(items, flat), max(len(items) - 1, 0))
    found = items[place] == flat if len(items) else np.zeros(len(flat), bool)
    out = np.zeros((len(lists), len(items)), np.float32)
    out[row[found], place[found]] = 1
    return out


def family_links(near: DataFrame, threshold: int) -> DataFrame:
    """Links between different components of classes near one pivot: (a, b), b standing for its component.

    ``near`` holds (pivot, id, component, n_b, n_missing, differences). With P the pivot's set, two classes have
    |P| - missing of both + shared differences shingles in common.
    """
    parts = near.groupBy("pivot", "component").agg(F.count(F.lit(1)).alias("n"))
    families = parts.groupBy("pivot").agg(
        F.max(F.struct("n", "component")).alias("largest"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_parts")
    )

    def blocks(n):
        return F.ceil(n / FAMILY_BLOCK).cast("int")

    families = families.where("n_parts > 1").select(
        F.col("pivot").alias("_pivot"), F.col("largest.component").alias("_major"),
        blocks(F.col("largest.n")).alias("_majors"), blocks(F.col("n") - F.col("largest.n")).alias("_minors"),
    )
    dealt = near.join(families, F.col("pivot") == F.col("_pivot"))
    major = F.col("component") == F.col("_major")
    # blocks of the largest component come after those of the others
    block = F.when(major, F.col("_minors") + F.pmod(F.xxhash64("id"), F.col("_majors"))).otherwise(
        F.pmod(F.xxhash64("id"), F.col("_minors"))
    ).cast("int")
    dealt = dealt.withColumn("block", block)
    held = ("id", "component", "n_b", "n_missing", "differences")
    asked = dealt.where("component <> _major").select(
        "pivot", F.col("block").alias("i"), F.explode(F.sequence(F.lit(0), F.col("_minors") + F.col("_majors") - 1)).alias("j"),
        F.lit(0).alias("side"), *held,
    )
    given = dealt.select(
        "pivot", F.explode(F.sequence(F.lit(0), F.col("_minors") - 1)).alias("i"), F.col("block").alias("j"),
        F.lit(1).alias("side"), *held,
    )

    def compare(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        a, b = (table.filter(pa.array(side == s)).combine_chunks() for s in (0, 1))
        if not a.num_rows or not b.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        lists = [t.column("differences").chunk(0) for t in (a, b)]
        items = np.intersect1d(*[x.flatten().to_numpy() for x in lists])
        shared = _incidence(lists[0], items) @ _incidence(lists[1], items).T
        missing, n = [], []
        for t, x in zip((a, b), lists, strict=True):
            missing.append(t.column("n_missing").to_numpy())
            changed = pa.compute.list_value_length(x).to_numpy() - missing[-1]
            n.append(t.column("n_b").to_numpy() - missing[-1] + changed)
        common = a.column("n_b")[0].as_py() - missing[0][:, None] - missing[1][None, :] + shared
        linked = 100 * common >= threshold * (n[0][:, None] + n[1][None, :] - common)
        component = [t.column("component").to_numpy() for t in (a, b)]
        linked &= component[0][:, None] != component[1][None, :]
        row, column = np.nonzero(linked)
        pairs = np.unique(np.stack([a.column("id").to_numpy()[row], component[1][column]], 1), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return asked.union(given).groupBy("pivot", "i", "j").applyInArrow(compare, "a long, b long")


def components_of(docs: DataFrame, size: int = 5, threshold: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``: the smallest id reachable by links."""
    spark = docs.sparkSession
    with arrow_rows(spark, TEXT_ROWS):
        signed = stage(signatures(docs, size), "signatures")
    narrow = signed.select("doc_id", "n_shingles", "high", "low")
    full = narrow.where("doc_id is not null and n_shingles > 0")
    least = full.groupBy("high", "low").agg(F.min("doc_id").alias("class_id"))
    members = stage(
        full.join(least, ["high", "low"]).select("doc_id", "n_shingles", "class_id")
        .union(narrow.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", "doc_id")),
        "members",
    )
    copies = members.where("doc_id <> class_id").select("doc_id")
    classes = stage(
        signed.where("doc_id is not null and n_shingles > 0").join(copies, "doc_id", "left_anti")
        .select("doc_id", "n_shingles", "sketch", "bands"),
        "classes",
    )
    rows = classes.select(F.col("doc_id").alias("id"), F.explode("bands").alias("key"))
    buckets = stage(
        rows.groupBy("key").agg(F.min("id").alias("pivot"), F.count(F.lit(1)).alias("size")).where("size > 1"),
        "buckets",
    )
    held = stage(rows.join(buckets, "key").where("id <> pivot").select("key", "id", "pivot", "size"), "bucket-rows")
    stars = held.select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    with arrow_rows(spark, TEXT_ROWS):
        near = stage(
            compared(promising(stars, classes, threshold, NEAR_MARGIN), docs, size, threshold), "star-pairs"
        )
    links = near.where("linked").select("a", "b")
    found = stage(components(links), "star-components")
    of = found.withColumnRenamed("node", "id")

    # classes of different components near one pivot
    family = near.select(F.col("b").alias("pivot"), F.col("a").alias("id"), "n_b", "n_missing", "differences")
    family = family.join(of, "id", "left").withColumn("component", F.coalesce("component", "id"))
    more = family_links(family, threshold)

    # classes of different components that meet in a bucket whose pivot one of them is not near
    rest = held.where("size > 2").join(of, "id", "left").join(
        near.select(F.col("a").alias("id"), F.col("b").alias("pivot"), F.lit(True).alias("near")), ["id", "pivot"], "left"
    )
    rest = stage(rest.select("key", "id", F.coalesce("component", "id").alias("component"), "near"), "bucket-parts")
    far = rest.where("near is null").select("key", F.col("id").alias("a"), F.col("component").alias("_component"))
    across = rest.join(far, "key").where("component <> _component")
    across = across.select(F.greatest("a", "id").alias("a"), F.least("a", "id").alias("b")).distinct()
    with arrow_rows(spark, TEXT_ROWS):
        strangers = stage(
            compared(promising(across, classes, threshold), docs, size, threshold).where("linked").select("a", "b"), "strangers"
        )
    more = stage(more.union(strangers), "more-links")
    if more.limit(1).count():
        found = stage(components(links.union(more)), "components")

    out = members.join(found, F.col("class_id") == F.col("node"), "left")
    return out.select(
        "doc_id", "n_shingles", F.coalesce("component", "class_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, size: int = 5, threshold: int = 80) -> DataFrame:
    """``docs`` without near duplicates: of each component the row with its smallest id stays.

    Rows that repeat an id stay or go together.
    """
    own = f"{free_prefix(docs)}gone"
    gone = components_of(docs, size, threshold).where("not kept").select(F.col("doc_id").alias(own)).distinct()
    gone = stage(gone, "near-duplicates")
    small = gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(gone) if small else gone, F.col("doc_id") == F.col(own), "left_anti")
