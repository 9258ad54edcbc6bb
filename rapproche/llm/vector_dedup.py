"""Near-duplicate vectors by sorted projection passes.

In every pass random planes give each vector a string of sign bits; vectors of one label are put in the order of their
strings, cut in blocks of ``BLOCK`` neighbours, and each block is compared with itself and the next one. Pairs whose
cosine reaches the threshold are linked, and the links of all passes are united. A pass may part two close vectors, but
hardly all passes do; recall is measured in the tests.

Neighbour windows are bounded, so a group of thousands is seen in parts. What they find decides only which vectors belong
together: in every group found, all vectors are then compared with each other in pairs of blocks, which counts the links
exactly without emitting them.

Equal vectors of one label are compared once and counted as often as they occur. Vectors that are null, zero or hold null
or non-finite components, and vectors without label, link with nothing; so do vectors of different lengths. Rows without
id take no part and have a null component; rows that repeat an id are taken one by one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rapproche.llm.components import components
from rapproche.llm.words import mix
from rapproche.session import stage

PASSES = 12
BITS = 64
BLOCK = 256
#: Vectors of a found group that are compared with another such number at a time.
GROUP_BLOCK = 512


def planes(number: int, size: int) -> np.ndarray:
    return np.random.default_rng([17, number]).standard_normal((size, BITS)).astype(np.float32)


def _matrix(column: pa.Array) -> np.ndarray:
    size = len(column[0]) if len(column) else 0
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), size)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, scaled first so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def sort_keys(vectors: DataFrame, passes: int) -> DataFrame:
    """One row per vector and pass: its sign bits as a number whose order is that of the strings."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                part = batch.slice(first, 2000)
                column = part.column(part.schema.get_field_index("vector"))
                lengths = pa.compute.list_value_length(column).to_numpy()
                for size in np.unique(lengths):
                    rows = part.filter(pa.array(lengths == size))
                    unit = _unit(_matrix(rows.column(rows.schema.get_field_index("vector")))).astype(np.float32)
                    for number in range(passes):
                        bits = unit @ planes(number, int(size)) > 0
                        key = (bits * weights).sum(1, dtype=np.uint64) ^ np.uint64(1 << 63)  # unsigned order, signed type
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(key), number, np.int32)), pa.array(key.view(np.int64)), *rows.columns],
                            names=["pass", "key", *rows.schema.names],
                        )

    schema = T.StructType([T.StructField("pass", T.IntegerType()), T.StructField("key", T.LongType()), *vectors.schema.fields])
    return vectors.mapInArrow(run, schema)


def _linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    return a @ b.T >= threshold


def window_links(keyed: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) inside sorted windows: of each block's rows, every one to the first of those it reaches.

    Blocks are cut within a sorted partition; range partitions change between passes, and so do their borders.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, rows = None, np.zeros(0, np.int64), np.zeros((0, 0))

        def links() -> pa.RecordBatch:
            found = _linked(rows[:BLOCK], rows, threshold)
            label = np.arange(len(rows))
            while True:  # least index reached through the block's links
                step = np.minimum(label, np.where(found, label[:BLOCK, None], len(rows)).min(0))
                step[: len(found)] = np.minimum(step[: len(found)], np.where(found, step[None, :], len(rows)).min(1))
                if (step == label).all():
                    break
                label = step
            far = np.flatnonzero(label < np.arange(len(rows)))
            return pa.RecordBatch.from_arrays([pa.array(ids[far]), pa.array(ids[label[far]])], names=["a", "b"])

        for batch in batches:
            names = batch.schema.names
            place = {n: batch.column(names.index(n)) for n in ("pass", "label", "size", "id", "vector")}
            codes = [place[n].to_numpy() for n in ("pass", "label", "size")]
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in codes], axis=0)) + 1
            for first, last in zip([0, *change], [*change, batch.num_rows], strict=True):
                if first == last:
                    continue
                now = tuple(int(c[first]) for c in codes)
                new_ids = place["id"].slice(first, last - first).to_numpy()
                new_rows = _unit(_matrix(place["vector"].slice(first, last - first)))
                if now != group:
                    if len(ids) > 1:
                        yield links()
                    group, ids, rows = now, new_ids, new_rows
                else:
                    ids, rows = np.concatenate([ids, new_ids]), np.concatenate([rows, new_rows])
                while len(ids) >= 2 * BLOCK:
                    all_ids, all_rows = ids, rows
                    ids, rows = ids[: 2 * BLOCK], rows[: 2 * BLOCK]
                    yield links()
                    ids, rows = all_ids[BLOCK:], all_rows[BLOCK:]
        if len(ids) > 1:
            yield links()

    return keyed.mapInArrow(run, "a long, b long")


def group_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(id, n_near): how many vectors of its found group each one links with, itself included, by pairs of blocks.

    ``members`` holds (component, id, copies, vector). Each pair of blocks is a row of its own, so a large group is
    spread over tasks.
    """
    # blocks by hash, as many as the group's size asks for
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / GROUP_BLOCK).cast("int").alias("n_blocks"))
    dealt = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("n_blocks") - 1)
    asked = dealt.select("component", F.col("block").alias("i"), F.explode(every).alias("j"), F.lit(0).alias("side"), "id", "copies", "vector")
    given = dealt.select("component", F.explode(every).alias("i"), F.col("block").alias("j"), F.lit(1).alias("side"), "id", "copies", "vector")

    def count(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        one, other = (table.filter(pa.array(side == s)).combine_chunks() for s in (0, 1))
        if not one.num_rows or not other.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "n_near": pa.array([], pa.int64())})
        a, b = (_unit(_matrix(t.column("vector").chunk(0))) for t in (one, other))
        near = _linked(a, b, threshold) @ other.column("copies").to_numpy()
        return pa.table({"id": one.column("id"), "n_near": pa.array(near.astype(np.int64))})

    pairs = asked.union(given).groupBy("component", "i", "j").applyInArrow(count, "id long, n_near long")
    return pairs.groupBy("id").agg(F.sum("n_near").alias("n_near"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, passes: int = PASSES) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding, label)."""
    given = vectors.schema["embedding"].dataType.elementType
    kind = "float" if isinstance(given, T.FloatType) else "double"  # not widened: every pass ships the vectors
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: x.cast(kind)).alias("vector"),
    )
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    ) & F.exists("vector", lambda x: x != 0)
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite, F.lit(False))
    # -0.0 and 0.0 are one value: adding 0.0 makes them one
    rows = rows.withColumn("vector", F.when(usable, F.transform("vector", lambda x: x + F.lit(0.0).cast(kind))))
    digest = F.transform("vector", lambda x: x.cast("string"))
    rows = stage(
        rows.withColumn("same", F.when(usable, F.sha2(F.concat_ws(",", F.col("label").cast("string"), digest), 256))),
        "vectors",
    )
    good = rows.where("same is not null")
    copies = good.groupBy("same").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    classes = (
        good.join(copies, "same").where("vec_id = id").dropDuplicates(["same"])
        .select("id", "label", F.size("vector").alias("size"), "copies", "vector")
    )
    classes = stage(classes, "vector-classes")
    order = ["pass", "label", "size", "key"]
    dealt = sort_keys(classes, passes).repartitionByRange(*order).sortWithinPartitions(*order)
    found = stage(components(window_links(dealt, threshold).distinct()), "vector-components")
    members = found.withColumnRenamed("node", "id").join(classes.select("id", "copies", "vector"), "id")
    near = group_counts(members, threshold)

    every = classes.select("id", "copies").join(near, "id", "left").join(
        found.withColumnRenamed("node", "id"), "id", "left"
    )
    verdict = every.select(
        "id", F.coalesce("n_near", "copies").alias("n_near"), F.coalesce("component", "id").alias("component")
    )
    by_row = rows.select("vec_id", "same").join(copies.select("same", "id"), "same", "left")
    out = by_row.join(verdict, "id", "left")
    return out.select(
        "vec_id",
        F.coalesce(F.col("n_near") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
