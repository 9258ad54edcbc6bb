"""Sums of many vectors by key, without a row per key and vector that carries the vector.

Pairs of key and token are dealt to blocks by their key. A block gets each vector that it needs once, however many of its
pairs use it, and adds them up as a matrix. So what is shuffled is the pairs, which are narrow, and at most
``BLOCK_BYTES`` of vectors a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapproche.operators.skew import SkewLimits, hot_keys
from rapproche.session import stage

#: Bytes of vectors that a block holds at most, and pairs that are multiplied at once.
BLOCK_BYTES = 256 * 1024 * 1024
CHUNK_PAIRS = 50_000


def _codes(values: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """The number of each value among the distinct ones, nulls included, and those."""
    found = pc.dictionary_encode(values.combine_chunks(), null_encoding="encode")
    if isinstance(found, pa.ChunkedArray):
        found = found.combine_chunks()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _rows(keys: pa.Array, sums: np.ndarray, n: np.ndarray) -> pa.Table:
    offsets = pa.array(np.arange(len(sums) + 1, dtype=np.int32) * sums.shape[1])
    lists = pa.ListArray.from_arrays(offsets, pa.array(sums.reshape(-1)))
    return pa.table({"_key": keys, "vector": lists, "n": pa.array(n)})


def vector_sums(pairs: DataFrame, vectors: DataFrame, size: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, vector, n): the sum of ``share`` times vector over each key's pairs, and the number of vectors in it.

    ``pairs`` has (key, token, share), ``vectors`` (token, vector) with ``size`` components; a token that has several rows
    adds all of them. Keys without a known token are left out. A key with more pairs than a block is dealt to several,
    by token, and their sums are added.
    """
    pairs = stage(pairs.where("token is not null").select("key", "token", F.col("share").cast("double").alias("share")), "vector-pairs")
    most = max(1, block_bytes // (8 * size))
    count = pairs.count()
    blocks = max(1, -(-count // most))
    block = F.pmod(F.xxhash64("key"), F.lit(blocks))
    hot = hot_keys(pairs, "key", SkewLimits(task_rows=most)) if blocks > 1 else None
    split = hot is not None and not hot.isEmpty()
    if split:
        parts = F.broadcast(hot.select("_hot", F.ceil(F.col("_rows") / most).cast("int").alias("_parts")))
        pairs = pairs.join(parts, F.col("key") == F.col("_hot"), "left").drop("_hot")
        other = F.pmod(F.xxhash64("key", F.pmod(F.xxhash64("token"), F.col("_parts"))), F.lit(blocks))
        block = F.when(F.col("_parts").isNull(), block).otherwise(other)
    dealt = pairs.select(block.alias("_block"), F.col("key").alias("_key"), "token", "share")
    table = vectors.select(F.col("token").alias("_token"), F.col("vector").cast("array<double>").alias("_vector"))
    needed = dealt.select(F.col("_block").alias("_part"), "token").distinct().hint("merge").join(table, F.col("token") == F.col("_token"))
    schema = dealt.select("_key", F.lit(None).cast("array<double>").alias("vector"), F.lit(0).cast("long").alias("n")).schema

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        token, known = _codes(right["_token"])
        at = pc.index_in(left["token"].combine_chunks(), known)
        held = np.asarray(at.is_valid())
        key, keys = _codes(left["_key"].filter(pa.array(held)))
        if not len(key):
            return _rows(pa.array([], left["_key"].type), np.zeros((0, size)), np.zeros(0, np.int64))
        at = at.drop_null().to_numpy().astype(np.int64)
        copies = np.bincount(token, minlength=len(known))
        matrix = np.zeros((len(known), size))
        np.add.at(matrix, token, _matrix(right["_vector"], size))
        share = left["share"].filter(pa.array(held)).to_numpy()
        order = np.lexsort((at, key))
        key, at, share = key[order], at[order], share[order]
        sums = np.zeros((len(keys), size))
        for first in range(0, len(key), CHUNK_PAIRS):
            own = slice(first, first + CHUNK_PAIRS)
            start = np.flatnonzero(np.concatenate([[True], key[own][1:] != key[own][:-1]]))
            sums[key[own][start]] += np.add.reduceat(matrix[at[own]] * share[own][:, None], start, axis=0)
        n = np.bincount(key, copies[at], len(keys)).astype(np.int64)
        return _rows(keys, sums, n)

    sums = dealt.groupBy("_block").cogroup(needed.select("_part", "_token", "_vector").groupBy("_part")).applyInArrow(add, schema)
    if split:
        sums = _added(sums, hot, size)
    return sums.select(F.col("_key").alias("key"), "vector", "n")


def _added(sums: DataFrame, hot: DataFrame, size: int) -> DataFrame:
    """The sums of those keys that several blocks hold are added; all others pass."""
    sums = stage(sums, "partial-sums")
    keys = F.broadcast(hot.select("_hot"))

    def add(rows: pa.Table) -> pa.Table:
        vectors = _matrix(rows["vector"], size)
        vectors = vectors[np.lexsort(vectors.T[::-1])]  # in the same order however the rows arrive
        return _rows(rows["_key"].combine_chunks()[:1], vectors.sum(axis=0)[None], np.array([pc.sum(rows["n"]).as_py()]))

    parted = sums.join(keys, F.col("_key") == F.col("_hot"), "left_semi").groupBy("_key").applyInArrow(add, sums.schema)
    whole = sums.join(keys, F.col("_key") == F.col("_hot"), "left_anti")
    return whole.unionByName(parted)
