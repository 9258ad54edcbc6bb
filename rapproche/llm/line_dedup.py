"""Line deduplication with an index that documents can enter and leave.

The index is a folder of tables, one generation per change, and outlives the session: the newest generation with a
manifest, which is written last, is the index. One that was not finished is not seen, and an earlier one stays whole
until somebody deletes it. One writer at a time.

* ``refs``: which document holds which line key, exact;
* ``counts``: documents per key and the largest id among them, exact, of keys that two documents hold (a key in ``refs``
  without a count has one document; an index with ``min_docs`` of one counts those too);
* ``filters``: per shard of keys, a cuckoo filter of those that at least ``min_docs`` documents hold.

A key is 128 bits of a line that is stripped of white space, with A-Z in lower case; keys under ``min_chars`` code
points are not counted. Asking for a batch's repeated lines probes the filters with the batch's keys, and only those that
pass are looked up in the exact counts, so filters decide nothing by themselves. Deleting documents takes
their references away, and keys that fall below ``min_docs`` leave their filter. When references have outgrown the shards
twofold, the filters are built again over more shards.

Null text is one empty line. A document without id adds nothing to the index and keeps its lines. Rows that repeat an id
are one document: their keys are counted once, each row is cleaned. Other columns are passed on; ``text`` is replaced,
and so are columns named ``n_lines`` and ``n_dropped``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rapproche.llm.batches import free_prefix
from rapproche.llm.cuckoo import CuckooFilter

WHITE = " \t\n\v\f\r"
#: References a shard holds when the index is made.
SHARD_KEYS = 100_000
#: Keys a task remembers so as to ask for each once; a full memory is sent on and emptied.
ASKED_KEYS = 200_000

REFS = "high long, low long, doc_id long"
COUNTS = "high long, low long, n_docs long, last_doc long"
FILTERS = "shard long, blocks array<binary>"
MANIFEST = "generation long, name string, shards long, min_chars int, min_docs int"
ROWS = 1000


def line_key(line: str, min_chars: int) -> bytes | None:
    key = line.strip(WHITE)
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= min_chars else None


def line_keys(docs: DataFrame, min_chars: int = 20) -> DataFrame:
    """Each row's distinct line keys as (high, low, doc_id)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                keys, ids = [], []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    own = {line_key(line, min_chars) for line in (text.as_py() or "").split("\n")} - {None}
                    keys += own
                    ids += [doc_id] * len(own)
                halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(ids, pa.int64())],
                    names=["high", "low", "doc_id"],
                )

    held = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    return held.mapInArrow(run, REFS)


def asked_keys(docs: DataFrame, min_chars: int = 20) -> DataFrame:
    """The line keys of ``docs`` as (high, low), each once per task or per ``ASKED_KEYS`` keys of it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(keys: set[bytes]) -> pa.RecordBatch:
            halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1])], names=["high", "low"])

        keys: set[bytes] = set()
        for batch in batches:
            for text in batch.column(0):
                keys.update(k for line in (text.as_py() or "").split("\n") if (k := line_key(line, min_chars)))
                if len(keys) >= ASKED_KEYS:
                    yield sent(keys)
                    keys = set()
        yield sent(keys)

    return docs.where("doc_id is not null").select("text").mapInArrow(run, "high long, low long")


class LineIndex:
    """The index in ``folder``, a place that all executors share; see the module's text.

    A folder that holds an index is opened, with the settings it was made with; others raise ValueError.
    """

    def __init__(self, spark: SparkSession, folder: str, min_chars: int = 20, min_docs: int = 3):
        self.spark, self.folder, self.min_chars, self.min_docs = spark, folder.rstrip("/"), min_chars, min_docs
        self.generation = 0
        self.shards = 0
        self.name = ""
        newest = self._manifests().orderBy(F.desc("generation")).first()
        if newest:
            if (newest["min_chars"], newest["min_docs"]) != (min_chars, min_docs):
                raise ValueError(f"the index in {folder} has min_chars={newest['min_chars']}, min_docs={newest['min_docs']}")
            self.generation, self.shards, self.name = newest["generation"], newest["shards"], newest["name"]

    def _manifests(self) -> DataFrame:
        reader = self.spark.read.schema(MANIFEST).option("recursiveFileLookup", "true")
        try:
            return reader.parquet(f"{self.folder}/manifests")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def _table(self, name: str, schema: str) -> DataFrame:
        if not self.generation:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{self.name}/{name}")

    @property
    def refs(self) -> DataFrame:
        return self._table("refs", REFS)

    @property
    def counts(self) -> DataFrame:
        return self._table("counts", COUNTS)

    @property
    def filters(self) -> DataFrame:
        return self._table("filters", FILTERS)

    def insert(self, docs: DataFrame) -> None:
        """Adds documents; what the index already holds of them is not counted again."""
        new = line_keys(docs, self.min_chars).distinct()
        self._change(self.refs.union(new).distinct() if self.generation else new)

    def delete(self, ids: DataFrame) -> None:
        """Takes out the documents whose ``doc_id`` is in ``ids``."""
        self._change(self.refs.join(ids.select("doc_id").distinct(), "doc_id", "left_anti"))

    def _change(self, refs: DataFrame) -> None:
        """Writes the next generation, its manifest last."""
        name = f"generation-{self.generation + 1}-{uuid.uuid4().hex}"
        refs = self._write(name, "refs", REFS, refs)
        counts = self._write(name, "counts", COUNTS, self._count(refs))
        wanted = max(1, -(-refs.count() // SHARD_KEYS))
        afresh = not self.generation or wanted > 2 * self.shards
        if afresh:
            self.shards = wanted
        self._write(name, "filters", FILTERS, self._filters(None if afresh else self.counts, counts))
        entry = self.spark.range(1).select(
            F.lit(self.generation + 1).cast("long").alias("generation"), F.lit(name).alias("name"),
            F.lit(self.shards).cast("long").alias("shards"), F.lit(self.min_chars).alias("min_chars"), F.lit(self.min_docs).alias("min_docs"),
        )
        entry.coalesce(1).write.parquet(f"{self.folder}/manifests/{name}")
        self.generation, self.name = self.generation + 1, name

    def _write(self, generation: str, name: str, schema: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{generation}/{name}"
        df.select(*T._parse_datatype_string(schema).names).write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def _count(self, refs: DataFrame) -> DataFrame:
        counts = refs.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
        return counts.where(F.col("n_docs") >= min(2, self.min_docs))

    def _shard(self):
        return F.pmod("high", F.lit(self.shards)).alias("shard")

    def _repeated(self, counts: DataFrame) -> DataFrame:
        return counts.where(F.col("n_docs") >= self.min_docs)

    def _filters(self, old: DataFrame | None, new: DataFrame) -> DataFrame:
        """The filters, with keys that have come to ``min_docs`` added and those that fell below it removed.

        Without ``old`` counts they are built from all keys.
        """
        is_new = self._repeated(new).select("high", "low", F.lit(1).alias("step"))
        if old is None:
            before, changes = self.spark.createDataFrame([], FILTERS), is_new
        else:
            before = self.filters
            was = self._repeated(old).select("high", "low", F.lit(-1).alias("step"))
            changes = is_new.union(was).groupBy("high", "low").agg(F.sum("step").alias("step")).where("step != 0")

        def apply(key, filters: pa.Table, steps: pa.Table) -> pa.Table:
            blocks = filters.column("blocks").to_pylist()
            cuckoo = CuckooFilter(blocks[0] if blocks else None)
            high, low, step = (steps.column(c).to_numpy() for c in ("high", "low", "step"))
            cuckoo.remove(high[step < 0], low[step < 0])
            cuckoo.add(high[step > 0], low[step > 0])
            return pa.table(
                {"shard": pa.array([key[0].as_py()], pa.int64()), "blocks": pa.array([cuckoo.to_bytes()], pa.list_(pa.binary()))}
            )

        return (
            before.groupBy("shard")
            .cogroup(changes.select(self._shard(), "high", "low", "step").groupBy("shard"))
            .applyInArrow(apply, FILTERS)
        )

    def repeated(self, keys: DataFrame) -> DataFrame:
        """Of keys (high, low), each once, those that ``min_docs`` documents hold, with ``last_doc``."""

        def probe(filters: pa.Table, asked: pa.Table) -> pa.Table:
            asked = asked.select(["high", "low"])
            if not filters.num_rows:
                return asked.slice(0, 0)
            cuckoo = CuckooFilter(filters.column("blocks")[0].as_py())
            found = cuckoo.contains(asked.column("high").to_numpy(), asked.column("low").to_numpy())
            return asked.filter(pa.array(found))

        possible = (
            self.filters.groupBy("shard")
            .cogroup(keys.select(self._shard(), "high", "low").groupBy("shard"))
            .applyInArrow(probe, "high long, low long")
        )
        counts = self._repeated(self.counts)
        return possible.distinct().join(counts, ["high", "low"]).select("high", "low", "last_doc")

    def clean(self, docs: DataFrame) -> DataFrame:
        """``docs`` without the lines that repeat, but for those in the largest document that holds them."""
        docs = docs.drop("n_lines", "n_dropped")
        own = free_prefix(docs)
        lines = line_keys(docs, self.min_chars)
        last = self.repeated(asked_keys(docs, self.min_chars))
        drops = (
            lines.join(last, ["high", "low"])
            .where("doc_id < last_doc")
            .groupBy(F.col("doc_id").alias(f"{own}doc"))
            .agg(F.collect_set(F.struct("high", "low")).alias(f"{own}drop"))
        )
        joined = docs.join(drops, F.col("doc_id") == F.col(f"{own}doc"), "left").drop(f"{own}doc")
        added = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
        min_chars = self.min_chars

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first in range(0, max(1, batch.num_rows), ROWS):
                    part = batch.slice(first, ROWS)
                    texts, before, dropped = [], [], []
                    column = part.schema.get_field_index("text")
                    for text, drop in zip(part.column(column), part.column(part.num_columns - 1), strict=True):
                        all_lines = (text.as_py() or "").split("\n")
                        keep = all_lines
                        if drop.is_valid:
                            gone = {np.array([k["high"], k["low"]], np.int64).tobytes() for k in drop.as_py()}
                            keep = [line for line in all_lines if line_key(line, min_chars) not in gone]
                        texts.append("\n".join(keep))
                        before.append(len(all_lines))
                        dropped.append(len(all_lines) - len(keep))
                    columns = list(part.columns[:-1])
                    columns[column] = pa.array(texts, pa.string())
                    columns += [pa.array(before, pa.int64()), pa.array(dropped, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:-1], "n_lines", "n_dropped"])

        return joined.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def dedup_lines(docs: DataFrame, folder: str, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Indexes ``docs`` in ``folder`` and returns them without their repeated lines."""
    index = LineIndex(docs.sparkSession, folder, min_chars, min_docs)
    index.insert(docs)
    return index.clean(docs)
