"""Byte strings of a fixed length that occur more than once, by a radix sort of suffixes that stops at that length.

A suffix is sorted by its first ``length`` bytes. The sort key is those bytes read from the suffix's anchor outwards: the
anchor is the ``ANCHOR`` bytes with the smallest hash (the leftmost of equals), which equal strings have at the same
place. Consecutive suffixes with one anchor differ only in the anchor's place, so they travel as one run, cut finer from
pass to pass, most significant digit first:

1. the digit is the anchor. A run alone with its anchor holds no repeated string and is done;
2. the digit is the run's whole text. Runs equal in it are repeated from end to end; one of them stays for comparison
   where their anchor has other texts;
3. runs are cut where the anchor's place passes a multiple of ``GRID``. The digit is the text that all strings of the
   part have in common; parts alone in it are done, parts equal in their whole text are repeated;
4. what is left is cut in single strings, whose last digit is the rest of their bytes.

Groups still equal then are exactly the repeated strings. Digits are 64-bit hashes; as every key holds the digits before
it too, strings are compared by 128 bits. A pass counts digits by a grouped sum, writes the counts, and joins them back,
so no group is collected, however large.

Null text is empty. Rows are told apart by id and a hash of their text, rows without id by 96 bits of it; repeated rows
are rows of their own, and so repeat each other. Texts longer than ``CHUNK`` are hashed in overlapping chunks. Other
columns are passed on; columns named like the results are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rapproche.llm.batches import arrow_rows
from rapproche.llm.words import BASE, BASE_INVERSE, mix, powers, slices
from rapproche.session import stage

LENGTH = 200
ANCHOR = 32
GRID = 16
#: Bytes of text hashed at once.
CHUNK = 1 << 20

#: A random number per byte value, for two hashes.
DIGITS = mix(np.arange(512, dtype=np.uint64) + np.uint64(1 << 20)).reshape(2, 256)

RUN = "key long, tag int, at long, shape int, anchor long, body long"
RESULTS = ("n_bytes", "n_removed", "spans", "kept")


class Spans:
    """Hashes of any spans of some bytes."""

    def __init__(self, raw: np.ndarray):
        self.inverse = powers(BASE_INVERSE, len(raw) + 1)
        power = powers(BASE, len(raw))
        self.sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(d[raw] * power)]) for d in DIGITS]

    def hash(self, number: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums = self.sums[number]
        return mix((sums[end] - sums[start]) * self.inverse[start] ^ (end - start).astype(np.uint64))


def _least(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of every ``width`` consecutive values, the leftmost of equals; ``width`` is 256 at most.

    Minima from both ends of blocks of that width: a window is the end of one block and the start of the next.
    """
    n = len(hashes) - width + 1
    blocks = -(-len(hashes) // width)
    keys = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    keys[: len(hashes)] = hashes
    keys = (keys & ~np.uint64(255)).reshape(blocks, width) | np.arange(width, dtype=np.uint64)
    head = np.minimum.accumulate(keys, axis=1).reshape(-1)[width - 1 : width - 1 + n]
    tail = np.minimum.accumulate(keys[:, ::-1], axis=1)[:, ::-1].reshape(-1)[:n]
    start = np.arange(n)
    later = head >> np.uint64(8) < tail >> np.uint64(8)
    block = np.where(later, start + width - 1, start) // width
    return block * width + (np.where(later, head, tail) & np.uint64(255)).astype(np.int64)


def runs_of(raw: np.ndarray, bounds: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of the strings within ``bounds`` of ``raw``: text, first string, strings, anchor's place, two hashes."""
    empty = np.zeros(0, np.int64)
    if len(raw) < length:
        return empty, empty, empty, empty, empty, empty
    spans = Spans(raw)
    grams = np.arange(len(raw) - anchor + 1)
    hashes = spans.hash(0, grams, grams + anchor)
    place = _least(hashes, length - anchor + 1)
    inside = np.zeros(len(place) + 1, np.int64)
    full = np.diff(bounds) >= length
    np.add.at(inside, bounds[:-1][full], 1)
    np.add.at(inside, bounds[1:][full] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    place = place[start]
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])[: len(place)])
    count = np.diff(np.append(first, len(place)))
    start, place = start[first], place[first]
    shape = count * 256 + place - start
    body = mix(spans.hash(1, start, start + count - 1 + length) ^ mix(shape.astype(np.uint64)))
    text = np.searchsorted(bounds, start, "right") - 1
    return text, start, count, place, hashes[place].view(np.int64), body.view(np.int64)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins (and the last ends)."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def suffix_runs(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """All runs of (key, tag, text): where a run begins, its strings and the anchor's place in the first (``shape``)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column(2), CHUNK):
                part = batch.slice(first, last - first)
                raw, bounds = _bytes(part.column(2))
                step = CHUNK if len(raw) > 2 * CHUNK else max(1, len(raw))  # then it is one text
                for base in range(0, max(1, len(raw)), step):
                    chunk = raw[base : base + step + length - 1]
                    own = bounds if step >= len(raw) else np.array([0, len(chunk)])
                    text, start, count, place, *digits = runs_of(chunk, own, length, anchor)
                    taken = part.select([0, 1]).take(pa.array(text))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *taken.columns, pa.array(start - own[text] + base),
                            pa.array((count * 256 + place - start).astype(np.int32)), *map(pa.array, digits),
                        ],
                        names=["key", "tag", "at", "shape", "anchor", "body"],
                    )

    return texts.mapInArrow(run, RUN)


def run_texts(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, body, copies, key, tag, at, shape, bytes) of the runs that ``texts`` lists in its column ``runs``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = (batch.column(2)[i].as_py() or "").encode()
                found = pa.RecordBatch.from_struct_array(batch.column(3)[i].values)
                at = found.column(3).to_numpy()
                end = at + (found.column(4).to_numpy() >> 8) - 1 + length
                cut = pa.array([raw[a:b] for a, b in zip(at.tolist(), end.tolist(), strict=True)], pa.binary())
                for first in range(0, found.num_rows, 4096):
                    own = found.slice(first, 4096)
                    same = [pa.repeat(batch.column(k)[i], own.num_rows) for k in (0, 1)]
                    yield pa.RecordBatch.from_arrays(
                        [*own.columns[:3], *same, *own.columns[3:], cut.slice(first, 4096)],
                        names=["anchor", "body", "copies", "key", "tag", "at", "shape", "bytes"],
                    )

    return texts.mapInArrow(run, "anchor long, body long, copies long, key long, tag int, at long, shape int, bytes binary")


def _cut(anchor: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, first and last anchor's place of the parts in which places ``low`` to ``high`` are cut at multiples of GRID."""
    n = high // GRID - low // GRID + 1
    row = np.repeat(np.arange(len(n)), n)
    grid = low[row] // GRID + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return row, np.maximum(low[row], grid * GRID), np.minimum(high[row], grid * GRID + GRID - 1)


def run_parts(contexts: DataFrame, length: int, anchor: int) -> DataFrame:
    """Parts of runs with two digits: the text common to all strings of the grid cell, and the part's whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = _bytes(batch.column(3))
            spans = Spans(raw)
            shape = batch.column(2).to_numpy().astype(np.int64)
            high = shape & 255
            row, low, top = _cut(bounds[:-1], high - (shape >> 8) + 1, high)
            place = bounds[row] + high[row]  # of the anchor
            cell = low // GRID * GRID
            core = spans.hash(0, place - cell, place - np.minimum(cell + GRID - 1, length - anchor) + length)
            whole = spans.hash(1, place - top, place - low + length) ^ mix((low * 256 + top).astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(pa.array(row)) for k in (0, 1)), *(pa.array(x.astype(np.int32)) for x in (low, top)), pa.array(core.view(np.int64)), pa.array(mix(whole).view(np.int64))],
                names=["anchor", "body", "low", "high", "core", "whole"],
            )

    out = "anchor long, body long, low int, high int, core long, whole long"
    return contexts.select("anchor", "body", "shape", "bytes").mapInArrow(run, out)


def single_strings(parts: DataFrame, length: int) -> DataFrame:
    """Every string of the parts (anchor, body, shape, bytes, low, high) with the anchor's place and a hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = _bytes(batch.column(3))
            spans = Spans(raw)
            low, top = (batch.column(k).to_numpy().astype(np.int64) for k in (4, 5))
            n = top - low + 1
            row = np.repeat(np.arange(len(n)), n)
            place = low[row] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = bounds[row] + (batch.column(2).to_numpy().astype(np.int64) & 255)[row] - place
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(pa.array(row)) for k in (0, 1)), pa.array(place.astype(np.int32)), pa.array(spans.hash(1, start, start + length).view(np.int64))],
                names=["anchor", "body", "low", "string"],
            )

    rows = parts.select("anchor", "body", "shape", "bytes", "low", "high")
    return rows.mapInArrow(run, "anchor long, body long, low int, string long")


def _keyed(docs: DataFrame) -> tuple[Column, Column]:
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("key"), F.hash("text").alias("tag")


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(key, tag, found): per row with repeated strings, spans (start, end) in bytes, which may overlap."""
    if not length - 256 < anchor <= length:
        raise ValueError("an anchor must leave at most 256 places in a string")
    texts = docs.select(*_keyed(docs), "text")
    runs = suffix_runs(texts, length, anchor)
    # first digit
    shared = stage(runs.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    left = stage(runs.join(shared, "anchor"), "runs")
    # second digit
    one = F.min(F.struct("key", "tag", "at", "shape")).alias("one")
    bodies = stage(left.groupBy("anchor", "body").agg(F.count(F.lit(1)).alias("copies"), one), "bodies")
    several = stage(bodies.groupBy("anchor").count().where("count > 1").select("anchor"), "several")
    equal = left.join(bodies.where("copies > 1").select("anchor", "body"), ["anchor", "body"])
    whole = equal.select("key", "tag", F.col("at").alias("start"), (F.col("at") + F.expr("shape >> 8") - 1 + length).alias("end"))
    opened = bodies.join(several, "anchor").select("anchor", "body", "copies", "one.*")
    listed = opened.groupBy(F.col("key").alias("_key"), F.col("tag").alias("_tag")).agg(
        F.collect_list(F.struct("anchor", "body", "copies", "at", "shape")).alias("runs")
    )
    owners = (F.col("key") == F.col("_key")) & (F.col("tag") == F.col("_tag"))
    one_row = texts.join(stage(listed, "listed"), owners)  # rows that repeat an id and text give the same run again
    contexts = run_texts(one_row.select("key", "tag", "text", "runs"), length)
    contexts = stage(contexts.dropDuplicates(["anchor", "body"]), "run-texts")
    # third digit
    parts = stage(run_parts(contexts, length, anchor), "parts")
    cell = F.floor(F.col("low") / GRID).alias("cell")
    parts = parts.withColumn("cell", cell)
    cores = parts.groupBy("anchor", "cell", "core").agg(F.count(F.lit(1)).alias("n"), (F.min("whole") != F.max("whole")).alias("differ"))
    alive = stage(parts.join(stage(cores.where("n > 1").drop("n"), "cores"), ["anchor", "cell", "core"]), "alive")
    same = stage(
        alive.groupBy("anchor", "whole").agg(F.count(F.lit(1)).alias("n"), F.first("differ").alias("differ"), F.min(F.struct("body", "low", "high")).alias("one")),
        "equal-parts",
    )
    settled = alive.join(same.where("n > 1").select("anchor", "whole"), ["anchor", "whole"]).select("anchor", "body", "low", "high")
    # last digit
    still = same.where("differ").select("anchor", "one.*")
    strings = stage(single_strings(still.join(contexts.select("anchor", "body", "shape", "bytes"), ["anchor", "body"]), length), "strings")
    twice = stage(strings.groupBy("anchor", "low", "string").count().where("count > 1").drop("count"), "twice")
    single = strings.join(twice, ["anchor", "low", "string"]).select("anchor", "body", "low", F.col("low").alias("high"))
    # back to places in texts; runs with copies are whole spans already
    place = F.col("at") + F.expr("shape & 255")
    some = stage(settled.union(single), "some").join(contexts.where("copies = 1").drop("copies", "bytes"), ["anchor", "body"])
    some = some.select("key", "tag", (place - F.col("high")).alias("start"), (place - F.col("low") + length).alias("end"))
    every = whole.union(some).groupBy(F.col("key").alias("_key"), F.col("tag").alias("_tag"))
    return stage(every.agg(F.collect_set(F.struct("start", "end")).alias("_found")), "spans")


def merged(found: np.ndarray) -> np.ndarray:
    """Maximal spans covered by the spans ``found`` (start, end)."""
    found = found[np.argsort(found[:, 0], kind="stable")]
    reach = np.maximum.accumulate(found[:, 1])
    first = np.flatnonzero(np.concatenate([[True], found[1:, 0] > reach[:-1]])[: len(found)])
    return np.column_stack([found[first, 0], reach[np.append(first[1:], len(found)) - 1]])


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, the removed ``spans`` (start, end) and the bytes ``kept``."""
    docs = docs.drop(*RESULTS)
    rows = docs.select(F.struct(*docs.columns).alias("row"), *_keyed(docs))
    found = repeated_spans(docs, length, anchor)
    joined = rows.join(found, (F.col("key") == F.col("_key")) & (F.col("tag") == F.col("_tag")), "left")
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    fields = [T.LongType(), T.LongType(), T.ArrayType(span), T.BinaryType()]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, k in zip(RESULTS, fields, strict=True)]])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    place = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.column(0).flatten()
            sizes, gone, spans, kept = [], [], [], []
            for i in range(batch.num_rows):
                raw = (columns[place][i].as_py() or "").encode()
                own = np.zeros((0, 2), np.int64)
                if batch.column(1)[i].is_valid:
                    own = merged(np.column_stack([f.to_numpy() for f in batch.column(1)[i].values.flatten()]))
                edges = [0, *own.reshape(-1).tolist(), len(raw)]
                sizes.append(len(raw))
                gone.append(int((own[:, 1] - own[:, 0]).sum()))
                spans.append([{"start": a, "end": b} for a, b in own.tolist()])
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                names=schema.fieldNames(),
            )

    return joined.select("row", "_found").mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """Sizes and digest per document."""
    with arrow_rows(docs.sparkSession, 1000):
        cleaned = remove_repeats(docs.select("doc_id", "text"))
        found = cleaned.select(
            "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
        )
        return stage(found, "repeats-removed")  # written here, where batches are small
