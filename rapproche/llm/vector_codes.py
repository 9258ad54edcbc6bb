"""Product codes of vectors, with the nearest codebook entry found by Orchard's search.

Components become integers, vectors are cut in ``PARTS`` consecutive parts, and every part position has a codebook of at
most ``ENTRIES`` entries, which starts as those parts of the smallest ids. A round assigns every part to its nearest
entry and replaces each entry by the floored mean of its parts; unused entries stay. The sums of a round are formed in
the tasks and added up by a grouped sum, so only the codebooks, of a fixed size, come to the driver.

The search keeps for every entry the list of the others by distance. It walks the list of the best entry so far, jumps
to the list of an entry that is nearer (or as near with a lower index), skips entries marked as visited, and stops where
the list is beyond twice the best distance: by the triangle inequality no nearer or equal entry follows. All distances
are integers, so equal ones are seen as equal.

Vectors that are null or hold null or non-finite components are dropped; so are vectors of another length than the first
entry's, if lengths differ. Rows without id or label are coded like others, but a row without id starts no entry; rows
that repeat an id are rows of their own, started from in the order of their components. Without a usable id the result
is empty. A length that the number of parts does not divide, or components whose squared distance would leave 64 bits,
raise a ValueError. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rapproche.session import stage

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Vectors searched at once.
BLOCK = 4096


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(-1)


@dataclass(frozen=True)
class Codebook:
    """Entries of one part position, and for every entry the others in the order of their distance (ties by index)."""

    entries: np.ndarray
    order: np.ndarray
    gaps: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray) -> Codebook:
        n = len(entries)
        gaps = np.stack([squares(entries, e) for e in entries])
        order = np.argsort(gaps, axis=1, kind="stable")
        order = order[order != np.arange(n)[:, None]].reshape(n, n - 1)
        return cls(entries, order, np.take_along_axis(gaps, order, 1))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each point's nearest entry, the lowest index among equals."""
        n, last = len(points), self.order.shape[1]
        best = self.guess(points)
        distance = squares(points, self.entries[best])
        place = np.zeros(n, np.int64)
        visited = np.zeros((n, len(self.entries)), bool)
        visited[np.arange(n), best] = True
        active = np.arange(n if last else 0)
        while len(active):
            at = place[active]
            active = active[self.gaps[best[active], at] <= 4 * distance[active]]  # squared: twice the distance
            entry = self.order[best[active], place[active]]
            place[active] += 1
            fresh = ~visited[active, entry]
            rows, entry = active[fresh], entry[fresh]
            visited[rows, entry] = True
            found = squares(points[rows], self.entries[entry])
            nearer = (found < distance[rows]) | ((found == distance[rows]) & (entry < best[rows]))
            moved = rows[nearer]
            best[moved], distance[moved], place[moved] = entry[nearer], found[nearer], 0
            active = active[place[active] < last]
        return best, distance

    def guess(self, points: np.ndarray) -> np.ndarray:
        """An entry to start from: one whose first component is next to the point's."""
        first = np.argsort(self.entries[:, 0], kind="stable")
        return first[np.minimum(np.searchsorted(self.entries[first, 0], points[:, 0]), len(first) - 1)]


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector): usable rows of ``vectors`` with components as integers ``floor(SCALE * x)``."""
    exact = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", exact.alias("vector"))
    rows = rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0)).where(finite)
    most = 2.0**53 / SCALE  # floor() to 64 bits is exact below it; larger ones fail the check of squared distances
    floors = F.transform("vector", lambda x: F.floor(F.least(F.greatest(x, F.lit(-most)), F.lit(most)) * SCALE))
    return rows.select("vec_id", "label", floors.alias("vector"))


def starts(rows: DataFrame, entries: int = ENTRIES, parts: int = PARTS) -> list[np.ndarray]:
    """The codebooks to start with: parts of the vectors with the smallest ids."""
    first = rows.where("vec_id is not null").orderBy("vec_id", "vector").limit(entries).collect()
    if not first:
        return []
    size = len(first[0]["vector"])
    if size % parts:
        raise ValueError(f"{parts} parts do not divide vectors of {size} components")
    matrix = np.array([r["vector"] for r in first if len(r["vector"]) == size], np.int64)
    return list(matrix.reshape(len(matrix), parts, -1).transpose(1, 0, 2))


def _blocks(batches: Iterable[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK):
            rows = batch.slice(first, BLOCK)
            flat = rows.column(rows.schema.get_field_index("vector")).flatten().to_numpy()
            yield rows, flat.reshape(rows.num_rows, parts, -1)


def _updated(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round over all rows."""
    size = books[0].shape[1]

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Codebook.of(b) for b in books]
        total = np.zeros((len(books), len(books[0]), size + 1), np.int64)  # the last place counts
        for _, points in _blocks(batches, len(books)):
            for part, book in enumerate(held):
                entry, _ = book.nearest(points[:, part])
                np.add.at(total[part], entry, np.column_stack([points[:, part], np.ones(len(entry), np.int64)]))
        part, entry = np.nonzero(total[:, :, size])
        columns = [np.repeat(part, size + 1), np.repeat(entry, size + 1), np.tile(np.arange(size + 1), len(part)), total[part, entry].reshape(-1)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "entry", "place", "total"])

    sums = rows.mapInArrow(add, "part long, entry long, place long, total long")
    table = sums.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).toPandas()
    out = [b.copy() for b in books]
    for (part, entry), found in table.sort_values("place").groupby(["part", "entry"]):  # as many as the codebooks hold
        *totals, n = (int(x) for x in found["total"])
        out[part][entry] = [t // n for t in totals]
    return out


def train(rows: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES, parts: int = PARTS) -> list[np.ndarray]:
    """Codebooks by part position, from a table as :func:`integers` gives it, which is read once per round."""
    books = starts(rows, entries, parts)
    for _ in range(rounds if books else 0):
        books = _updated(rows, books)
    return books


def encode(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``rows`` (with ``vector``) and two more columns: ``code``, two hex digits a part, and ``error``."""
    rows = rows.drop("code", "error")
    fields = [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Codebook.of(b) for b in books]
        for part, points in _blocks(batches, len(books)):
            found = [book.nearest(points[:, i]) for i, book in enumerate(held)]
            codes = np.column_stack([f[0] for f in found]).astype(np.uint8)
            text = [bytes(c).hex() for c in codes]
            error = np.sum([f[1] for f in found], axis=0)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(text, pa.string()), pa.array(error)], names=[*part.schema.names, "code", "error"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *fields]))


def decode(coded: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``coded`` with ``approximation``: the entries that ``code`` names, as integers."""
    table = [b.tolist() for b in books]
    rebuilt = F.flatten(
        F.array(*[
            F.element_at(
                F.array(*[F.array(*map(F.lit, entry)) for entry in book]),
                F.conv(F.substring("code", 2 * i + 1, 2), 16, 10).cast("int") + 1,
            )
            for i, book in enumerate(table)
        ])
    )
    return coded.withColumn("approximation", rebuilt)


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def digests(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES, parts: int = PARTS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) per usable row."""
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    rows = stage(integers(vectors), "integers")
    first = rows.where("vec_id is not null").orderBy("vec_id", "vector").select(F.size("vector")).first()
    if first is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("vector") == first[0])
    most = rows.agg(F.max(F.array_max(F.transform("vector", lambda x: F.abs(x))))).first()[0]
    if 4 * most**2 * first[0] >= 1 << 63:
        raise ValueError(f"components up to {most / SCALE} are too large for squared distances of 64 bits")
    books = train(rows, rounds, entries, parts)
    coded = stage(encode(rows, books).drop("vector"), "codes")
    errors = stage(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    joined = coded.join(errors, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
