"""Nearest reference vector of every query vector by cosine.

Both sides are dealt to the leaves of several random-projection trees. A tree splits at the median of a random
projection of all references, so its leaves hold about equally many of them however crowded the vectors are. Within a
leaf the rows are cut in chunks, each pair of chunks is one matrix product that returns one best reference per query, and
a group-by keeps the best over all leaves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapproche.config import NeighbourConfig
from rapproche.functions.similarity import norm
from rapproche.functions.text import once
from rapproche.operators.skew import SkewLimits, lookup_join
from rapproche.session import stage

#: Bytes that a row of the chunk counts takes when broadcast.
CHUNK_BYTES = 48
#: A crowded cell is cut in so many chunks a side, each row being copied to as many, while a chunk's vectors stay below these
#: bytes; larger cells get more chunks, not larger ones.
CELL_CHUNKS = 16
CHUNK_VECTOR_BYTES = 64 * 1024 * 1024
#: Rows a side of the products that a pair of chunks is searched by, and what each component may add to the error of a score
#: in single precision: twice its rounding.
TILE_ROWS = 1024
SINGLE_ERROR = 2.0**-23

_BEST_SCHEMA = "query_id long, reference_id long, model_score double"


def unit_vectors(rows: DataFrame, id_name: str) -> DataFrame:
    """(id_name, vector) with vectors scaled to length one; those without length are dropped."""
    vector = F.transform("vector", lambda x: x.cast("double"))
    # given to the lambda as a value: a column's expression would be copied there and worked out for every component
    scaled = once(norm(F.col("vector")), lambda length: F.transform("vector", lambda x: x / length))
    return rows.select(id_name, vector.alias("vector")).where(norm(F.col("vector")) > 0).select(id_name, scaled.alias("vector"))


def distinct_references(references: DataFrame) -> DataFrame:
    """One row per distinct vector, under the smallest id that has it: copies would tie with it anyway."""
    return references.groupBy("vector").agg(F.min("reference_id").alias("reference_id")).select("reference_id", "vector")


@dataclass(frozen=True)
class Trees:
    """Random-projection trees: the upper levels' split points by tree in level order, those of deeper levels as tables.

    Every level of a tree has one direction, which follows from the seed. ``deeper`` holds (tree, node, split) per level
    beyond the upper ones.
    """

    count: int
    size: int
    seed: int
    upper: np.ndarray
    deeper: tuple[DataFrame, ...] = ()

    @property
    def depth(self) -> int:
        return int(np.log2(self.upper.shape[1] + 1)) + len(self.deeper)

    def direction(self, tree: int, level: int) -> np.ndarray:
        return direction(self.seed, tree, level, self.size)


def direction(seed: int, tree: int, level: int, size: int) -> np.ndarray:
    return np.random.default_rng([seed, tree, level]).standard_normal(size)


def _descend(vectors: np.ndarray, upper: np.ndarray, seed: int) -> np.ndarray:
    """Node of each vector in each tree below the levels of ``upper``, numbered within its level."""
    trees, points = upper.shape
    levels = int(np.log2(points + 1))
    result = np.zeros((len(vectors), trees), dtype=np.int64)
    for tree in range(trees):
        node = result[:, tree]
        for level in range(levels):
            above = vectors @ direction(seed, tree, level, vectors.shape[1]) > upper[tree, (1 << level) - 1 + node]
            node *= 2
            node += above
    return result


def _medians(values: DataFrame) -> DataFrame:
    """The median of all values of each (tree, node)."""
    return values.groupBy("tree", "node").agg(F.percentile_approx("value", 0.5, 10_000).alias("split"))


def _upper_values(rows: DataFrame, upper: np.ndarray, seed: int) -> DataFrame:
    """(tree, node, value): where each row stands in every tree, and its projection on that level's direction."""
    shared = rows.sparkSession.sparkContext.broadcast(upper)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above = shared.value
        trees, level = above.shape[0], int(np.log2(above.shape[1] + 1))
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch["vector"])
                nodes = _descend(vectors, above, seed)
                at = np.stack([direction(seed, t, level, vectors.shape[1]) for t in range(trees)])
                columns = (np.tile(np.arange(trees, dtype=np.int32), len(vectors)), nodes.reshape(-1), (vectors @ at.T).reshape(-1))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["tree", "node", "value"])

    return rows.select("vector").mapInArrow(project, "tree int, node long, value double")


def _with_values(placed: DataFrame, id_name: str, level: int, seed: int) -> DataFrame:
    """``placed`` (id, vector, tree, node) with the projection of each row on its tree's direction at ``level``."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors, trees = _matrix(batch["vector"]), batch["tree"].to_numpy()
                value = np.zeros(len(vectors))
                for tree in np.unique(trees):
                    own = trees == tree
                    value[own] = vectors[own] @ direction(seed, int(tree), level, vectors.shape[1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], [*batch.schema.names, "value"])

    rows = placed.select(id_name, "vector", "tree", "node")
    return rows.mapInArrow(project, f"{id_name} long, vector array<double>, tree int, node long, value double")


def _one_level_down(valued: DataFrame, id_name: str, splits: DataFrame) -> DataFrame:
    points = splits.select(F.col("tree").alias("_tree"), F.col("node").alias("_node"), "split")
    # a node that no reference reached has no split point, and nothing below it either
    joined = valued.join(points, (F.col("tree") == F.col("_tree")) & (F.col("node") == F.col("_node")))
    below = 2 * F.col("node") + (F.col("value") > F.col("split")).cast("long")
    return joined.select(id_name, "vector", "tree", below.alias("node"))


def grow_trees(references: DataFrame, config: NeighbourConfig, n: int | None = None) -> Trees:
    """Trees deep enough for leaves of about ``leaf_size`` references, split at the medians of all of them.

    Levels grow one by one. Split points of the upper levels are few enough to broadcast; where the references ask for
    more levels, rows are joined with their node's split point instead.
    """
    n = references.count() if n is None else n
    depth = max(0, int(np.ceil(np.log2(max(n, 1) / config.leaf_size))))
    count = config.trees if depth else 1  # one leaf holds all, in every tree alike
    size = references.select(F.size("vector")).first()[0] if depth else 1
    upper = np.zeros((count, 0))
    for level in range(min(depth, config.upper_levels)):
        points = np.zeros((count, 1 << level))
        for row in _medians(_upper_values(references, upper, config.seed)).collect():  # a row per node of the level
            points[row["tree"], row["node"]] = row["split"]
        upper = np.concatenate([upper, points], axis=1)
    trees = Trees(count, size, config.seed, upper)
    if depth <= config.upper_levels:
        return trees
    placed, splits = _in_upper(references, "reference_id", trees), []
    for level in range(config.upper_levels, depth):
        valued = stage(_with_values(placed, "reference_id", level, config.seed), "placed")
        splits.append(stage(_medians(valued), "splits"))
        placed = _one_level_down(valued, "reference_id", splits[-1])
    return Trees(count, size, config.seed, upper, tuple(splits))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equally long vectors as a matrix, without visiting its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(rows: np.ndarray, counts: np.ndarray | None = None) -> pa.Array:
    """A long list per row: of the matrix rows, or of runs of ``counts`` values."""
    counts = np.full(len(rows), rows.shape[1]) if counts is None else counts
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1), pa.int64()))


def _in_upper(rows: DataFrame, id_name: str, trees: Trees) -> DataFrame:
    """(id, vector, tree, node): one row per tree, placed by the upper levels."""
    shared, seed = rows.sparkSession.sparkContext.broadcast(trees.upper), trees.seed

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = shared.value
        for batch in batches:
            if batch.num_rows:
                nodes = _lists(_descend(_matrix(batch["vector"]), upper, seed))
                yield pa.RecordBatch.from_arrays([batch[id_name], batch["vector"], nodes], [id_name, "vector", "nodes"])

    return (
        rows.select(id_name, "vector")
        .mapInArrow(deal, f"{id_name} long, vector array<double>, nodes array<long>")
        .select(id_name, "vector", F.posexplode("nodes").alias("tree", "node"))
    )


def deal_to_leaves(rows: DataFrame, id_name: str, trees: Trees) -> DataFrame:
    """(id, vector, cell): one row per tree, ``cell`` naming tree and leaf."""
    placed = _in_upper(rows, id_name, trees)
    for level, splits in enumerate(trees.deeper, trees.depth - len(trees.deeper)):
        placed = _one_level_down(_with_values(placed, id_name, level, trees.seed), id_name, splits)
    leaf = F.col("tree").cast("long") * F.lit(1 << min(trees.depth, 48)) + F.col("node")
    return placed.select(id_name, "vector", leaf.alias("cell"))


def _chunk_counts(rows: DataFrame, name: str, chunk_rows: int, size: int) -> DataFrame:
    """Chunks each cell needs: of ``chunk_rows`` rows where these are few, else of larger ones up to the bound of bytes."""
    n = F.count("*")
    most = max(chunk_rows, CHUNK_VECTOR_BYTES // (8 * size))
    chunk = F.least(F.greatest(F.ceil(n / CELL_CHUNKS), F.lit(chunk_rows)), F.lit(most))
    return rows.groupBy("cell").agg(F.ceil(n / chunk).cast("int").alias(name))


def _best_rows(queries: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row of the best reference for each query, the first of equal ones, and its score, tile by tile.

    Scores in single precision tell which pairs may be the best; those are worked out in double precision. Where such
    pairs are many, the tile is. Vectors have length one.
    """
    at, top = np.zeros(len(queries), np.int64), np.full(len(queries), -np.inf)
    error = (queries.shape[1] + 4) * SINGLE_ERROR
    for first in range(0, len(queries), TILE_ROWS):
        own = queries[first : first + TILE_ROWS]
        small, best, best_at = own.astype(np.float32), top[first : first + TILE_ROWS], at[first : first + TILE_ROWS]
        for low in range(0, len(references), TILE_ROWS):
            other = references[low : low + TILE_ROWS]
            scores = small @ other.astype(np.float32).T
            high = scores.max(axis=1)
            rows = np.flatnonzero(~(high < best - error))
            if not len(rows):
                continue
            row, column = np.nonzero(scores[rows] >= (np.maximum(high[rows], best[rows]) - 2 * error)[:, None])
            if len(row) <= 16 * len(rows) and np.isfinite(high[rows]).all():
                exact = np.einsum("ij,ij->i", own[rows[row]], other[column])
                order = np.lexsort((column, -exact, row))
                row, column, exact = row[order], column[order], exact[order]
                one = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])[: len(row)])
                rows, column, exact = rows[row[one]], column[one], exact[one]
            else:
                whole = np.einsum("ij,kj->ik", own[rows], other)  # adds up as above, so that equal references tie
                column = whole.argmax(axis=1)
                exact = whole[np.arange(len(rows)), column]
            better = (exact > best[rows]) | (np.isnan(exact) & ~np.isnan(best[rows]))
            best[rows[better]], best_at[rows[better]] = exact[better], low + column[better]
    return at, top


def best_in_cells(
    queries: DataFrame, references: DataFrame, chunk_rows: int, limits: SkewLimits = SkewLimits()
) -> DataFrame:
    """Best reference of each query among those that share a cell with it: (query_id, reference_id, model_score).

    Each pair of chunks is one group, so a crowded cell becomes many groups. A row is copied to all chunks of the other
    side; so chunks grow with the cell up to a bound of bytes. Ties go to the smallest reference id. The chunk counts, a
    row per cell, are broadcast if their number allows.
    """
    head = references.select(F.size("vector")).first()
    size = max(1, head[0]) if head else 1
    counts = _chunk_counts(queries, "_nq", chunk_rows, size).join(_chunk_counts(references, "_nr", chunk_rows, size), "cell")
    chunks = stage(counts.withColumnRenamed("cell", "_cell"), "chunks")

    def dealt(rows: DataFrame, id_name: str, own: str, other: str, own_chunk: str, other_chunk: str) -> DataFrame:
        return lookup_join(rows, chunks, "cell", "_cell", CHUNK_BYTES, limits=limits).select(
            id_name,
            "vector",
            "cell",
            F.pmod(F.xxhash64(id_name, F.lit(7)), F.col(own)).cast("int").alias(own_chunk),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other_chunk),
        )

    q = dealt(queries, "query_id", "_nq", "_nr", "_q", "_r").groupBy("cell", "_q", "_r")
    r = dealt(references, "reference_id", "_nr", "_nq", "_r", "_q").groupBy("cell", "_q", "_r")

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = right["reference_id"].to_numpy()
        if not len(ids) or not left.num_rows:
            empty = {"query_id": pa.array([], pa.int64()), "reference_id": pa.array([], pa.int64())}
            return pa.table({**empty, "model_score": pa.array([], pa.float64())})
        order = np.argsort(ids, kind="stable")
        at, top = _best_rows(_matrix(left["vector"]), _matrix(right["vector"])[order])
        return pa.table({"query_id": left["query_id"], "reference_id": ids[order][at], "model_score": top})

    return top_match(q.cogroup(r).applyInArrow(best, _BEST_SCHEMA))


def top_match(candidates: DataFrame) -> DataFrame:
    """Best-scored reference of each query, ties to the smaller id; partial maxima are formed before the shuffle."""
    best = F.max(F.struct("model_score", (-F.col("reference_id")).alias("_minus_id"))).alias("_best")
    return candidates.groupBy("query_id").agg(best).select(
        "query_id", (-F.col("_best._minus_id")).alias("reference_id"), F.col("_best.model_score").alias("model_score")
    )


def above(candidates: DataFrame, threshold: float) -> DataFrame:
    return candidates.where(F.col("model_score") > threshold)


def nearest(
    queries: DataFrame,
    references: DataFrame,
    config: NeighbourConfig = NeighbourConfig(),
    threshold: float | None = None,
) -> DataFrame:
    """Nearest reference of each query: (query_id, reference_id, model_score), only scores over ``threshold`` if given.

    Input has (query_id, vector) and (reference_id, vector). Approximate once the references outgrow a leaf; with
    ``exact`` the approximate scores only serve to rule cells out, and the result is the true nearest.
    """
    spark = queries.sparkSession
    q = stage(unit_vectors(queries, "query_id"), "queries")  # read twice, to be counted and to be dealt
    r = stage(distinct_references(unit_vectors(references, "reference_id")), "references")
    n = r.count()
    if n == 0:
        return spark.createDataFrame([], _BEST_SCHEMA)
    trees = grow_trees(r, config, n)
    found = best_in_cells(
        deal_to_leaves(q, "query_id", trees), deal_to_leaves(r, "reference_id", trees), config.chunk_rows
    )
    if config.exact and trees.depth:
        found = _exact(q, r, stage(found, "nearby"), config, n, threshold)
    return found if threshold is None else above(found, threshold)


@dataclass(frozen=True)
class Pivots:
    """Centres on two levels: groups, and cells that belong to a group each (ordered by group, from ``first[g]`` on)."""

    groups: np.ndarray
    cells: np.ndarray
    first: np.ndarray


def _chosen(references: DataFrame, count: int, seed: int) -> np.ndarray:
    """``count`` reference vectors, chosen by a hash of their id."""
    order = references.select("vector", F.xxhash64("reference_id", F.lit(seed)).alias("_order"), "reference_id")
    rows = order.orderBy("_order", "reference_id").limit(count).toArrow()
    return _matrix(rows["vector"])


def choose_pivots(references: DataFrame, n: int, config: NeighbourConfig) -> Pivots:
    """About the fourth root of ``n`` groups and the square root of ``n`` cells, so that either level costs alike.

    ``pivot_bytes`` bounds what every task holds: 64 MB are cells for 6 thousand million references of 100 components.
    """
    size = references.select(F.size("vector")).first()[0]
    most = max(1, config.pivot_bytes // (8 * size))
    cells = min(most, int(np.ceil(np.sqrt(n))))
    chosen = _chosen(references, cells, config.seed + 1)
    groups = chosen[: int(np.ceil(np.sqrt(len(chosen))))]
    owner = (chosen @ groups.T).argmax(axis=1)
    order = np.argsort(owner, kind="stable")
    first = np.searchsorted(owner[order], np.arange(len(groups) + 1))
    return Pivots(groups, chosen[order], first)


def _angles(scores: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(scores, -1, 1))


def _nearest_pivot(rows: DataFrame, pivots: Pivots) -> DataFrame:
    """(reference_id, vector, cell, angle, group, group_angle): each reference's closest group, and its closest cell there."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch["vector"])
                scores = vectors @ held.groups.T
                group = scores.argmax(axis=1)
                wide = _angles(scores[np.arange(len(group)), group])
                cell, angle = np.zeros(len(group), np.int64), np.zeros(len(group))
                for g in np.unique(group):
                    own, (low, high) = group == g, held.first[g : g + 2]
                    near = vectors[own] @ held.cells[low:high].T
                    at = near.argmax(axis=1)
                    cell[own], angle[own] = low + at, _angles(near[np.arange(len(at)), at])
                columns = [batch["reference_id"], batch["vector"], *map(pa.array, (cell, angle, group, wide))]
                yield pa.RecordBatch.from_arrays(columns, ["reference_id", "vector", "cell", "angle", "group", "group_angle"])

    schema = "reference_id long, vector array<double>, cell long, angle double, group long, group_angle double"
    return rows.mapInArrow(assign, schema)


def _ranges(placed: DataFrame, key: str, angle: str, count: int) -> np.ndarray:
    """Smallest and largest angle between a centre and what belongs to it; empty centres get an empty range."""
    out = np.array([[np.inf, -np.inf]] * count)
    found = placed.groupBy(key).agg(F.min(angle).alias("low"), F.max(angle).alias("high")).toPandas()
    out[found[key].to_numpy(np.int64)] = found[["low", "high"]].to_numpy()
    return out


def _reachable(vectors: np.ndarray, centres: np.ndarray, ranges: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Whether a centre's range of angles leaves room for a reference at least as close as ``best``.

    By the triangle inequality for angles nothing of a centre is closer to a query than the query's angle to the centre
    lies outside the range.
    """
    angle = _angles(vectors @ centres.T)
    outside = np.maximum(np.maximum(ranges[:, 0] - angle, angle - ranges[:, 1]), 0.0)
    return np.cos(np.minimum(outside, np.pi)) >= best[:, None] - 1e-9


def _exact(
    queries: DataFrame, references: DataFrame, found: DataFrame, config: NeighbourConfig, n: int, threshold: float | None
) -> DataFrame:
    """The true nearest, given good candidates.

    Groups, and then the cells of the groups left, are skipped where they cannot reach the query's best so far; the
    references of all other cells are searched in full.
    """
    pivots = choose_pivots(references, n, config)
    placed = stage(_nearest_pivot(references, pivots), "placed")
    group_ranges = _ranges(placed, "group", "group_angle", len(pivots.groups))
    cell_ranges = _ranges(placed, "cell", "angle", len(pivots.cells))
    shared = queries.sparkSession.sparkContext.broadcast((pivots, group_ranges, cell_ranges))
    floor = -2.0 if threshold is None else threshold
    best_so_far = F.greatest(F.coalesce(F.col("model_score"), F.lit(-2.0)), F.lit(floor))
    bounded = queries.join(found.select("query_id", "model_score"), "query_id", "left").select(
        "query_id", "vector", best_so_far.alias("best")
    )

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, wide, narrow = shared.value
        for batch in batches:
            if batch.num_rows:
                vectors, best = _matrix(batch["vector"]), batch["best"].to_numpy()
                open_groups = _reachable(vectors, held.groups, wide, best)
                hits = []
                for g in np.flatnonzero(open_groups.any(axis=0)):
                    own, (low, high) = np.flatnonzero(open_groups[:, g]), held.first[g : g + 2]
                    near = np.nonzero(_reachable(vectors[own], held.cells[low:high], narrow[low:high], best[own]))
                    hits.append(np.stack([own[near[0]], low + near[1]]))
                row, cell = np.concatenate(hits, axis=1) if hits else np.zeros((2, 0), np.int64)
                order = np.argsort(row, kind="stable")
                cells = _lists(cell[order], np.bincount(row, minlength=len(best)))
                yield pa.RecordBatch.from_arrays(
                    [batch["query_id"], batch["vector"], cells], ["query_id", "vector", "cells"]
                )

    visits = bounded.mapInArrow(visit, "query_id long, vector array<double>, cells array<long>").select(
        "query_id", "vector", F.explode("cells").alias("cell")
    )
    searched = best_in_cells(visits, placed.select("reference_id", "vector", "cell"), config.chunk_rows)
    return top_match(found.unionByName(searched))
