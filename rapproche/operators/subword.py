"""A unigram subword vocabulary, trained and applied with Spark.

Words are counted once; each training step then weighs all cuttings of the distinct words in parallel and adds up expected
piece counts by a shuffle. Only the piece table, whose size the configuration bounds, visits the driver and is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rapproche.config import SubwordConfig
from rapproche.operators.lattice import Lattice, Trie
from rapproche.session import stage

WORD_START = "▁"
MIN_EXPECTED = 0.5
#: Occurrences of a substring that make it a seed.
MIN_COUNT = 2
#: Words that a task keeps with their pieces.
STORE = 200_000
#: Signs of texts that a task cuts at once, unless one text has more.
TEXT_SIGNS = 1 << 20

PIECE_SCHEMA = T.StructType([T.StructField("piece", T.StringType()), T.StructField("score", T.DoubleType())])


def word_counts(corpus: DataFrame) -> DataFrame:
    """Distinct words of the ``text`` column, each with its start mark, and how often they occur."""
    words = F.explode(F.split("text", " ")).alias("word")
    return (
        corpus.select(words)
        .where("word <> ''")
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .select(F.concat(F.lit(WORD_START), F.col("word")).alias("word"), "n")
    )


def covered_characters(words: DataFrame, coverage: float) -> DataFrame:
    """Most frequent characters that together make up ``coverage`` of the text: (piece, n).

    One row per distinct character reaches the window, of which Unicode has about a million.
    """
    counts = (
        words.select(F.explode(F.split("word", "")).alias("piece"), "n")
        .where("piece <> ''")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.orderBy(F.desc("n"), "piece")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("_before", before).where(F.col("_before") < total * coverage).select("piece", "n")


def _levels(longest: int) -> list[tuple[int, int]]:
    """Ranges of piece sizes that are counted together: 2 to 3, 4 to 7, and so on."""
    first, out = 2, []
    while first <= longest:
        out.append((first, min(2 * first - 1, longest)))
        first *= 2
    return out


def frequent_pieces(words: DataFrame, least: int, longest: int) -> DataFrame:
    """All substrings of 2 to ``longest`` characters that occur ``least`` times at least: (piece, n).

    Sizes are counted in levels. A substring can be frequent only if its own substrings are; so a place is carried on to
    the next level only where every substring of the last level's size is frequent. Words that are frequent themselves
    need no such check. A row holds no more of a word than the longest piece, however long the word is.
    """
    length = F.length("word")
    mark = [F.xxhash64("word").alias("w1"), F.xxhash64("word", F.lit(1)).alias("w2")]
    starts = words.where(length >= 2).select("word", "n", F.explode(F.sequence(F.lit(1), length - 1)).alias("start"))
    tail = F.col("word").substr(F.col("start"), F.lit(longest))
    places = starts.select(*mark, "n", "start", tail.alias("tail"), F.length(tail).alias("reach"))
    levels, found = _levels(longest), []
    for number, (low, high) in enumerate(levels):
        sizes = F.sequence(F.lit(low), F.least(F.col("reach"), F.lit(high)))
        pieces = F.explode(F.transform(sizes, lambda size: F.substring(F.col("tail"), F.lit(1), size))).alias("piece")
        counted = places.where(F.col("reach") >= low).select(pieces, "n").groupBy("piece").agg(F.sum("n").alias("n"))
        found.append(stage(counted.where(F.col("n") >= least), "pieces"))
        if number + 1 == len(levels):
            break
        going = places.where(F.col("reach") > high)
        rare = places.where((F.col("n") < least) & (F.col("reach") >= high)).withColumn("head", F.substring("tail", 1, high))
        last = found[-1].where(F.length("piece") == high).select(F.col("piece").alias("_piece"))
        held = rare.join(last, F.col("head") == F.col("_piece"), "left_semi")
        # neighbouring places that are all frequent form a run, which bounds how far a substring may reach
        order = Window.partitionBy("w1", "w2").orderBy("start")
        run = held.withColumn("run", F.col("start") - F.row_number().over(order))
        end = F.max("start").over(Window.partitionBy("w1", "w2", "run"))
        reach = F.least(F.col("reach"), (end - F.col("start") + high).cast("int"))
        left = run.withColumn("reach", reach).where(F.col("reach") > high)
        places = going.where(F.col("n") >= least).unionByName(left.select(*going.columns))
        places = stage(places, "places")
    return reduce(DataFrame.union, found) if found else words.select(F.col("word").alias("piece"), "n").where("false")


def seed_pieces(words: DataFrame, config: SubwordConfig) -> DataFrame:
    """Substrings of two or more characters that occur twice at least, the best ``seed_size`` by count times length.

    ``seed_size`` bounds what training holds; a corpus with fewer frequent substrings starts with all of them.
    """
    found = frequent_pieces(words, MIN_COUNT, config.max_piece_length)
    return found.orderBy(F.desc(F.col("n") * F.length("piece")), "piece").limit(config.seed_size)


def _expected_uses(words: DataFrame, trie: Broadcast, scores: np.ndarray) -> np.ndarray:
    """Expected uses of every piece over all words; each task adds up its own words first."""
    shared = words.sparkSession.sparkContext.broadcast(scores)

    def count_uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(trie.value, shared.value)
        total = np.zeros(len(shared.value))
        for batch in batches:
            n = batch["n"].to_numpy().astype(np.float64)
            total += lattice.expected(batch["word"].to_pylist(), n)[1]
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "uses"])

    sums = words.mapInArrow(count_uses, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses"))
    found, uses = sums.toArrow(), np.zeros(len(scores))  # a row per piece at most
    uses[found["piece"].to_numpy()] = found["uses"].to_numpy()
    shared.unpersist()
    return uses


def _maximised(uses: np.ndarray, required: np.ndarray) -> np.ndarray:
    """New log probabilities; pieces that are hardly used go, single characters stay."""
    kept = np.where(required, np.maximum(uses, MIN_EXPECTED), np.where(uses >= MIN_EXPECTED, uses, 0.0))
    with np.errstate(divide="ignore"):
        return np.log(kept) - np.log(kept.sum())


def _losses(pieces: DataFrame, trie: Broadcast, scores: np.ndarray, uses: np.ndarray) -> np.ndarray:
    """The likelihood that removing each piece would cost, worked out in parallel."""
    shared = pieces.sparkSession.sparkContext.broadcast((scores, uses))

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n = shared.value
        lattice = Lattice(trie.value, known)
        for batch in batches:
            place = batch["place"].to_numpy()
            batch = batch.filter(pa.array(np.isfinite(known[place])))
            place = batch["place"].to_numpy()
            other = lattice.best(batch["piece"].to_pylist(), whole=False)[0]
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(n[place] * (known[place] - other))], ["place", "loss"])

    found, losses = pieces.mapInArrow(cost, "place long, loss double").toArrow(), np.full(len(scores), -np.inf)
    losses[found["place"].to_numpy()] = found["loss"].to_numpy()
    shared.unpersist()
    return losses


def _sent(spark: SparkSession, pieces: list[str]) -> tuple[DataFrame, Broadcast]:
    """The pieces as rows (place, piece), and as a trie for every task."""
    places = pa.table({"place": np.arange(len(pieces)), "piece": pa.array(pieces, pa.string())})
    spread = spark.createDataFrame(places).repartition(spark.sparkContext.defaultParallelism)
    return stage(spread, "piece-places"), spark.sparkContext.broadcast(Trie.of(pieces))


def train_subwords(corpus: DataFrame, config: SubwordConfig = SubwordConfig()) -> DataFrame:
    """Train a vocabulary of at most ``vocab_size`` pieces on the ``text`` column: (piece, score).

    Expectation and maximisation alternate; between rounds the table shrinks by dropping the pieces least missed. All
    covered characters stay pieces. The tasks get the pieces as a trie, anew when half of them are gone, and new scores in
    every step.
    """
    spark = corpus.sparkSession
    # Few bytes but much work per row: as many parts as there are cores, not as few as the bytes would fill.
    words = stage(word_counts(corpus).repartition(spark.sparkContext.defaultParallelism), "words")
    characters = covered_characters(words, config.character_coverage).withColumn("required", F.lit(True))
    seeds = characters.unionByName(seed_pieces(words, config).withColumn("required", F.lit(False)))
    # at most seed_size pieces and the characters, whose places name them from here on
    table = stage(seeds, "seeds").orderBy("piece").toArrow()
    pieces, required = table["piece"].to_pylist(), table["required"].to_numpy()
    if not pieces:
        return spark.createDataFrame([], PIECE_SCHEMA)
    rows, trie = _sent(spark, pieces)
    scores = _maximised(table["n"].to_numpy().astype(np.float64), required)
    target = max(config.vocab_size, int(required.sum()))
    while True:
        for _ in range(config.em_steps):
            uses = _expected_uses(words, trie, scores)
            scores = _maximised(uses, required)
        left = int(np.isfinite(scores).sum())
        if left <= target:
            break
        keep = max(target, int(left * config.shrink)) - int(required.sum())
        losses = np.where(required, -np.inf, _losses(rows, trie, scores, uses))
        kept = np.lexsort((np.arange(len(losses)), -losses))[:keep]
        dropped = ~required
        dropped[kept] = False
        scores[dropped] = -np.inf
        if 2 * int(np.isfinite(scores).sum()) < len(pieces):  # a smaller trie is walked faster
            left = np.flatnonzero(np.isfinite(scores))
            pieces, scores, required = [pieces[i] for i in left], scores[left], required[left]
            trie.unpersist()
            rows, trie = _sent(spark, pieces)
    kept = np.flatnonzero(np.isfinite(scores))
    return spark.createDataFrame([(pieces[i], float(scores[i])) for i in kept], PIECE_SCHEMA)


def _portions(texts: pd.Series) -> Iterator[pd.Series]:
    """The texts in order, in runs of about ``TEXT_SIGNS`` signs."""
    ends = texts.str.len().cumsum().to_numpy(np.int64)
    runs = (ends - 1).clip(0) // TEXT_SIGNS
    for own in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(runs)) + 1):
        yield texts.iloc[own]


def encoder(pieces: DataFrame):
    """A function from a text column to its array of pieces. The piece table, bounded by its training, is broadcast.

    Texts are cut in portions, as a batch has thousands of them, however long. The distinct words of a portion that the
    worker has not met yet are cut together.
    """
    table = pieces.orderBy("piece").toArrow()
    lattice = Lattice(Trie.of(table["piece"].to_pylist()), table["score"].to_numpy())
    shared = pieces.sparkSession.sparkContext.broadcast((lattice.trie, lattice.scores))

    @F.pandas_udf("array<string>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cutter = Lattice(*shared.value)
        seen: dict[str, list[str]] = {}
        for part in chain.from_iterable(map(_portions, batches)):
            texts = [text.split() for text in part]
            distinct = {w for words in texts for w in words}
            new = [w for w in distinct if w not in seen]
            if len(seen) + len(new) > STORE:
                seen, new = {}, list(distinct)
            seen.update(zip(new, cutter.best([WORD_START + w for w in new])[1], strict=True))
            yield pd.Series([list(chain.from_iterable(map(seen.__getitem__, words))) for words in texts], dtype=object)

    encode = encode.asNondeterministic()  # evaluated once per row, also when its result is filtered on

    def encode_column(c: Column) -> Column:
        return encode(F.coalesce(c, F.lit("")))

    return encode_column


def decode(pieces: Column) -> Column:
    """The text that a piece array stands for."""
    return F.ltrim(F.translate(F.array_join(pieces, ""), WORD_START, " "))
