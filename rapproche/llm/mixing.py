"""Mixing of sources to target weights by iterative proportional fitting, in built-in functions only.

Documents are summed into cells of source, language and topic; a cell's weight is its number of words. Fitting scales
the cells to one target marginal after the other, in rounds of ``SWEEPS`` sweeps, until no category's weight is further
than ``BOUND`` from its target. Targets that no weights on the given cells can meet (a source that has one language only,
and so on) stop coming nearer; then fitting stops and warns with the distance left. The ratio of a cell's fitted to its
own weight is the calibrated weight of its documents; with a factor that is fixed by the share of words to keep, capped
at one, it becomes the probability with which each of them is sampled. The draw is a hash of the id, so a recomputed
task draws the same.

Targets are shares per category, given as tables, or by default the corpus's own shares to the power ``TEMPER``. A
category without a target gets no weight. Cells are as many as combinations of categories that occur, not as rows; the
fitting runs on them in grouped windows.

Nulls are a category of their own; null text has no words. A row without id is drawn by its text, and rows that repeat
an id are drawn alike. Where all texts are empty, every probability is ``share``. Other columns are passed on, and
columns named like the results are replaced.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rapproche.llm.batches import free_prefix
from rapproche.session import stage

WORD = r"[^\x20\x09-\x0D]+"
DIMENSIONS = ("source", "lang", "topic")
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.7}
#: Sweeps of a round; after each round the marginals are compared with their targets.
SWEEPS = 10
BOUND = 1e-6
#: Fitting has stalled if a round leaves more than this part of the distance.
STALLED = 0.9
#: Sweeps between two written tables.
SWEEPS_A_STAGE = 5
#: Cells up to which their probabilities are broadcast to the documents.
BROADCAST_ROWS = 100_000

#: First pattern that is found in a text names its topic.
TOPICS = (
    ("legal", r"(?i)licen[cs]e|copyright|warranty"),
    ("contact", r"@|https?://"),
    ("tables", r"\|"),
    ("figures", r"[0-9]{4}"),
)
OTHER_TOPIC = "prose"


def topic_of(text: Column) -> Column:
    out = F.lit(OTHER_TOPIC)
    for name, pattern in reversed(TOPICS):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def with_words(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """``docs`` with ``n_tokens`` (its words) and ``topic``."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.withColumns({"n_tokens": words, "topic": topic_of(F.col("text")) if topic is None else topic})


def _targets(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """``cells`` with the target share of each cell's category in every dimension."""
    for name in DIMENSIONS:
        target = f"t_{name}"
        if name in targets:
            given = targets[name].select(F.col(name).alias("_category"), F.col("share").cast("double").alias(target))
            cells = cells.join(given, F.col(name).eqNullSafe(F.col("_category")), "left").drop("_category")
            cells = cells.withColumn(target, F.coalesce(target, F.lit(0.0)))
        else:
            mass = F.sum("w").over(W.partitionBy(name))
            cells = cells.withColumn(target, F.when(mass > 0, F.pow(mass, TEMPER[name])).otherwise(0.0))
    # each category's share of all categories present: its cells carry it in parts by their weight
    parts = [
        F.sum(F.when(F.col(f"m_{n}") > 0, F.col(f"t_{n}") * F.col("w") / F.col(f"m_{n}"))) for n in DIMENSIONS
    ]
    cells = stage(cells.withColumns({f"m_{n}": F.sum("w").over(W.partitionBy(n)) for n in DIMENSIONS}), "cell-targets")
    sums = cells.agg(*parts).first()
    for name, total in zip(DIMENSIONS, sums, strict=True):
        cells = cells.withColumn(f"t_{name}", F.col(f"t_{name}") / F.lit(total or 1.0))
    return cells.drop(*[f"m_{n}" for n in DIMENSIONS])


def marginal_distance(fitted: DataFrame) -> float:
    """The largest difference of a category's weight from its target, over all dimensions."""
    worst = [
        fitted.groupBy(n).agg(F.abs(F.sum("w") - F.first(f"t_{n}")).alias("off"), F.sum("own").alias("own")).select("off", "own")
        for n in DIMENSIONS
    ]
    every = worst[0].union(worst[1]).union(worst[2])
    return float(every.where("own > 0").agg(F.max("off")).first()[0] or 0.0)


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (dimensions, tokens) with ``ratio``, fitted over own weight."""
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    cells = cells.withColumn("w", F.col("tokens") / F.lit(total or 1.0))
    fitted = _targets(cells, targets or {}).withColumn("own", F.col("w"))
    distance = None
    while True:
        for sweep in range(sweeps):
            for name in DIMENSIONS:
                mass = F.sum("w").over(W.partitionBy(name))
                fitted = fitted.withColumn("w", F.when(mass > 0, F.col("w") * F.col(f"t_{name}") / mass).otherwise(0.0))
            if (sweep + 1) % SWEEPS_A_STAGE == 0 or sweep == sweeps - 1:
                fitted = stage(fitted, "cells")
        before, distance = distance, marginal_distance(fitted)
        if distance <= BOUND:
            break
        if before is not None and not distance <= STALLED * before:
            warnings.warn(f"targets conflict: a category's weight is {distance:.2g} from its target", stacklevel=2)
            break
    return fitted.withColumn("ratio", F.when(F.col("own") > 0, F.col("w") / F.col("own")).otherwise(1.0))


def calibrate(raked: DataFrame, share: float) -> DataFrame:
    """``raked`` with ``probability`` = min(1, factor * ratio), so that ``share`` of all words is expected."""
    tokens, ratio = F.col("tokens"), F.col("ratio")
    total = float(raked.agg(F.sum("tokens")).first()[0] or 0)
    if not total:
        return raked.withColumn("probability", F.lit(float(share)))
    factor, capped = 0.0, -1
    while True:  # more cells reach one with every step, until the factor fits those that are left
        full = ratio * factor >= 1
        got = raked.agg(
            F.sum(F.when(full, tokens)), F.sum(F.when(~full, tokens * ratio)), F.count(F.when(full, 1))
        ).first()
        if got[2] == capped or not got[1]:
            break
        capped = got[2]
        factor = max(factor, (share * total - (got[0] or 0)) / got[1])
    return raked.withColumn("probability", F.round(F.least(F.lit(1.0), ratio * factor), 6))


def draw(seed: int = 0) -> Column:
    """A number from 0 to 1 that depends on the row's id, or its text where that is null."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix_sources(
    rows: DataFrame, share: float = 0.5, targets: dict[str, DataFrame] | None = None, seed: int = 0
) -> DataFrame:
    """``rows`` of ``with_words`` with ``probability`` and ``kept``."""
    rows = rows.drop("probability", "kept")
    own = free_prefix(rows)
    cells = stage(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "cell-words")
    found = stage(calibrate(rake(cells, targets), share).select(*DIMENSIONS, "probability"), "probabilities")
    found = found.select(*[F.col(n).alias(f"{own}{n}") for n in DIMENSIONS], "probability")
    small = found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    same = [F.col(n).eqNullSafe(F.col(f"{own}{n}")) for n in DIMENSIONS]
    joined = rows.join(F.broadcast(found) if small else found, same, "left")
    return joined.drop(*[f"{own}{n}" for n in DIMENSIONS]).withColumn("kept", draw(seed) < F.col("probability"))


def digests(docs: DataFrame) -> DataFrame:
    """Every document's cell, probability and draw. Texts are read once."""
    rows = with_words(docs.select("doc_id", "text", "source", "lang"))
    text = F.when(F.col("doc_id").isNull(), F.col("text")).alias("text")
    rows = stage(rows.select("doc_id", text, *DIMENSIONS, "n_tokens"), "words")
    return mix_sources(rows).drop("text")


def sample(docs: DataFrame, share: float = 0.5, seed: int = 0) -> DataFrame:
    """The sampled rows of ``docs`` with its columns."""
    own = free_prefix(docs)
    clash = {c: f"{own}{c}" for c in docs.columns if c.lower() in ("topic", "n_tokens", "probability", "kept")}
    kept = mix_sources(with_words(docs.withColumnsRenamed(clash)), share, seed=seed).where("kept")
    return kept.select(*[F.col(clash.get(c, c)).alias(c) for c in docs.columns])
