"""Quality rules whose cutoffs carry a bound on the share of good documents they reject.

Each rule compares one measure of a text with a cutoff; its cutoffs are a fixed list from lenient to strict. For each
stratum (by default the language) the labelled documents that the base rule passes are dealt by a hash of their id: one in
``TRAINING`` is used to choose, the others are the holdout. On the first part a path of cutoff vectors is chosen, which
leads through all rules from lenient to strict to the vector that rejects most bad documents, each good one counted
``WEIGHT`` times against it. On the holdout the path is tested in order: with ``n`` good documents of which a vector
rejects ``k`` by any rule, it holds if a rejection rate of ``risk`` would give ``k`` or fewer with a probability of at
most the stratum's share of ``error`` (the exact binomial bound). The last vector before the first that does not hold is
used. As the order is fixed before the holdout is seen and rejection by all rules is tested at once, neither steps nor
rules need a correction; over strata the error is spent by Holm's rule: each path has an equal share, and paths that
hold whole pass theirs on. So with probability ``1 - error`` no stratum loses more than ``risk`` of its good documents
to the rules. A stratum with too few labelled documents has no cutoffs, and its documents are judged by the base rule
alone.

Null text has no words. A null stratum is a stratum of its own. Labels of a null or unknown document are ignored; a
document with several labels is good if one of them says so. Rows that repeat an id are judged one by one. Other
columns are passed on, and columns named like the measures are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rapproche.llm.batches import free_prefix
from rapproche.llm.words import Words, mix, slices
from rapproche.session import stage

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: A good document rejected counts as so many bad ones.
WEIGHT = 10
#: One labelled document in so many serves to choose the path of cutoffs.
TRAINING = 3


@dataclass(frozen=True)
class Rule:
    """Rejects where ``measure`` is above the cutoff; cutoffs go from lenient to strict."""

    name: str
    measure: str
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols", "n_symbols / n_words", (2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02)),
    Rule("dup_lines", "n_dup_lines / n_lines", (0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    Rule("repeats", "n_repeat_words / n_words", (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15)),
    Rule("long_words", "word_chars / n_words", (15.0, 12.0, 10.0, 9.0, 8.0, 7.0, 6.5)),
    Rule("short_words", "-word_chars / n_words", (-1.5, -2.0, -2.5, -3.0, -3.5, -4.0)),
)


def _same_as_earlier(owner: np.ndarray, value: np.ndarray, at_least_twice: bool = False) -> np.ndarray:
    """Flags values equal to an earlier one of the same owner, or with ``at_least_twice`` the first as well."""
    key = mix(value ^ mix(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    equal = np.zeros(len(key) + 1, bool)
    equal[1:-1] = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order] = equal[:-1] | equal[1:] if at_least_twice else equal[:-1]
    return out


#: Bytes of text measured at once; some forty times as many are held meanwhile.
SLICE_BYTES = 1 << 19


def text_measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """The measures of a slice of texts."""
    w = Words(texts)
    n = len(w)
    owner = w.owner()
    at, value = w.runs(3)
    twice = at[_same_as_earlier(owner[at], value, at_least_twice=True)]
    cover = np.zeros(len(w.hash) + 4, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + 3, -1)
    covered = np.cumsum(cover)[: len(w.hash)] > 0

    breaks = np.flatnonzero(w.raw == 10)
    starts = np.sort(np.concatenate([w.bytes_at[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([w.bytes_at[1:], breaks]))
    line_owner = np.repeat(np.arange(n), np.bincount(np.searchsorted(w.bytes_at, breaks, "right") - 1, minlength=n) + 1)
    letters = np.zeros(len(w.raw) + 1, np.int64)
    np.cumsum(w.letter, out=letters[1:])
    full = letters[ends] > letters[starts]
    dup = _same_as_earlier(line_owner[full], w.span_hash(starts[full], ends[full]))
    return {
        "n_words": np.diff(w.offset),
        "word_chars": w.per_text(w.letter & ((w.raw & 0xC0) != 0x80)),
        "n_symbols": w.per_text(SYMBOL[w.raw]),
        "n_dup_lines": np.bincount(line_owner[full][dup], minlength=n),
        "n_repeat_words": np.bincount(owner[covered], minlength=n),
        "n_lines": np.bincount(line_owner, minlength=n),
    }


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the measures of each whole text as long columns."""
    docs = docs.drop(*MEASURES)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(m, T.LongType()) for m in MEASURES]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for first, last in slices(texts, SLICE_BYTES):
                part = batch.slice(first, last - first)
                found = text_measures(texts.slice(first, last - first))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(found[m].astype(np.int64)) for m in MEASURES]],
                    names=[*batch.schema.names, *MEASURES],
                )

    return docs.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _value(rule: Rule) -> Column:
    """The rule's measure; null, which rejects nothing, where it divides by zero."""
    over, under = rule.measure.split(" / ")
    sign, name = (-1, over[1:]) if over[0] == "-" else (1, over)
    return F.col(name) * sign / F.when(F.col(under) > 0, F.col(under))


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X of ``n`` trials of probability ``p``, by the terms' ratios from the largest down."""
    if k >= n:
        return 1.0
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    term, total, i = 1.0, 1.0, k
    while i > 0 and term > 1e-18 * total:
        term *= i * (1 - p) / ((n - i + 1) * p)
        total += term
        i -= 1
    return math.exp(min(0.0, log + math.log(total)))


def _level(rule: Rule) -> Column:
    """How many of the rule's cutoffs, lenient ones first, it takes to reject the row; one more than all if none does."""
    steps = [F.when(_value(rule) > cutoff, i + 1) for i, cutoff in enumerate(rule.cutoffs)]
    return F.coalesce(*steps, F.lit(len(rule.cutoffs) + 1)).cast("int")


def _rejected(levels: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Which rows of ``levels`` a vector, the number of cutoffs in use per rule, rejects."""
    return (levels <= vector).any(1)


def choose_path(levels: np.ndarray, good: np.ndarray, rows: np.ndarray, most: np.ndarray) -> list[np.ndarray]:
    """Cutoff vectors from lenient to strict, chosen on training documents (``rows`` of each level and label).

    The last vector is found greedily: the rule and cutoff with the largest gain is taken until none gains. The path
    leads to it in rounds that tighten each rule by one cutoff.
    """
    weight = np.where(good, -WEIGHT, 1) * rows
    last = np.zeros(len(most), np.int64)
    while True:
        left = ~_rejected(levels, last)
        best, gain = None, 0
        for rule, cutoffs in enumerate(most):
            for used in range(last[rule] + 1, cutoffs + 1):
                more = int(weight[left & (levels[:, rule] <= used)].sum())
                if more > gain:
                    best, gain = (rule, used), more
        if best is None:
            break
        last[best[0]] = best[1]
    path, now = [], np.zeros(len(most), np.int64)
    for used in range(1, int(last.max(initial=0)) + 1):
        for rule in np.flatnonzero(last >= used):
            now = now.copy()
            now[rule] = used
            path.append(now)
    return path


def path_chances(path: list[np.ndarray], levels: np.ndarray, good: np.ndarray, rows: np.ndarray, risk: float) -> list[float]:
    """For each vector of the path, the chance of so few good documents rejected, by it or one before, at a rate of ``risk``."""
    n = int(rows[good].sum())
    chances = [binomial_cdf(int(rows[good & _rejected(levels, v)].sum()), n, risk) if n else 1.0 for v in path]
    return np.maximum.accumulate(chances).tolist() if chances else []


def fit_cutoffs(
    measured: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, error: float = 0.05,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Valid cutoffs by stratum: a row (_stratum, cutoffs), with a null for a rule that is not used. A stratum without a path has no row."""
    good = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        (F.max("quality") > 0).alias("_good")
    )
    names = [f"level_{i}" for i in range(len(rules))]
    held = measured.where(~base_failed()).select(
        "doc_id", F.col(stratum).alias("_stratum"), *[_level(r).alias(n) for r, n in zip(rules, names, strict=True)]
    )
    training = (F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(TRAINING)) == 0).alias("training")
    # Rows per stratum, label and levels: however many documents are labelled, a stratum has no more rows than
    # there are combinations of levels.
    table = held.join(good, "doc_id").groupBy("_stratum", training, F.col("_good").alias("good"), *names).agg(
        F.count(F.lit(1)).alias("n")
    )
    most = np.array([len(r.cutoffs) for r in rules])

    def plan(frame: pd.DataFrame) -> pd.DataFrame:
        levels, is_good = frame[names].to_numpy(np.int64), frame["good"].to_numpy(bool)
        rows, train = frame["n"].to_numpy(np.int64), frame["training"].to_numpy(bool)
        path = choose_path(levels[train], is_good[train], rows[train], most)
        chances = path_chances(path, levels[~train], is_good[~train], rows[~train], risk)
        vectors = [[float(r.cutoffs[k - 1]) if k else None for r, k in zip(rules, v, strict=True)] for v in path]
        return pd.DataFrame({"_stratum": frame["_stratum"].iloc[:1], "vectors": [vectors], "chances": [chances]})

    kind = measured.schema[stratum].dataType
    numbers = T.ArrayType(T.DoubleType())
    schema = T.StructType(
        [T.StructField("_stratum", kind), T.StructField("vectors", T.ArrayType(numbers)), T.StructField("chances", numbers)]
    )
    plans = stage(table.groupBy("_stratum").applyInPandas(plan, schema).where(F.size("chances") > 0), "cutoff-paths")
    level = holm_level(plans.select(F.element_at("chances", -1).alias("chance")), error)
    valid = F.size(F.filter("chances", lambda p: p <= level))  # chances never fall along a path
    nothing = F.array(*[F.lit(None).cast("double") for _ in rules])
    return plans.select("_stratum", F.when(valid > 0, F.get("vectors", valid - 1)).otherwise(nothing).alias("cutoffs"))


def holm_level(tests: DataFrame, error: float) -> float:
    """The error each unfinished path may spend: ``error`` over the number of paths, without those that hold whole.

    ``tests`` has the ``chance`` of each path's last vector. A path that holds whole passes its share on to the others.
    """
    total = tests.count()
    done, level = 0, error / max(1, total)
    while True:
        now = tests.where(F.col("chance") <= level).count()
        if now == done:
            return level
        done, level = now, error / max(1, total - now)


def judge(
    measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``measured`` with ``base_failed``, ``failed`` (names of the rules that reject) and ``kept``."""
    measured = measured.drop("base_failed", "failed", "kept")
    own = free_prefix(measured)
    cutoffs = cutoffs.select(F.col("_stratum").alias(f"{own}stratum"), F.col("cutoffs").alias(f"{own}cutoffs"))
    joined = measured.join(cutoffs, F.col(stratum).eqNullSafe(F.col(f"{own}stratum")), "left")
    hits = [F.when(_value(rule) > F.col(f"{own}cutoffs")[i], F.lit(rule.name)) for i, rule in enumerate(rules)]
    failed = F.filter(F.array(*hits), lambda name: name.isNotNull())
    return (
        joined.withColumn("base_failed", base_failed())
        .withColumn("failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
        .drop(f"{own}stratum", f"{own}cutoffs")
    )


def digests(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Measures and verdict per document; texts are measured once."""
    measured = stage(measure(docs.select("doc_id", "text", "lang")).drop("text"), "measures")
    cutoffs = stage(fit_cutoffs(measured, labels), "cutoffs")
    return judge(measured, cutoffs).drop("lang")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with its columns. All texts are measured first, to fit the cutoffs without moving any."""
    known = docs.select("doc_id", "text", "lang")
    cutoffs = stage(fit_cutoffs(stage(measure(known).drop("text"), "measures"), labels), "cutoffs")
    prefix = free_prefix(docs)
    taken = {*MEASURES, "base_failed", "failed", "kept"}
    own = {c: f"{prefix}{c}" for c in docs.columns if c.lower() in taken}
    judged = judge(measure(docs.withColumnsRenamed(own)), cutoffs).where("kept")
    return judged.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])
