"""Similarity scores between two columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from rapproche.functions.text import once, tokens


def common_subsequence_lengths(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Longest common subsequence of each pair of strings.

    One row of the dynamic programme per character of the right side, for all pairs of a slice at once: the best
    extension by a match, then a running maximum along the row.
    """
    width = np.fromiter((max(len(a), len(b)) for a, b in zip(left, right)), dtype=np.int64, count=len(left))
    order = np.argsort(width, kind="stable")
    result = np.zeros(len(left), dtype=np.int64)
    start = 0
    while start < len(order):
        # Pairs of like width share a slice of at most about two million cells.
        widest = max(1, int(width[order[start]]))
        stop = min(len(order), start + max(1, 2_000_000 // (2 * widest)))
        while stop > start + 1 and width[order[stop - 1]] > 2 * widest:
            stop = start + int(np.searchsorted(width[order[start:stop]], 2 * widest, side="right"))
        part = order[start:stop]
        a, b = _code_points(left[part], 0xFFFFFFFF), _code_points(right[part], 0xFFFFFFFE)
        row = np.zeros((len(part), a.shape[1] + 1), dtype=np.int32)
        for j in range(b.shape[1]):
            row[:, 1:] = np.maximum(row[:, 1:], row[:, :-1] + (a == b[:, j : j + 1]))
            np.maximum.accumulate(row, axis=1, out=row)
        result[part] = row[:, -1]
        start = stop
    return result


def _code_points(texts: np.ndarray, filler: int) -> np.ndarray:
    """Texts as rows of code points, filled up with a value that is no character."""
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    longest = max(1, int(lengths.max(initial=0)))
    points = np.array([t.ljust(longest) for t in texts], dtype=f"<U{longest}").view(np.uint32)
    points = points.reshape(len(texts), longest).copy()
    points[np.arange(longest)[None, :] >= lengths[:, None]] = filler
    return points


@F.pandas_udf(DoubleType())
def _edit_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    present = (left.notna() & right.notna()).to_numpy()
    result = np.full(len(left), np.nan)
    if present.any():
        a = left.to_numpy(dtype=object)[present]
        b = right.to_numpy(dtype=object)[present]
        total = np.fromiter((len(x) + len(y) for x, y in zip(a, b)), dtype=np.int64, count=len(a))
        shared = 2.0 * common_subsequence_lengths(a, b)
        result[present] = np.divide(shared, total, out=np.ones(len(a)), where=total > 0)
    return pd.Series(result).where(pd.Series(present))


# So declared, the optimizer neither moves the call below an earlier filter nor repeats it for a later one.
_edit_ratio = _edit_ratio.asNondeterministic()


def edit_ratio(left: Column, right: Column) -> Column:
    """Edit similarity in 0..1 where a substitution counts as two edits: 2 * LCS / (len + len).

    Equal texts are answered without leaving the JVM; only the rest travel to Python.
    """
    open_case = left != right
    scored = _edit_ratio(F.when(open_case, left), F.when(open_case, right))
    return F.when(left == right, F.lit(1.0)).otherwise(scored)


def token_set_text(token_array: Column) -> Column:
    """Distinct tokens in code-point order, joined by blanks."""
    return F.array_join(F.sort_array(F.array_distinct(token_array)), " ")


def fuzzy_keys(left: Column, right: Column, at_least: float | None = None) -> Column:
    """What is to be compared of two token arrays: struct(same, a, b).

    ``same`` says that the token sets are equal. ``a`` and ``b`` are their texts where only an edit ratio can tell; they
    are null where the sets are equal, share no token, or, with ``at_least``, differ too much in length to reach it.
    """

    def compare(t: Column) -> Column:
        differ = t["a"] != t["b"]
        if at_least is not None:
            shorter = F.least(F.length(t["a"]), F.length(t["b"]))
            differ = differ & (F.try_divide(shorter * 2.0, F.length(t["a"]) + F.length(t["b"])) >= at_least)
        return F.struct(
            F.coalesce(t["a"] == t["b"], F.lit(False)).alias("same"),
            F.when(differ, t["a"]).alias("a"),
            F.when(differ, t["b"]).alias("b"),
        )

    def texts(s: Column) -> Column:
        meet = F.arrays_overlap(s["l"], s["r"])
        a = F.when(meet, F.array_join(F.sort_array(s["l"]), " "))
        b = F.when(meet, F.array_join(F.sort_array(s["r"]), " "))
        return once(F.struct(a.alias("a"), b.alias("b")), compare)

    sets = F.struct(F.array_distinct(left).alias("l"), F.array_distinct(right).alias("r"))
    return once(sets, texts)


def fuzzy_score(keys: Column) -> Column:
    """Score of ``fuzzy_keys``; best given as a column of its own, since it is used three times."""
    return F.when(keys["same"], F.lit(1.0)).otherwise(F.coalesce(_edit_ratio(keys["a"], keys["b"]), F.lit(0.0)))


def fuzzy_match_tokens(left: Column, right: Column, at_least: float | None = None) -> Column:
    """Edit ratio of the two token sets, 0 when they share no token or either is empty.

    With ``at_least``, pairs whose lengths alone rule that score out get 0 at once.
    """
    return fuzzy_score(fuzzy_keys(left, right, at_least))


def fuzzy_match(left: Column, right: Column, at_least: float | None = None) -> Column:
    return fuzzy_match_tokens(tokens(left), tokens(right), at_least)


def set_overlap(left: Column, right: Column) -> Column:
    """Shared over all distinct elements; 1 when either side is empty."""
    shared = F.size(F.array_intersect(left, right))
    either = F.size(F.array_union(left, right))
    return F.when((F.size(left) == 0) | (F.size(right) == 0), F.lit(1.0)).otherwise(shared / either)


def text_overlap(left: Column, right: Column) -> Column:
    """``set_overlap`` of two texts, each taken as a set of one."""
    return F.when((left == "") | (right == "") | (left == right), F.lit(1.0)).otherwise(F.lit(0.0))


def equal_or_missing(left: Column, right: Column) -> Column:
    return F.when((left == "") | (right == "") | (left == right), F.lit(1)).otherwise(F.lit(0))


def equal_postal_codes(left: Column, right: Column) -> Column:
    """Equality of stored codes, where the code 0 counts as missing."""

    def known(c: Column) -> Column:
        return F.when(c == "0", F.lit("")).otherwise(c)

    return equal_or_missing(known(left), known(right))


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(
        F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x
    )


def norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity; null when either vector has no length."""
    length = norm(left) * norm(right)
    return F.when(length > 0, dot(left, right) / length)


def similarity_of_distance(distance: Column) -> Column:
    return F.lit(1.0) - distance
