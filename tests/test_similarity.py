import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rapproche.functions import similarity as M


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


texts = st.text(alphabet="abcé \0😀", max_size=30)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(texts, texts), min_size=1, max_size=20))
def test_common_subsequence_agrees_with_brute_force(pairs):
    a = np.array([p[0] for p in pairs], dtype=object)
    b = np.array([p[1] for p in pairs], dtype=object)
    assert list(M.common_subsequence_lengths(a, b)) == [common(x, y) for x, y in pairs]
    assert list(M.common_subsequence_lengths(b, a)) == list(M.common_subsequence_lengths(a, b))


def test_mixed_lengths_cross_slices():
    a = np.array(["ab" * n for n in (1, 2000, 3, 800)], dtype=object)
    b = np.array(["ba" * n for n in (1500, 2, 3, 700)], dtype=object)
    assert list(M.common_subsequence_lengths(a, b)) == [common(x, y) for x, y in zip(a, b)]


def score(spark, function, a, b):
    row = spark.createDataFrame([(a, b)], "a string, b string")
    return row.select(function(F.col("a"), F.col("b"))).first()[0]


@pytest.mark.parametrize(
    "a, b, expected",
    [("kitten", "sitting", 0.615385), ("hugo victor", "hugo victr", 0.952381), ("abc", "xyz", 0), ("é a", "e a", 0.666667),
     ("", "", 1), ("", "a", 0), ("same", "same", 1)],
)
def test_edit_ratio(spark, a, b, expected):
    assert score(spark, M.edit_ratio, a, b) == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize(
    "a, b, expected",
    [("victor hugo", "hugo victor", 1), ("paris", "pariss", 0), ("", "x", 0), ("a a b", "b a", 1),
     ("rue victor hugo", "rue victr hugo", 28 / 29)],
)
def test_fuzzy_match(spark, a, b, expected):
    assert score(spark, M.fuzzy_match, a, b) == pytest.approx(expected)


@pytest.mark.parametrize("a, b, expected", [("", "x", 1), ("x", "x", 1), ("x", "y", 0)])
def test_equal_or_missing(spark, a, b, expected):
    assert score(spark, M.equal_or_missing, a, b) == expected


def test_postal_zero_is_missing(spark):
    assert score(spark, M.equal_postal_codes, "0", "75011") == 1
    assert score(spark, M.equal_postal_codes, "1000", "75011") == 0


def test_set_overlap(spark):
    rows = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], ["a"])], "a array<string>, b array<string>")
    assert [r[0] for r in rows.select(M.set_overlap(F.col("a"), F.col("b"))).collect()] == [pytest.approx(1 / 3), 1]


def test_length_gate_changes_no_passing_score(spark):
    rows = spark.createDataFrame(
        [("rue du bac", "rue bac"), ("rue", "rue de la republique"), ("a b c", "a b c d e f g h")], "a string, b string"
    )
    for limit in (0.3, 0.7, 0.9):
        both = rows.select(
            M.fuzzy_match(F.col("a"), F.col("b")).alias("free"), M.fuzzy_match(F.col("a"), F.col("b"), limit).alias("gated")
        ).collect()
        assert all((r["free"] >= limit) == (r["gated"] >= limit) for r in both)
        assert all(r["free"] == r["gated"] for r in both if r["free"] >= limit)


def test_cosine(spark):
    rows = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in rows.select(M.cosine(F.col("a"), F.col("b"))).collect()] == [pytest.approx(0.96), None]
