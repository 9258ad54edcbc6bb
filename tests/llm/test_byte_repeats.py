"""Repeated byte strings against a table of all of them."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rapproche.llm import byte_repeats


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept) of each text, from a count of every string."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        starts = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])[: len(r)]).sum()) if r else 0
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return out


def some_texts(n, seed, length):
    """Texts with copies, copies cut at any byte, shared passages, periods and non-ASCII letters."""
    r = random.Random(seed)
    signs = ["a", "b", "c", "é", "漢", " ", "\n"]
    passages = ["".join(r.choices(signs, k=r.randint(length // 2, 3 * length))) for _ in range(6)]
    out = [None, "", "a", "a" * (length - 1), "ab" * length, "a" * (3 * length), "abc" * length + "x" + "abc" * length]
    while len(out) < n:
        kind = r.random()
        if kind < 0.1:
            out.append(r.choice(out))
        elif kind < 0.4:
            t = list(r.choice(out) or "b")
            for _ in range(r.randint(1, 3)):
                t[r.randrange(len(t))] = r.choice(signs)
            out.append("".join(t))
        else:
            parts = ["".join(r.choices(signs, k=r.randint(0, 2 * length))) for _ in range(r.randint(1, 3))]
            for p in r.choices(passages, k=r.randint(0, 3)):
                a = r.randrange(len(p))
                parts.insert(r.randint(0, len(parts)), p[a:] if r.random() < 0.5 else p)
            out.append("".join(parts))
    return out


def run(spark, texts, **kw):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in byte_repeats.remove_repeats(docs, **kw).collect()}
    return [
        (r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest())
        for r in (got[i] for i in range(len(texts)))
    ]


@pytest.mark.parametrize(("length", "anchor", "seed"), [(200, 32, 1), (40, 8, 2), (20, 20, 3), (50, 3, 4)])
def test_repeats_match_brute_force(spark, length, anchor, seed):
    texts = some_texts(150, seed, length)
    assert run(spark, texts, length=length, anchor=anchor) == brute(texts, length)


def test_chunks_of_long_texts(spark, monkeypatch):
    r = np.random.default_rng(5)
    base = "".join(map(chr, r.integers(97, 123, 30_000)))
    texts = [base, base[5_000:9_000] + "X" + base[20_000:20_199], "é" * 500, base[100:400]]
    want = brute(texts, 200)
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = byte_repeats.suffix_runs(docs.select(F.col("doc_id").alias("key"), F.lit(0).alias("tag"), "text"), 200, 32)
    assert plain.where("key = 0").count() > 200
    monkeypatch.setattr(byte_repeats, "CHUNK", 1_000)  # seen by the tasks, which get the function with its globals
    assert run(spark, texts) == want


def test_least_is_the_leftmost():
    r = np.random.default_rng(1)
    for width in (1, 2, 7, 169, 256):
        values = (r.integers(0, 5, 600).astype(np.uint64) << np.uint64(8))
        windows = np.lib.stride_tricks.sliding_window_view(values, width)
        assert (byte_repeats._least(values, width) == windows.argmin(1) + np.arange(len(windows))).all()


def test_edges(spark):
    long = "".join(map(chr, np.random.default_rng(2).integers(97, 123, 300)))
    schema = "doc_id long, text string, key string, tag int, anchor string, row int, _found int, spans int, runs int"
    extra = ("k", 1, "a", 1, 1, 1, 1)
    rows = [
        (None, long, *extra), (None, "x" + long[:150], *extra), (1, None, *extra), (2, "", *extra), (3, long + "!", *extra),
        (4, "one", *extra), (4, "one", *extra), (5, long[:100] + "y", *extra), (5, long[50:280], *extra),
    ]
    docs = spark.createDataFrame(rows, schema)
    out = byte_repeats.remove_repeats(docs)
    assert out.columns == ["doc_id", "text", "key", "tag", "anchor", "row", "_found", "runs", *byte_repeats.RESULTS]
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["key"]) for r in out.collect())
    assert got == sorted([
        ("None", 300, 300, "k"), ("None", 151, 0, "k"), ("1", 0, 0, "k"), ("2", 0, 0, "k"), ("3", 301, 300, "k"),
        ("4", 3, 0, "k"), ("4", 3, 0, "k"), ("5", 101, 0, "k"), ("5", 230, 230, "k"),
    ])
    assert byte_repeats.digests(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, long), (1, long), (1, long + "z")], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in byte_repeats.digests(twice).collect()) == [300, 300, 300]
