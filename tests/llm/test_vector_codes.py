"""Vector codes against full distance tables."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from rapproche.llm import vector_codes as codes

COLUMNS = "vec_id long, embedding array<float>, label int"


def brute(rows, rounds=codes.ROUNDS, entries=codes.ENTRIES):
    """The contract, with every distance worked out."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = np.array([[math.floor(1024 * float(np.float32(x))) for x in r[1]] for r in kept], np.int64)
    first = sorted((r[0], v.tolist()) for r, v in zip(kept, whole) if r[0] is not None)[:entries]
    books = [np.array([p for p in np.split(np.array([v for _, v in first]), 4, axis=1)][k]) for k in range(4)]
    parts = np.split(whole, 4, axis=1)

    def assign(k):
        table = ((parts[k][:, None] - books[k][None]) ** 2).sum(2)
        best = table.argmin(1)
        return best, table[np.arange(len(best)), best]

    for _ in range(rounds):
        for k in range(4):
            best, _ = assign(k)
            for e in set(best.tolist()):
                mine = parts[k][best == e]
                books[k][e] = [int(s) // len(mine) for s in mine.sum(0)]
    found = [assign(k) for k in range(4)]
    errors = sum(d for _, d in found)
    by_label = defaultdict(int)
    for r, e in zip(kept, errors):
        by_label[r[2]] += int(e)
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()
    return sorted(
        (str(r[0]), "".join(f"{found[k][0][i]:02x}" for k in range(4)), int(errors[i]), by_label[r[2]], digest)
        for i, r in enumerate(kept)
    )


def run(spark, rows, **kw):
    got = codes.digests(spark.createDataFrame(rows, COLUMNS).repartition(4), **kw).collect()
    return sorted((str(r[0]), *r[1:]) for r in got)


@pytest.mark.parametrize(("n", "size", "spread"), [(600, 8, 1.0), (300, 64, 0.2), (700, 4, 0.002), (20, 16, 1.0)])
def test_codes_match_brute_force(spark, n, size, spread):
    r = np.random.default_rng(n)
    rows = [(int(i), (r.standard_normal(size) * spread).tolist(), int(r.integers(3)) if i % 7 else None) for i in r.permutation(n)]
    rows += [(r0[0], r0[1], 1) for r0 in rows[:40]]  # repeated ids and vectors
    rows += [(n + 1, None, 1), (n + 2, [float("nan")] * size, 1), (n + 3, [float("inf")] * size, 1), (n + 4, [None] * size, 1)]
    rows += [(None, rows[0][1], 2), (n + 5, [0.0] * size, 0), (n + 6, [-0.0] * size, None)]
    assert run(spark, rows) == brute(rows)


def test_orchard_finds_the_nearest_of_many_ties():
    r = np.random.default_rng(3)
    for n, m, span in ((256, 16, 2000), (256, 2, 4), (37, 1, 3), (1, 5, 10), (256, 3, 1)):
        entries = r.integers(-span, span + 1, (n, m))
        points = np.concatenate([r.integers(-span, span + 1, (500, m)), entries, r.integers(-9 * span, 9 * span, (50, m))])
        table = ((points[:, None] - entries[None]) ** 2).sum(2)
        best, distance = codes.Codebook.of(entries).nearest(points)
        assert (best == table.argmin(1)).all() and (distance == table.min(1)).all()


def test_orchard_skips_what_the_bound_rules_out(monkeypatch):
    r = np.random.default_rng(4)
    centres = r.integers(-10_000, 10_000, (256, 4))
    points = np.repeat(centres, 20, axis=0) + r.integers(-20, 21, (256 * 20, 4))
    book, seen = codes.Codebook.of(centres), []
    plain = codes.squares
    monkeypatch.setattr(codes, "squares", lambda a, b: seen.append(len(a)) or plain(a, b))
    book.nearest(points)
    assert sum(seen) < 0.35 * len(points) * 256


def test_decoded_vectors_are_the_named_entries(spark):
    r = np.random.default_rng(6)
    rows = [(i, r.standard_normal(8).tolist(), 0) for i in range(300)]
    table = codes.integers(spark.createDataFrame(rows, COLUMNS)).cache()
    books = codes.train(table)
    for row in codes.decode(codes.encode(table, books), books).collect():
        assert sum((a - b) ** 2 for a, b in zip(row["vector"], row["approximation"], strict=True)) == row["error"]
    table.unpersist()


def test_edges(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, [1.0] * 4, 1)]) == []
    assert run(spark, [(1, None, 1), (2, [], 1)]) == []
    mixed = run(spark, [(1, [1.0] * 8, 1), (2, [1.0] * 4, 1), (3, [2.0] * 8, None)])
    assert [m[:3] for m in mixed] == [("1", "00000000", 0), ("3", "01010101", 0)]
    with pytest.raises(ValueError, match="divide"):
        run(spark, [(1, [1.0] * 6, 1)])
    with pytest.raises(ValueError, match="too large"):
        run(spark, [(1, [1e30] * 8, 1)])
    long = [(i, [float(i)] * 8_000, 1) for i in range(3)]
    assert [r[1:3] for r in run(spark, long)] == [(f"{i:02x}" * 4, 0) for i in range(3)]
    clash = spark.createDataFrame(
        [(1, [1.0] * 4, 1, "a", 1, 2, 3)], "vec_id long, embedding array<float>, label int, code string, error int, _label int, vector int"
    )
    assert codes.digests(clash).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert codes.digests(clash).count() == 1
