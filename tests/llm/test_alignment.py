"""Token alignment against both libraries and nested loops."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from rapproche.llm import alignment
from rapproche.operators.skew import SkewLimits

public_tokenizers = pytest.importorskip("public_tokenizers")
PATHS = tuple(str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
PARTS = [
    "word", " ", "  ", "\n", "\t", "É", "été", "漢字", "𝔘", "'s", "12", "3.14", "<|endoftext|>", "<s>", "</s>", "<0x41>",
    "<unk>", "don't", "ﬁ", "▁", "é", " ", " ", "!!", "internationalisation", "\x00", "😀", "\r\n", "A",
]


@pytest.fixture(scope="module")
def files():
    return alignment.Tokenizers.load(*PATHS)


def some_texts(n: int) -> list[str | None]:
    r = random.Random(5)
    fixed = [None, "", " ", "\n", "a", "a", "x▁y", "ﬁne", "word word", "word word"]
    return fixed + ["".join(r.choices(PARTS, k=r.randint(1, 25))) for _ in range(n)]


def brute(texts: list[str | None]) -> list[tuple]:
    """The contract's rows, token by token, with the tokenizers and sentencepiece libraries on whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(PATHS[0])
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    byte_of = {chr(b) if b in own else chr(next(rest)): b for b in range(256)}
    found = []
    for text in texts:
        given = (" " + text).encode() if text else b""
        a = [(i, bytes(byte_of[s] for s in a_side.id_to_token(i))) for i in a_side.encode(given.decode(), add_special_tokens=False).ids]
        b = []
        for i in b_side.encode(text or ""):
            sign = b_side.id_to_piece(i)
            b.append((i, bytes([int(sign[3:5], 16)]) if b_side.is_byte(i) else sign.replace("▁", " ").encode()))
        if b"".join(x for _, x in a) != given or b"".join(x for _, x in b) != given:
            a = b = []
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        links = [(i, j) for i, s, e in spans[0] for j, u, v in spans[1] if s < v and u < e]
        ends = sorted({e for _, _, e in spans[0]} & {v for _, _, v in spans[1]})
        groups, before = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in side if before <= s and e <= end) for side in spans))
            before = end
        found.append((len(a), len(b), groups, links))
    counts = Counter(link for *_, links in found for link in links)
    best: dict[int, int] = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return [
        (
            n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for n_a, n_b, groups, links in found
    ]


@pytest.mark.parametrize("broadcast_bytes", [1 << 26, 0])
def test_alignment_matches_brute_force(spark, files, broadcast_bytes):
    texts = some_texts(300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    limits = SkewLimits(task_rows=200, broadcast_bytes=broadcast_bytes)
    got = {r[0]: tuple(r[1:]) for r in alignment.digests(docs, files, limits).collect()}
    assert got == dict(enumerate(brute(texts)))


def test_parts_give_the_tokens_of_the_whole(files, monkeypatch):
    r = random.Random(8)
    texts = ["".join(r.choices([*PARTS, " the ", " of a word", "s and "], k=r.randint(1, 300))) for _ in range(60)]
    aligner = alignment.Aligner(files)
    whole = [column.to_pylist() for column in aligner.align(texts)]
    monkeypatch.setattr(alignment, "PART", 5)
    assert any(len(aligner.parts(t)) > 3 for t in texts)
    assert [column.to_pylist() for column in aligner.align(texts)] == whole


def test_long_texts(files):
    aligner = alignment.Aligner(files)
    for text in (" ".join(f"word{i % 997}" for i in range(200_000)), "x" * 300_000, " " * 300_000, "漢" * 100_000):
        n_a, n_b, n_groups, n_links, groups, pairs, times = (c.to_pylist()[0] for c in aligner.align([text]))
        assert 0 < n_groups <= min(n_a, n_b) and sum(times) == n_links and len(pairs) == len(times)
        assert groups.count(";") == n_groups - 1


def test_library_stands_in_where_ids_are_no_ranks(files):
    side = alignment.ByteLevel(files.byte_level)
    texts = [" " + (t or "") for t in some_texts(50)]
    ranked = [x.tolist() for x in side.encode(texts)]
    side.ranked = False
    assert [x.tolist() for x in side.encode(texts)] == ranked


def test_edge_rows(spark, files):
    schema = "doc_id long, text string, row long, _row long, pair string, groups string, `times` int, token int"
    rows = [
        (None, "no id", 1, 1, "p", "g", 1, 1), (1, None, None, None, None, None, None, None), (2, "same", 1, 1, "p", "g", 1, 1),
        (2, "same", 1, 1, "p", "g", 1, 1), (3, "", 1, 1, "p", "g", 1, 1),
    ]
    docs = spark.createDataFrame(rows, schema)
    kept = alignment.align(docs, files)
    assert kept.columns == ["doc_id", "text", "row", "_row", "pair", "token", *alignment.RESULTS]
    assert kept.count() == 5
    got = sorted((str(r["doc_id"]), r["n_a"], r["n_links"], r["groups_sha256"] == "") for r in alignment.digests(docs, files).collect())
    assert [(g[0], g[3]) for g in got] == [("1", True), ("2", False), ("2", False), ("3", True), ("None", False)]
    assert alignment.digests(docs.limit(0), files).count() == 0
