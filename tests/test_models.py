import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rapproche.config import EmbeddingConfig, NeighbourConfig, SubwordConfig
from rapproche.operators import bm25, embedding, lattice, neighbours, skipgram, subword
from rapproche.operators.lattice import Lattice, Trie
from rapproche.operators.skew import SkewLimits
from rapproche.operators.vector_sums import vector_sums

DOCS = [(1, ["rue", "bac", "rue"]), (2, ["rue", "hugo"]), (3, ["quai", "bac"]), (4, ["rue", "foch", "paris", "x"]), (5, [])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id long, tokens array<string>")


def brute_weights():
    n = len(DOCS)
    avgdl = sum(len(t) for _, t in DOCS) / n
    df = Counter(t for _, tokens in DOCS for t in set(tokens))
    raw = {t: math.log(n - c + 0.5) - math.log(c + 0.5) for t, c in df.items()}
    floor = 0.25 * sum(raw.values()) / len(raw)
    idf = {t: floor if v < 0 else v for t, v in raw.items()}
    return {
        (i, t): idf[t] * 2.5 * c / (1.5 * (0.25 + 0.75 * len(tokens) / avgdl) + c)
        for i, tokens in DOCS
        for t, c in Counter(tokens).items()
    }


def test_bm25_weights(docs):
    found = bm25.weighted_terms(docs, bm25.corpus_stats(docs)).collect()
    assert {(r["id"], r["term"]): pytest.approx(r["weight"]) for r in found} == brute_weights()


def test_document_vectors_in_place_and_joined(spark, docs):
    random = np.random.default_rng(1)
    table = {t: random.standard_normal(4) for t in ("rue", "bac", "hugo", "quai", "foch")}
    vectors = spark.createDataFrame([(t, [float(x) for x in v]) for t, v in table.items()], "token string, vector array<double>")
    stats = bm25.corpus_stats(docs)
    weights = brute_weights()
    docs = docs.union(spark.createDataFrame([(99, ["unknown"])], docs.schema))
    for tokens_stats in (stats, None):
        expected = {
            i: sum((table[t] * (weights[i, t] if tokens_stats else 1.0) for t in tokens if t in table), np.zeros(4))
            / max(len(tokens), 1)
            for i, tokens in [*DOCS, (99, ["unknown"])]
        }
        for limits in (SkewLimits(), SkewLimits(task_rows=2, broadcast_bytes=1)):
            rows = embedding.document_vectors(docs, vectors, tokens_stats, 4, limits).collect()
            assert {r["id"] for r in rows} == set(expected)
            for r in rows:
                assert np.allclose(r["vector"], expected[r["id"]])


CORPUS = ["rue victor hugo", "rue du bac", "avenue victor hugo", "rue de la republique", "quai de la rapee"] * 20


def test_subword_vocabulary(spark):
    corpus = spark.createDataFrame([(t,) for t in CORPUS], "text string")
    pieces = subword.train_subwords(corpus, SubwordConfig(vocab_size=40, seed_size=500))
    rows = {r["piece"]: r["score"] for r in pieces.collect()}
    assert len(rows) <= 40
    assert set("".join(CORPUS).replace(" ", "▁")) <= set(rows)
    assert sum(math.exp(s) for s in rows.values()) <= 1.0 + 1e-9
    encode = subword.encoder(pieces)
    probe = spark.createDataFrame([("rue victor hugo",), ("rue ωψ hugo",), ("",), (None,)], "text string")
    cut = probe.select("text", encode(F.col("text")).alias("p")).select("*", subword.decode(F.col("p")).alias("t")).collect()
    assert [r["t"] for r in cut] == ["rue victor hugo", "rue ωψ hugo", "", ""]
    assert "ωψ" in cut[1]["p"] and cut[2]["p"] == []


def test_likelihood_rises(spark):
    words = subword.word_counts(spark.createDataFrame([(t,) for t in CORPUS], "text string"))
    config = SubwordConfig(vocab_size=40, seed_size=500)
    counted = {r["word"]: r["n"] for r in words.collect()}
    counts = {r["piece"]: float(r["n"]) for r in subword.seed_pieces(words, config).collect()}
    characters = {r["piece"] for r in subword.covered_characters(words, 1.0).collect()}
    counts.update(dict.fromkeys(characters, 1.0))
    pieces = sorted(counts)
    trie, required = Trie.of(pieces), np.array([p in characters for p in pieces])
    shared = spark.sparkContext.broadcast(trie)
    scores = subword._maximised(np.array([counts[p] for p in pieces]), required)
    history = []
    for _ in range(4):
        n = np.array(list(counted.values()), float)
        likelihood, here = Lattice(trie, scores).expected(list(counted), n)
        history.append(likelihood @ n)
        uses = subword._expected_uses(words, shared, scores)
        assert uses == pytest.approx(here)
        scores = np.log(np.maximum(uses, 1e-300) / uses.sum())
    assert history == sorted(history)


def all_cuttings(word, scores, floor):
    if not word:
        yield [], 0.0
    for end in range(1, len(word) + 1):
        if word[:end] in scores or end == 1:
            for rest, score in all_cuttings(word[end:], scores, floor):
                yield [word[:end], *rest], scores.get(word[:end], floor) + score


def test_expected_counts_against_enumeration():
    random = np.random.default_rng(1)
    for trial in range(12):
        signs = list("abé漢")[: 2 + trial % 3]
        pieces = sorted({"".join(random.choice(signs, random.integers(1, 5))) for _ in range(9)})
        scores = dict(zip(pieces, (-random.random(len(pieces)) * 4).tolist(), strict=True))
        words = ["".join(random.choice([*signs, "z"], random.integers(1, 9))) for _ in range(15)]
        lattice = Lattice(Trie.of(pieces), np.array(list(scores.values())))
        counts = random.integers(1, 5, len(words)).astype(float)
        likelihood, uses = lattice.expected(words, counts)
        best, cuttings = lattice.best(words)
        without, _ = lattice.best(words, whole=False)
        expected = Counter()
        for i, word in enumerate(words):
            found = list(all_cuttings(word, scores, lattice.floor))
            total = sum(math.exp(s) for _, s in found)
            assert likelihood[i] == pytest.approx(math.log(total))
            for cut, score in found:
                for piece in cut:
                    if piece in scores:
                        expected[piece] += math.exp(score) / total * counts[i]
            assert best[i] == pytest.approx(max(s for _, s in found))
            assert "".join(cuttings[i]) == word
            other = [s for cut, s in found if cut != [word]] or [lattice.floor]
            assert without[i] == pytest.approx(max(other))
        assert uses == pytest.approx([expected[p] for p in pieces])


def test_removed_pieces_are_no_pieces():
    pieces = ["a", "ab", "b", "ba"]
    some = Lattice(Trie.of(pieces), np.array([-1.0, -np.inf, -2.0, -1.5]))
    left = Lattice(Trie.of(["a", "b", "ba"]), np.array([-1.0, -2.0, -1.5]))
    words = ["abab", "ba", "a", "zzab"]
    assert some.best(words)[1] == left.best(words)[1]
    assert some.expected(words, np.ones(4))[0] == pytest.approx(left.expected(words, np.ones(4))[0])
    assert some.best(["azzb"])[1] == [["a", "zz", "b"]]


def test_ties_keep_the_longest_last_piece():
    lattice = Lattice(Trie.of(["a", "aa", "aaa"]), np.array([-1.0, -2.0, -3.0]))
    assert lattice.best(["aaaa", "aa"])[1] == [["a", "aaa"], ["aa"]]
    assert Lattice(Trie.of([]), np.zeros(0)).best(["xyz", ""])[1] == [["xyz"], []]


def test_very_long_words(spark):
    word = "ab" * 50_000
    lattice = Lattice(Trie.of(["a", "ab", "b", "ba"]), np.log([0.2, 0.3, 0.3, 0.2]))
    likelihood, uses = lattice.expected([word], np.ones(1))
    assert np.isfinite(likelihood[0]) and uses @ [1, 2, 1, 2] == pytest.approx(100_000)
    assert set(lattice.best([word])[1][0]) == {"ab"}
    rows = spark.createDataFrame([("▁" + "ab" * 5_000, 1), ("▁abab", 3)], "word string, n long")
    found = {r["piece"]: r["n"] for r in subword.frequent_pieces(rows, 2, 16).collect()}
    assert found["abab"] == 4_999 + 3 and found["ba" * 8] == 4_992 and found["▁ab"] == 4 and "▁ababa" not in found


@pytest.mark.parametrize("least", [2, 5])
def test_frequent_pieces_match_brute_force(spark, least):
    random = np.random.default_rng(least)
    words = Counter("▁" + "".join(random.choice(list("abcé"), random.integers(1, 30))) for _ in range(120))
    words.update({"▁abcabcabcabcabc": 4, "▁a": 9, "▁": 3, "▁aaaaaaaaaaaaaaaaaaaaaaaaa": 1})
    expected = Counter()
    for word, n in words.items():
        for i in range(len(word)):
            for size in range(2, min(16, len(word) - i) + 1):
                expected[word[i : i + size]] += n
    rows = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    found = {r["piece"]: r["n"] for r in subword.frequent_pieces(rows, least, 16).collect()}
    assert found == {p: n for p, n in expected.items() if n >= least}
    best = sorted(found, key=lambda p: (-found[p] * len(p), p))[:50]
    if least == 2:
        assert [r["piece"] for r in subword.seed_pieces(rows, SubwordConfig(seed_size=50)).collect()] == best


def nearest_tokens(found, token, among, n=5):
    unit = lambda v: v / np.linalg.norm(v)
    return sorted(among, key=lambda s: -(unit(found[s]) @ unit(found[token])))[:n]


def test_typing_errors_stay_close(spark):
    """One sign left out, doubled or changed: the right token is among the nearest five of some hundreds."""
    random = np.random.default_rng(3)
    syllables = "ra ne mo li que vi tor hu go ba st en pa ris du bo la ru fo ch ma clerc jean jau res sa int mar tin".split()
    names = sorted({"".join(random.choice(syllables, random.integers(2, 5))) for _ in range(400)})
    types = ["rue", "avenue", "place", "quai"]
    lists = [(i, [types[i % 4], "de", "la", names[i % len(names)], names[(i * 7 + 3) % len(names)]]) for i in range(6000)]
    docs = spark.createDataFrame(lists, "id long, tokens array<string>")
    config = EmbeddingConfig(vector_size=48, shard_tokens=8000)
    words, ngrams = skipgram.train_vectors(docs, config)
    typos = {}
    for n, name in enumerate(n for n in names if len(n) > 5):
        i = int(random.integers(1, len(name) - 1))
        typo = (name[:i] + name[i + 1 :], name[:i] + name[i] + name[i:], name[:i] + "z" + name[i + 1 :])[n % 3]
        if typo not in names:
            typos[typo] = name
    wanted = spark.createDataFrame([(t,) for t in [*names, *typos, "%%%"]], "token string")
    found = {r["token"]: np.array(r["vector"]) for r in embedding.token_vectors(wanted, words, ngrams, config).collect()}
    assert "%%%" not in found
    hits = [name in nearest_tokens(found, typo, names) for typo, name in typos.items()]
    assert len(hits) > 200 and np.mean(hits) > 0.8


def test_tokens_of_like_contexts_are_alike(spark):
    """Two languages of tokens that never meet end up apart."""
    random = np.random.default_rng(4)
    sides = [[f"{x}{i}" for i in range(60)] for x in ("ab", "cd")]
    lists = [(i, [str(t) for t in random.choice(sides[i % 2], 8)]) for i in range(4000)]
    docs = spark.createDataFrame(lists, "id long, tokens array<string>")
    config = EmbeddingConfig(vector_size=16, epochs=3, min_n=20, max_n=20)  # no n-gram tells the sides apart
    words, ngrams = skipgram.train_vectors(docs, config)
    assert ngrams.count() == 0
    found = {r["token"]: np.array(r["vector"]) for r in words.collect()}
    assert len(found) == 120
    right = [sum(t[:2] == token[:2] for t in nearest_tokens(found, token, [x for x in found if x != token])) for token in found]
    assert np.mean(right) > 4.9


def test_vectors_do_not_depend_on_partitions_or_batches(spark):
    random = np.random.default_rng(6)
    vocabulary = [f"token{i}" for i in range(80)]
    lists = [(i, [str(t) for t in random.choice(vocabulary, random.integers(0, 30))]) for i in range(900)]
    lists += [(1, lists[0][1])] * 100 + [(2, None), (3, [])]
    config = EmbeddingConfig(vector_size=8, epochs=2, shard_tokens=3000)
    docs = spark.createDataFrame(lists, "id long, tokens array<string>")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    results = []
    try:
        for partitions, rows in ((1, "10000"), (7, "64")):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
            tables = skipgram.train_vectors(docs.repartition(partitions), config)
            results.append([sorted(map(tuple, ((r[0], tuple(r[1])) for r in t.collect()))) for t in tables])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert results[0] == results[1] and len(results[0][0]) == 80
    assert skipgram._dealt(docs, skipgram.Vocabulary(vocabulary, np.ones(80), np.arange(80), np.arange(81)), config)[1] > 3


def test_vectors_are_trained_without_the_model_on_the_driver(spark, monkeypatch):
    """What is collected has a row per distinct count of tokens, and a joined vocabulary gives the same vectors."""
    random = np.random.default_rng(8)
    lists = [(i, [f"token{t}" for t in random.integers(0, 300, 20)]) for i in range(400)] + [(1, None), (2, []), (3, ["seldom"] * 2)]
    docs = spark.createDataFrame(lists, "id long, tokens array<string>")
    config = EmbeddingConfig(vector_size=8, epochs=2, shard_tokens=3000)
    collected = []
    for name in ("toArrow", "toPandas"):
        old = getattr(type(docs), name)
        monkeypatch.setattr(type(docs), name, lambda self, old=old: (rows := old(self), collected.append(len(rows)))[0])
    joined = skipgram.train_vectors(docs, config, SkewLimits(broadcast_bytes=1))
    assert max(collected) < 100
    monkeypatch.undo()
    results = [[sorted((r[0], tuple(r[1])) for r in t.collect()) for t in tables] for tables in (joined, skipgram.train_vectors(docs, config))]
    assert results[0] == results[1] and len(results[0][0]) == 300


def test_frequencies_draw_as_single_tokens_do():
    counts = np.array([9.0, 9.0, 7.0, 5.0, 5.0, 5.0])
    frequencies = skipgram.Frequencies(np.array([9.0, 7.0, 5.0]), np.array([0, 2, 3, 6]))
    uniform = np.random.default_rng(3).random((50, 7))
    weight = counts**skipgram.FLATTEN
    single = np.minimum(np.searchsorted(np.cumsum(weight / weight.sum()), uniform), 5)
    assert (frequencies.draw(uniform) == single).all()
    share = counts / counts.sum()
    assert np.array_equal(frequencies.keep(np.arange(6)), np.minimum(1, np.sqrt(skipgram.THIN / share) + skipgram.THIN / share))


def test_gradient_of_a_step_against_differences():
    """A small step raises the pairs' likelihood as much as its gradient says."""
    random = np.random.default_rng(2)
    counts = np.array([5.0, 4.0, 3.0, 2.0])
    vocabulary = skipgram.Vocabulary(list("abcd"), counts, np.array([0, 4, 1, 2, 4, 5, 3]), np.array([0, 2, 3, 6, 7]))
    model = skipgram.Model.start(4, 2, 6, 1)
    model.input[:] = random.standard_normal(model.input.shape)
    model.output[:] = random.standard_normal(model.output.shape)
    trainer = skipgram.Trainer(model, vocabulary, EmbeddingConfig(vector_size=6, negative=3), 0.0, [1])
    moves = {}
    trainer.move = lambda matrix, rows, seen, place, gradient: moves.__setitem__(id(matrix), (rows, gradient))
    vectors = random.standard_normal((4, 6)).astype(np.float32)
    centre, context = np.array([0, 2, 2, 3, 1]), np.array([1, 0, 3, 2, 2])
    state = trainer.random.bit_generator.state
    trainer.step(vectors, np.arange(4), centre, context)
    trainer.random.bit_generator.state = state
    drawn = np.minimum(np.searchsorted(trainer.drawn, trainer.random.random((1, 3))), 3)[0]

    def likelihood(inner, outer):
        sigmoid = lambda x: 1 / (1 + np.exp(-x))
        total = 0.0
        for c, o in zip(centre, context, strict=True):
            total += np.log(sigmoid(inner[c] @ outer[o])) + sum(np.log(sigmoid(-inner[c] @ outer[d])) for d in drawn if d != o)
        return total

    inner, outer = vectors.astype(np.float64), model.output.astype(np.float64)
    for target, (rows, gradient) in ((0, moves[id(vectors)]), (1, moves[id(trainer.model.output)])):
        for row, slope in zip(rows, gradient, strict=True):
            for k in range(6):
                sides = []
                for sign in (1e-5, -1e-5):
                    moved = [inner.copy(), outer.copy()]
                    moved[target][row, k] += sign
                    sides.append(likelihood(*moved))
                assert (sides[0] - sides[1]) / 2e-5 == pytest.approx(slope[k], abs=1e-3)


def test_no_frequent_token_gives_empty_tables(spark):
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, None)], "id long, tokens array<string>")
    assert [t.count() for t in skipgram.train_vectors(docs, EmbeddingConfig(vector_size=4))] == [0, 0]
    assert embedding.train_word_vectors(docs.where("false")).count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 20, 8 * 3 * 20])
def test_vector_sums_in_blocks(spark, block_bytes):
    """Sums over blocks of pairs: repeated and unknown tokens, null keys, and a key of more pairs than a block."""
    random = np.random.default_rng(8)
    held = {f"t{i}": random.standard_normal(3) for i in range(30)}
    rows = [(t, [float(x) for x in v]) for t, v in held.items()] + [("t1", [1.0, 2.0, 3.0]), (None, [1.0, 1.0, 1.0])]
    pairs = [(k, f"t{random.integers(0, 35)}", float(random.random())) for k in [*range(40), None] for _ in range(4)]
    pairs += [(7, f"t{i % 35}", 0.5) for i in range(200)] + [(90, "t99", 1.0), (3, None, 1.0)]
    want, n = {}, {}
    for k, t, share in pairs:
        for token, v in rows:
            if t is not None and token == t:
                want[k] = want.get(k, 0) + share * np.array(v)
                n[k] = n.get(k, 0) + 1
    got = vector_sums(
        spark.createDataFrame(pairs, "key long, token string, share double"),
        spark.createDataFrame(rows, "token string, vector array<double>"), 3, block_bytes,
    ).collect()
    assert len(got) == len(want) and {r["key"]: r["n"] for r in got} == n
    for r in got:
        assert r["vector"] == pytest.approx(want[r["key"]])


def test_copies_of_a_token_count_once_each_in_its_ngrams(spark):
    """Two rows of one token weigh twice as much as one row of another, not four times."""
    rows = [("abc", [1.0]), ("abc", [3.0]), ("abd", [8.0])]
    found = embedding.ngram_vectors(spark.createDataFrame(rows, "token string, vector array<double>"))
    got = {r["ngram"]: r["vector"][0] for r in found.collect()}
    assert got["<ab"] == pytest.approx(4.0) and got["abc"] == pytest.approx(2.0) and got["abd"] == pytest.approx(8.0)


def test_vectors_are_shuffled_once_a_block(spark):
    """No row of the plan carries a vector per document and term."""
    terms = spark.createDataFrame([(i, f"t{i % 3}", 1, 1, 1.0) for i in range(50)], "id long, term string, tf long, doc_len long, weight double")
    vectors = spark.createDataFrame([(f"t{i}", [float(i), 1.0]) for i in range(3)], "token string, vector array<double>")
    found = bm25.mean_vectors(terms, vectors, bm25.SkewLimits(broadcast_bytes=1), 2)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().toString()
    assert {r["id"]: r["vector"] for r in found.collect()} == {i: [float(i % 3), 1.0] for i in range(50)}


def vectors_frame(spark, matrix, name):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} long, vector array<double>")


def brute_nearest(queries, references):
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = unit(queries) @ unit(references).T
    return scores.argmax(axis=1), scores.max(axis=1)


@pytest.fixture(scope="module")
def crowded(spark):
    """Crowded references of which a third are copies of one, and queries near them."""
    random = np.random.default_rng(5)
    references = random.standard_normal((900, 16)) * 0.4 + 1.0
    references[600:] = references[17]
    queries = references[random.permutation(900)[:500]] + random.standard_normal((500, 16)) * 0.05
    queries[:150] = queries[0]
    return queries, references


def test_exact_nearest_is_brute_force(spark, crowded):
    queries, references = crowded
    config = NeighbourConfig(trees=2, leaf_size=50, chunk_rows=40, exact=True)
    found = neighbours.nearest(
        vectors_frame(spark, queries, "query_id"), vectors_frame(spark, references, "reference_id"), config
    ).collect()
    at, score = brute_nearest(queries, references)
    assert {r["query_id"]: r["reference_id"] for r in found} == dict(enumerate(at))
    assert all(r["model_score"] == pytest.approx(score[r["query_id"]]) for r in found)


def test_best_rows_are_brute_force():
    """Tiles in single precision find the true best, the first of equal references, and spread over several tiles."""
    random = np.random.default_rng(12)
    references = random.standard_normal((2500, 24)) + 0.5
    references[1200:1900] = references[31]
    references[2000:2400] = references[40] + random.standard_normal((400, 24)) * 1e-6  # closer than single precision tells
    queries = references[random.permutation(2500)[:1300]] + random.standard_normal((1300, 24)) * 1e-7
    unit = [x / np.linalg.norm(x, axis=1)[:, None] for x in (queries, references)]
    at, top = neighbours._best_rows(*unit)
    scores = np.einsum("ij,kj->ik", *unit)
    assert top == pytest.approx(scores.max(axis=1), abs=1e-12)
    assert scores[np.arange(1300), at] == pytest.approx(scores.max(axis=1), abs=1e-12)
    assert not ((at >= 1200) & (at < 1900)).any()


def test_rows_of_a_crowded_cell_are_copied_to_few_chunks(spark):
    """The copies of a row do not grow with the cell until chunks reach their bound of bytes."""
    rows = spark.range(20_000).select(F.lit(0).cast("long").alias("cell"))
    chunks = lambda size: neighbours._chunk_counts(rows, "n", 40, size).first()["n"]
    assert chunks(16) == neighbours.CELL_CHUNKS
    assert chunks(neighbours.CHUNK_VECTOR_BYTES // (8 * 100)) == 200  # a hundred rows fill a chunk
    assert neighbours._chunk_counts(rows.limit(90), "n", 40, 16).first()["n"] == 3


def test_trees_find_nearly_all(spark, crowded):
    queries, references = crowded
    found = neighbours.nearest(
        vectors_frame(spark, queries, "query_id"), vectors_frame(spark, references, "reference_id"),
        NeighbourConfig(trees=16, leaf_size=50, chunk_rows=40),
    ).collect()
    at, _ = brute_nearest(queries, references)
    assert len(found) == len(queries)
    assert np.mean([at[r["query_id"]] == r["reference_id"] for r in found]) > 0.95


def leaf_sizes(spark, references, config):
    unit = neighbours.distinct_references(neighbours.unit_vectors(references, "reference_id"))
    trees = neighbours.grow_trees(unit, config)
    return trees, neighbours.deal_to_leaves(unit, "reference_id", trees).groupBy("cell").count()


def test_leaves_are_balanced(spark, crowded):
    references = vectors_frame(spark, crowded[1], "reference_id")
    for upper in (16, 2):  # all levels broadcast, or the lower two joined
        trees, sizes = leaf_sizes(spark, references, NeighbourConfig(trees=4, leaf_size=50, upper_levels=upper))
        assert trees.depth == 4 and len(trees.deeper) == (2 if upper == 2 else 0)
        assert sizes.agg(F.sum("count"), F.max("count"), F.count("*")).first()[:] == (2400, 38, 64)


def test_sixteen_levels_stay_balanced(spark):
    """As deep as trees over 67 million references; the leaf holds few here, so that as many levels fit."""
    rows = spark.range(1 << 19).select(
        F.col("id").alias("reference_id"),
        F.array(*[F.pow(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1 << 30)) / (1 << 30), 3) for k in range(4)]).alias("vector"),
    )
    trees = neighbours.grow_trees(rows, NeighbourConfig(trees=1, leaf_size=8, upper_levels=14), 1 << 19)
    assert trees.depth == 16 and len(trees.deeper) == 2
    sizes = neighbours.deal_to_leaves(rows, "reference_id", trees).groupBy("cell").count()
    most, mean, leaves = sizes.agg(F.max("count"), F.avg("count"), F.count("*")).first()
    assert leaves == 1 << 16 and most / mean < 1.3


def test_deeper_levels_find_the_same(spark, crowded):
    queries = vectors_frame(spark, crowded[0], "query_id")
    references = vectors_frame(spark, crowded[1], "reference_id")
    found = [
        sorted(map(tuple, neighbours.nearest(queries, references, NeighbourConfig(trees=3, leaf_size=50, upper_levels=u)).collect()))
        for u in (16, 1)
    ]
    assert found[0] == found[1]


@pytest.mark.parametrize("pivot_bytes", [1 << 26, 8 * 16 * 5])
def test_exact_search_prunes_on_two_levels(spark, pivot_bytes):
    """Clustered vectors: most cells are ruled out, and the true nearest is found whatever their number."""
    random = np.random.default_rng(8)
    centres = random.standard_normal((30, 16))
    references = centres[random.integers(0, 30, 3000)] + random.standard_normal((3000, 16)) * 0.1
    queries = centres[random.integers(0, 30, 400)] + random.standard_normal((400, 16)) * 0.1
    config = NeighbourConfig(trees=1, leaf_size=100, chunk_rows=500, exact=True, pivot_bytes=pivot_bytes)
    r = vectors_frame(spark, references, "reference_id")
    unit = neighbours.unit_vectors(r, "reference_id").cache()
    pivots = neighbours.choose_pivots(unit, 3000, config)
    cells, groups = (5, 3) if pivot_bytes < 1000 else (55, 8)
    assert (len(pivots.cells), len(pivots.groups), pivots.first[-1]) == (cells, groups, cells)
    found = neighbours.nearest(vectors_frame(spark, queries, "query_id"), r, config).collect()
    at, score = brute_nearest(queries, references)
    assert {r["query_id"]: r["reference_id"] for r in found} == dict(enumerate(at))
    placed = neighbours._nearest_pivot(unit, pivots)
    ranges = [neighbours._ranges(placed, k, a, n) for k, a, n in (("cell", "angle", cells), ("group", "group_angle", groups))]
    lengths = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    open_cells = neighbours._reachable(lengths, pivots.cells, ranges[0], score)
    open_groups = neighbours._reachable(lengths, pivots.groups, ranges[1], score)
    if cells == 55:
        assert open_groups.mean() < 0.9 and open_cells.mean() < 0.5
    unit.unpersist()


def test_threshold_and_empty_sides(spark, crowded):
    q = vectors_frame(spark, crowded[0], "query_id")
    r = vectors_frame(spark, crowded[1], "reference_id")
    config = NeighbourConfig(leaf_size=50, exact=True)
    counts = [neighbours.nearest(q, r, config, t).count() for t in (-1.0, 0.99, 0.998, 1.0)]
    assert counts == sorted(counts, reverse=True) and counts[0] == 500 and counts[-1] == 0
    assert neighbours.nearest(q, r.where("false"), config, 0.5).count() == 0
    assert neighbours.nearest(q.where("false"), r, config, 0.5).count() == 0
    zero = vectors_frame(spark, np.zeros((2, 16)), "reference_id")
    assert neighbours.nearest(q, zero, config).count() == 0


def test_documents_without_tokens_have_the_zero_vector(spark):
    docs = spark.createDataFrame([(1, None), (2, []), (3, ["x", "zz"]), (4, ["zz"])], "id long, tokens array<string>")
    vectors = spark.createDataFrame([("x", [2.0, 4.0])], "token string, vector array<double>")
    found = {r["id"]: r["vector"] for r in embedding.document_vectors(docs, vectors, None, 2).collect()}
    assert found == {1: [0, 0], 2: [0, 0], 3: [1, 2], 4: [0, 0]}
    none = embedding.document_vectors(docs, vectors.where("false"), None, 2).collect()
    assert sorted(r["vector"] for r in none) == [[0, 0]] * 4


def test_searches_ask_for_every_row(spark, tmp_path):
    from catalogue import model_queries
    from catalogue.registry import QUERIES

    random = np.random.default_rng(11)
    vectors = random.standard_normal((230, 8)).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert "%" not in model_queries.NEAREST_SQL
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    true = dict(enumerate((unit[:, ::-1] @ unit.T).argmax(1).tolist()))
    for name in ("j5_nearest_exact", "j5_nearest_single_leaf"):
        assert {r["query_id"]: r["reference_id"] for r in QUERIES[name](spark, str(tmp_path)).collect()} == true


def test_recall_asks_for_every_row(spark, tmp_path):
    from catalogue import model_queries  # noqa: F401
    from catalogue.registry import QUERIES

    vectors = np.random.default_rng(11).standard_normal((230, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert QUERIES["j5_recall"](spark, str(tmp_path)).first()["queries"] == 230


def test_sums_as_numbers_equal_sums_of_logarithms():
    """Short words are summed without logarithms, long ones with them; both give the same."""
    rng = np.random.default_rng(5)
    score = np.log(rng.random((9, 4, 6)))
    score[rng.random(score.shape) < 0.4] = -np.inf
    score[:, 0] = np.maximum(score[:, 0], -12.0)  # a single sign always has a score
    for start in range(9):
        score[start, 9 - start :] = -np.inf
    places = np.nonzero(score > -np.inf)
    for plain, logs in zip(lattice._sums(score, places), lattice._log_sums(score, places), strict=True):
        assert np.allclose(plain, logs, rtol=1e-12)


def test_batches_are_cut_in_portions():
    """However long its texts, a worker cuts a batch in runs of bounded size, in order."""
    half = subword.TEXT_SIGNS // 2
    texts = pd.Series(["", "a" * half, "b", "c" * half, "d" * (3 * half), "", "e"])
    portions = list(subword._portions(texts))
    assert pd.concat(portions).tolist() == texts.tolist() and len(portions) > 2
    assert all(p.str.len().sum() - p.str.len().max() <= subword.TEXT_SIGNS for p in portions)
    assert [len(p) for p in subword._portions(pd.Series([], dtype=object))] == [0]


def test_runs_are_summed_as_reduceat_does():
    random = np.random.default_rng(4)
    for runs in (1, 5, 400):
        length = np.concatenate([random.integers(1, 6, runs), [1, 300]])
        first = np.cumsum(length) - length
        values, order = random.standard_normal((700, 3)), random.integers(0, 700, length.sum())
        assert skipgram._run_sums(values, order, first) == pytest.approx(np.add.reduceat(values[order], first, axis=0))
    assert skipgram._run_sums(np.zeros((0, 3)), np.zeros(0, int), np.zeros(0, int)).shape == (0, 3)
    packed = skipgram._packed(values[:50].astype(np.float32))
    assert np.array_equal(skipgram._unpacked(packed.slice(7, 20)), values[7:27].astype(np.float32))


def test_shards_do_not_outnumber_what_the_model_leaves_room_for(spark, monkeypatch):
    """A shard is dealt most of the model, so a corpus of many rare tokens has fewer shards; each is a task of its own."""
    lists = [(i, [f"word{(7 * i + k) % 1500}" for k in range(10)]) for i in range(1500)]
    docs = spark.createDataFrame(lists, "id long, tokens array<string>")
    seen, dealt = [], skipgram._dealt
    monkeypatch.setattr(skipgram, "_dealt", lambda *args: (seen.append(dealt(*args)), seen[0])[1])
    words, _ = skipgram.train_vectors(docs, EmbeddingConfig(vector_size=4, epochs=1, min_n=30, max_n=30, shard_tokens=1000))
    shards, rows = seen[0][1], 2 * 1500
    assert words.count() == 1500 and 1 < shards <= -(-15_000 // (skipgram.ROW_TOKENS * rows)) < 15
    parts = seen[0][0].repartitionById(shards, "shard").select("shard", skipgram.F.spark_partition_id().alias("task")).distinct().collect()
    assert len(parts) == shards and all(r["shard"] == r["task"] for r in parts)


def test_orders_are_grouped_once_for_weighted_components(spark, tmp_path):
    from catalogue import model_queries  # noqa: F401
    from catalogue.registry import QUERIES

    lines = [(o, o % 4 + k) for o in range(40) for k in range(3)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    vectors = [(i, [float(i)] * 64) for i in range(6)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    found = QUERIES["a4_vector_components"](spark, str(tmp_path))
    assert "collect_list" not in found._jdf.queryExecution().toString()
    assert found.count() == 40 and all(len(r["components"].split(" ")) == 64 for r in found.collect())
