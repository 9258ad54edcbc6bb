import dataclasses

import pytest
from pyspark.sql import functions as F

from catalogue import frames, text_queries  # noqa: F401
from catalogue.link_queries import candidate_pairs
from catalogue.model_queries import JOB
from catalogue.registry import QUERIES, SQL
from rapproche.config import EmbeddingConfig, Parity, SubwordConfig, Thresholds
from rapproche.operators import matching, scoring
from rapproche.operators.matching import merged_columns
from rapproche.operators.skew import SkewLimits
from rapproche.operators.model_store import ModelStore, digest, fit_or_load
from rapproche.plans.link import RUN, link_entries, link_files, run_link, train_models
from rapproche.session import stage
from rapproche.sources import sinks
from rapproche.sources.sinks import numbered_merged

SF = "/root/testdata/sf0.001"
ROWS1 = [
    ("1", "Café du Port", "3", "rue", "Victor Hugo", "", "75011", "Paris"),
    ("2", "Boulangerie Martin", "12", "avenue", "Foch", "", "69006", "Lyon"),
    ("3", "Garage Central", "8", "quai", "des Belges", "", "13001", "Marseille"),
    ("4", "Pharmacie", "1", "rue", "du Bac", "", "01000", "Bourg"),
]
ROWS2 = [
    ("3 rue Victor Hugo, 75011 Paris", "w", "1", "cafe port"),
    ("12 avenue Foch, 69006 Lyon", "w", "b2", "Boulangerie Martin"),
    ("8 quai des Belges, 13002 Marseille", "w", "b3", "Garage Central"),
    ("99 rue du Bac, 1000 Bourg", "w", "b4", "Pharmacie"),
    ("nulle part", "w", "b5", "Inconnu"),
]


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("in")
    one, two = folder / "one.tsv", folder / "two.tsv"
    one.write_text("h\n" + "\n".join("\t".join(r) for r in ROWS1) + "\n")
    two.write_text("h\n" + "\n".join("\t".join(r) for r in ROWS2) + "\nbad\tline\n")
    config = dataclasses.replace(
        JOB,
        thresholds=Thresholds(model=-1.0),
        subwords=SubwordConfig(vocab_size=60, seed_size=200),
        embedding=EmbeddingConfig(vector_size=16, min_count=1),
    )
    return link_files(spark, str(one), str(two), config)


def test_links_by_id_and_by_similarity(result):
    pairs = {(r["match_type"], r["table1_rawid1"], r["table2_rawid2"]) for r in result.merged.collect()}
    # Different postal codes keep b3 apart; street numbers are not compared, so b4 links.
    assert pairs == {("id", "1", "1"), ("similarity", "2", "b2"), ("similarity", "4", "b4")}
    assert [r["n_fields"] for r in result.rejects.collect()] == [2]


def test_sinks(spark, result, tmp_path):
    merged, scores = str(tmp_path / "merged"), str(tmp_path / "scores")
    sinks.write_merged_tsv(result.merged, merged, single_file=True)
    sinks.write_scores_tsv(result.scores, scores, single_file=True)
    lines = [r[0].split("\t") for r in spark.read.text(merged).collect()]
    assert lines[0] == ["merged_id", *merged_columns()]
    assert [line[0] for line in lines[1:]] == ["1", "2", "3"]
    assert lines[1][1:4] == ["1", "cafe port", "3"]
    assert len(spark.read.text(scores).collect()) == 3
    sinks.write_merged_tsv(result.merged.where("false"), str(tmp_path / "none"), single_file=True)
    assert [r[0].split("\t")[0] for r in spark.read.text(str(tmp_path / "none")).collect()] in ([], ["merged_id"])


def test_job_properties(spark):
    table1 = stage(frames.entries1(spark, SF), "e1")
    table2 = stage(frames.entries2(spark, SF), "e2")
    found = link_entries(table1, table2, dataclasses.replace(JOB, thresholds=Thresholds(model=0.5)))
    by_id = found.merged.where("match_type = 'id'")
    similar = found.scores
    assert similar.count() == similar.select("query_id").distinct().count()
    linked = by_id.select(F.col("table2_rawid2").alias("query_rawid"))
    assert similar.join(linked, "query_rawid", "left_semi").count() == 0
    assert by_id.count() == 33
    swapped = dataclasses.replace(JOB, thresholds=Thresholds.open(), query_table="table1")
    turned = link_entries(table1, table2, swapped, models=found.models)
    assert turned.scores.count() == 119


def test_raising_a_threshold_never_adds_pairs(spark):
    rows = QUERIES["f9_score_pairs_open"](spark, SF)
    assert rows.count() == 269
    pairs = stage(candidate_pairs(spark, SF), "pairs")
    seen = None
    for name in (-1.0, 0.5, 0.8, 0.95):
        kept = scoring.score_pairs(pairs, dataclasses.replace(Thresholds(), name=name))
        ids = {(r["query_id"], r["reference_id"]) for r in kept.select("query_id", "reference_id").collect()}
        assert seen is None or ids <= seen
        seen = ids


def test_models_are_found_by_settings_and_corpus(spark, tmp_path):
    config = dataclasses.replace(JOB, model_dir=str(tmp_path / "models"))
    t1, t2 = stage(frames.entries1(spark, SF), "e1"), stage(frames.entries2(spark, SF), "e2")
    rows = lambda models: {n: sorted(map(str, getattr(models, n).collect())) for n in ("pieces", "word_vectors", "ngrams")}
    stores = [ModelStore(spark, f"{config.model_dir}/{n}") for n in ("pieces", "embeddings")]
    first = rows(train_models(t1, t2, None, config))
    assert all(first.values()) and [s.manifests().count() for s in stores] == [1, 1]
    assert rows(train_models(t1.repartition(3), t2, None, config)) == first  # same corpus in another order
    assert [s.manifests().count() for s in stores] == [1, 1]
    other = dataclasses.replace(config, embedding=dataclasses.replace(config.embedding, vector_size=8))
    assert rows(train_models(t1, t2, None, other))["pieces"] == first["pieces"]
    assert [s.manifests().count() for s in stores] == [1, 2]
    train_models(t1, t2.limit(50), None, config)  # another corpus of pieces; the embeddings depend on the pieces too
    assert stores[0].manifests().count() == 2
    assert rows(train_models(t1, t2, None, config)) == first


def test_half_written_models_are_not_seen(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "store"))
    assert store.load("a") is None
    rows = spark.range(3)

    def fails():
        bad = spark.range(1).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
        return {"one": rows, "two": bad}

    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            fit_or_load(spark, store.folder, {"x": 1}, lambda: "s", fails)
    assert store.manifests().count() == 0
    unfinished = tmp_path / "store" / "manifests" / "b-1" / "_temporary"
    unfinished.mkdir(parents=True)
    assert store.load("b") is None
    made = fit_or_load(spark, store.folder, {"x": 1}, lambda: "s", lambda: {"one": rows, "two": rows.where("id < 0")})
    found = fit_or_load(spark, store.folder, {"x": 1}, lambda: "s", fails)
    assert [found[t].count() for t in ("one", "two")] == [made[t].count() for t in ("one", "two")] == [3, 0]
    newer = store.save(digest({"x": 1}, "s"), {"one": spark.range(5)})
    assert newer["one"].count() == 5 and store.manifests().count() == 2
    assert fit_or_load(spark, None, {"x": 1}, fails, lambda: {"one": rows})["one"].count() == 3


def test_names_of_statements_and_queries_agree():
    assert set(SQL) <= set(QUERIES)


def test_pair_checks_run_in_stages(spark):
    pairs = stage(candidate_pairs(spark, SF), "pairs")
    plan = scoring.score_pairs(pairs)._jdf.queryExecution().executedPlan().toString()
    # The city filter stands between the evaluation of its own score and that of the others.
    last, first = plan.index("ArrowEvalPython"), plan.rindex("ArrowEvalPython")
    assert last < plan.index("Filter", last) < first
    strict = scoring.score_pairs(pairs, Thresholds(), Parity.intended()).count()
    assert strict <= scoring.score_pairs(pairs).count()


def test_run_writes_everything(spark, tmp_path):
    one, two = tmp_path / "one.tsv", tmp_path / "two.tsv"
    one.write_text("h\n" + "\n".join("\t".join(r) for r in [*ROWS1, ("", *ROWS1[0][1:])]) + "\n")
    two.write_text("h\n" + "\n".join("\t".join(r) for r in [*ROWS2, (*ROWS2[0][:2], "", ROWS2[0][3])]) + "\nbad\tline\n")
    small = {"subwords": SubwordConfig(vocab_size=60, seed_size=200), "embedding": EmbeddingConfig(vector_size=16, min_count=1)}
    config = dataclasses.replace(RUN, thresholds=Thresholds(model=-1.0), **small)
    counts = {r["match_type"]: r["n"] for r in run_link(spark, str(one), str(two), str(tmp_path / "out"), config).collect()}
    pairs = {r["kind"]: (r["ids"], int(r["pairs"])) for r in spark.read.parquet(str(tmp_path / "out" / "id_pairs")).collect()}
    assert pairs == {"blank": (1, 1), "other": (1, 1)}
    assert counts["id"] == 1 and counts["similarity"] >= 2  # the rows without id are left to similarity
    assert spark.read.parquet(str(tmp_path / "out" / "rejects")).count() == 1
    merged = [r[0].split("\t") for r in spark.read.text(str(tmp_path / "out" / "merged")).collect()]
    assert len([m for m in merged if m[0] != "merged_id"]) == sum(counts.values())


def test_id_matches_are_numbered_in_the_join(spark):
    """Equal rows, blank ids and ids of one list only; numbers are those that sorting all pairs gives."""
    columns = "rawid string, name string, street_number string, address string, postal_code string, city string, extra string"

    def entries(ids, names):
        return spark.createDataFrame([(i, n, "", "", "", "", "") for i, n in zip(ids, names, strict=True)], columns)

    table1 = entries(["", "", "", "a", "a", "a", "b", "c", None], "xxyuuvwpq")
    table2 = entries(["", "", "", "", "a", "a", "d", "c", None], "zzkmsttpq")
    limits = SkewLimits(task_rows=3, task_pairs=4)
    by_id = matching.link_by_id(table1, table2, limits=limits, numbered=True)
    similar = matching.link_by_id(entries("fe", "ab"), entries("fe", "ab"))
    found = numbered_merged(matching.combine(by_id, similar), matching.pair_count(table1, table2)).collect()
    sorted_pairs = numbered_merged(matching.combine(matching.link_by_id(table1, table2), similar)).collect()
    assert len(found) == 21 and sorted(map(tuple, found)) == sorted(map(tuple, sorted_pairs))
