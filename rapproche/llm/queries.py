"""Queries of the pipeline operators over the given tables, with the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rapproche.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it is tested against a brute-force version instead."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op5_bpe_round_trip")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from rapproche.llm.bpe import BpeModel, digests

    model = BpeModel.load(str(public_tokenizers.path("word_bpe_49k.json")))
    return digests(table(spark, folder, "documents"), model, "doc_id")


@query("op6_line_dedup", """
WITH lines AS (
  SELECT doc_id, i, line,
         translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
repeated AS (
  SELECT key, max(doc_id) AS last_doc FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT l.doc_id, l.i, l.line, coalesce(l.doc_id < r.last_doc, false) AS dropped
  FROM lines l LEFT JOIN repeated r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    from rapproche.llm.line_dedup import dedup_lines

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return dedup_lines(docs, scratch_path(spark, "lines")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def _secret_sql() -> str:
    """Spans from the gaps between matches, as in the operator; found in every text, without an index."""
    from rapproche.llm.secret_scan import BASE_RULES, RULES

    parts = []
    for number, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
SELECT doc_id, '{rule.kind}' AS kind, {number} AS number,
       unnest(list_transform(range(1, len(m) + 1), lambda i: {{'s': list_sum([length(x) for x in g[1:i]])
         + coalesce(list_sum([length(x) for x in m[1:i - 1]]), 0), 'm': length(m[i]), 'v': length(v[i])}})) AS span
FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS g, regexp_extract_all(text, '{pattern}') AS m,
             regexp_extract_all(text, '{pattern}', {rule.group}) AS v FROM documents
      WHERE regexp_matches(text, '{pattern}'))""")
    least = " ".join(f"WHEN '{r.kind}' THEN {r.least}" for r in RULES)
    base = ", ".join(f"'{r.kind}'" for r in BASE_RULES)
    joined = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, number)"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)
    return f"""
WITH spans AS ({" UNION ALL ".join(parts)}),
kept AS (SELECT doc_id, kind, number, CAST(span.s AS BIGINT) AS s, CAST(span.s + span.m AS BIGINT) AS e FROM spans
         WHERE span.v >= CASE kind {least} END)
SELECT d.doc_id, {counts},
       sha256(coalesce({joined} FILTER (WHERE kind IN ({base})), '')) AS base_sha256, coalesce({joined}, '') AS spans
FROM documents d LEFT JOIN kept USING (doc_id) GROUP BY d.doc_id"""


@query("op1_secret_scan", _secret_sql())
def op1(spark: SparkSession, folder: str) -> DataFrame:
    from rapproche.llm.secret_scan import digests

    return digests(table(spark, folder, "documents"))


@query("op9_quality_rules")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    from rapproche.llm.quality import digests

    return digests(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op3_minhash_dedup")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    from rapproche.llm.minhash import components_of

    return components_of(table(spark, folder, "documents"), size=2)


@query("op10_substring_dedup", """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS h
  FROM words, LATERAL (SELECT unnest(range(1, len(w) - 48)) AS s)),
early AS (SELECT h, min(doc_id) AS first_doc FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)),
found AS (SELECT doc_id, s FROM windows JOIN early USING (h) WHERE doc_id > first_doc),
gone AS (SELECT DISTINCT doc_id, s + k AS i FROM found, (SELECT unnest(range(0, 50)) AS k)),
one AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
rest AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM one ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN rest USING (doc_id)
""")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    from rapproche.llm.substrings import digests

    return digests(table(spark, folder, "documents"))


def _mixing_sql() -> str:
    """Fitting written out sweep by sweep; the factor is found among the sorted ratios."""
    from rapproche.llm.mixing import DIMENSIONS, OTHER_TOPIC, SWEEPS, TEMPER, TOPICS, WORD

    topic = " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in TOPICS)
    steps, last = [], "start"
    for sweep in range(SWEEPS):
        for name in DIMENSIONS:
            steps.append(
                f"s{sweep}_{name} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN sum(w) OVER (PARTITION BY {name}) > 0 "
                f"THEN w * t_{name} / sum(w) OVER (PARTITION BY {name}) ELSE 0 END AS w) FROM {last})"
            )
            last = f"s{sweep}_{name}"
    shares = ", ".join(
        f"{n}s AS (SELECT {n}, pow(sum(w), {TEMPER[n]}) / sum(pow(sum(w), {TEMPER[n]})) OVER () AS t_{n} FROM cells GROUP BY {n})"
        for n in DIMENSIONS
    )
    return f"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, source, lang, CASE {topic} ELSE '{OTHER_TOPIC}' END AS topic,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n_tokens FROM documents),
cells AS MATERIALIZED (
  SELECT source, lang, topic, sum(n_tokens) AS tokens, sum(n_tokens) / (SELECT sum(n_tokens) FROM docs) AS w
  FROM docs GROUP BY ALL),
{shares},
start AS MATERIALIZED (
  SELECT c.*, t_source, t_lang, t_topic, w AS own FROM cells c JOIN sources USING (source) JOIN langs USING (lang)
  JOIN topics USING (topic)),
{", ".join(steps)},
raked AS MATERIALIZED (SELECT source, lang, topic, tokens, w / own AS ratio FROM {last}),
sorted AS (
  SELECT ratio, (0.5 * (SELECT sum(tokens) FROM raked) - coalesce(sum(tokens) OVER before, 0))
    / sum(tokens * ratio) OVER after AS factor
  FROM raked WINDOW before AS (ORDER BY ratio DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    after AS (ORDER BY ratio DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
fitting AS (SELECT arg_max(factor, ratio) AS factor FROM sorted WHERE factor > 0 AND factor * ratio <= 1)
SELECT doc_id, source, lang, topic, CAST(n_tokens AS BIGINT) AS n_tokens,
       round(least(1.0, ratio * factor), 6) AS probability,
       ('0x' || substr(md5('0:' || doc_id), 1, 13))::BIGINT / pow(2, 52) < round(least(1.0, ratio * factor), 6) AS kept
FROM docs JOIN raked USING (source, lang, topic), fitting"""


@query("op7_source_mixing", _mixing_sql())
def op7(spark: SparkSession, folder: str) -> DataFrame:
    from rapproche.llm.mixing import digests

    return digests(table(spark, folder, "documents"))


@query("op8_vector_dedup", """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b USING (label)
  WHERE a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT a AS node, b AS other FROM links UNION SELECT node, l.b FROM reach JOIN links l ON other = l.a),
least AS (SELECT node, min(other) AS other FROM reach GROUP BY node),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(other, vec_id)) AS component_id,
       vec_id <= coalesce(other, vec_id) AS kept
FROM embeddings LEFT JOIN least ON vec_id = node LEFT JOIN degrees ON vec_id = a
""")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    from rapproche.llm.vector_dedup import near_duplicates

    return near_duplicates(table(spark, folder, "embeddings"))


@query("op2_html_text")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    from rapproche.llm.html_text import digests

    return digests(table(spark, folder, "pages"))


@query("op4_masked_lm")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    from rapproche.llm.masked_lm import score, train

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return score(docs, train(docs)).select("doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood")


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


@query("op12_token_alignment")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from rapproche.llm.alignment import Tokenizers, digests

    paths = (str(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return digests(table(spark, folder, "documents"), Tokenizers.load(*paths))


def _codes_sql() -> str:
    """Rounds written out; a part's key is its least squared distance times 256 plus the index, over all entries."""
    steps = []
    for r in range(5):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, p, min(CAST(list_inner_product(v, v) - 2 * list_inner_product(v, e.c) + list_inner_product(e.c, e.c) AS BIGINT)
    * 256 + e.entry) AS key FROM parts JOIN e{r} e USING (p) GROUP BY vec_id, p)""")
        if r < 4:
            steps.append(f"""
m{r} AS MATERIALIZED (
  SELECT p, entry, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS c FROM (
    SELECT p, key % 256 AS entry, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
    FROM a{r} JOIN parts USING (vec_id, p), (SELECT unnest(range(1, 17)) AS i) GROUP BY ALL) GROUP BY p, entry),
e{r + 1} AS MATERIALIZED (
  SELECT p, entry, coalesce(m.c, e.c) AS c FROM e{r} e LEFT JOIN m{r} m USING (p, entry))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, p, v[p * 16 + 1 : p * 16 + 16] AS v FROM kept, (SELECT unnest(range(4)) AS p)),
e0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS entry, v AS c FROM parts
  QUALIFY entry < 256),{",".join(steps)},
books AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, entry, i)) AS digest
  FROM (SELECT p, entry, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM e4)),
coded AS (
  SELECT vec_id, string_agg(lpad(lower(to_hex(key % 256)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(key // 256) AS BIGINT) AS error
  FROM a4 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM coded JOIN kept USING (vec_id), books"""


@query("op13_vector_codes", _codes_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    from rapproche.llm.vector_codes import digests

    return digests(table(spark, folder, "embeddings"))


@query("op11_suffix_dedup", """
WITH docs AS MATERIALIZED (
  SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
strings AS MATERIALIZED (
  SELECT doc_id, s, md5(b[s + 1:s + 200]) AS h FROM (SELECT doc_id, b, unnest(range(0, n - 199)) AS s FROM docs)),
twice AS (SELECT h FROM strings GROUP BY h HAVING count(*) > 1),
found AS (SELECT doc_id, s FROM strings SEMI JOIN twice USING (h)),
begun AS (
  SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 200 THEN 0 ELSE 1 END AS begins FROM found),
numbered AS (SELECT doc_id, s, sum(begins) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM begun),
spans AS (SELECT doc_id, min(s) AS a, max(s) + 200 AS z FROM numbered GROUP BY doc_id, k),
gaps AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM spans
  UNION ALL SELECT doc_id, coalesce(max(spans.z), 0), any_value(n) FROM docs LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
rest AS (
  SELECT doc_id, sha256(unhex(coalesce(string_agg(hex(b[a + 1:z]), '' ORDER BY a) FILTER (WHERE z > a), ''))) AS kept_sha256
  FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id),
gone AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(z - a) AS BIGINT) AS n_removed FROM spans GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256
FROM docs JOIN rest USING (doc_id) LEFT JOIN gone USING (doc_id)
""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    from rapproche.llm.byte_repeats import digests

    return digests(table(spark, folder, "documents"))
