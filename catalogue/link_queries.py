"""Scans, sinks, joins, filters and similarity scores over the derived address lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import frames
from catalogue import sql as S
from catalogue.frames import SOURCE1_SQL, SOURCE2_SQL, entries1, entries2, table, with_word_tokens
from catalogue.registry import query
from rapproche.config import LinkConfig, Parity, Thresholds
from rapproche.functions import similarity as M
from rapproche.operators import matching, neighbours, numbering, scoring
from rapproche.operators.entries import embedding_corpus, entries_from_source1, entries_from_source2, subword_corpus
from rapproche.plans.link import link_entries, link_files
from rapproche.session import scratch_path, stage
from rapproche.sources import files, sinks, tables
from rapproche.sources.sinks import score_table

ENTRY = "id, " + ", ".join(S.FIELDS)

# ------------------------------------------------------------------------------------------------ scans


@query("s1_read_lines", f"""WITH s AS ({SOURCE1_SQL}) SELECT concat_ws(chr(9), entry_id, name, street_number, street_type,
  street_name, address2, postal_code, city) AS line, 8 AS n_fields FROM s""")
def read_lines(spark, sf_dir):
    lines = files.read_lines(spark, frames.write_source1_file(spark, sf_dir))
    return files.split_lines(lines).select("line", F.size("fields").alias("n_fields"))


@query("s2_read_source1", f"""SELECT entry_id, name, street_number, street_type, street_name, address2, postal_code, city
  FROM ({SOURCE1_SQL}) s""")
def read_source1(spark, sf_dir):
    return files.read_source1(spark, frames.write_source1_file(spark, sf_dir))[0]


@query("s3_read_source2", f"""SELECT address, website, entry_id, name, coalesce(address2, '') AS address2
  FROM ({SOURCE2_SQL}) s""")
def read_source2(spark, sf_dir):
    return files.read_source2(spark, frames.write_source2_file(spark, sf_dir))[0]


@query("s3_rejected_lines", f"""SELECT 'source2' AS source, 6 AS n_fields,
  concat_ws(chr(9), address, website, entry_id, name, 'a', 'b') AS line FROM ({SOURCE2_SQL}) s WHERE id % 60 = 0""")
def rejected_lines(spark, sf_dir):
    return files.read_source2(spark, frames.write_source2_file(spark, sf_dir))[1]


@query("f1_blank_lines", f"""WITH s AS ({SOURCE1_SQL}) SELECT concat_ws(chr(9), entry_id, name, street_number, street_type,
  street_name, address2, postal_code, city) AS line FROM s WHERE id % 2 = 1 UNION ALL
  SELECT concat(' "', name, chr(39)) FROM s WHERE id % 2 = 0 AND id % 6 = 0""")
def blank_lines(spark, sf_dir):
    """Lines that are empty, or nothing but quotes, are dropped; quotes around a line are cut, others stay."""
    path = scratch_path(spark, "blank-lines")
    rows = frames.source1(spark, sf_dir)
    line = F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("")) for c in files.SOURCE1_FIELDS])
    odd = F.when(F.col("id") % 6 == 0, F.concat(F.lit(' "'), F.col("name"), F.lit("'\"")))
    blank = F.when(F.col("id") % 6 == 2, F.lit("")).otherwise(F.lit('""'))
    text = F.when(F.col("id") % 2 == 1, F.concat(F.lit('"'), line, F.lit('"'))).otherwise(F.coalesce(odd, blank))
    rows.select(text.alias("line")).write.options(**frames.LINE_FILE).csv(path)
    return files.split_lines(files.read_lines(spark, path)).select("line")


@query("s5_many_files_one_scan", f"""WITH s AS ({SOURCE1_SQL}) SELECT concat_ws(chr(9), entry_id, name, street_number,
  street_type, street_name, address2, postal_code, city) AS line FROM s UNION ALL
  SELECT concat_ws(chr(9), entry_id, name) FROM s""")
def many_files(spark, sf_dir):
    """Plain and gzipped files side by side, each with a header of its own."""
    path = scratch_path(spark, "many-files")
    rows = frames.source1(spark, sf_dir).repartition(5)
    fields = [F.coalesce(F.col(c), F.lit("")) for c in files.SOURCE1_FIELDS]
    rows.select(F.concat_ws("\t", *fields).alias("line")).write.options(**frames.LINE_FILE).csv(path)
    short = rows.select(F.concat_ws("\t", *fields[:2]).alias("line")).repartition(3)
    short.write.mode("append").options(compression="gzip", **frames.LINE_FILE).csv(path)
    return files.read_lines(spark, path)


NATIONAL_SQL = f"""SELECT street_number, concat(street_type, ' ', street_name) AS street_name, postal_code, city,
  'old' AS old_city FROM ({SOURCE1_SQL}) s WHERE id % 40 <> 0"""


@query("s4_s5_read_national_gz", NATIONAL_SQL)
def read_national(spark, sf_dir):
    return files.read_national(spark, frames.write_national_file(spark, sf_dir), partitions=8)


def _stored_entries(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "entries")
    tables.write_entries(with_word_tokens(entries1(spark, sf_dir)), path)
    return path


@query("s6_read_entries", f"WITH {S.E1_CTES} SELECT {ENTRY}, replace(address, ' ', '##') AS tokenized FROM e1")
def read_entries(spark, sf_dir):
    entries = tables.read_entries(spark, _stored_entries(spark, sf_dir))
    return entries.select(*frames.ENTRY_COLUMNS, F.array_join("tokens", "##").alias("tokenized"))


@query("s7_read_token_lists", f"""WITH {S.E1_CTES} SELECT replace(address, ' ', '##') AS tokenized, count(*) AS n FROM e1
  GROUP BY ALL""")
def read_token_lists(spark, sf_dir):
    tokens = tables.read_token_lists(spark, _stored_entries(spark, sf_dir))
    joined = tokens.select(F.array_join("tokens", "##").alias("tokenized"))
    back = tables.with_split_tokens(joined)
    return back.select(F.array_join("tokens", "##").alias("tokenized")).groupBy("tokenized").agg(F.count("*").alias("n"))


@query("s8_rows_by_id", f"WITH {S.E1_CTES} SELECT {ENTRY} FROM e1 WHERE id IN (SELECT o_custkey FROM orders)")
def rows_by_id(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    return matching.rows_by_id(entries1(spark, sf_dir), ids)


# ------------------------------------------------------------------------------------------------ entries


@query("k1_k2_entries1", f"WITH {S.E1_CTES} SELECT {ENTRY} FROM e1")
def stored_entries1(spark, sf_dir):
    path = scratch_path(spark, "table1")
    tables.write_entries(entries1(spark, sf_dir).withColumn("tokens", F.lit(None).cast("array<string>")), path, "rawid")
    return tables.read_entries(spark, path, list(frames.ENTRY_COLUMNS))


@query("p25_entries2", f"WITH {S.E2_CTES} SELECT {ENTRY} FROM e2")
def standard_entries2(spark, sf_dir):
    return entries2(spark, sf_dir).select(*frames.ENTRY_COLUMNS)


# ------------------------------------------------------------------------------------------------ link by id


@query("j1_link_by_id", f"WITH {S.MERGED_CTES} SELECT {S.MERGED_NAMES} FROM by_id")
def link_by_id(spark, sf_dir):
    return matching.link_by_id(entries1(spark, sf_dir), entries2(spark, sf_dir))


@query("j1_link_by_id_split_keys", f"WITH {S.MERGED_CTES} SELECT {S.MERGED_NAMES} FROM by_id")
def link_by_id_split_keys(spark, sf_dir):
    """The same join with a limit so low that the empty id is cut into blocks."""
    limits = matching.SkewLimits(task_rows=5)
    return matching.link_by_id(entries1(spark, sf_dir), entries2(spark, sf_dir), limits=limits)


@query("parity_link_without_blank_ids", f"""WITH {S.MERGED_CTES} SELECT {S.MERGED_NAMES} FROM by_id
  WHERE table1_rawid1 <> ''""")
def link_without_blank_ids(spark, sf_dir):
    return matching.link_by_id(entries1(spark, sf_dir), entries2(spark, sf_dir), skip_blank_ids=True)


UNMATCHED2 = "SELECT * FROM e2 WHERE rawid NOT IN (SELECT table2_rawid2 FROM by_id)"
UNMATCHED1 = "SELECT * FROM e1 WHERE rawid NOT IN (SELECT table1_rawid1 FROM by_id)"


@query("j2_unmatched", f"WITH {S.MERGED_CTES} SELECT {ENTRY} FROM ({UNMATCHED2}) u")
def unmatched(spark, sf_dir):
    rows = matching.unmatched(entries2(spark, sf_dir), entries1(spark, sf_dir))
    return rows.select(*frames.ENTRY_COLUMNS)


@query("j3_unmatched_ids", f"""WITH {S.MERGED_CTES} SELECT 'table1' AS source, id FROM ({UNMATCHED1}) a
  UNION ALL SELECT 'table2', id FROM ({UNMATCHED2}) b""")
def unmatched_ids(spark, sf_dir):
    left1, left2 = matching.unmatched_ids(entries1(spark, sf_dir), entries2(spark, sf_dir))
    return left1.select(F.lit("table1").alias("source"), "id").union(left2.select(F.lit("table2"), "id"))


# ------------------------------------------------------------------------------------------------ candidate pairs
# Each row of the second list with the row of the first that has the same key, and with the one after.

PAIR_CTES = f"""{S.BOTH_CTES},
ids AS (SELECT b.id AS query_id, a.id AS reference_id, CAST(CASE WHEN a.id = b.id THEN 0.95 ELSE 0.5 END AS DOUBLE) AS model_score
  FROM e2 b JOIN e1 a ON a.id = b.id OR a.id = b.id + 1),
pairs AS (SELECT query_id, reference_id, model_score,
  {', '.join(f'b.{c} AS query_{c}, a.{c} AS reference_{c}' for c in S.FIELDS)}
  FROM ids JOIN e2 b ON b.id = query_id JOIN e1 a ON a.id = reference_id)"""


def candidate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = frames.source2(spark, sf_dir).select(F.col("id").alias("query_id"))
    top = frames.source1(spark, sf_dir).select(F.col("id").alias("reference_id"))
    near = own.select("query_id", F.explode(F.array(F.col("query_id"), F.col("query_id") + 1)).alias("reference_id"))
    score = F.when(F.col("query_id") == F.col("reference_id"), F.lit(0.95)).otherwise(F.lit(0.5))
    return near.hint("merge").join(top, "reference_id").select("query_id", "reference_id", score.alias("model_score"))


def candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.hydrate(
        candidate_ids(spark, sf_dir),
        stage(with_word_tokens(entries2(spark, sf_dir)), "entries2"),
        stage(with_word_tokens(entries1(spark, sf_dir)), "entries1"),
    )


@query("j4_hydrate_pairs", f"WITH {PAIR_CTES} SELECT * FROM pairs")
def hydrate_pairs(spark, sf_dir):
    return candidate_pairs(spark, sf_dir).drop("query_tokens", "reference_tokens")


@query("f6_above_model_threshold", f"WITH {PAIR_CTES} SELECT query_id, reference_id FROM ids WHERE model_score > 0.9")
def above_model_threshold(spark, sf_dir):
    found = neighbours.above(candidate_ids(spark, sf_dir), Thresholds().model)
    return found.select("query_id", "reference_id")


NAMES = f"{PAIR_CTES}, texts AS (SELECT query_id, reference_id, query_name AS a, reference_name AS b FROM pairs)"


@query("m2_edit_ratio", f"""WITH RECURSIVE {NAMES}, {S.lcs_ctes('texts')}
  SELECT query_id, reference_id, round(CAST(ratio AS DOUBLE), 6) AS score FROM texts JOIN lcs USING (a, b)""")
def edit_ratio(spark, sf_dir):
    score = M.edit_ratio(F.col("query_name"), F.col("reference_name"))
    return candidate_pairs(spark, sf_dir).select("query_id", "reference_id", F.round(score, 6).alias("score"))


def fuzzy_ctes(field: str, name: str) -> str:
    """CTEs ending in {name}_fuzzy(query_id, reference_id, {name}_score)."""
    a, b = S.word_list(f"query_{field}"), S.word_list(f"reference_{field}")
    part = S.lcs_ctes(f"{name}_sets").replace("lcs", f"{name}_lcs")
    return f"""{name}_sets AS (SELECT query_id, reference_id, {S.token_set(a)} AS a, {S.token_set(b)} AS b,
      list_has_any({a}, {b}) AS meet FROM pairs), {part},
      {name}_fuzzy AS (SELECT query_id, reference_id, CASE WHEN meet THEN CAST(ratio AS DOUBLE) ELSE 0.0 END
        AS {name}_score FROM {name}_sets JOIN {name}_lcs USING (a, b))"""


@query("m1_fuzzy_match", f"""WITH RECURSIVE {PAIR_CTES}, {fuzzy_ctes('address', 'address')}, {fuzzy_ctes('city', 'city')}
  SELECT query_id, reference_id, round(address_score, 6) AS address_score, round(city_score, 6) AS city_score
  FROM address_fuzzy JOIN city_fuzzy USING (query_id, reference_id)""")
def fuzzy_match(spark, sf_dir):
    return candidate_pairs(spark, sf_dir).select(
        "query_id",
        "reference_id",
        F.round(M.fuzzy_match_tokens(F.col("query_tokens"), F.col("reference_tokens")), 6).alias("address_score"),
        F.round(M.fuzzy_match(F.col("query_city"), F.col("reference_city")), 6).alias("city_score"),
    )


@query("m3_set_overlap", f"""WITH {PAIR_CTES}, sets AS (SELECT query_id, reference_id,
    {S.word_list('query_address')} AS a, {S.word_list('reference_address')} AS b, query_extra AS qe, reference_extra AS re
    FROM pairs)
  SELECT query_id, reference_id, round(CASE WHEN len(a) = 0 OR len(b) = 0 THEN 1.0
    ELSE CAST(len(list_intersect(a, b)) AS DOUBLE) / len(list_distinct(list_concat(a, b))) END, 6) AS overlap,
    CASE WHEN qe = '' OR re = '' OR qe = re THEN 1.0 ELSE 0.0 END AS extra_overlap FROM sets""")
def set_overlap(spark, sf_dir):
    return candidate_pairs(spark, sf_dir).select(
        "query_id",
        "reference_id",
        F.round(M.set_overlap(F.col("query_tokens"), F.col("reference_tokens")), 6).alias("overlap"),
        M.text_overlap(F.col("query_extra"), F.col("reference_extra")).alias("extra_overlap"),
    )


def equal_sql(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' OR {b} = '' OR {a} = {b} THEN 1 ELSE 0 END"


def postal_equal_sql() -> str:
    q, r = (f"CASE WHEN {s}_postal_code = '0' THEN '' ELSE {s}_postal_code END" for s in ("query", "reference"))
    return equal_sql(f"({q})", f"({r})")


@query("m4_equal_or_missing", f"""WITH {PAIR_CTES} SELECT query_id, reference_id, {postal_equal_sql()} AS postal_score,
  {equal_sql('query_street_number', 'reference_street_number')} AS number_score FROM pairs""")
def equal_or_missing(spark, sf_dir):
    return candidate_pairs(spark, sf_dir).select(
        "query_id",
        "reference_id",
        M.equal_postal_codes(F.col("query_postal_code"), F.col("reference_postal_code")).alias("postal_score"),
        M.equal_or_missing(F.col("query_street_number"), F.col("reference_street_number")).alias("number_score"),
    )


SCORED_CTES = f"""{PAIR_CTES}, {fuzzy_ctes('address', 'address')}, {fuzzy_ctes('city', 'city')}, {fuzzy_ctes('name', 'name')},
scored AS (SELECT pairs.*, address_score, city_score, name_score, {postal_equal_sql()} AS postal_code_score,
  1 AS street_number_score FROM pairs JOIN address_fuzzy USING (query_id, reference_id)
  JOIN city_fuzzy USING (query_id, reference_id) JOIN name_fuzzy USING (query_id, reference_id)),
passed AS (SELECT * FROM scored WHERE city_score > 0.9 AND address_score >= 0.7 AND postal_code_score >= 1
  AND name_score >= 0.8)"""

SCORE_NAMES = ("city", "address", "name", "postal_code", "street_number")
SCORES_SQL = ", ".join(
    f"round(CAST({n}_score AS DOUBLE), 6) AS {n}_score" for n in SCORE_NAMES
)


def rounded_pair_scores(scored: DataFrame) -> DataFrame:
    columns = [F.round(F.col(f"{n}_score").cast("double"), 6).alias(f"{n}_score") for n in SCORE_NAMES]
    return scored.select("query_id", "reference_id", *columns)


@query("m5_score_pairs", f"WITH RECURSIVE {SCORED_CTES} SELECT query_id, reference_id, {SCORES_SQL} FROM passed")
def score_pairs(spark, sf_dir):
    return rounded_pair_scores(scoring.score_pairs(candidate_pairs(spark, sf_dir)))


@query("f9_score_pairs_open", f"WITH RECURSIVE {SCORED_CTES} SELECT query_id, reference_id, {SCORES_SQL} FROM scored")
def score_pairs_open(spark, sf_dir):
    return rounded_pair_scores(scoring.score_pairs(candidate_pairs(spark, sf_dir), Thresholds.open()))


@query("f7_city_barrier", f"""WITH RECURSIVE {PAIR_CTES}, {fuzzy_ctes('city', 'city')}
  SELECT query_id, reference_id, round(city_score, 6) AS city_score FROM city_fuzzy WHERE city_score > 0.9""")
def city_barrier(spark, sf_dir):
    kept = scoring.city_barrier(candidate_pairs(spark, sf_dir), Thresholds())
    return kept.select("query_id", "reference_id", F.round("city_score", 6).alias("city_score"))


@query("parity_score_pairs_intended", f"""WITH RECURSIVE {PAIR_CTES}, {fuzzy_ctes('address', 'address')},
  {fuzzy_ctes('city', 'city')}, {fuzzy_ctes('name', 'name')},
  codes AS (SELECT query_id, reference_id, query_postal_code AS a, reference_postal_code AS b FROM pairs),
  {S.lcs_ctes('codes').replace('lcs', 'code_lcs')},
  scored AS (SELECT query_id, reference_id, address_score, city_score, name_score,
    CAST(ratio AS DOUBLE) AS postal_code_score,
    {equal_sql('query_street_number', 'reference_street_number')} AS street_number_score
    FROM pairs JOIN address_fuzzy USING (query_id, reference_id) JOIN city_fuzzy USING (query_id, reference_id)
    JOIN name_fuzzy USING (query_id, reference_id) JOIN codes USING (query_id, reference_id)
    JOIN code_lcs USING (a, b))
  SELECT query_id, reference_id, {SCORES_SQL} FROM scored WHERE city_score > 0.9 AND address_score >= 0.7
    AND postal_code_score >= 1 AND name_score >= 0.8 AND street_number_score >= 1""")
def score_pairs_intended(spark, sf_dir):
    return rounded_pair_scores(scoring.score_pairs(candidate_pairs(spark, sf_dir), Thresholds(), Parity.intended()))


SIDES = {1: "reference", 2: "query"}
SIMILAR_SQL = ", ".join(
    f"{SIDES[n]}_{c} AS table{n}_{'rawid' + str(n) if c == 'rawid' else c}" for n in (1, 2) for c in S.FIELDS
)


@query("p27_merged_rows", f"WITH RECURSIVE {SCORED_CTES} SELECT {SIMILAR_SQL} FROM passed")
def merged_rows(spark, sf_dir):
    return scoring.merged_rows(scoring.score_pairs(candidate_pairs(spark, sf_dir)))


def _score_sql() -> str:
    columns = []
    for field in sinks.SCORE_FIELDS:
        for side, suffix in (("query", "table_1"), ("reference", "table_2")):
            value = f"{side}_{field}"
            if field == "model":
                value = f"concat('[''', replace({side}_address, ' ', ''', '''), ''']')"
            columns.append(f"{value} AS {field}_{suffix}")
        columns.append(f"round(CAST({field}_score AS DOUBLE), 6) AS {field}_score")
    return ", ".join(columns)


def _rounded_scores(scores: DataFrame) -> DataFrame:
    return scores.select(
        *[F.round(F.col(c).cast("double"), 6).alias(c) if c.endswith("_score") else F.col(c) for c in scores.columns]
    )


@query("p28_score_rows", f"WITH RECURSIVE {SCORED_CTES} SELECT {_score_sql()} FROM passed")
def score_rows(spark, sf_dir):
    return _rounded_scores(score_table(scoring.score_pairs(candidate_pairs(spark, sf_dir))))


@query("k5_scores_tsv", f"WITH RECURSIVE {SCORED_CTES} SELECT {_score_sql()} FROM passed")
def scores_tsv(spark, sf_dir):
    path = scratch_path(spark, "scores")
    scores = scoring.score_pairs(candidate_pairs(spark, sf_dir))
    sinks.write_scores_tsv(scores, path)
    columns = score_table(scores).columns
    schema = ", ".join(f"{c} {'double' if c.endswith('_score') else 'string'}" for c in columns)
    return _rounded_scores(read_tsv(spark, path, schema))


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    rows = spark.read.schema(schema).options(sep="\t", header=True, quote="", nullValue="\u0001").csv(path)
    return rows.select(
        *[F.coalesce(c, F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes]
    )


# ------------------------------------------------------------------------------------------------ merged table

COMBINED_CTES = f"""{SCORED_CTES}, by_id AS (SELECT {S.merged_columns()} FROM e1 a JOIN e2 b ON a.rawid = b.rawid),
merged AS (SELECT *, 'id' AS match_type FROM by_id UNION ALL SELECT {SIMILAR_SQL}, 'similarity' FROM passed)"""


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_id = matching.link_by_id(entries1(spark, sf_dir), entries2(spark, sf_dir))
    return matching.combine(by_id, scoring.merged_rows(scoring.score_pairs(candidate_pairs(spark, sf_dir))))


@query("u1_k3_combine", f"WITH RECURSIVE {COMBINED_CTES} SELECT * FROM merged")
def combine(spark, sf_dir):
    return _merged(spark, sf_dir)


@query("a1_match_counts", f"WITH RECURSIVE {COMBINED_CTES} SELECT match_type, count(*) AS n FROM merged GROUP BY ALL")
def match_counts(spark, sf_dir):
    return matching.match_counts(_merged(spark, sf_dir))


def _numbered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """The merged table whose id matches are numbered, and how many these are."""
    table1, table2 = stage(entries1(spark, sf_dir), "entries1"), stage(entries2(spark, sf_dir), "entries2")
    by_id = matching.link_by_id(table1, table2, numbered=True)
    similar = scoring.merged_rows(scoring.score_pairs(candidate_pairs(spark, sf_dir)))
    return matching.combine(by_id, similar), matching.pair_count(table1, table2)


NUMBERED_SQL = f"""WITH RECURSIVE {COMBINED_CTES} SELECT row_number() OVER (ORDER BY match_type, table1_rawid1,
  table2_rawid2, {S.MERGED_NAMES}) AS merged_id, {S.MERGED_NAMES} FROM merged"""


@query("w2_numbered_merged", NUMBERED_SQL)
def numbered_merged(spark, sf_dir):
    return sinks.numbered_merged(*_numbered(spark, sf_dir))


@query("k4_merged_tsv", NUMBERED_SQL)
def merged_tsv(spark, sf_dir):
    path = scratch_path(spark, "merged")
    merged, id_rows = _numbered(spark, sf_dir)
    sinks.write_merged_tsv(merged, path, id_rows=id_rows)
    schema = "merged_id long, " + ", ".join(f"{c} string" for c in matching.merged_columns())
    return read_tsv(spark, path, schema)


@query("w2_number_rows", """SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS n, o_orderkey FROM orders""")
def number_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_totalprice", "o_orderkey")
    return numbering.number_rows(orders, ["o_totalprice", "o_orderkey"], "n").select("n", "o_orderkey")


# ------------------------------------------------------------------------------------------------ corpora

CORPUS_SQL = f"""WITH {S.BOTH_CTES}, national AS ({NATIONAL_SQL}),
  corpus AS (SELECT {S.standard('street_name')} AS text FROM national UNION ALL SELECT {S.standard('address')} FROM e1
    UNION ALL SELECT {S.standard('address')} FROM e2)
  SELECT text, count(*) AS n FROM corpus GROUP BY ALL"""


def _corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    national = files.read_national(spark, frames.write_national_file(spark, sf_dir))
    return subword_corpus(entries1(spark, sf_dir), entries2(spark, sf_dir), national)


@query("u2_subword_corpus", CORPUS_SQL)
def subword_corpus_counts(spark, sf_dir):
    return _corpus(spark, sf_dir).groupBy("text").agg(F.count("*").alias("n"))


@query("k6_corpus_file", CORPUS_SQL)
def corpus_file(spark, sf_dir):
    path = scratch_path(spark, "corpus")
    sinks.write_corpus(_corpus(spark, sf_dir), path)
    return spark.read.text(path).groupBy(F.col("value").alias("text")).agg(F.count("*").alias("n"))


@query("u3_embedding_corpus", f"""WITH {S.E1_CTES}, national AS ({NATIONAL_SQL}),
  corpus AS (SELECT address AS text FROM e1 UNION ALL
    SELECT {S.standard("concat(street_number, ' ', street_name)")} FROM national)
  SELECT text, count(*) AS n FROM corpus GROUP BY ALL""")
def embedding_corpus_counts(spark, sf_dir):
    national = files.read_national(spark, frames.write_national_file(spark, sf_dir))
    corpus = embedding_corpus(
        with_word_tokens(entries1(spark, sf_dir)), national, lambda c: F.filter(F.split(c, " "), lambda t: t != "")
    )
    return corpus.groupBy(F.array_join("tokens", " ").alias("text")).agg(F.count("*").alias("n"))


# ------------------------------------------------------------------------------------------------ whole job, by id


@query("l1_link_entries_by_id", f"WITH {S.MERGED_CTES} SELECT {S.MERGED_NAMES}, 'id' AS match_type FROM by_id")
def link_entries_by_id(spark, sf_dir):
    config = LinkConfig(skip_similarity=True)
    return link_entries(entries1(spark, sf_dir), entries2(spark, sf_dir), config).merged


@query("l4_link_files_by_id", f"WITH {S.MERGED_CTES} SELECT {S.MERGED_NAMES}, 'id' AS match_type FROM by_id")
def link_files_by_id(spark, sf_dir):
    file1, file2 = frames.write_source1_file(spark, sf_dir), frames.write_source2_file(spark, sf_dir)
    return link_files(spark, file1, file2, LinkConfig(skip_similarity=True)).merged


@query("parity_entries_intended", f"""WITH src1 AS ({SOURCE1_SQL})
  SELECT id, entry_id AS rawid, {S.standard('postal_code')} AS postal_code,
    {S.standard("regexp_replace(city, '[0-9]+', ' ', 'g')")} AS city FROM src1""")
def entries_intended(spark, sf_dir):
    entries = entries_from_source1(frames.source1(spark, sf_dir), Parity.intended())
    return entries.select("id", "rawid", "postal_code", "city")


@query("l4_link_files_rejects", f"""SELECT 'source2' AS source, 6 AS n_fields,
  concat_ws(chr(9), address, website, entry_id, name, 'a', 'b') AS line FROM ({SOURCE2_SQL}) s WHERE id % 60 = 0""")
def link_files_rejects(spark, sf_dir):
    file1, file2 = frames.write_source1_file(spark, sf_dir), frames.write_source2_file(spark, sf_dir)
    return link_files(spark, file1, file2, LinkConfig(skip_similarity=True)).rejects


@query("f2_f4_rows_with_tokens", f"WITH {S.E2_CTES} SELECT id, address FROM e2 WHERE address <> ''")
def rows_with_tokens(spark, sf_dir):
    rows = entries_from_source2(frames.source2(spark, sf_dir))
    return matching.with_tokens(stage(with_word_tokens(rows), "entries2")).select("id", "address")
