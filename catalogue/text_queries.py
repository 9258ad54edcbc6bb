"""Text functions over the whole documents, and address functions over the derived lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogue import sql as S
from catalogue.frames import SOURCE1_SQL, SOURCE2_SQL, entries1, source1, source2, table
from catalogue.registry import query
from rapproche.config import Parity
from rapproche.functions import address as A
from rapproche.functions import text as T


def _on_documents(name: str, expression, sql_expression: str) -> None:
    """Register ``expression`` of the document text."""

    @query(name, f"SELECT doc_id, {sql_expression} AS result FROM documents")
    def run(spark, sf_dir):
        return table(spark, sf_dir, "documents").select("doc_id", expression(F.col("text")).alias("result"))


_on_documents(
    "p1_clean_field",
    lambda c: T.clean_field(F.concat(F.lit(' \t"'), c, F.lit(' "\n'))),
    "concat(text, ' ')",
)
_on_documents(
    "p3_null_to_empty",
    lambda c: T.null_to_empty(F.when(F.length(c) > 1000, c)),
    "CASE WHEN length(text) > 1000 THEN text ELSE '' END",
)
_on_documents("p4_standardise", T.standardise, S.standard("text"))
_on_documents("p5_lower_strip", T.lower_strip, "trim(lower(text), ' \n')")
_on_documents("p6_punctuation_to_space", T.punctuation_to_space, S.spaced("text"))
_on_documents("p7_fold_to_ascii", T.fold_to_ascii, S.folded("text"))
_on_documents("p8_remove_stop_words", T.remove_stop_words, S.without_stop_words("text"))
_on_documents("p9_collapse", T.collapse, f"array_to_string({S.words('text')}, ' ')")
_on_documents(
    "p10_drop_single_letters",
    T.drop_single_letters,
    f"array_to_string(list_filter({S.words('text')}, lambda t: length(t) > 1), ' ')",
)
_on_documents(
    "p11_remove_pattern", lambda c: T.remove_pattern(c, T.POSTAL_CODE), S.remove_matches("text", "[0-9]{3,}")
)
_on_documents(
    "p12_remove_leading_pattern",
    lambda c: T.remove_leading_pattern(c, "[A-Za-z]{2}"),
    "CASE WHEN regexp_matches(text, '^[A-Za-z]{2}') THEN replace(text, regexp_extract(text, '^[A-Za-z]{2}'), ' ') "
    "ELSE text END",
)
_on_documents("p13_remove_digits", T.remove_digits, S.remove_matches("text", "[0-9]+"))
_on_documents("p15_remove_acronyms", A.remove_acronyms, S.remove_matches("text", "\\([A-Z]+[''\"]?\\)"))


@query(
    "p14_named_patterns",
    f"""SELECT doc_id, len(regexp_extract_all(text, '[0-9]{{3,}}')) AS postal_codes,
      len(regexp_extract_all(text, '[0-9]+')) AS digit_runs, len(regexp_extract_all(text, '{S.CAPS}')) AS capital_runs,
      len(regexp_extract_all(text, '\\([A-Z]+[''"]?\\)')) AS acronyms,
      len(regexp_extract_all(text, '\\sd[aeu]?s?\\s')) AS d_particles,
      len(regexp_extract_all(text, '\\sau?x?\\s')) AS a_particles,
      len(regexp_extract_all(text, '\\sl[ae]?[sz]?\\s')) AS l_particles,
      CAST(regexp_matches(text, '^l[ae]?[sz]?\\s') AS INTEGER) AS l_start FROM documents""",
)
def named_patterns(spark, sf_dir):
    text = F.col("text")

    def count(pattern: str) -> Column:
        return F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).cast("long")

    return table(spark, sf_dir, "documents").select(
        "doc_id",
        count(T.POSTAL_CODE).alias("postal_codes"),
        count(T.DIGITS).alias("digit_runs"),
        count(T.CAPITAL_RUN).alias("capital_runs"),
        count(T.ACRONYM).alias("acronyms"),
        count(T.PARTICLE_D).alias("d_particles"),
        count(T.PARTICLE_A).alias("a_particles"),
        count(T.PARTICLE_L).alias("l_particles"),
        text.rlike(f"^(?:{T.PARTICLE_L_START})").cast("int").alias("l_start"),
    )


@query(
    "p2_join_street",
    f"SELECT id, concat(street_type, ' ', street_name) AS street FROM ({SOURCE1_SQL}) s",
)
def join_street(spark, sf_dir):
    return source1(spark, sf_dir).select("id", A.join_street(F.col("street_type"), F.col("street_name")).alias("street"))


def _with_parts(spark, sf_dir):
    return A.split_address(source2(spark, sf_dir).select("id", "address"), "address")


@query(
    "p16_split_comma_address",
    f"WITH {S.SPLIT_CTES} SELECT id, city, postal_code, rest FROM cut_d WHERE comma",
)
def split_comma_address(spark, sf_dir):
    rows = source2(spark, sf_dir).where(F.col("address").contains(","))
    return rows.select("id", A.split_comma_address(F.col("address")).alias("p")).select(
        "id", "p.city", "p.postal_code", "p.rest"
    )


@query(
    "p17_trailing_city",
    f"WITH {S.SPLIT_CTES} SELECT id, caps AS city FROM cut_b",
)
def trailing_city(spark, sf_dir):
    return source2(spark, sf_dir).select("id", A.trailing_city(F.col("address")).alias("city"))


@query(
    "p18_split_plain_address",
    f"WITH {S.SPLIT_CTES} SELECT id, city, postal_code, rest FROM cut_d WHERE NOT comma",
)
def split_plain_address(spark, sf_dir):
    rows = source2(spark, sf_dir).where(~F.col("address").contains(","))
    return rows.select("id", A.split_plain_address(F.col("address")).alias("p")).select(
        "id", "p.city", "p.postal_code", "p.rest"
    )


@query(
    "p19_leading_street_number",
    """SELECT doc_id, CASE WHEN length(regexp_extract(text, '^[^0-9]*[0-9]+')) * 2 >= length(text) THEN ''
      ELSE regexp_extract(text, '[0-9]+') END AS street_number FROM documents""",
)
def leading_street_number(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", A.leading_street_number(F.col("text")).alias("street_number")
    )


@query(
    "p20_remove_street_number",
    f"WITH {S.SPLIT_CTES} SELECT id, street FROM cut_f",
)
def remove_street_number(spark, sf_dir):
    comma = F.col("address").contains(",")
    rest = F.when(comma, A.split_comma_address(F.col("address"))["rest"]).otherwise(
        A.split_plain_address(F.col("address"))["rest"]
    )
    rows = source2(spark, sf_dir).select("id", rest.alias("rest"))
    return rows.select("id", A.remove_street_number(F.col("rest"), A.leading_street_number(F.col("rest"))).alias("street"))


@query(
    "p21_empty_address",
    f"""WITH {S.E1_CTES} SELECT id, '' AS city, '' AS postal_code, '' AS street_number, '' AS address FROM e1
      WHERE extra = ''""",
)
def empty_address(spark, sf_dir):
    rows = entries1(spark, sf_dir).where("extra = ''").select("id", F.col("extra").alias("source"))
    return A.split_address(rows, "source")


@query(
    "p22_expand_street_types",
    f"""WITH whole AS (SELECT doc_id, text FROM documents), {S.expand_streets_steps('whole', 'text', 'expanded')}
      SELECT doc_id, expanded FROM {S.LAST_STREET}""",
)
def expand_street_types(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", A.expand_street_types(F.col("text")).alias("expanded"))


@query(
    "p16_p22_split_address",
    f"WITH {S.SPLIT_CTES} SELECT id, city, postal_code, street_number, address FROM split2",
)
def split_address(spark, sf_dir):
    return _with_parts(spark, sf_dir)


@query(
    "p23_token_text",
    f"SELECT doc_id, joined, len(string_split(joined, '##')) AS n_tokens FROM (SELECT doc_id, "
    f"array_to_string({S.words('text')}, '##') AS joined FROM documents) d",
)
def token_text(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", T.join_tokens(T.tokens(F.col("text"))).alias("joined"))
    return rows.select("doc_id", "joined", F.size(T.split_tokens(F.col("joined"))).cast("long").alias("n_tokens"))


@query(
    "p24_canonical_postal_code",
    f"""SELECT id, {S.canonical_code('postal_code')} AS as_given, {S.canonical_code("concat(postal_code, ' x')")} AS mixed
      FROM ({SOURCE1_SQL}) s""",
)
def canonical_postal_code(spark, sf_dir):
    code = F.col("postal_code")
    return source1(spark, sf_dir).select(
        "id",
        A.stored_postal_code(code).alias("as_given"),
        A.stored_postal_code(F.concat(code, F.lit(" x"))).alias("mixed"),
    )


@query(
    "parity_intended_split",
    f"""WITH src AS ({SOURCE2_SQL}),
      a AS (SELECT id, address AS txt, contains(address, ',') AS comma, trim(string_split(address, ',')[-1]) AS tail,
        trim(upper(reverse(regexp_extract(reverse(address), '^{S.CAPS}')))) AS caps FROM src),
      b AS (SELECT id, CASE WHEN comma THEN trim(replace(replace(txt, tail, ''), ',', ''))
        WHEN caps <> '' THEN trim(replace(txt, caps, '')) ELSE txt END AS rest0, comma, tail FROM a),
      c AS (SELECT id, CASE WHEN comma THEN regexp_extract(tail, '[0-9]{{3,}}') ELSE regexp_extract(rest0, '[0-9]{{3,}}$')
        END AS postal_code, CASE WHEN comma THEN rest0 ELSE trim(regexp_replace(rest0, '[0-9]{{3,}}$', '')) END AS rest
        FROM b)
      SELECT id, postal_code, rest FROM c""",
)
def intended_split(spark, sf_dir):
    parts = F.when(F.col("address").contains(","), A.split_comma_address(F.col("address"))).otherwise(
        A.split_plain_address(F.col("address"), Parity.intended().fix_trailing_postal_code)
    )
    return source2(spark, sf_dir).select("id", parts.alias("p")).select("id", "p.postal_code", "p.rest")
