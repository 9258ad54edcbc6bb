"""Pieces of the SQL that states each query's expected result."""

from __future__ import annotations

import string

from catalogue.frames import SOURCE1_SQL, SOURCE2_SQL
from rapproche.functions.address import STREET_TYPES
from rapproche.functions.text import STOP_WORDS
from rapproche.operators.bm25 import EPSILON, K1, B

PUNCT = "'" + string.punctuation.replace("'", "''") + "'"
STOP = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"

FIELDS = ("rawid", "name", "street_number", "address", "postal_code", "city", "extra")


def clean(x: str) -> str:
    return f"trim(trim(coalesce({x}, '')), '\"')"


def lowered(x: str) -> str:
    return f"trim(lower(coalesce({x}, '')))"


def spaced(x: str) -> str:
    return f"translate({x}, {PUNCT}, repeat(' ', 32))"


def folded(x: str) -> str:
    return f"replace(strip_accents({x}), 'ß', 'ss')"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '\\s+'), lambda t: t <> '')"


def without_stop_words(x: str) -> str:
    return f"array_to_string(list_filter({words(x)}, lambda t: NOT list_contains({STOP}, t)), ' ')"


def standard(x: str) -> str:
    return without_stop_words(folded(spaced(lowered(x))))


def remove_matches(x: str, pattern: str) -> str:
    return (
        f"list_reduce(list_prepend({x}, regexp_extract_all({x}, '{pattern}')), lambda acc, m: replace(acc, m, ' '))"
    )


def canonical_code(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({x}, '[0-9]+') THEN CAST(TRY_CAST({x} AS BIGINT) AS VARCHAR) ELSE {x} END"
    )


def expand_streets_steps(source: str, column: str, result: str) -> str:
    """CTEs street_0 ... that expand one abbreviation each; the last has column ``result``."""
    steps = [f"street_0 AS (SELECT *, {column} AS {result} FROM {source})"]
    for i, (short, long) in enumerate(STREET_TYPES.items()):
        found = f"regexp_extract({column}, '(?i)(\\s?|^[A-Za-z]){short}\\s')"
        value = f"CASE WHEN {found} <> '' THEN replace({result}, {found}, ' {long} ') ELSE {result} END"
        steps.append(f"street_{i + 1} AS (SELECT * REPLACE ({value} AS {result}) FROM street_{i})")
    return ", ".join(steps)


LAST_STREET = f"street_{len(STREET_TYPES)}"

CAPS = "[A-ZÀ-ú]{2,}(\\s[A-ZÀ-ú]{2,})*"

SPLIT_CTES = f"""
src AS ({SOURCE2_SQL}),
cut_a AS (SELECT id, {clean('entry_id')} AS rawid, {clean('name')} AS name, {clean('address2')} AS address2,
  {clean('address')} AS txt, trim(string_split({clean('address')}, ',')[-1]) AS tail FROM src),
cut_b AS (SELECT *, contains(txt, ',') AS comma, regexp_extract(tail, '\\d{{3,}}') AS tail_code,
  trim(upper(reverse(regexp_extract(reverse(txt), '^{CAPS}')))) AS caps FROM cut_a),
cut_c AS (SELECT *, CASE WHEN comma THEN CASE WHEN tail_code <> '' THEN replace(tail, tail_code, '') ELSE tail END
    ELSE caps END AS city,
  CASE WHEN comma THEN trim(replace(CASE WHEN tail <> '' THEN replace(txt, tail, '') ELSE txt END, ',', ''))
    WHEN caps <> '' THEN trim(replace(txt, caps, '')) ELSE txt END AS rest0 FROM cut_b),
cut_d AS (SELECT *, CASE WHEN comma THEN tail_code ELSE regexp_extract(reverse(rest0), '^\\d{{3,}}') END AS postal_code,
  trim(rest0) AS rest FROM cut_c),
cut_e AS (SELECT *, CASE WHEN length(regexp_extract(rest, '^\\D*\\d+')) * 2 >= length(rest) THEN ''
  ELSE regexp_extract(rest, '\\d+') END AS street_number FROM cut_d),
cut_f AS (SELECT *, trim(CASE WHEN street_number <> '' THEN replace(rest, street_number, '') ELSE rest END) AS street
  FROM cut_e),
{expand_streets_steps('cut_f', 'street', 'address')},
split2 AS (SELECT id, rawid, name, address2, city, postal_code, street_number, trim(address) AS address FROM {LAST_STREET})
"""


def entry_columns(city: str) -> str:
    code = standard("postal_code")
    return f"""id, rawid, {standard('name')} AS name, {standard('street_number')} AS street_number,
  {standard('address')} AS address, {canonical_code(code)} AS postal_code, {standard(city)} AS city,
  {standard('address2')} AS extra"""


E1_CTES = f"""
raw1 AS (SELECT id, {clean('entry_id')} AS rawid, {clean('name')} AS name, {clean('street_number')} AS street_number,
  concat({clean('street_type')}, ' ', {clean('street_name')}) AS address, {clean('postal_code')} AS postal_code,
  {remove_matches(clean('city'), '[0-9]+')} AS city0, {clean('address2')} AS address2 FROM ({SOURCE1_SQL}) s),
e1 AS (SELECT {entry_columns('city0')} FROM raw1)
"""

E2_CTES = f"""
{SPLIT_CTES},
raw2 AS (SELECT *, {remove_matches('city', '[0-9]+')} AS city0 FROM split2),
e2 AS (SELECT {entry_columns('city0')} FROM raw2)
"""

BOTH_CTES = f"{E1_CTES}, {E2_CTES}"


def merged_columns(left: str = "a", right: str = "b") -> str:
    columns = []
    for number, side in ((1, left), (2, right)):
        for c in FIELDS:
            name = f"rawid{number}" if c == "rawid" else c
            columns.append(f"{side}.{c} AS table{number}_{name}")
    return ", ".join(columns)


MERGED_NAMES = ", ".join(
    f"table{n}_rawid{n}" if c == "rawid" else f"table{n}_{c}" for n in (1, 2) for c in FIELDS
)

MERGED_CTES = f"{BOTH_CTES}, by_id AS (SELECT {merged_columns()} FROM e1 a JOIN e2 b ON a.rawid = b.rawid)"


def lcs_ctes(pairs: str) -> str:
    """CTEs that end in lcs(a, b, ratio) for the distinct pairs (a, b) of relation ``pairs``.

    One recursion step per character of b: best extension by a match, then running maximum.
    """
    extended = (
        "list_transform(range(1, len(row) + 1), lambda i: CASE WHEN i = 1 THEN 0::BIGINT ELSE "
        "greatest(row[i], row[i - 1] + CASE WHEN ca[i - 1] = cb[j + 1] THEN 1 ELSE 0 END) END)"
    )
    return f"""
lcs_pairs AS (SELECT DISTINCT a, b FROM {pairs}),
lcs_rows AS (
  SELECT a, b, string_split(a, '') AS ca, string_split(b, '') AS cb, 0::BIGINT AS j,
    list_transform(range(1, length(a) + 2), lambda i: 0::BIGINT) AS row
  FROM lcs_pairs WHERE a <> '' AND b <> ''
  UNION ALL
  SELECT a, b, ca, cb, j + 1, list_transform(range(1, len(row) + 1), lambda k: list_max(longer[1:k]))
  FROM (SELECT *, {extended} AS longer FROM lcs_rows WHERE j < len(cb)) g
),
lcs_last AS (SELECT a, b, list_max(row) AS n FROM lcs_rows WHERE j = len(cb)),
lcs AS (SELECT p.a, p.b, CASE WHEN p.a = '' AND p.b = '' THEN 1.0 WHEN l.n IS NULL THEN 0.0
    ELSE 2.0 * l.n / (length(p.a) + length(p.b)) END AS ratio
  FROM lcs_pairs p LEFT JOIN lcs_last l ON l.a = p.a AND l.b = p.b)
"""


def token_set(x: str) -> str:
    return f"array_to_string(list_sort(list_distinct({x})), ' ')"


def word_list(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


DOCS_CTE = (
    "docs AS (SELECT doc_id AS id, list_filter(string_split_regex(text, '[ \\n]+'), lambda t: t <> '') AS tokens "
    "FROM documents)"
)


def bm25_ctes(docs: str = "docs") -> str:
    """CTEs tot, tf, terms(term, df, idf) and weights(id, term, tf, doc_len, weight) over docs(id, tokens)."""
    return f"""
occ AS (SELECT id, len(tokens) AS doc_len, unnest(tokens) AS term FROM {docs}),
tf AS MATERIALIZED (SELECT id, doc_len, term, count(*) AS tf FROM occ GROUP BY ALL),
tot AS MATERIALIZED (SELECT count(*) AS n_docs, avg(len(tokens)) AS avgdl FROM {docs}),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
raw_idf AS MATERIALIZED (SELECT term, df, ln(n_docs - df + 0.5) - ln(df + 0.5) AS r FROM dfs, tot),
mean_idf AS MATERIALIZED (SELECT avg(r) AS mean FROM raw_idf),
terms AS MATERIALIZED (SELECT term, df, CASE WHEN r < 0 THEN {EPSILON} * mean ELSE r END AS idf FROM raw_idf, mean_idf),
weights AS (SELECT id, tf.term, tf, doc_len,
  idf * ({K1} + 1.0) * tf / ({K1} * (1.0 - {B} + {B} * doc_len / avgdl) + tf) AS weight
  FROM tf JOIN terms ON tf.term = terms.term, tot)
"""

#: Distinct words of the documents with their start mark, and how often each occurs.
MARKED_CTE = f"""marked AS MATERIALIZED (SELECT concat('▁', w) AS word, count(*) AS n
  FROM (SELECT unnest({words('text')}) AS w FROM documents) t GROUP BY w)"""

SUBWORD_CTES = f"""{MARKED_CTE},
  signs AS (SELECT piece, sum(n) AS n FROM (SELECT unnest(string_split(word, '')) AS piece, n FROM marked) t GROUP BY piece),
  covered AS (SELECT piece FROM (SELECT piece, sum(n) OVER (ORDER BY n DESC, piece) - n AS before, sum(n) OVER () AS total
    FROM signs) t WHERE before < total * 0.9995)"""

FIXED_PIECES_CTES = f"""{MARKED_CTE},
  counted AS (
    SELECT piece, sum(n) AS n FROM (SELECT unnest(string_split(word, '')) AS piece, n FROM marked) t GROUP BY piece
    UNION ALL
    SELECT substr(word, i, size) AS piece, sum(n) AS n
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM marked) a, (SELECT unnest([2, 3, 4]) AS size) b
    WHERE i + size - 1 <= length(word) GROUP BY piece HAVING sum(n) >= 100),
  fixed AS MATERIALIZED (
    SELECT piece, CAST(4 * length(CAST(CAST(n AS BIGINT) AS VARCHAR)) - 40 + n % 5 AS BIGINT) AS score FROM counted)"""
