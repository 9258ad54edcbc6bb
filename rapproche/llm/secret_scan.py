"""Secret scan over a trigram index, in built-in functions only.

From each rule's pattern a Boolean query over trigrams is derived: every match must hold all trigrams of one of the
query's alternatives. The index posts, for every trigram that some rule asks for, the documents that hold it. Meeting
the postings of an alternative gives candidates, and only those are searched with the rule's pattern. A rule whose
pattern has no mandatory trigram is searched in every document.

Null text is empty. A row without id is a candidate of every rule; rows that repeat an id share their candidates and
are searched one by one. Other columns are passed on; columns named ``spans`` are replaced.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapproche.llm.batches import free_prefix
from rapproche.session import stage

#: Alternatives a pattern's literal prefix may branch into before it is turned into trigrams.
MOST_STRINGS = 24
#: Conjunctions of a query; a conjunct that would exceed it is left out, which only adds candidates.
MOST_ALTERNATIVES = 64
#: Candidate documents up to which their ids are broadcast instead of shuffled.
BROADCAST_ROWS = 500_000
#: Trigrams in one word of bits.
WORD = 62
#: Sums that one block of ``running_sums`` holds.
BLOCK = 512

TrigramQuery = frozenset[frozenset[str]]
ANY: TrigramQuery = frozenset([frozenset()])


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches whose ``group`` has at least ``least`` signs."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE_RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),  # a shorter run never ends inside a longer one
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN (RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY( BLOCK)?-----"),
)
RULES = BASE_RULES + MORE_RULES


def _both(a: TrigramQuery, b: TrigramQuery) -> TrigramQuery:
    if len(a) * len(b) > MOST_ALTERNATIVES:
        return min(a, b, key=lambda q: (q == ANY, len(q)))
    return frozenset(x | y for x in a for y in b)


def _needs(strings: set[str]) -> TrigramQuery:
    """Trigrams of one of ``strings``; nothing is known if one of them is shorter or not ASCII."""
    if any(len(s) < 3 or not s.isascii() for s in strings):
        return ANY
    return frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _strings(op, value) -> set[str] | None:
    """All strings that a part of a pattern matches, in lower case, if they are few."""
    if op is sre.LITERAL:
        return {chr(value).lower()}
    if op is sre.IN:
        out: set[str] = set()
        for kind, x in value:
            if kind is sre.LITERAL:
                out.add(chr(x).lower())
            elif kind is sre.RANGE and x[1] - x[0] < MOST_STRINGS:
                out |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is sre.SUBPATTERN:
        return _sequence(value[3])
    if op is sre.BRANCH:
        parts = [_sequence(p) for p in value[1]]
        return None if None in parts else set().union(*parts)
    if op is sre.MAX_REPEAT and value[1] <= 1:
        inner = _sequence(value[2])
        return None if inner is None else inner | ({""} if value[0] == 0 else set())
    return None


def _sequence(parts) -> set[str] | None:
    out = {""}
    for op, value in parts:
        found = _strings(op, value)
        if found is None or len(out) * len(found) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in found}
    return out


def _query(parts) -> TrigramQuery:
    out, now = ANY, {""}
    for op, value in parts:
        found = _strings(op, value)
        if found is not None and len(now) * len(found) > MOST_STRINGS:
            out, now = _both(out, _needs(now)), {s[-2:] for s in now}
        if found is not None and len(now) * len(found) <= MOST_STRINGS:
            now = {a + b for a in now for b in found}
            continue
        out, now = _both(out, _needs(now)), {""}
        if op is sre.SUBPATTERN:
            out = _both(out, _query(value[3]))
        elif op is sre.BRANCH:
            parts_of = [_query(p) for p in value[1]]
            out = _both(out, frozenset().union(*parts_of))
        elif op is sre.MAX_REPEAT and value[0] > 0:
            out = _both(out, _query(value[2]))
    return _both(out, _needs(now))


def trigram_query(pattern: str) -> TrigramQuery:
    """Alternatives of lower-case trigrams, one of which every match of ``pattern`` holds whole; ANY if none is known."""
    found = _query(parser.parse(pattern))
    if frozenset() in found:
        return ANY
    return frozenset(q for q in found if not any(p < q for p in found))


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, doc_id) of ``trigrams`` over the lower-case texts."""
    words = F.array(*map(F.lit, trigrams))
    folded = F.array(F.lower("text"))  # bound once, not folded again per trigram
    held = F.flatten(F.transform(folded, lambda text: F.filter(words, lambda t: F.contains(text, t))))
    return docs.where("doc_id is not null and text is not null").select(F.explode(held).alias("trigram"), "doc_id")


def candidates(index: DataFrame, queries: list[TrigramQuery]) -> DataFrame:
    """Documents in which at least one query holds: doc_id and ``hits``, one flag per query."""
    trigrams = sorted({t for q in queries for alternative in q for t in alternative})
    place = {t: divmod(i, WORD) for i, t in enumerate(trigrams)}
    n_words = -(-len(trigrams) // WORD)
    bits = [
        F.create_map(*[F.lit(x) for t, (w, b) in place.items() if w == word for x in (t, 1 << b)])
        for word in range(n_words)
    ]
    grouped = index.groupBy("doc_id").agg(
        *[F.bit_or(F.coalesce(bits[w][F.col("trigram")], F.lit(0)).cast("long")).alias(f"w{w}") for w in range(n_words)]
    )

    def holds(query: TrigramQuery) -> Column:
        out = F.lit(False)
        for alternative in query:
            all_held = F.lit(True)
            for w in range(n_words):
                if mask := sum(1 << place[t][1] for t in alternative if place[t][0] == w):
                    all_held = all_held & (F.col(f"w{w}").bitwiseAND(F.lit(mask).cast("long")) == mask)
            out = out | all_held
        return out

    found = grouped.select("doc_id", F.array(*[holds(q) for q in queries]).alias("hits"))
    return found.where(F.exists("hits", lambda hit: hit))


def running_sums(values: Column) -> Column:
    """Running sums of an array of longs, block by block, so that long arrays are not copied per element."""
    zero = F.array().cast("array<bigint>")

    def sums(array: Column, start: Column) -> Column:
        pair = F.aggregate(
            array,
            F.struct(start.alias("sum"), zero.alias("all")),
            lambda acc, x: F.struct(
                (acc["sum"] + x).alias("sum"), F.concat(acc["all"], F.array(acc["sum"] + x)).alias("all")
            ),
        )
        return pair["all"]

    starts = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
    blocks = F.transform(starts, lambda b: F.slice(values, b * BLOCK + 1, BLOCK))
    totals = F.transform(
        blocks, lambda block: F.aggregate(block, F.lit(0).cast("long"), lambda a, x: a + x)
    )
    before = F.concat(F.array(F.lit(0).cast("long")), sums(totals, F.lit(0).cast("long")))
    return F.when(F.size(values) > 0, F.flatten(F.zip_with(
        blocks, F.slice(before, 1, F.size(blocks)), lambda block, start: sums(block, start)
    ))).otherwise(zero)


def _lengths(strings: Column) -> Column:
    return F.transform(strings, lambda s: F.length(s).cast("long"))


def _spans(rule: Rule, number: int, gaps: Column, matches: Column, values: Column) -> Column:
    """Spans (start, number, end) from the lengths of gaps, matches and checked groups."""
    n = F.size(matches)
    steps = F.zip_with(
        F.slice(gaps, 1, n),
        F.concat(F.array(F.lit(0).cast("long")), F.slice(matches, 1, F.greatest(n - 1, F.lit(0)))),
        lambda gap, match: gap + match,
    )
    rows = F.arrays_zip(
        running_sums(F.slice(steps, 1, n)).alias("start"), matches.alias("match"), values.alias("value")
    )
    return F.transform(
        F.filter(rows, lambda r: r["value"] >= rule.least),
        lambda r: F.struct(
            r["start"].alias("start"), F.lit(number).alias("number"), (r["start"] + r["match"]).alias("end")
        ),
    )


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``spans``: (start, end, kind) of every secret by start, then order of the rules; ends exclusive."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) != ANY}
    rows = docs.drop("spans")
    own = free_prefix(rows)
    if queries:
        trigrams = sorted({t for q in queries.values() for alternative in q for t in alternative})
        index = stage(trigram_index(docs.select("doc_id", "text"), trigrams), "trigrams")
        found = stage(candidates(index, list(queries.values())), "candidates")
        small = found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        found = found.select(F.col("doc_id").alias(f"{own}doc"), F.col("hits").alias(f"{own}hits"))
        rows = rows.join(
            F.broadcast(found) if small else found.hint("shuffle_hash"), F.col("doc_id") == F.col(f"{own}doc"), "left"
        )
    asked = {
        kind: F.col("doc_id").isNull() | F.coalesce(F.col(f"{own}hits")[i], F.lit(False)) for i, kind in enumerate(queries)
    }
    text = F.col("text")
    lengths: dict[str, Column] = {}
    for rule in rules:
        wanted = asked.get(rule.kind, text.rlike(rule.pattern))
        for name, strings in (
            ("gaps", F.split(text, rule.pattern, -1)),
            ("match", F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))),
            ("value", F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))),
        ):
            if name != "value" or rule.group:
                lengths[f"{own}{rule.kind}_{name}"] = F.when(wanted, _lengths(strings))
    rows = rows.withColumns(lengths)
    none = F.array().cast("array<struct<start:bigint,number:int,end:bigint>>")
    every = [
        F.coalesce(
            _spans(
                rule,
                number,
                F.col(f"{own}{rule.kind}_gaps"),
                F.col(f"{own}{rule.kind}_match"),
                F.col(f"{own}{rule.kind}_{'value' if rule.group else 'match'}"),
            ),
            none,
        )
        for number, rule in enumerate(rules)
    ]
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    spans = F.transform(
        F.array_sort(F.concat(*every)),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), kinds[s["number"]].alias("kind")),
    )
    extra = [*lengths, *([f"{own}doc", f"{own}hits"] if queries else [])]
    return rows.withColumn("spans", spans).drop(*extra)


def span_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def digests(docs: DataFrame) -> DataFrame:
    """Per document: number of base secrets of each kind, SHA-256 of the base spans, and all spans as text."""
    spans = F.col("spans")

    def number_of(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin(*[r.kind for r in BASE_RULES]))
    return scan(docs.select("doc_id", "text")).select(
        "doc_id",
        *[number_of(r.kind) for r in BASE_RULES],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )
