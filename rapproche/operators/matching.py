"""Linking the two lists by raw id, and the rows that such a link leaves over."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapproche.operators.numbering import number_rows, running_total
from rapproche.operators.skew import SkewLimits, hot_keys, salted_join
from rapproche.session import stage

FIELDS = ("rawid", "name", "street_number", "address", "postal_code", "city", "extra")


def table_columns(number: int) -> list[str]:
    """Column names of a list: the raw id carries the number of its list."""
    return [f"rawid{number}", *FIELDS[1:]]


def merged_columns() -> list[str]:
    return [f"table{n}_{c}" for n in (1, 2) for c in table_columns(n)]


def prefixed(entries: DataFrame, number: int, with_tokens: bool = False) -> DataFrame:
    """Columns of list ``number`` under their names in the merged table."""
    columns = [F.col("rawid" if c.startswith("rawid") else c).alias(f"table{number}_{c}") for c in table_columns(number)]
    if with_tokens:
        columns.append(F.col("tokens").alias(f"table{number}_tokens"))
    return entries.select(*columns)


def link_by_id(
    table1: DataFrame,
    table2: DataFrame,
    skip_blank_ids: bool = False,
    limits: SkewLimits = SkewLimits(),
    with_tokens: bool = False,
    numbered: bool = False,
) -> DataFrame:
    """Inner join on equal raw ids, every pair of rows; empty ids join each other unless skipped.

    With ``numbered`` each pair has its ``merged_id``: 1, 2, ... by raw id, then by the first row, then by the second.
    """
    left, right = prefixed(table1, 1, with_tokens), prefixed(table2, 2, with_tokens)
    if skip_blank_ids:
        left, right = left.where("table1_rawid1 <> ''"), right.where("table2_rawid2 <> ''")
    if numbered:
        return _numbered_pairs(left, right, "table1_rawid1", "table2_rawid2", limits)
    return salted_join(left, right, "table1_rawid1", "table2_rawid2", limits=limits)


def _numbered_pairs(left: DataFrame, right: DataFrame, left_key: str, right_key: str, limits: SkewLimits) -> DataFrame:
    """Pairs of equal keys with their place in the order of key, left row and right row, found without sorting the pairs.

    Each distinct left row is followed by its pairs with all right rows of its key in their order. So a pair's place
    follows from where the pairs of its left row begin and where its right row stands, and only the two lists are sorted.
    Of ``_copies`` equal left rows, which meet every right row in turn, this one is number ``_copy``.
    """
    placed = number_rows(right.where(F.col(right_key).isNotNull()), right.columns, "_at")
    keys = placed.groupBy(F.col(right_key).alias("_key")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    rows = left.where(F.col(left_key).isNotNull()).groupBy(*left.columns).agg(F.count("*").alias("_copies"))
    rows = stage(rows, "left-rows")
    met = salted_join(rows, keys, left_key, "_key", limits=limits, hot=(hot_keys(rows, left_key, limits), None))
    sized = met.withColumn("_pairs", F.col("_copies") * F.col("_n"))
    started = running_total(sized, left.columns, "_pairs", "_start")
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias("_copy")
    dealt = started.select(*left.columns, "_start", "_first", "_copies", copy)
    joined = salted_join(stage(dealt, "left-places"), placed, left_key, right_key, limits=limits)
    place = F.col("_start") + F.col("_copies") * (F.col("_at") - F.col("_first")) + F.col("_copy") + 1
    return joined.select(place.alias("merged_id"), *left.columns, *right.columns)


def id_pairs(table1: DataFrame, table2: DataFrame) -> DataFrame:
    """How many pairs the link by id makes: a row for the blank id and one for all others (kind, ids, pairs).

    Rows are counted per id on either side first, so the answer costs a fraction of the join.
    """
    counts = [
        t.where("rawid is not null").groupBy(F.col("rawid").alias("_id")).agg(F.count("*").cast("decimal(38,0)").alias(n))
        for t, n in ((table1, "_n1"), (table2, "_n2"))
    ]
    both = counts[0].join(counts[1], "_id").select((F.col("_id") == "").alias("blank"), (F.col("_n1") * F.col("_n2")).alias("_n"))
    kinds = [(F.col("blank"), "blank"), (~F.col("blank"), "other")]
    sums = both.agg(*[x for c, k in kinds for x in (F.count(F.when(c, 1)).alias(f"{k}_ids"), F.sum(F.when(c, F.col("_n"))).alias(f"{k}_pairs"))])
    rows = [F.struct(F.lit(k).alias("kind"), F.col(f"{k}_ids").alias("ids"), F.coalesce(f"{k}_pairs", F.lit(0)).cast("decimal(38,0)").alias("pairs")) for _, k in kinds]
    return sums.select(F.inline(F.array(*rows)))


def pair_count(table1: DataFrame, table2: DataFrame, skip_blank_ids: bool = False) -> int:
    """Number of rows of the link by id."""
    pairs = id_pairs(table1, table2)
    if skip_blank_ids:
        pairs = pairs.where("kind <> 'blank'")
    return int(pairs.agg(F.sum("pairs")).first()[0])


def unmatched(
    entries: DataFrame, other: DataFrame, skip_blank_ids: bool = False, limits: SkewLimits = SkewLimits()
) -> DataFrame:
    """Rows of a list whose raw id the other list lacks, which is to say that the link by id left over.

    The other list's distinct ids stand for the merged table, whose pairs may be many more.
    """
    ids = other.select(F.col("rawid").alias("_linked")).distinct()
    if skip_blank_ids:
        ids = ids.where("_linked <> ''")
    return salted_join(entries, ids, "rawid", "_linked", "left_anti", limits)


def unmatched_ids(table1: DataFrame, table2: DataFrame, limits: SkewLimits = SkewLimits()) -> tuple[DataFrame, DataFrame]:
    """The ids of the unmatched rows of both lists."""
    return (
        unmatched(table1, table2, limits=limits).select("id"),
        unmatched(table2, table1, limits=limits).select("id"),
    )


def with_tokens(entries: DataFrame) -> DataFrame:
    """Rows that have at least one token."""
    return entries.where(F.size("tokens") > 0)


def rows_by_id(entries: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is listed; ``ids`` may repeat."""
    return entries.join(ids.select("id").distinct(), "id", "left_semi")


def combine(by_id: DataFrame, by_similarity: DataFrame | None = None) -> DataFrame:
    """All linked pairs in one frame, each with its ``match_type``; numbers of the pairs linked by id are kept."""
    columns = merged_columns()
    numbers = ["merged_id"] if "merged_id" in by_id.columns else []
    merged = by_id.select(*numbers, *columns, F.lit("id").alias("match_type"))
    if by_similarity is not None:
        open_numbers = [F.lit(None).cast("long").alias(n) for n in numbers]
        similar = by_similarity.select(*open_numbers, *columns, F.lit("similarity").alias("match_type"))
        merged = merged.unionByName(similar)
    return merged


def match_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy("match_type").agg(F.count("*").alias("n"))
