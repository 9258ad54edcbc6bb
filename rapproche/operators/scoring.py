"""Checking candidate pairs field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapproche.config import Parity, Thresholds
from rapproche.functions.similarity import (
    edit_ratio,
    equal_or_missing,
    equal_postal_codes,
    fuzzy_keys,
    fuzzy_score,
)
from rapproche.functions.text import tokens
from rapproche.operators.matching import FIELDS, table_columns
from rapproche.operators.skew import SkewLimits, hot_keys, salted_join


def hydrate(
    candidates: DataFrame, queries: DataFrame, references: DataFrame, limits: SkewLimits = SkewLimits()
) -> DataFrame:
    """Candidate pairs with the full rows of both sides, as query_* and reference_* columns.

    A reference may be the nearest of a great many queries; such references are split. Rows of few compressed bytes are
    not broadcast either: that would pass a list through the driver.
    """

    def side(entries: DataFrame, name: str) -> DataFrame:
        columns = [F.col(c).alias(f"{name}_{c}") for c in (*FIELDS, "tokens")]
        return entries.select(F.col("id").alias(f"_{name}"), *columns)

    hot = (hot_keys(candidates, "reference_id", limits), None)
    with_reference = salted_join(candidates, side(references, "reference"), "reference_id", "_reference", "inner", limits, hot)
    with_both = with_reference.hint("merge").join(side(queries, "query"), F.col("query_id") == F.col("_query"))
    return with_both.drop("_query", "_reference")


def _reachable(threshold: float) -> float | None:
    return threshold if threshold > 0 else None


def city_barrier(pairs: DataFrame, thresholds: Thresholds) -> DataFrame:
    """Pairs whose city score exceeds the threshold."""
    keys = fuzzy_keys(tokens(F.col("query_city")), tokens(F.col("reference_city")), _reachable(thresholds.city))
    scored = pairs.withColumn("_keys", keys).withColumn("city_score", fuzzy_score(F.col("_keys")))
    return scored.where(F.col("city_score") > thresholds.city).drop("_keys")


def postal_code_score(parity: Parity) -> Column:
    query, reference = F.col("query_postal_code"), F.col("reference_postal_code")
    return edit_ratio(query, reference) if parity.fuzzy_postal_code else equal_postal_codes(query, reference)


def street_number_score(parity: Parity) -> Column:
    query = F.col("query_street_number")
    return equal_or_missing(query, F.col("reference_street_number") if parity.compare_street_numbers else query)


def score_pairs(
    pairs: DataFrame, thresholds: Thresholds = Thresholds(), parity: Parity = Parity()
) -> DataFrame:
    """Pairs that pass every check, with their scores.

    The city comes first. The checks that cost nothing follow, then the two that compare texts, so those see only the
    pairs still open.
    """
    cheap = (
        city_barrier(pairs, thresholds)
        .withColumn("postal_code_score", postal_code_score(parity))
        .withColumn("street_number_score", street_number_score(parity))
        .where(F.col("postal_code_score") >= thresholds.postal_code)
        .where(F.col("street_number_score") >= thresholds.street_number)
    )
    address = fuzzy_keys(F.col("query_tokens"), F.col("reference_tokens"), _reachable(thresholds.address))
    name = fuzzy_keys(tokens(F.col("query_name")), tokens(F.col("reference_name")), _reachable(thresholds.name))
    return (
        cheap.withColumns({"_address": address, "_name": name})
        .withColumns({"address_score": fuzzy_score(F.col("_address")), "name_score": fuzzy_score(F.col("_name"))})
        .where((F.col("address_score") >= thresholds.address) & (F.col("name_score") >= thresholds.name))
        .drop("_address", "_name")
    )


def merged_rows(scored: DataFrame, query_table: str = "table2", with_tokens: bool = False) -> DataFrame:
    """Scored pairs as rows of the merged table."""
    sides = {query_table: "query", "table1" if query_table == "table2" else "table2": "reference"}
    columns = []
    for number in (1, 2):
        side = sides[f"table{number}"]
        for name in table_columns(number):
            field = "rawid" if name.startswith("rawid") else name
            columns.append(F.col(f"{side}_{field}").alias(f"table{number}_{name}"))
        if with_tokens:
            columns.append(F.col(f"{side}_tokens").alias(f"table{number}_tokens"))
    return scored.select(*columns)
