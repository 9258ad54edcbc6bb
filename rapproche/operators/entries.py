"""From raw rows of either list to standardised entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapproche.config import Parity
from rapproche.functions import text as T
from rapproche.functions.address import join_street, split_address, stored_postal_code


def _cleaned(rows: DataFrame) -> DataFrame:
    """All fields cleaned but the row's own ``id``, if it has one."""
    return rows.select(
        *[c if c == "id" else T.clean_field(T.null_to_empty(F.col(c))).alias(c) for c in rows.columns]
    )


def _standard(rows: DataFrame, parity: Parity) -> DataFrame:
    key = [c for c in ("id",) if c in rows.columns]
    city = T.remove_digits(F.col("city"), parity.remove_all_digits_from_city)
    return rows.select(
        *key,
        F.col("entry_id").alias("rawid"),
        T.standardise(F.col("name")).alias("name"),
        T.standardise(F.col("street_number")).alias("street_number"),
        T.standardise(F.col("address")).alias("address"),
        stored_postal_code(T.standardise(F.col("postal_code")), parity.keep_postal_text).alias("postal_code"),
        T.standardise(city).alias("city"),
        T.standardise(F.col("address2")).alias("extra"),
    )


def entries_from_source1(rows: DataFrame, parity: Parity = Parity()) -> DataFrame:
    """Entries of the list whose addresses come in fields; a column ``id`` is passed through."""
    address = join_street(F.col("street_type"), F.col("street_name"))
    return _standard(_cleaned(rows).withColumn("address", address), parity)


def entries_from_source2(rows: DataFrame, parity: Parity = Parity()) -> DataFrame:
    """Entries of the list whose addresses are free text; a column ``id`` is passed through.

    Stage the result before filtering on its columns: the optimizer would copy their long expressions into the filter.
    """
    return _standard(split_address(_cleaned(rows.drop("website")), "address", parity), parity)


def encoded(entries: DataFrame, encode) -> DataFrame:
    """Entries with the subword tokens of their address."""
    return entries.withColumn("tokens", encode(F.col("address")))


def subword_corpus(table1: DataFrame, table2: DataFrame, national: DataFrame | None = None) -> DataFrame:
    """One standardised street per row of all sources, as column ``text``."""
    parts = [t.select(T.standardise(F.col("address")).alias("text")) for t in (table1, table2)]
    if national is not None:
        parts.insert(0, national.select(T.standardise(F.col("street_name")).alias("text")))
    corpus = parts[0]
    for part in parts[1:]:
        corpus = corpus.union(part)
    return corpus


def embedding_corpus(table1: DataFrame, national: DataFrame | None, encode) -> DataFrame:
    """Token lists to train embeddings on: all of the first list, and number and street of the national file."""
    corpus = table1.select("tokens")
    if national is None:
        return corpus
    address = T.standardise(F.concat(F.col("street_number"), F.lit(" "), F.col("street_name")))
    return corpus.union(national.select(encode(address).alias("tokens")))
