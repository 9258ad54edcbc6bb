"""Stored entries: the standardised lists as tables, and their compatible text form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rapproche.functions.text import split_tokens
from rapproche.operators.matching import FIELDS

ENTRY_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in FIELDS]
    + [T.StructField("tokens", T.ArrayType(T.StringType()))]
)


def write_entries(entries: DataFrame, path: str, files_by: str | None = None) -> None:
    """Replace the table at ``path``, columns in their fixed order; ``files_by`` sorts each file by a key.

    Rows stay in their tasks: a common key, such as the blank id, is not brought together.
    """
    rows = entries.select(*[c for c in ENTRY_SCHEMA.fieldNames() if c in entries.columns])
    if files_by:
        rows = rows.sortWithinPartitions(files_by)
    rows.write.mode("overwrite").parquet(path)


def read_entries(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All entries, or the named columns of them."""
    entries = spark.read.schema(ENTRY_SCHEMA).parquet(path)
    return entries.select(*columns) if columns else entries


def read_token_lists(spark: SparkSession, path: str) -> DataFrame:
    return read_entries(spark, path, ["tokens"])


def with_split_tokens(entries: DataFrame, column: str = "tokenized") -> DataFrame:
    """Entries from a file that holds tokens as joined text."""
    return entries.withColumn("tokens", split_tokens(F.col(column))).drop(column)
