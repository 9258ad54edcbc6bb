"""Size of the Arrow batches that tasks exchange with Python, and names that no column of the user's has."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def free_prefix(df: DataFrame) -> str:
    """Underscores that no column of ``df`` begins with, so that columns named with them clash with none."""
    prefix = "_"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs planned within send at most ``rows`` rows a batch: whole texts are long, and a batch is held at once."""
    before = spark.conf.get(ROWS_KEY)
    spark.conf.set(ROWS_KEY, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(ROWS_KEY, before)
