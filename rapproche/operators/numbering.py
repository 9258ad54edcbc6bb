"""Consecutive row numbers over a total order, without passing the rows through one task."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rapproche.session import scratch_path, stage


def part_number(file: str) -> int:
    """Number of a part file. Names are padded to five digits only, so they do not sort as their numbers do."""
    return int(re.match(r"part-(\d+)", file)[1])


def _in_files(df: DataFrame, order: list[str], size: Column) -> DataFrame:
    """Rows in order, written once, each with its ``_file``, its ``_row`` there and the ``_before`` of its file: the sum of
    ``size`` over all earlier files. One sum per file reaches the driver."""
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    df = stage(df, "to-number")  # sorting reads its input twice, for the ranges and for the rows
    df.orderBy(*order).write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    offsets, before = [], 0
    sums = rows.groupBy("_file").agg(F.sum(size)).collect()
    for file, total in sorted((tuple(r) for r in sums), key=lambda r: part_number(r[0])):
        offsets.append((file, before))
        before += total
    schema = T.StructType([T.StructField("_file", T.StringType()), T.StructField("_before", T.LongType())])
    return rows.join(F.broadcast(spark.createDataFrame(offsets, schema)), "_file")


def number_rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add ``name`` = 1, 2, ... in the order of ``order``.

    Rows are range-partitioned, sorted and written once; a row's number is its position in its file plus the length of
    the files before it. Only one count per file reaches the driver.
    """
    rows = _in_files(df, order, F.lit(1))
    return rows.withColumn(name, F.col("_before") + F.col("_row") + 1).select(name, *df.columns)


def running_total(df: DataFrame, order: list[str], size: str, name: str) -> DataFrame:
    """Add ``name``: the sum of the whole numbers ``size`` over all rows that come before in the order of ``order``.

    As in ``number_rows``, rows are sorted by ranges; sums run within a file and start at what the files before it hold.
    """
    earlier = Window.partitionBy("_file").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(size).over(earlier), F.lit(0))
    return _in_files(df, order, F.col(size)).withColumn(name, F.col("_before") + inside).select(name, *df.columns)
