"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "rapproche", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; explicit ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The folder shared by all executors, as named by the cluster.

    A local session without one gets a temporary folder; elsewhere it must be set.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="rapproche-")
        spark.conf.set(CHECKPOINT_KEY, folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/rapproche/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result is computed once, has fixed row ids and does not depend on any executor's memory or disk.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
