"""Shared folders for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent, as in a local test, a new temporary
    folder stands in and is remembered for the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = getattr(spark, "_rowtide_folder", None) or tempfile.mkdtemp(prefix="rowtide-")
        spark._rowtide_folder = folder
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; cuts the lineage."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
