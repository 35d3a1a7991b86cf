"""Intermediate tables that several branches of a job read.

They are Parquet in the folder that driver and executors share
(``spark.checkpoint.dir``), so a lost executor costs no recomputation, no
executor memory stays taken, and later readers prune columns and rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session without one gets a
    folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by driver and executors")
    named = "file://" + tempfile.mkdtemp(prefix="tickframe-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
