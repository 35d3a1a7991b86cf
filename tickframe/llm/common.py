"""Shared helpers of the corpus operators: staged tables, checked
broadcasts, and the reading of the driver's tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a table of a few narrow columns is broadcast. Larger
#: tables take a shuffle join instead; results are the same.
BROADCAST_ROWS = 400_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.
    Only a session without one and with a local master gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by driver and executors")
    named = "file://" + tempfile.mkdtemp(prefix="corpus-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts
    the lineage, survives lost executors, computed once."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the folder of a staged table that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (staged, narrow) with a broadcast hint if it has at most
    ``rows`` rows, else as it is, for a shuffle join."""
    return F.broadcast(df) if df.count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of every document, null texts as empty ones. Further
    columns, whatever their names, play no part."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
