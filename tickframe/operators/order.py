"""Global sort (F1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged


def global_sort(df: DataFrame, *keys, position: str = "position") -> DataFrame:
    """``df`` in the order of ``keys`` (columns, ``asc``/``desc`` with their
    null order; ties by the remaining columns), each row with its 0-based
    ``position``. Spark deals the rows to partitions by sampled ranges and
    sorts each; positions are row numbers within a partition plus the rows of
    the partitions before it, so that no task sees more than its partition.
    Rows that are equal in all columns are interchangeable."""
    names = [c for c in df.columns]
    keys = [F.col(f"`{k}`") if isinstance(k, str) else k for k in keys]
    ties = [F.xxhash64(F.col(f"`{c}`")) if t.startswith("map") else F.col(f"`{c}`") for c, t in df.dtypes]
    at = F.monotonically_increasing_id()
    ordered = staged(df.orderBy(*keys, *ties).select("*", F.shiftright(at, 33).alias("_part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("_row")), "global-sort")
    # one row for each partition
    counts = ordered.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return ordered.join(F.broadcast(before), "_part").select(*[F.col(f"`{c}`") for c in names], (F.col("_before") + F.col("_row")).alias(position))
