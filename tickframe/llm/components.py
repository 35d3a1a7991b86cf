"""Connected components of a link table, by alternating star contractions.

Each round points every node's larger neighbours at its smallest one
(large-star), then its smaller ones (small-star), until nothing changes.
Every step is an aggregation and a join on the link table; a hub's links
are rows, never one task's list. Rounds are staged tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (a, b) with a > b; the result too."""
    both = links if not large else links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    moved = both.join(least, "a")
    if large:
        moved = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.where("a != b").distinct()
    return (moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
            .where("a != b").distinct())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node of ``links`` (a, b); component is the
    smallest id that links reach."""
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    now = stage(ordered, "links")
    while True:
        before, now = now, stage(_star(_star(now, True), False), "links")
        changed = now.count() != before.count() or not now.join(before, ["a", "b"], "left_anti").isEmpty()
        release(before)
        if not changed:
            break
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
