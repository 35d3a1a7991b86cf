"""Sinks (A4-A6). Writes are the only actions in the library."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, partition_by: tuple = (), mode: str = "overwrite",
                fmt: str = "parquet", table: str | None = None, sort_within: tuple = ()) -> None:
    """A4: overwrite a table. Facts should be partitioned by ``Year`` so later
    year filters prune files instead of scanning them; ``sort_within`` (a
    per-task sort, no shuffle) clusters rows so parquet row-group statistics
    let entity and date filters skip data."""
    if sort_within:
        df = df.sortWithinPartitions(*partition_by, *sort_within)
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table:
        w.option("path", path).saveAsTable(table)
    else:
        w.save(path)


def write_by_key(df: DataFrame, path: str, key: str = "k", mode: str = "overwrite") -> None:
    """A5: one output per value of ``key`` (the reference wrote one table per
    k); a single partitioned write instead of a driver loop."""
    df.write.mode(mode).partitionBy(key).parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """CSV with header. ``single_file`` funnels the result through one
    task, so only use it for small, already-aggregated results."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)
