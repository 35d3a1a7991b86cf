"""Joins (C1, C2, C6). No broadcast hints: with AQE on, Spark switches a
shuffle join to a broadcast only after measuring the small side at run time,
and splits skewed partitions otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame

JOIN_KEYS = ("Instrument", "Quarter", "Year")


def join_tech_fund(tech: DataFrame, fund: DataFrame, keys=JOIN_KEYS) -> DataFrame:
    """Each daily row with its reporting quarter's statement(s); the
    statement's own ``Date`` is dropped so the daily one survives."""
    return tech.join(fund.drop("Date"), list(keys), "inner")


def join_on_period(left: DataFrame, right: DataFrame,
                   keys=("Instrument", "Year", "Quarter")) -> DataFrame:
    """Inner equi-join on entity and period."""
    return left.join(right, list(keys), "inner")
