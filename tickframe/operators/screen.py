"""Eight-point value screen (K1-K9).

Plan: statements -> ``annual_rollup`` (one shuffle on entity and year, map-
side combined) -> one aggregate per entity of the per-year conditions (a
shuffle of a table with one row per entity-year) -> left join with the
latest price (one row per entity each side). The reference needed ten
groupings, two anti-joins and a chain of seven full outer joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import safe_div
from ..specs import ScreenParams
from .rollup import annual_rollup, latest_price

METRICS = ("metric1", "metric2", "metric3", "metric4", "metric5", "metric6", "metric7", "metric8")


def _flag(cond):
    return F.max(F.when(cond, 1).otherwise(0))


def _at(cond, value):
    return F.max(F.when(cond, value))


def screen_inputs(fund: DataFrame, tech: DataFrame, p: ScreenParams = ScreenParams()) -> DataFrame:
    """Per entity: every quantity the eight tests read, plus the latest price."""
    c = F.col
    # years before the earliest tested one never matter (later ones do: the
    # earnings and dividend records cover every year since ``since_year``);
    # a statement's reporting Year is its calendar year or the next one, so
    # the same bound on Year prunes partitions of a written table
    first = min(p.base_year, p.since_year, p.current_year)
    fund = fund.where(F.year("Date") >= first)
    if "Year" in fund.columns:
        fund = fund.where(c("Year") >= first)
    annual = annual_rollup(fund)
    cur = c("actual_year") == p.current_year
    base = c("actual_year") == p.base_year
    recent = c("actual_year") >= p.since_year
    per = annual.groupBy("Instrument").agg(
        _flag(cur & (c("revenue") > p.min_revenue)).alias("size_ok"),
        _flag(cur & (c("assets") >= c("liabilities") * p.liquidity_ratio)).alias("liquidity_ok"),
        _flag(cur & (c("assets") - c("liabilities") > c("long_term_debt"))).alias("capital_ok"),
        _flag(recent & (c("earnings_avg") > 0)).alias("earn_pos"),
        _flag(recent & (c("earnings_sum") < 0)).alias("earn_neg"),
        _flag(recent & (c("dividend_per_share") > 0)).alias("div_pos"),
        _flag(recent & (c("dividend_per_share") == 0)).alias("div_zero"),
        _flag(base).alias("has_base"),
        _flag(cur).alias("has_current"),
        _at(base, F.coalesce(c("earnings_sum"), F.lit(0.0))).alias("base_earnings"),
        _at(cur, F.coalesce(c("earnings_sum"), F.lit(0.0))).alias("current_earnings"),
        _at(cur, c("eps")).alias("eps"),
        _at(cur, c("shares_avg")).alias("shares"),
        _at(cur, c("book_per_share_avg")).alias("book_per_share"),
    )
    return per.join(latest_price(tech, p.current_year), "Instrument", "left")


def screen_flags(inputs: DataFrame, p: ScreenParams = ScreenParams()) -> DataFrame:
    """All entities with their eight 0/1 flags (no absence rule)."""
    c = F.col
    growth = safe_div(c("current_earnings") - c("base_earnings"), F.abs(c("base_earnings")))

    def flag(cond):
        return F.coalesce(cond, F.lit(False)).cast("int")

    return inputs.select(
        "Instrument",
        flag(c("size_ok") == 1).alias("metric1"),
        flag(c("liquidity_ok") == 1).alias("metric2"),
        flag(c("capital_ok") == 1).alias("metric3"),
        flag((c("earn_pos") == 1) & (c("earn_neg") == 0)).alias("metric4"),
        flag((c("div_pos") == 1) & (c("div_zero") == 0)).alias("metric5"),
        flag((c("has_base") == 1) & (c("has_current") == 1) & (growth >= p.growth_min)).alias("metric6"),
        flag((c("has_current") == 1) & (c("Price") <= c("eps") * p.pe_max)).alias("metric7"),
        flag((c("has_current") == 1)
             & (c("Price") * c("shares") <= F.lit(p.pb_max) * c("book_per_share") * c("shares"))).alias("metric8"),
    )


def value_screen(fund: DataFrame, tech: DataFrame, p: ScreenParams = ScreenParams()) -> DataFrame:
    """K9: ``Instrument, metric1..metric8``; entities passing no test are
    absent, as in the reference's join of the eight flagged sets."""
    flags = screen_flags(screen_inputs(fund, tech, p), p)
    return flags.where(F.greatest(*[F.col(m) for m in METRICS]) == 1)


def single_metric(fund: DataFrame, tech: DataFrame, metric: str, p: ScreenParams = ScreenParams()) -> DataFrame:
    """One test alone: the entities that pass it, with its flag (= 1)."""
    flags = screen_flags(screen_inputs(fund, tech, p), p)
    return flags.where(F.col(metric) == 1).select("Instrument", metric)


def combine_flags(frames: list, key: str = "Instrument") -> DataFrame:
    """C4 stand-alone: merge flagged sets (each ``key`` + one flag column)
    as a full outer join would, with absent flags as 0. Written as one union
    and one aggregate instead of a chain of full joins."""
    names = [[c for c in f.columns if c != key][0] for f in frames]
    aligned = [f.select(key, *[(F.col(n) if n == own else F.lit(None).cast("int")).alias(n) for n in names])
               for f, own in zip(frames, names)]
    merged = reduce(lambda a, b: a.unionByName(b), aligned)
    return merged.groupBy(key).agg(*[F.coalesce(F.max(n), F.lit(0)).cast("int").alias(n) for n in names])
