"""Grouped rollups (D5-D12). Every aggregate here combines map-side, so a
hot entity costs one partial row per task, not one task holding it all."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_avg, exact_sum, safe_div


def quarterly_avg_price(tech: DataFrame, price: str = "Price_Close", scale: int | None = 2) -> DataFrame:
    """Mean close per (Instrument, Year, Quarter)."""
    return (tech.groupBy("Instrument", "Year", "Quarter")
                .agg(exact_avg(price, scale).alias("avg_price_close")))


def annual_rollup(fund: DataFrame, scale: int | None = 2) -> DataFrame:
    """One row per (Instrument, calendar year of the statement date)
    with every yearly figure the value screen needs, computed once (the
    reference rebuilt this grouping ten times)."""
    c = F.col
    yearly = fund.groupBy("Instrument", F.year("Date").alias("actual_year")).agg(
        exact_sum("Total_Revenue", scale).alias("revenue"),
        exact_avg("Total_Current_Assets", scale).alias("assets"),
        exact_avg("Total_Current_Liabilities", scale).alias("liabilities"),
        exact_avg("Total_Long_Term_Debt", scale).alias("long_term_debt"),
        exact_sum("Normalized_Income_Avail_to_Cmn_Shareholders", scale).alias("earnings_sum"),
        exact_avg("Normalized_Income_Avail_to_Cmn_Shareholders", scale).alias("earnings_avg"),
        exact_sum("Gross_Dividends___Common_Stock", scale).alias("dividends_sum"),
        exact_avg("Total_Common_Shares_Outstanding", scale).alias("shares_avg"),
        exact_avg("Book_Value_Per_Share", None if scale is None else 10).alias("book_per_share_avg"),
    )
    return yearly.select(
        "*",
        safe_div(c("dividends_sum"), c("shares_avg")).alias("dividend_per_share"),
        safe_div(c("earnings_sum"), c("shares_avg")).alias("eps"),
    )


def latest_price(tech: DataFrame, year: int, price: str = "Price_Close", date: str = "Date") -> DataFrame:
    """Last close of ``year`` per entity (``max_by`` on the date, with
    the price as tie-break, instead of the reference's sort-dependent
    ``last``). The year test is a date range so it can reach the scan."""
    lo, hi = _dt.date(year, 1, 1), _dt.date(year + 1, 1, 1)
    rows = tech.where((F.col(date) >= F.lit(lo)) & (F.col(date) < F.lit(hi)))
    if "Year" in tech.columns:  # daily Year is the calendar year: prunes Year partitions
        rows = rows.where(F.col("Year") == year)
    return rows.groupBy("Instrument").agg(
        F.max_by(F.col(price), F.struct(F.col(date), F.col(price))).alias("Price"))


def endpoint_growth(annual: DataFrame, base_year: int, current_year: int,
                    value: str = "earnings_sum") -> DataFrame:
    """``(last - first) / |first|`` over the two endpoint years, with
    missing sums counted as 0. One endpoint only gives growth 0; first = 0
    gives null."""
    ends = (annual.where(F.col("actual_year").isin(base_year, current_year))
                  .select("Instrument", "actual_year", F.coalesce(F.col(value), F.lit(0.0)).alias("v")))
    g = ends.groupBy("Instrument").agg(F.min_by("v", "actual_year").alias("first_value"),
                                       F.max_by("v", "actual_year").alias("last_value"))
    return g.withColumn("growth", safe_div(F.col("last_value") - F.col("first_value"),
                                           F.abs(F.col("first_value"))))


def earnings_record(annual: DataFrame, since_year: int) -> DataFrame:
    """C3/D12 rewritten as one aggregate: entities with a year since
    ``since_year`` of positive mean earnings and none with a negative sum
    (the reference's distinct + left-anti join)."""
    recent = F.col("actual_year") >= since_year
    g = annual.groupBy("Instrument").agg(
        F.max(F.when(recent & (F.col("earnings_avg") > 0), 1).otherwise(0)).alias("pos"),
        F.max(F.when(recent & (F.col("earnings_sum") < 0), 1).otherwise(0)).alias("neg"))
    return g.where((F.col("pos") == 1) & (F.col("neg") == 0)).select("Instrument")
