"""Average-growth baseline.

Prediction for every day of year y+1 = mean(y) * (1 + mean yearly growth),
growth(y) = (mean(y) - mean(previous year)) / mean(y) (the reference divides
by the current year; ``base='previous'`` divides by the earlier one).
All windows run over the per-entity yearly table (one row per year).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import STAT_SCALE, exact_avg, pct_error, safe_div
from .cleaning import fill_zero
from .regress import entity_filter, split_by_year


def test_rows(joined: DataFrame, split_year: int, entities=None) -> DataFrame:
    """P9's input: joined rows from ``split_year`` on, of the listed entities
    (all without a list), numeric nulls as 0."""
    rows = split_by_year(joined, split_year)[1]
    return fill_zero(entity_filter(rows, entities) if entities is not None else rows)


def yearly_means(prices: DataFrame, entity: str = "Instrument", date: str = "Date",
                 value: str = "Price_Close") -> DataFrame:
    """Mean value per (entity, calendar year)."""
    return prices.groupBy(entity, F.year(date).alias("year")).agg(exact_avg(value).alias("avg_price"))


def growth_model(yearly: DataFrame, entity: str = "Instrument", base: str = "current") -> DataFrame:
    """E4 + D15: the next-year price each year implies."""
    c = F.col
    w = Window.partitionBy(entity).orderBy("year")
    prev = F.lag("avg_price", 1).over(w)
    denom = c("avg_price") if base == "current" else prev
    g = yearly.withColumn("growth", safe_div(c("avg_price") - prev, denom))
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    g = g.withColumn("mean_growth", F.avg("growth").over(full))
    return g.select(entity, (c("year") + 1).alias("year"),
                    (c("avg_price") * (F.lit(1.0) + c("mean_growth"))).alias("next_year_price"))


def growth_baseline(prices: DataFrame, entity: str = "Instrument", date: str = "Date",
                    value: str = "Price_Close", base: str = "current") -> DataFrame:
    """Daily rows with the baseline prediction for their year. Rows
    without a prediction (first year, a gap year, one-year entities) drop."""
    model = growth_model(yearly_means(prices, entity, date, value), entity, base)
    rows = prices.select(entity, date, value, F.year(date).alias("year"))
    return (rows.join(model, [entity, "year"], "inner")
                .where(F.col("next_year_price").isNotNull()))


def growth_baseline_error(baseline: DataFrame, entity: str = "Instrument",
                          value: str = "Price_Close") -> DataFrame:
    """Per-entity MSE and mean absolute percent error."""
    c = F.col
    err = c(value) - c("next_year_price")
    return baseline.groupBy(entity).agg(
        F.count(F.lit(1)).alias("n_days"),
        exact_avg(err * err, STAT_SCALE).alias("mse"),
        exact_avg(pct_error(c(value), c("next_year_price")), STAT_SCALE).alias("mean_pct_error"))
