"""Feature engineering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_moments, safe_div

# The statement measures the reference puts on a per-share
# basis, the divisor, and the measures that are already per share.
PER_SHARE_MEASURES = (
    "Gross_Dividends___Common_Stock", "Net_Income_Before_Taxes",
    "Normalized_Income_Avail_to_Cmn_Shareholders", "Operating_Expenses", "EBIT",
    "Total_Assets__Reported", "Total_Debt", "Total_Equity", "Total_Liabilities",
    "Total_Long_Term_Debt",
)
SHARES = "Total_Common_Shares_Outstanding"
EXISTING_PER_SHARE = ("Revenue_Per_Share", "Book_Value_Per_Share", "Tangible_Book_Value_Per_Share")
KEYS = ("Instrument", "Year", "Quarter")


def per_share_names() -> list:
    """Feature order for the ratios: existing per-share features, then the
    derived ones, with dividends moved last so they are never a divisor."""
    derived = [f"{m}_per_share" for m in PER_SHARE_MEASURES]
    div = "Gross_Dividends___Common_Stock_per_share"
    return list(EXISTING_PER_SHARE) + [d for d in derived if d != div] + [div]


def per_share_features(fund: DataFrame, keys=KEYS) -> DataFrame:
    """H12 + B8: keys and 13 per-share features in one projection; rows with
    any null (a missing measure or a zero/null share count) are dropped."""
    cols = [F.col(k) for k in keys] + [F.col(c) for c in EXISTING_PER_SHARE]
    cols += [safe_div(F.col(m), F.col(SHARES)).alias(f"{m}_per_share") for m in PER_SHARE_MEASURES]
    out = fund.select(*cols)
    return out.select(*keys, *per_share_names()).na.drop()


def ratio_names(features=None) -> list:
    f = list(features or per_share_names())
    return [f"{f[j]}_to_{f[i]}" for i in range(len(f) - 1) for j in range(i + 1, len(f))]


def pairwise_ratios(per_share: DataFrame, features=None, keys=KEYS) -> DataFrame:
    """H13 + B8: every ratio ``f[j] / f[i]`` for i < j (13 features -> 78) in
    one projection, then drop rows where any ratio is null."""
    f = list(features or per_share_names())
    ratios = [safe_div(F.col(f[j]), F.col(f[i])).alias(f"{f[j]}_to_{f[i]}")
              for i in range(len(f) - 1) for j in range(i + 1, len(f))]
    return per_share.select(*keys, *ratios).na.drop()


def standardize(df: DataFrame, cols, fit: DataFrame | None = None, suffix: str = "_z") -> DataFrame:
    """I2 as SQL: ``(x - mean) / stddev_samp`` with the statistics of ``fit``
    (the training rows; default ``df``) from a single scalar subquery that
    Spark evaluates once and inlines, so no join is needed. Moments are
    order-independent decimal sums."""
    fit = fit if fit is not None else df

    def mean_sd(c):
        n, s1, s2 = exact_moments(c)
        nd = n.cast("double")
        var = F.try_divide(s2 - F.try_divide(s1 * s1, nd), nd - 1.0)
        return F.struct(F.try_divide(s1, nd).alias("m"), F.sqrt(var).alias("s"))

    stats = fit.agg(F.struct(*[mean_sd(c).alias(f"c{i}") for i, c in enumerate(cols)]).alias("stats")).scalar()
    return df.select("*", *[safe_div(F.col(c) - stats.getField(f"c{i}").getField("m"),
                                     stats.getField(f"c{i}").getField("s")).alias(f"{c}{suffix}")
                            for i, c in enumerate(cols)])


def assemble(df: DataFrame, cols, out: str = "features") -> DataFrame:
    """Feature vector column."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)
