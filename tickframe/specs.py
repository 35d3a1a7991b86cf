"""Parameter objects. Defaults are the reference's values; the registered
queries pass the fixture's equivalents (see ``plans.registry``)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    """How one raw table is profiled and cleaned."""

    name: str
    types: dict = field(default_factory=dict)       # column -> Spark type for repair
    or_cols: tuple = ()                              # subset for the "any null" profile
    not_required_cols: tuple = ()                    # dropped in cleaning
    non_null_cols: tuple = ()                        # rows need all of these
    dedup_keys: tuple = ()                           # one row per key after cleaning
    dedup_order: tuple = ()                          # total order: first row is kept


# The column names and rules of the reference's two raw tables.
TECHNICALS = TableSpec(
    name="technicals",
    types={
        "Date": "date",
        "Price_Close": "double",
        "Enterprise_Value_To_Sales__Daily_Time_Series_Ratio_": "double",
        "P_E__Daily_Time_Series_Ratio_": "double",
        "Price_To_Book_Value_Per_Share__Daily_Time_Series_Ratio_": "double",
        "Price_To_Cash_Flow_Per_Share__Daily_Time_Series_Ratio_": "double",
        "Price_To_Sales_Per_Share__Daily_Time_Series_Ratio_": "double",
        "Total_Debt_To_EBITDA__Daily_Time_Series_Ratio_": "double",
        "Total_Debt_To_Enterprise_Value__Daily_Time_Series_Ratio_": "double",
    },
    or_cols=("Date", "Instrument", "Price_Close", "Volume"),
    not_required_cols=("int64_field_0",),
    non_null_cols=("Date", "Instrument", "Price_Close", "Volume"),
)

FUNDAMENTALS = TableSpec(
    name="fundamentals",
    or_cols=("Date", "Instrument", "Total_Debt", "Total_Revenue",
             "Total_Current_Assets", "Total_Current_Liabilities"),
    non_null_cols=("Date", "Instrument"),
    dedup_keys=("Date", "Instrument"),
    dedup_order=("Total_Revenue",),
)


@dataclass(frozen=True)
class ScreenParams:
    """Value-screen thresholds (reference: current 2019, base 2009, since 2015)."""

    current_year: int = 2019
    base_year: int = 2009
    since_year: int = 2015
    min_revenue: float = 5_000_000.0
    liquidity_ratio: float = 2.0
    growth_min: float = 0.33
    pe_max: float = 15.0
    pb_max: float = 1.5


@dataclass(frozen=True)
class SplitParams:
    """Chronological block split of one entity's history."""

    window: int = 180
    train_frac: float = 0.65
    test_frac_of_rest: float = 0.5


@dataclass(frozen=True)
class ForecastParams:
    """Direct multi-horizon forecaster (reference: 360 in, 90 out, 180 blocks).
    ``channels``: volume and further inputs on every day of the ``window``,
    as in the reference (12 channels make 4,321 features and a dense solve of
    that size per entity and scope), or on its last, the ``anchor``, only."""

    n_in: int = 360
    n_out: int = 90
    block: int = 180
    ridge: float = 1e-3
    tail_forecast: int = 45
    tail_price: int = 10
    channels: str = "window"
