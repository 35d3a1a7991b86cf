"""Type repair, cleaning and de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import price_quarter, statement_quarter, statement_year
from ..specs import FUNDAMENTALS, TECHNICALS, TableSpec


def coerce(df: DataFrame, types: dict) -> DataFrame:
    """B1/H1/H2: one projection that repairs text columns with ``try_cast``;
    unparseable values become null instead of failing the job."""
    return df.select(*[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`")
                       for c in df.columns])


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop listed columns that exist."""
    return df.drop(*[c for c in cols if c in df.columns])


def require_non_null(df: DataFrame, cols) -> DataFrame:
    """Keep rows where every listed column is non-null (and not NaN)."""
    cols = [c for c in cols if c in df.columns]
    return df.na.drop(how="any", subset=cols) if cols else df


def fill_zero(df: DataFrame) -> DataFrame:
    """Numeric nulls and NaN -> 0; strings and booleans untouched."""
    return df.na.fill(0)


def with_price_calendar(df: DataFrame, date_col: str = "Date", calendar: bool = False) -> DataFrame:
    """H3/H4: ``Year`` = calendar year, ``Quarter`` by the price rule."""
    return (df.withColumn("Year", F.year(date_col))
              .withColumn("Quarter", price_quarter(date_col, calendar)))


def with_statement_calendar(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """H5: reporting ``Year`` and ``Quarter`` of a statement date."""
    return (df.withColumn("Year", statement_year(date_col))
              .withColumn("Quarter", statement_quarter(date_col)))


def dedup(df: DataFrame, keys, order, keep: str = "first") -> DataFrame:
    """One row per key, the first (or last) in ``order``.

    Written as a grouped ``min``/``max`` of one struct, the order columns
    first, rather than ``row_number``: the aggregate combines map-side, so a
    key holding a large share of the rows never lands whole in one task, and
    a row is carried once. The remaining columns extend the ordering, so the
    survivor is deterministic even when ``order`` ties."""
    keys = list(keys)
    rest = list(order) + [c for c in df.columns if c not in keys and c not in order]
    pick = F.min if keep == "first" else F.max
    agg = df.groupBy(*keys).agg(pick(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("__row"))
    return agg.select(*[F.col(f"`{c}`") if c in keys else F.col(f"__row.`{c}`").alias(c) for c in df.columns])


def clean_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Repair types first, then drop unneeded columns and incomplete rows
    (the reference filtered the raw text, so unparseable values slipped
    through as nulls after the cast)."""
    out = coerce(df, spec.types) if spec.types else df
    out = drop_columns(out, spec.not_required_cols)
    return require_non_null(out, spec.non_null_cols)


def clean_technicals(raw: DataFrame, spec: TableSpec = TECHNICALS, calendar: bool = False) -> DataFrame:
    """P1 step for the daily table: repair, filter, add ``Year``/``Quarter``."""
    return with_price_calendar(clean_table(raw, spec), calendar=calendar)


def clean_fundamentals(raw: DataFrame, spec: TableSpec = FUNDAMENTALS,
                       one_per_quarter: bool = False) -> DataFrame:
    """P1 step for statements: repair, filter, reporting quarter, one row
    per (Date, Instrument); ``one_per_quarter`` also keeps only the latest
    statement of each reporting quarter so the later join cannot fan out."""
    out = with_statement_calendar(clean_table(raw, spec))
    if spec.dedup_keys:
        out = dedup(out, spec.dedup_keys, spec.dedup_order)
    if one_per_quarter:
        out = dedup(out, ("Instrument", "Year", "Quarter"), ("Date",), keep="last")
    return out
