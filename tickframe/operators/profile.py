"""Null profiles (D1-D4): one group-by per table, however many columns.

The reference ran one SQL job per column plus two more for the any-null
counts. Here every row becomes a bit mask of its nulls; the histogram of
masks is one aggregate that combines in each task, and the counts per
column, of rows with any null and of rows with a null in a subset all follow
from it, without another look at the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns whose null bits share one number.
_WORD = 60


def _pct(n, total):
    return F.try_divide(F.col(n).cast("double") * 100.0, F.col(total).cast("double"))


def null_patterns(df: DataFrame, cols: list | None = None) -> DataFrame:
    """(mask, rows): how many rows have which nulls. Bit ``i % 60`` of
    ``mask[i // 60]`` tells whether column ``i`` is null."""
    cols = list(cols or df.columns)

    def word(part):
        bits = F.lit(0).cast("long")
        for i, c in enumerate(part):
            bits = bits + F.when(F.col(f"`{c}`").isNull(), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
        return bits

    words = [word(cols[k:k + _WORD]).alias(f"w{k // _WORD}") for k in range(0, len(cols), _WORD)]
    masks = df.select(*words)
    return masks.groupBy(*masks.columns).agg(F.count("*").alias("rows")).select(F.array(*masks.columns).alias("mask"), "rows")


def _has(i: int) -> Column:
    return F.col("mask")[i // _WORD].bitwiseAND(F.lit(1 << i % _WORD)) != 0


def _any(indices) -> Column:
    words: dict[int, int] = {}
    for i in indices:
        words[i // _WORD] = words.get(i // _WORD, 0) | 1 << i % _WORD
    hit = F.lit(False)
    for w, bits in words.items():
        hit = hit | (F.col("mask")[w].bitwiseAND(F.lit(bits)) != 0)
    return hit


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("rows"))), F.lit(0).cast("long"))


def column_profile(patterns: DataFrame, cols) -> DataFrame:
    """Per column: ``column_name, nulls, total_rows, null_pct``.

    Counts are 0 (not null) for columns without nulls; the percentage of an
    empty table is null."""
    cols = list(cols)
    wide = patterns.agg(_count(F.lit(True)).alias("total_rows"), *[_count(_has(i)).alias(f"n{i}") for i in range(len(cols))])
    # unpivot the one-row result with its column names as literals
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(cols)]))
    return wide.select("total_rows", rows.alias("r")).select("r.column_name", "r.nulls", "total_rows", _pct("r.nulls", "total_rows").alias("null_pct"))


def row_profile(patterns: DataFrame, cols, subset: list | tuple = ()) -> DataFrame:
    """One row: rows with a null in any column, and (for a subset of at least
    two columns, as in the reference) rows with a null in the subset."""
    cols, subset = list(cols), list(subset)
    inner = _count(_any(cols.index(c) for c in subset)) if len(subset) >= 2 else F.lit(None).cast("long")
    out = patterns.agg(_count(F.lit(True)).alias("total_rows"), _count(_any(range(len(cols)))).alias("any_null_rows"), inner.alias("subset_null_rows"))
    return out.select("total_rows", "any_null_rows", _pct("any_null_rows", "total_rows").alias("any_null_pct"),
                      "subset_null_rows", _pct("subset_null_rows", "total_rows").alias("subset_null_pct"))


def null_profile(df: DataFrame, cols: list | None = None) -> DataFrame:
    """``column_profile`` of a table."""
    cols = list(cols or df.columns)
    return column_profile(null_patterns(df, cols), cols)


def null_profile_any(df: DataFrame, subset: list | tuple = ()) -> DataFrame:
    """``row_profile`` of a table."""
    return row_profile(null_patterns(df), df.columns, subset)
