"""Year-over-year returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import safe_div


def yoy_return(quarterly: DataFrame, lag: int = 4, calendar: bool = False,
               value: str = "avg_price_close") -> DataFrame:
    """Return of each (Instrument, Year, Quarter) against a year earlier.

    Default (reference parity): the value ``lag`` rows back in the entity's
    quarter sequence, so a missing quarter shifts the base. ``calendar=True``
    uses the same quarter of the previous year instead (null if absent).
    The window runs over quarterly aggregates, i.e. a few hundred rows per
    entity at most, however many daily rows the entity has."""
    if calendar:
        prev = quarterly.select("Instrument", (F.col("Year") + 1).alias("Year"), "Quarter",
                                F.col(value).alias("prev_year_price"))
        out = quarterly.join(prev, ["Instrument", "Year", "Quarter"], "left")
    else:
        w = Window.partitionBy("Instrument").orderBy("Year", "Quarter")
        out = quarterly.withColumn("prev_year_price", F.lag(value, lag).over(w))
    return out.withColumn(
        "yearly_return",
        safe_div((F.col(value) - F.col("prev_year_price")) * 100.0, F.col("prev_year_price")))
