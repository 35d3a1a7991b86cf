"""Shared inputs of the registered queries: the two fixture tables and their
cleaned and joined forms, plus the fixture's parameter values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import exact_sum
from ..operators.cleaning import clean_fundamentals, clean_technicals, coerce
from ..operators.features import PER_SHARE_MEASURES
from ..operators.joins import join_tech_fund
from ..sources.fixtures import fundamentals_raw, technicals_full, technicals_raw
from ..specs import TECHNICALS, ForecastParams, ScreenParams, SplitParams

# The fixture's stand-ins for the reference's parameters
# (FIXTURES.md section 2). Its years run 1995-2001.
SCREEN = ScreenParams(current_year=2000, base_year=1996, since_year=1996)
SPLIT_YEAR = 2000
SECTOR = "AMERICA"
ENTITIES = ("S0", "S1", "S2", "S3", "S4", "S5", "S6", "S7", "S8", "S9", "S999999")
# The reference's own windows: 180-row blocks, 360 rows in, 90 out.
BLOCKS = SplitParams()
FORECAST = ForecastParams()


class Inputs:
    """Lazily built, memoised per (session, folder) DataFrames."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        self._memo: dict = {}

    def _get(self, name, build):
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    @property
    def technicals_raw(self) -> DataFrame:
        return self._get("tr", lambda: technicals_raw(self.spark, self.base))

    @property
    def technicals_full(self) -> DataFrame:
        return self._get("tf", lambda: technicals_full(self.spark, self.base))

    @property
    def fundamentals_raw(self) -> DataFrame:
        return self._get("fr", lambda: fundamentals_raw(self.spark, self.base))

    @property
    def technicals_typed(self) -> DataFrame:
        return self._get("tt", lambda: coerce(self.technicals_raw, TECHNICALS.types))

    @property
    def technicals(self) -> DataFrame:
        return self._get("t", lambda: clean_technicals(self.technicals_raw))

    @property
    def fundamentals(self) -> DataFrame:
        return self._get("f", lambda: clean_fundamentals(self.fundamentals_raw))

    @property
    def joined(self) -> DataFrame:
        return self._get("j", lambda: join_tech_fund(self.technicals, self.fundamentals))

    @property
    def countries(self) -> DataFrame:
        """Daily series by country: the joined rows of its companies, highest
        close, summed volume and statement measures."""
        total = [exact_sum(c).alias(c) for c in ("Volume", *PER_SHARE_MEASURES)]
        return self._get("c", lambda: self.joined.groupBy(F.col("Country_of_Headquarters").alias("Instrument"), "Date")
                         .agg(F.max("Price_Close").alias("Price_Close"), *total))
