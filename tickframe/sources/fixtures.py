"""The two raw input tables of the reference, derived from the driver's
TPC-H-style tables (mapping in FIXTURES.md): entity = supplier, day = ship
date, close = largest extended price of the day, statements = quarterly
supplier aggregates. Both are built with the DataFrame API; the same
definitions as SQL text feed the DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..specs import TECHNICALS
from .tables import load_table

# Sums of values cast to 2 decimals are exact in any decimal width; 38
# digits keeps Spark on one accumulator type (faster than 18 -> 28).
_DEC = "decimal(38,2)"


def _dec(c):
    return F.col(c).cast(_DEC)


def _daily(spark: SparkSession, base: str) -> DataFrame:
    li = load_table(spark, base, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_linenumber")
    return (li.groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("dt"))
            .agg(F.max("l_extendedprice").alias("px"),
                 F.sum(_dec("l_quantity")).cast("double").alias("qty"),
                 F.count(F.lit(1)).alias("n"),
                 F.min("l_linenumber").alias("lm")))


def _daily_columns() -> list:
    return [
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("Instrument"),
        F.when(F.col("lm") == 7, F.lit(None)).otherwise(F.col("dt").cast("string")).alias("Date"),
        F.when(F.col("n") >= 3, F.lit("n/a")).otherwise(F.col("px").cast("string")).alias("Price_Close"),
        F.when((F.col("lm") == 6) & (F.col("n") == 1), F.lit(None).cast("double"))
         .otherwise(F.col("qty")).alias("Volume")]


def technicals_raw(spark: SparkSession, base: str) -> DataFrame:
    """Daily series with the reference's defects: text-typed dates and
    prices, null dates and volumes, and unparseable prices."""
    return _daily(spark, base).select(*_daily_columns())


#: The seven daily ratios of the raw table.
RATIOS = tuple(c for c in TECHNICALS.types if c not in ("Date", "Price_Close"))


def technicals_full(spark: SparkSession, base: str) -> DataFrame:
    """The raw daily table with all twelve columns: the row index of its
    origin and seven ratios, as text and with nulls, come with the four of
    ``technicals_raw``."""
    index = F.col("l_suppkey") * 10000 + F.datediff("dt", F.lit("1992-01-01").cast("date"))
    ratios = [F.when(F.col("lm") == k, F.lit(None)).otherwise((F.col("n") * 37 + F.col("lm") * 11 + k).cast("decimal(18,2)").cast("string")).alias(c)
              for k, c in enumerate(RATIOS, 1)]
    return _daily(spark, base).select(index.cast("long").alias("int64_field_0"), *_daily_columns(), *ratios)


def fundamentals_raw(spark: SparkSession, base: str) -> DataFrame:
    """Quarterly statements per entity with duplicate dates, null dates,
    null assets and shares, and zero-dividend entities."""
    li = load_table(spark, base, "lineitem")
    zero = F.lit(0).cast(_DEC)
    price = _dec("l_extendedprice")
    m = (li.groupBy(F.col("l_suppkey").alias("k"), F.year("l_shipdate").alias("_y"),
                     F.quarter("l_shipdate").alias("_q"))
         .agg(F.max("l_shipdate").cast("date").alias("Date"),
              F.sum(price).alias("rev"),
              F.sum(F.when(F.col("l_returnflag") == "R", price).otherwise(zero)).alias("ra"),
              F.sum(F.when(F.col("l_returnflag") == "A", price).otherwise(zero)).alias("aa"),
              F.sum(F.when(F.col("l_linestatus") == "F", price).otherwise(zero)).alias("fa"),
              F.sum(F.when(F.col("l_suppkey") % 3 == 0, zero)
                    .when(F.col("l_linestatus") == "O", _dec("l_quantity"))
                    .otherwise(zero)).alias("dv"),
              F.sum(_dec("l_quantity")).alias("qty"),
              F.count(F.lit(1)).alias("n"))
         .drop("_y", "_q"))
    # every fifth entity's statements appear twice (rep 0 and 1): one
    # aggregate pass and a generator, not a union that aggregates twice
    u = m.withColumn("rep", F.explode(F.when(F.col("k") % 5 == 0, F.array(F.lit(0), F.lit(1)))
                                       .otherwise(F.array(F.lit(0)))))
    sup = load_table(spark, base, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = load_table(spark, base, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = load_table(spark, base, "region").select("r_regionkey", "r_name")
    j = (u.join(sup, u.k == sup.s_suppkey)
         .join(nat, F.col("s_nationkey") == F.col("n_nationkey"))
         .join(reg, F.col("n_regionkey") == F.col("r_regionkey")))
    c = F.col
    d = lambda e: e.cast("double")
    k = c("k")
    return j.select(
        F.concat(F.lit("S"), k.cast("string")).alias("Instrument"),
        F.when(c("n") == 20, F.lit(None).cast("date")).otherwise(c("Date")).alias("Date"),
        d(c("rev") + c("rep")).alias("Total_Revenue"),
        F.when(k % 11 == 4, F.lit(None).cast("double")).otherwise(d(c("rev") + c("fa"))).alias("Total_Current_Assets"),
        F.when(k % 11 == 4, F.lit(None).cast("double")).otherwise(d(c("aa") + c("ra"))).alias("Total_Current_Liabilities"),
        d(c("aa")).alias("Total_Long_Term_Debt"),
        d(c("aa") + c("fa")).alias("Total_Debt"),
        d(c("rev") * 3 - c("aa") - c("ra")).alias("Total_Equity"),
        d(c("aa") + c("ra")).alias("Total_Liabilities"),
        d(c("rev") * 3).alias("Total_Assets__Reported"),
        d(c("fa")).alias("Operating_Expenses"),
        d(c("rev") - c("fa")).alias("EBIT"),
        d(c("rev") - c("fa") - c("aa")).alias("Net_Income_Before_Taxes"),
        d(c("rev") - c("aa") - c("fa")).alias("Normalized_Income_Avail_to_Cmn_Shareholders"),
        d(c("dv")).alias("Gross_Dividends___Common_Stock"),
        F.when(k % 13 == 6, F.lit(None).cast("double")).otherwise(d(c("qty"))).alias("Total_Common_Shares_Outstanding"),
        (d(c("rev")) / d(c("qty"))).alias("Revenue_Per_Share"),
        (d(c("rev") * 3 - c("aa") - c("ra")) * 12 / d(c("qty"))).alias("Book_Value_Per_Share"),
        (d(c("rev") * 3 - c("aa") - c("ra") - c("fa")) / d(c("qty"))).alias("Tangible_Book_Value_Per_Share"),
        c("s_name").alias("Company_Common_Name"),
        c("n_name").alias("Country_of_Headquarters"),
        c("r_name").alias("TRBC_Economic_Sector_Name"),
    )


# The fixture definitions of FIXTURES.md as SQL text, run by
# the DuckDB oracle over the same parquet tables.
_DAILY_SQL = """(SELECT l_suppkey, CONCAT('S', CAST(l_suppkey AS STRING)) AS Instrument, CAST(l_shipdate AS DATE) AS dt,
        MAX(l_extendedprice) AS px, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty,
        COUNT(*) AS n, MIN(l_linenumber) AS lm
      FROM lineitem
      GROUP BY l_suppkey, CAST(l_shipdate AS DATE)) q"""
_DAILY_COLUMNS = """Instrument,
  CASE WHEN lm = 7 THEN NULL ELSE CAST(dt AS STRING) END AS Date,
  CASE WHEN n >= 3 THEN 'n/a' ELSE CAST(px AS STRING) END AS Price_Close,
  CASE WHEN lm = 6 AND n = 1 THEN NULL ELSE qty END AS Volume"""
TECHNICALS_RAW_SQL = f"SELECT {_DAILY_COLUMNS} FROM {_DAILY_SQL}"
TECHNICALS_FULL_SQL = f"SELECT l_suppkey * 10000 + DATE_DIFF('day', DATE '1992-01-01', dt) AS int64_field_0, {_DAILY_COLUMNS}, " + ", ".join(
    f"CASE WHEN lm = {k} THEN NULL ELSE CAST(CAST(n * 37 + lm * 11 + {k} AS DECIMAL(18,2)) AS STRING) END AS {c}"
    for k, c in enumerate(RATIOS, 1)) + f" FROM {_DAILY_SQL}"

FUNDAMENTALS_RAW_SQL = """
WITH m AS (SELECT l_suppkey AS k, CAST(MAX(l_shipdate) AS DATE) AS Date,
   SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS rev,
   SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END) AS ra,
   SUM(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END) AS aa,
   SUM(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END) AS fa,
   SUM(CASE WHEN l_suppkey % 3 = 0 THEN CAST(0 AS DECIMAL(18,2)) WHEN l_linestatus = 'O' THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END) AS dv,
   SUM(CAST(l_quantity AS DECIMAL(18,2))) AS qty, COUNT(*) AS n
  FROM lineitem GROUP BY l_suppkey, YEAR(l_shipdate), QUARTER(l_shipdate)),
 u AS (SELECT m.*, 0 AS rep FROM m UNION ALL SELECT m.*, 1 AS rep FROM m WHERE k % 5 = 0)
SELECT CONCAT('S', CAST(k AS STRING)) AS Instrument, CASE WHEN n = 20 THEN NULL ELSE Date END AS Date,
  CAST(rev + rep AS DOUBLE) AS Total_Revenue,
  CASE WHEN k % 11 = 4 THEN NULL ELSE CAST(rev + fa AS DOUBLE) END AS Total_Current_Assets,
  CASE WHEN k % 11 = 4 THEN NULL ELSE CAST(aa + ra AS DOUBLE) END AS Total_Current_Liabilities,
  CAST(aa AS DOUBLE) AS Total_Long_Term_Debt, CAST(aa + fa AS DOUBLE) AS Total_Debt,
  CAST(rev * 3 - aa - ra AS DOUBLE) AS Total_Equity, CAST(aa + ra AS DOUBLE) AS Total_Liabilities,
  CAST(rev * 3 AS DOUBLE) AS Total_Assets__Reported, CAST(fa AS DOUBLE) AS Operating_Expenses,
  CAST(rev - fa AS DOUBLE) AS EBIT, CAST(rev - fa - aa AS DOUBLE) AS Net_Income_Before_Taxes,
  CAST(rev - aa - fa AS DOUBLE) AS Normalized_Income_Avail_to_Cmn_Shareholders,
  CAST(dv AS DOUBLE) AS Gross_Dividends___Common_Stock,
  CASE WHEN k % 13 = 6 THEN NULL ELSE CAST(qty AS DOUBLE) END AS Total_Common_Shares_Outstanding,
  CAST(rev AS DOUBLE) / CAST(qty AS DOUBLE) AS Revenue_Per_Share,
  CAST(rev * 3 - aa - ra AS DOUBLE) * 12 / CAST(qty AS DOUBLE) AS Book_Value_Per_Share,
  CAST(rev * 3 - aa - ra - fa AS DOUBLE) / CAST(qty AS DOUBLE) AS Tangible_Book_Value_Per_Share,
  s_name AS Company_Common_Name, n_name AS Country_of_Headquarters, r_name AS TRBC_Economic_Sector_Name
FROM u JOIN supplier ON k = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
