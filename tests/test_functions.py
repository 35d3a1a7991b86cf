import math

import pytest

import datetime as dt

from pyspark.sql import functions as F

from tickframe.functions import minmax, minmax_inverse, pct_error, price_quarter, safe_div
from tickframe.functions import statement_quarter, statement_year


def test_quarter_rules_every_month(spark):
    rows = [(dt.date(2019, m, 15),) for m in range(1, 13)] + [(None,)]
    df = spark.createDataFrame(rows, "Date date")
    got = df.select("Date", price_quarter("Date").alias("pq"), price_quarter("Date", calendar=True).alias("cq"),
                    statement_quarter("Date").alias("sq"), statement_year("Date").alias("sy")).collect()
    by_month = {r.Date.month: r for r in got if r.Date}
    # daily prices: Feb-Mar 1, Apr-Jun 2, Jul-Sep 3, Oct-Dec and January 4
    assert [by_month[m].pq for m in range(1, 13)] == [4, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4]
    assert [by_month[m].cq for m in range(1, 13)] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4]
    # statements: Dec-Feb 1 (December rolls into next year), Mar-May 2, Jun-Aug 3, Sep-Nov 4
    assert [by_month[m].sq for m in range(1, 13)] == [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 1]
    assert [by_month[m].sy for m in range(1, 13)] == [2019] * 11 + [2020]
    nulls = [r for r in got if r.Date is None][0]
    assert nulls.pq is None and nulls.sq is None and nulls.sy is None


def test_zero_denominators(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (3.0, 2.0), (None, 1.0)], "x double, y double")
    got = df.select(safe_div("x", "y").alias("d"), pct_error("y", "x").alias("p")).collect()
    assert got[0].d is None and got[1].d is None and got[2].d == 1.5 and got[3].d is None
    assert got[0].p is None and got[2].p == 50.0


def test_minmax_constant_and_inverse(spark):
    df = spark.createDataFrame([(5.0, 5.0, 5.0), (2.0, 1.0, 3.0), (None, 1.0, 3.0)], "x double, lo double, hi double")
    got = df.select(minmax("x", "lo", "hi").alias("s")).collect()
    assert got[0].s == 0.0 and got[1].s == 0.5 and got[2].s is None
    back = df.select(minmax_inverse(minmax("x", "lo", "hi"), F.col("lo"), F.col("hi")).alias("b")).collect()
    assert back[1].b == 2.0


def test_sums_keep_every_decimal(spark):
    from tickframe.functions.numeric import exact_avg, exact_sum

    def of(values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return tuple(df.agg(exact_avg("v").alias("m"), exact_sum("v").alias("s")).first())

    assert of([0.003, 0.004])[0] == pytest.approx(0.0035)
    assert of([0.012])[0] == pytest.approx(0.012)
    assert of([0.1] * 10) == (pytest.approx(0.1), 1.0)
    assert all(math.isnan(x) for x in of([1.0, float("nan")]))
    assert of([1.0, float("inf")])[0] == float("inf")
    assert of([1e37, 1e37])[1] == 2e37
    assert of([None]) == (None, None)


def test_global_sort(spark):
    df = spark.range(0, 1000, numPartitions=7).selectExpr("(id * 37) % 1000 AS v").orderBy("v")
    assert [r.v for r in df.collect()] == list(range(1000))
