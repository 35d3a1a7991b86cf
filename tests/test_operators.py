import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickframe.operators import baseline as bl
from tickframe.operators import profile as pr
from tickframe.operators import rollup as ru
from tickframe.operators import screen as sc
from tickframe.operators import sequence as sq
from tickframe.operators.cleaning import clean_technicals, coerce, dedup, fill_zero
from tickframe.operators.returns import yoy_return
from tickframe.specs import ScreenParams, SplitParams


def test_null_profile_all_null_and_empty(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None), (None, 2.0)], "a string, b double")
    got = {r.column_name: r for r in pr.null_profile(df).collect()}
    assert got["a"].nulls == 3 and got["a"].null_pct == 100.0
    assert got["b"].nulls == 1 and got["b"].total_rows == 3
    empty = pr.null_profile(df.limit(0)).collect()
    assert all(r.nulls == 0 and r.null_pct is None for r in empty)
    anyp = pr.null_profile_any(df, ["a", "b"]).first()
    assert anyp.any_null_rows == 3 and anyp.subset_null_rows == 3
    assert pr.null_profile_any(df, ["b"]).first().subset_null_rows is None  # subset < 2 columns


def test_clean_casts_before_filtering(spark):
    raw = spark.createDataFrame([("S1", "2019-03-01", "n/a", 1.0), ("S1", "bad", "10.5", 1.0),
                                 ("S1", "2019-01-02", "10.5", 2.0), ("S1", "2019-01-03", "11", None)],
                                "Instrument string, Date string, Price_Close string, Volume double")
    out = clean_technicals(raw).collect()
    assert len(out) == 1
    r = out[0]
    assert r.Date == dt.date(2019, 1, 2) and r.Price_Close == 10.5 and r.Year == 2019 and r.Quarter == 4
    typed = coerce(raw, {"Date": "date", "Price_Close": "double"})
    assert typed.schema["Price_Close"].dataType.simpleString() == "double"


def test_dedup_ties_are_deterministic(spark):
    df = spark.createDataFrame([("S1", 1, 5.0, "b"), ("S1", 1, 5.0, "a"), ("S1", 1, 7.0, "c"), ("S2", 1, 1.0, "z")],
                               "k string, d int, v double, tag string")
    for n in (1, 3):
        got = {r.k: r.tag for r in dedup(df.repartition(n), ["k", "d"], ["v"]).collect()}
        assert got == {"S1": "a", "S2": "z"}
    last = {r.k: r.tag for r in dedup(df, ["k", "d"], ["v"], keep="last").collect()}
    assert last["S1"] == "c"


def test_fill_zero_numeric_only(spark):
    df = spark.createDataFrame([(None, None, None), (float("nan"), "x", True)], "a double, s string, b boolean")
    got = fill_zero(df).collect()
    assert got[0].a == 0.0 and got[0].s is None and got[0].b is None and got[1].a == 0.0


def test_yoy_lag_counts_rows_unless_calendar(spark):
    rows = [("S1", y, q, float(10 * y + q)) for y in (2018, 2019) for q in (1, 2, 3, 4)]
    rows = [r for r in rows if not (r[1] == 2018 and r[2] == 2)]  # missing quarter
    df = spark.createDataFrame(rows, "Instrument string, Year int, Quarter int, avg_price_close double")
    by = {(r.Year, r.Quarter): r for r in yoy_return(df).collect()}
    assert by[(2019, 1)].prev_year_price is None  # only 3 earlier rows
    assert by[(2019, 2)].prev_year_price == 20181.0  # 4 rows back lands a quarter early
    cal = {(r.Year, r.Quarter): r for r in yoy_return(df, calendar=True).collect()}
    assert cal[(2019, 1)].prev_year_price == 20181.0 and cal[(2019, 2)].prev_year_price is None
    zero = spark.createDataFrame([("S1", 2018, 1, 0.0), ("S1", 2019, 1, 5.0)], df.schema)
    assert yoy_return(zero, lag=1).where("Year = 2019").first().yearly_return is None


def _fund(spark, rows):
    cols = ("Instrument string, Date date, Total_Revenue double, Total_Current_Assets double, "
            "Total_Current_Liabilities double, Total_Long_Term_Debt double, "
            "Normalized_Income_Avail_to_Cmn_Shareholders double, Gross_Dividends___Common_Stock double, "
            "Total_Common_Shares_Outstanding double, Book_Value_Per_Share double")
    return spark.createDataFrame(rows, cols)


def test_screen_absence_and_edges(spark):
    p = ScreenParams(current_year=2019, base_year=2009, since_year=2015)
    d = dt.date
    fund = _fund(spark, [
        # strong: passes size, liquidity, capital, earnings, dividends, growth
        ("A", d(2009, 6, 1), 1e6, 10.0, 1.0, 1.0, 10.0, 1.0, 10.0, 100.0),
        ("A", d(2019, 6, 1), 6e6, 10.0, 1.0, 1.0, 20.0, 1.0, 10.0, 100.0),
        # weak: nothing passes -> absent
        ("W", d(2019, 6, 1), 1.0, 1.0, 5.0, 9.0, -1.0, 0.0, 10.0, 0.0),
        # one endpoint only and a zero-dividend year
        ("E", d(2019, 6, 1), 1.0, 1.0, 5.0, 9.0, 5.0, 0.0, None, 1.0),
        ("Z", d(2009, 6, 1), 1.0, 1.0, 5.0, 9.0, 0.0, 1.0, 10.0, 1.0),
        ("Z", d(2019, 6, 1), 1.0, 1.0, 5.0, 9.0, 5.0, 1.0, 10.0, 1.0),
        # a loss after the current year still breaks the earnings record
        ("L", d(2019, 6, 1), 1.0, 1.0, 5.0, 9.0, 5.0, 1.0, 10.0, 1.0),
        ("L", d(2020, 6, 1), 1.0, 1.0, 5.0, 9.0, -5.0, 1.0, 10.0, 1.0),
        # a year with null shares has no dividend per share: it neither
        # counts as paying nor blocks the record
        ("N", d(2016, 6, 1), 1.0, 1.0, 5.0, 9.0, 5.0, 1.0, None, 1.0),
        ("N", d(2019, 6, 1), 1.0, 1.0, 5.0, 9.0, 5.0, 1.0, 10.0, 1.0),
        # years before the earliest tested one are ignored
        ("O", d(2001, 6, 1), 1.0, 1.0, 5.0, 9.0, -5.0, 0.0, 10.0, 1.0),
        ("O", d(2019, 6, 1), 1.0, 1.0, 5.0, 9.0, 5.0, 1.0, 10.0, 1.0),
    ])
    tech = spark.createDataFrame([("A", d(2019, 12, 30), 1.0), ("A", d(2019, 12, 31), 2.0)],
                                 "Instrument string, Date date, Price_Close double")
    got = {r.Instrument: r for r in sc.value_screen(fund, tech, p).collect()}
    assert "W" not in got
    a = got["A"]
    assert (a.metric1, a.metric2, a.metric3, a.metric4, a.metric5, a.metric6) == (1, 1, 1, 1, 1, 1)
    assert a.metric7 == 1 and a.metric8 == 1  # latest price 2.0 <= 15 * eps(2) and <= 1.5 * book
    assert got["E"].metric6 == 0 and got["E"].metric4 == 1 and got["E"].metric5 == 0
    assert got["Z"].metric6 == 0  # first endpoint 0 -> growth undefined
    assert got["L"].metric4 == 0 and got["L"].metric5 == 1
    assert got["N"].metric5 == 1
    assert got["O"].metric4 == 1 and got["O"].metric5 == 1
    assert ru.latest_price(tech, 2019).first().Price == 2.0


def test_growth_baseline_one_year_entity_absent(spark):
    d = dt.date
    rows = [("A", d(2018, 1, 1), 10.0), ("A", d(2018, 6, 1), 20.0), ("A", d(2019, 1, 1), 30.0),
            ("A", d(2020, 1, 1), 40.0), ("B", d(2019, 5, 5), 7.0)]
    df = spark.createDataFrame(rows, "Instrument string, Date date, Price_Close double")
    out = bl.growth_baseline(df).collect()
    assert {r.Instrument for r in out} == {"A"}
    # growth 2019: (30-15)/30 = .5; 2020: (40-30)/40 = .25; mean .375
    by = {r.year: r.next_year_price for r in out}
    assert by[2019] == pytest.approx(15.0 * 1.375) and by[2020] == pytest.approx(30.0 * 1.375)
    err = bl.growth_baseline_error(bl.growth_baseline(df)).first()
    assert err.n_days == 2


def test_sequence_ops_on_ramp(spark):
    n, n_in, n_out = 100, 7, 3
    start = dt.date(2019, 1, 1)
    rows = [("R", start + dt.timedelta(days=i), float(i + 1)) for i in range(n)]
    rows += [("S", start + dt.timedelta(days=i), 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "Instrument string, Date date, Price_Close double").repartition(5)
    s = sq.sequence_index(df, running={"cum": "Price_Close"})
    got = {(r.Instrument, r.seq): r for r in s.collect()}
    assert all(got[("R", i)].Price_Close == i + 1 for i in range(n))
    assert float(got[("R", n - 1)].cum) == n * (n + 1) / 2 and got[("R", 0)].n_rows == n
    w = sq.sliding_window_stats(s, n_in, n_out, running="cum")
    assert w.where("Instrument = 'R'").count() == n - n_in - n_out + 1
    assert w.where("Instrument = 'S'").count() == 0
    for small in (10, 3):  # halo blocks (3 is raised to n_in + n_out - 1)
        w2 = sq.sliding_window_stats(s, n_in, n_out, running="cum", block=small)
        assert sorted(map(tuple, w2.collect())) == sorted(map(tuple, w.collect()))
    first = w.where("Instrument = 'R' and sample_start = 0").first()
    assert first.input_mean == 4.0 and first.label_mean == 9.0
    blocks = sq.chrono_block_split(s, SplitParams(window=10)).where("Instrument = 'R'")
    sizes = {r.split: r["count"] for r in blocks.groupBy("split").count().collect()}
    assert sizes == {"train": 60, "test": 20, "val": 20}  # 10 blocks: 6 / ceil(2) / 2
    tail = sq.tail_mean(s, 10).where("Instrument = 'R'").first()
    assert tail.tail_mean == 95.5 and tail.tail_rows == 10


def test_repartitioning_does_not_change_exact_results(spark):
    rows = [("S%d" % (i % 3), dt.date(2018 + i % 2, 1 + i % 12, 1 + i % 28), float(i % 17) + 0.25)
            for i in range(300)]
    df = spark.createDataFrame(rows, "Instrument string, Date date, Price_Close double").dropDuplicates(
        ["Instrument", "Date"])
    df = df.withColumn("Year", F.year("Date")).withColumn("Quarter", F.quarter("Date"))
    a = sorted(map(tuple, yoy_return(ru.quarterly_avg_price(df.repartition(1))).collect()))
    b = sorted(map(tuple, yoy_return(ru.quarterly_avg_price(df.repartition(7))).collect()))
    assert a == b


def test_sequence_index_with_one_dominant_entity(spark):
    """A third of the rows in one entity: numbering equals a plain row_number."""
    from pyspark.sql import Window

    start = dt.date(2000, 1, 1)
    rows = [("HOT", start + dt.timedelta(days=i), float(i % 97)) for i in range(3000)]
    rows += [("E%d" % (i % 40), start + dt.timedelta(days=i // 40), float(i % 13)) for i in range(6000)]
    df = spark.createDataFrame(rows, "Instrument string, Date date, Price_Close double").repartition(6)
    got = sq.sequence_index(df, running={"cum": "Price_Close"})
    w = Window.partitionBy("Instrument").orderBy("Date")
    ref = df.select("Instrument", "Date", (F.row_number().over(w) - 1).alias("seq"),
                    F.sum(F.col("Price_Close").cast("decimal(38,2)")).over(
                        w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
    a = sorted((r.Instrument, r.Date, r.seq, r.cum) for r in got.select("Instrument", "Date", "seq", "cum").collect())
    b = sorted((r.Instrument, r.Date, r.seq, r.cum) for r in ref.collect())
    assert a == b
