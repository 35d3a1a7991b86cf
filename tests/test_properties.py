
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickframe.functions import price_quarter, statement_quarter, statement_year
from tickframe.operators import profile as pr
from tickframe.operators import sequence as sq
from tickframe.operators.cleaning import dedup
from tickframe.specs import SplitParams

dates = st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31))


def _price_rule(d):
    m = d.month
    return 4 if m == 1 else (m - 1) // 3 + 1


def _statement_rule(d):
    m = d.month
    q = 1 if m in (12, 1, 2) else 2 if m <= 5 else 3 if m <= 8 else 4
    return q, d.year + (1 if m == 12 else 0)


@settings(max_examples=5, deadline=None)
@given(st.lists(dates, min_size=1, max_size=40))
def test_quarter_rules_match_definition(spark, ds):
    df = spark.createDataFrame([(d,) for d in ds], "Date date")
    got = df.select("Date", price_quarter("Date").alias("pq"), statement_quarter("Date").alias("sq"),
                    statement_year("Date").alias("sy")).collect()
    for r in got:
        assert r.pq == _price_rule(r.Date)
        assert (r.sq, r.sy) == _statement_rule(r.Date)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 3),
                          st.one_of(st.none(), st.floats(-5, 5, allow_nan=False))), min_size=0, max_size=50))
def test_profile_bounds_and_dedup_unique(spark, rows):
    df = spark.createDataFrame(rows, "k string, d int, v double")
    for r in pr.null_profile(df).collect():
        assert r.null_pct is None or 0.0 <= r.null_pct <= 100.0
        assert 0 <= r.nulls <= r.total_rows == len(rows)
    out = dedup(df, ["k", "d"], ["v"]).collect()
    keys = [(r.k, r.d) for r in out]
    assert len(keys) == len(set(keys)) == len({(k, d) for k, d, _ in rows})


@settings(max_examples=4, deadline=None)
@given(st.integers(1, 120), st.integers(1, 9), st.integers(1, 5), st.integers(5, 30))
def test_sequence_counts_and_split_cover(spark, n, n_in, n_out, window):
    start = dt.date(2001, 1, 1)
    df = spark.createDataFrame([("E", start + dt.timedelta(days=3 * i), float(i)) for i in range(n)],
                               "Instrument string, Date date, Price_Close double")
    s = sq.sequence_index(df, running={"cum": "Price_Close"})
    w = sq.sliding_window_stats(s, n_in, n_out, running="cum")
    assert w.count() == max(0, n - n_in - n_out + 1)
    b = sq.chrono_block_split(s, SplitParams(window=window)).orderBy("seq").collect()
    nb = n // window
    assert len(b) == nb * window  # whole blocks, tail dropped
    order = {"train": 0, "test": 1, "val": 2}
    labels = [order[r.split] for r in b]
    assert labels == sorted(labels)  # disjoint and in time order
    if nb:
        assert sum(1 for x in labels if x == 0) == int(nb * 0.65) * window


@settings(max_examples=4, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=30))
def test_minmax_round_trip(spark, xs):
    df = spark.createDataFrame([("E", float(x)) for x in xs], "Instrument string, Price_Close double")
    out = sq.minmax_restore(sq.minmax_scale(df, ["Price_Close"]), ["Price_Close"]).collect()
    for r in out:
        assert abs(r.Price_Close_restored - r.Price_Close) <= 1e-9 * max(1.0, abs(r.Price_Close)) or \
            r.Price_Close_max == r.Price_Close_min
        assert 0.0 <= r.Price_Close_scaled <= 1.0
    assert F is not None
