import datetime as dt
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.operators import sequence as sq
from tickframe.operators import windows as wi
from tickframe.operators.forecast import block_bounds, forecast_entities, walk_forward_timeline
from tickframe.operators.lagstats import LagLayout, solve_in_place
from tickframe.specs import ForecastParams, SplitParams


def series(spark, lengths, seed=0, gap=()):
    g, start, rows = np.random.default_rng(seed), dt.date(2001, 1, 1), []
    for e, n in lengths.items():
        walk = 300 + np.cumsum(g.normal(size=n))
        rows += [(e, start + dt.timedelta(days=i), float(walk[i]), float(g.integers(1, 90)), float(g.normal())) for i in range(n)]
    rows += list(gap)
    return spark.createDataFrame(rows, "Instrument string, Date date, Price_Close double, Volume double, M double").repartition(4)


@pytest.mark.parametrize("n_window,n_anchor,n_in,n_out", [(1, 0, 4, 2), (1, 3, 5, 3), (3, 2, 6, 4), (2, 0, 1, 1)])
def test_lag_sums_give_the_normal_equations(n_window, n_anchor, n_in, n_out):
    g = np.random.default_rng(n_in)
    layout, rows = LagLayout(n_in, n_out, n_window, n_anchor), g.normal(size=(70, n_window + n_anchor))
    m = 70 - layout.span - 2  # samples; cut in three ranges
    sums = layout.sums(rows, 0, 9) + layout.sums(rows, 9, 10) + layout.sums(rows, 10, m)
    gram, cross = layout.equations(sums, rows[:layout.span - 1, :n_window], rows[m:m + layout.span - 1, :n_window])
    x = np.array([layout.features(rows, s + n_in - 1) for s in range(m)])
    y = np.array([rows[s + n_in:s + n_in + n_out, 0] for s in range(m)])
    assert np.allclose(gram, x.T @ x) and np.allclose(cross, x.T @ y) and len(sums) == layout.size


@pytest.mark.parametrize("n_window,n_anchor", [(1, 0), (1, 3), (3, 2)])
def test_fits_by_rows_and_by_lag_sums_are_the_same(n_window, n_anchor):
    """Few samples are solved by XX', many by X'X: the same coefficients."""
    layout, rows = LagLayout(7, 3, n_window, n_anchor), np.random.default_rng(n_anchor).normal(size=(60, n_window + n_anchor))
    counts = [0, 1, 8, 8, layout.samples(60)]
    for m, got in zip(counts, layout.fit_rows(rows, counts, 1e-3), strict=True):
        if m:
            x = np.array([layout.features(rows, s + 6) for s in range(m)])
            y = np.array([rows[s + 7:s + 10, 0] for s in range(m)])
            want = np.linalg.solve(x.T @ x + 1e-3 * np.trace(x.T @ x) / layout.width * np.eye(layout.width), x.T @ y)
            by_sums = layout.fit(layout.sums(rows, 0, m), rows[:9, :n_window], rows[m:m + 9, :n_window], 1e-3)
            assert np.allclose(got, want) and np.allclose(by_sums, want)
    assert layout.samples(9) == 0 and layout.fit_rows(rows, [0, 0, 0], 1e-3) == [None] * 3


def test_solve_in_place_by_blocks():
    g = np.random.default_rng(5)
    x, y = g.normal(size=(40, 23)), g.normal(size=(23, 4))
    for block in (1, 5, 23, 64):
        assert np.allclose(solve_in_place(x.T @ x, y, block), np.linalg.solve(x.T @ x, y))
    # not positive to rounding: solved in general
    layout, assumed = LagLayout(1, 1, 1, 0), np.array([[1.0, 2.0], [2.0, 1.0]])
    assert np.allclose(layout._ridge(lambda: (assumed.copy(), np.eye(2)), 0.0), np.linalg.inv(assumed))


def brute(pdf, p, exog):
    """All models and predictions of one entity by plain matrices."""
    pdf = pdf.sort_values("Date").reset_index(drop=True)
    z = pdf[["Price_Close", "Volume", *exog]].to_numpy(float)
    lo, hi = z.min(axis=0), z.max(axis=0)
    z = (z - lo) / (hi - lo)
    nb = len(z) // p.block
    nt = int(nb * 0.65)
    ns = int(np.ceil((nb - nt) * 0.5))
    ends = [nt * p.block, (nt + ns) * p.block, nb * p.block]
    feat = lambda t: np.concatenate([z[t - p.n_in + 1:t + 1, :].T.ravel() if p.channels == "window" else np.concatenate([z[t - p.n_in + 1:t + 1, 0], z[t, 1:]]), [1.0]])
    coefs = []
    for end in ends:
        anchors = range(p.n_in - 1, end - p.n_out)
        if not len(anchors):
            coefs.append(None)
            continue
        x, y = np.array([feat(t) for t in anchors]), np.array([z[t + 1:t + 1 + p.n_out, 0] for t in anchors])
        gram = x.T @ x
        coefs.append(np.linalg.solve(gram + p.ridge * max(np.trace(gram) / len(gram), 1e-12) * np.eye(len(gram)), x.T @ y))
    days = {}
    for b in range(ends[0], ends[2], p.block):
        model = coefs[0 if b < ends[1] else 1]
        yhat = feat(b - 1) @ model * (hi[0] - lo[0]) + lo[0] if model is not None and b >= p.n_in else [None] * p.n_out
        for h in range(p.n_out):
            if b + h < len(z):
                days[b, h] = ("test" if b < ends[1] else "val", pdf["Date"][b + h], pdf["Price_Close"][b + h], yhat[h])
    future = feat(ends[2] - 1) @ coefs[2] * (hi[0] - lo[0]) + lo[0] if coefs[2] is not None else None
    return days, future


@pytest.mark.parametrize("channels", ["anchor", "window"])
@pytest.mark.parametrize("chunk", [16, 2048])
def test_forecaster_equals_plain_matrices(spark, channels, chunk):
    """Every prediction, with rows of an entity over many blocks, against one
    dense fit per scope; entities too short for a model, or for any block,
    keep their evaluated days without predictions."""
    df = series(spark, {"A": 301, "B": 95, "C": 44, "D": 12})
    p = ForecastParams(n_in=20, n_out=6, block=30, ridge=1e-3, tail_forecast=3, tail_price=4, channels=channels)
    res, details = forecast_entities(df, p, chunk=chunk, exog=["M"])
    got = {}
    for r in details.collect():
        got.setdefault(r.Instrument, {})[r.block_start, r.h] = (r.split, r.Date, r.actual, r.predicted)
    out = {r.Instrument: r for r in res.collect()}
    assert set(out) == {"A", "B", "C", "D"}
    for e, pdf in df.toPandas().groupby("Instrument"):
        days, future = brute(pdf, p, ["M"])
        assert set(got.get(e, {})) == set(days)
        for k, want in days.items():
            assert got[e][k][:3] == want[:3]
            assert (got[e][k][3] is None) == (want[3] is None) and (want[3] is None or abs(got[e][k][3] - want[3]) < 1e-6)
        assert out[e].n_eval_days == len(days) and out[e].n_predicted_days == sum(d[3] is not None for d in days.values())
        if future is not None:
            assert abs(out[e].future_predicted_price - future[-3:].mean()) < 1e-6
    assert out["D"].n_eval_days == 0 and out["D"].test_pct_err is None and out["A"].n_predicted_days > 0


def test_by_default_every_channel_counts_on_every_day(spark, monkeypatch):
    """The default looks at volume and statement measures on all days of a
    window, as the reference does, and so does the registered query: not on
    the anchor day alone."""
    from tickframe.operators import forecast as fc
    from tickframe.plans import registry

    # A has more samples than features, B fewer
    df, p = series(spark, {"A": 130, "B": 80}), ForecastParams(n_in=20, n_out=6, block=30, tail_forecast=3, tail_price=4)
    _, details = forecast_entities(df, p, exog=["M"])
    got = {(r.Instrument, r.block_start, r.h): r.predicted for r in details.collect()}
    want = {(e, *k): day[3] for e, pdf in df.toPandas().groupby("Instrument")
            for k, day in brute(pdf, replace(p, channels="window"), ["M"])[0].items()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    passed = []

    def noted(rows, p, *args, **kw):
        passed.append((p, kw["exog"]))
        return forecast_entities(rows, ForecastParams(n_in=2, n_out=1, block=3, tail_forecast=1, tail_price=1), exog=["M"])

    monkeypatch.setattr(fc, "forecast_entities", noted)
    registry._entity_forecast(type("Given", (), {"countries": series(spark, {"A": 13})}))
    (used, exog), = passed
    assert (used.n_in, used.n_out, used.block, used.channels, len(exog)) == (360, 90, 180, "window", 10)


def test_left_out_rows_are_counted(spark):
    bad = [("A", dt.date(2002, 1, 1), None, 1.0, 1.0), ("A", dt.date(2002, 1, 2), float("nan"), 1.0, 1.0),
           ("A", dt.date(2002, 1, 3), 1.0, float("inf"), 1.0), ("A", None, 1.0, 1.0, 1.0)]
    p = ForecastParams(n_in=10, n_out=3, block=12, tail_forecast=3)
    clean, _ = forecast_entities(series(spark, {"A": 90}), p)
    dirty, _ = forecast_entities(series(spark, {"A": 90}, gap=bad), p)
    a, b = clean.first(), dirty.first()
    assert (a.rows_left_out, b.rows_left_out) == (0, 4) and a.n_rows == b.n_rows and abs(a.val_pct_err - b.val_pct_err) < 1e-9


def test_timeline_with_steps_longer_than_a_block(spark):
    s = sq.sequence_index(series(spark, {"A": 47}))
    t = walk_forward_timeline(block_bounds(s, 10, SplitParams(window=10)), 15, 10).collect()
    # 4 blocks: 2 train, 1 test, 1 val; 15 steps from rows 20 and 30, as far as rows go
    assert {(r.block_start, r.h, r.row_number) for r in t} == {(b, h, b + h) for b in (20, 30) for h in range(15) if b + h < 47}
    assert {(r.block_start, r.split) for r in t} == {(20, "test"), (30, "val")}


def test_row_blocks_refuse_gaps(spark):
    s = sq.sequence_index(series(spark, {"A": 40}))
    assert wi.row_blocks(s, ["Price_Close"], 2, 3, block=8).count() == 5
    with pytest.raises(Exception, match="gap or a repeat"):
        wi.row_blocks(s.where("seq <> 11"), ["Price_Close"], 2, 3, block=8).collect()
    with pytest.raises(Exception, match="gap or a repeat"):
        wi.row_blocks(s.unionByName(s.where("seq = 11")), ["Price_Close"], 2, 3, block=8).collect()


def test_window_summary_does_not_depend_on_blocks(spark):
    s = sq.sequence_index(series(spark, {"A": 70, "B": 11, "C": 9}))
    got = {}
    for block in (3, 7, 2048):
        for r in wi.window_summary(s, ["Price_Close", "Volume"], 6, 4, block=block).collect():
            got.setdefault((r.Instrument, r.channel), []).append(r)
    assert set(e for e, _ in got) == {"A", "B"}
    a = s.where("Instrument = 'A'").orderBy("seq").toPandas()
    for (e, channel), rows in got.items():
        assert len(rows) == 3 and len({r.n_windows for r in rows}) == 1
        assert np.ptp([r.input_weighted_mean for r in rows]) < 1e-9 and np.ptp([r.input_mean for r in rows]) < 1e-9
        if e == "A":
            z = a[channel].to_numpy()
            starts = range(70 - 10 + 1)
            assert rows[0].n_windows == len(starts) and abs(rows[0].input_mean - np.mean([z[i:i + 6].mean() for i in starts])) < 1e-9
            assert abs(rows[0].input_weighted_mean - np.mean([z[i:i + 6] @ np.arange(1, 7) / 21 for i in starts])) < 1e-9
            assert (rows[0].label_mean is None) == (channel == "Volume")


def test_prices_below_a_cent_are_kept(spark):
    rows = [("P", dt.date(2003, 1, 1) + dt.timedelta(days=i), 0.004) for i in range(12)]
    s = sq.sequence_index(spark.createDataFrame(rows, "Instrument string, Date date, Price_Close double"), running={"cum": "Price_Close"})
    w = sq.sliding_window_stats(s, 5, 3, running="cum").collect()
    assert len(w) == 5 and all(abs(r.input_mean - 0.004) < 1e-12 and abs(r.label_mean - 0.004) < 1e-12 for r in w)


def test_small_errors_are_kept(spark):
    from tickframe.operators.regress import regression_metrics

    df = spark.createDataFrame([("A", 1.0, 1.0 + 1e-7), ("A", 2.0, 2.0 + 2e-7)], "Instrument string, a double, p double")
    m = regression_metrics(df, "a", "p").first()
    assert abs(m.mse - 2.5e-14) < 1e-19 and F is not None


def test_the_series_is_made_once(spark):
    """Counting, numbering and fitting read one staged copy: what made the
    series (scans, joins, sums) does not run again for each of them."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for one in batches:
            made.add(one.num_rows)
            yield one

    df = series(spark, {"A": 120, "B": 60})
    counted = df.mapInArrow(count, df.schema)
    p = ForecastParams(n_in=10, n_out=3, block=20, ridge=1e-3, tail_forecast=2, tail_price=2)
    res, details = forecast_entities(counted, p, exog=["M"])
    assert {r.Instrument: r.n_rows for r in res.collect()} == {"A": 120, "B": 60}
    assert details.count() > 0 and made.value == 180
