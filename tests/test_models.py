import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from tickframe.operators import dense, regress, segments
from tickframe.operators.forecast import forecast_entities
from tickframe.operators.gram import correlations, moments
from tickframe.specs import ForecastParams, SplitParams


def test_lasso_recovers_planted_relation(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        a, b = float(rng.normal()), float(rng.normal())
        rows.append(("S%d" % (i % 4), dt.date(2015 + i % 5, 1 + i % 12, 1), 2017 + (i % 5) - 2, a, b,
                     3.0 * a - 2.0 * b + 10.0, "X"))
    df = spark.createDataFrame(rows, "Instrument string, Date date, Year int, f1 double, f2 double, "
                                     "Price_Close double, TRBC_Economic_Sector_Name string")
    train, test = regress.split_by_year(df, 2017)
    feats = ["f1", "f2"]
    model = regress.fit_lasso(regress.prepare(train, feats), feats, reg=0.0, elastic_net=0.0, max_iter=50)
    pred = model.transform(regress.prepare(test, feats))
    m = regress.regression_metrics(pred, "Price_Close", "prediction", by=()).first()
    assert m.r2 > 0.999 and m.rmse < 0.01


def test_lasso_predictions_and_optimality(spark):
    """Predictions from the published coefficients equal the fitted model's,
    residuals vanish at the optimum and grow away from it, constant features
    and features that the penalty removes included."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(600):
        a, b, c = (float(v) for v in rng.normal(size=3))
        rows.append(("S%d" % i, dt.date(2015 + i % 5, 1 + i % 12, 1 + i % 28), 2015 + i % 5, a, 5 * b, 0.01 * c, 7.0,
                     30.0 * a - 4.0 * b + 100.0 + float(rng.normal()), "X" if i % 3 else "Y"))
    df = spark.createDataFrame(rows, "Instrument string, Date date, Year int, f1 double, f2 double, f3 double, f4 double, "
                                     "Price_Close double, TRBC_Economic_Sector_Name string")
    summary, coefficients, pred = regress.lasso_scopes(df, 2018, "X")
    coef = {(r.Tech_Only_Pred, r.feature): r for r in coefficients.collect()}
    assert set(f for _, f in coef) == {"f1", "f2", "f3", "f4"} and len(coef) == 8
    assert all(r.residual < 1e-5 for r in coef.values()) and coef[False, "f4"].coefficient == 0 and coef[False, "f1"].coefficient > 25
    feats = regress.feature_columns(df)
    train, test = regress.split_by_year(df, 2018)
    model = regress.fit_lasso(regress.prepare(train, feats), feats)
    want = {(r.Instrument, r.Date): r.prediction for r in model.transform(regress.prepare(test, feats)).collect()}
    got = {(r.Instrument, r.Date): r.prediction for r in pred.where("not Tech_Only_Pred").collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 0.05 for k in got)
    spark_rows = regress.lasso_scopes(df, 2018, "X", solver="spark")[1].collect()
    assert all(abs(r.coefficient - coef[r.Tech_Only_Pred, r.feature].coefficient) < 0.05 and r.residual < 0.05 for r in spark_rows)
    # moved coefficients are not optimal
    m = moments(regress.prepare(train, feats), [*feats, "Price_Close"])
    scaler, lr = model.stages[1], model.stages[-1]
    shifted = regress.optimality(m, scaler.mean.toArray(), scaler.std.toArray(), lr.coefficients.toArray() + [1, 0, 0, 0], lr.intercept, 1.0)
    assert shifted[0][1] > 0.9


def test_gram_and_correlations(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 3))
    x[:, 2] = 4.0
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, `b b` double, c double").repartition(5)
    m = moments(df, ["a", "b b", "c"])
    assert m.n == 500 and np.allclose(m.products, x.T @ x) and np.allclose(m.covariance, np.cov(x.T), atol=1e-12)
    got = {(r.feature, r.other): r.correlation for r in correlations(df, ["a", "b b", "c"]).collect()}
    assert abs(got["a", "b b"] - np.corrcoef(x.T)[0, 1]) < 1e-12 and got["a", "c"] is None
    assert moments(df.limit(0), ["a"]).n == 0


def test_kmeans_sweep_silhouette(spark):
    """The summed form equals the mean over all pairs; a single cluster has none."""
    rows = [("E%d" % i, *[int(b) for b in format(i * 7 % 16, "08b")]) for i in range(60)]
    cols = ["metric%d" % k for k in range(1, 9)]
    df = spark.createDataFrame(rows, "Instrument string, " + ", ".join(f"{c} int" for c in cols))
    assign = segments.kmeans_sweep(df, cols, ks=(2, 4, 45))
    s = {r.k: r.silhouette for r in segments.sweep_scores(assign, cols).collect()}
    assert set(s) == {2, 4, 45}
    assert assign.count() == 180 and assign.where("prediction < 0 or prediction >= k").count() == 0
    for k in s:
        part = assign.where(F.col("k") == k).toPandas()
        x, c = part[cols].to_numpy(float), part["prediction"].to_numpy()
        d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
        want = []
        for i in range(len(x)):
            own = (c == c[i]) & (np.arange(len(x)) != i)
            a = d[i, own].mean() if own.any() else None
            b = min(d[i, c == o].mean() for o in set(c) if o != c[i])
            want.append(0.0 if a is None or max(a, b) == 0 else (b - a) / max(a, b))
        assert abs(s[k] - np.mean(want)) < 1e-9
    one = spark.createDataFrame([("A", 1), ("B", 1)], "Instrument string, m int")
    assert [r.silhouette for r in segments.sweep_scores(segments.kmeans_sweep(one, ["m"], ks=(2,)), ["m"]).collect()] == [None]


def test_nearest_centre_ties(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([2.0, 0.0],), ([1.0, 0.0],)], "x array<double>")
    got = [r.c for r in df.select(segments.nearest(F.col("x"), [[0.0, 0.0], [2.0, 0.0], [2.0, 0.0]]).alias("c")).collect()]
    assert got == [0, 1, 0]


def test_components_equal_a_plain_decomposition(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4))
    rows = [("E", 2000, i, *map(float, r), 3.0) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "Instrument string, Year int, Quarter int, a double, b double, c double, d double, e double")
    cols = ["a", "b", "c", "d", "e"]
    z = np.column_stack([(x - x.min(axis=0)) / (x.max(axis=0) - x.min(axis=0)), np.full(300, 0.5)])
    values, vectors = np.linalg.eigh(np.cov(z.T))
    fitted = segments.fit_components(df, cols, 3)
    for k in range(3):
        v = vectors[:, -1 - k]
        v = v * np.sign(v[np.argmax(np.abs(v))])
        assert np.allclose(fitted.loadings[k], v, atol=1e-9) and abs(fitted.variance[k] - values[-1 - k]) < 1e-12
    scores = {r.Quarter: (r.pc1, r.pc2, r.pc3) for r in segments.pca_features(df, 3, cols=cols).collect()}
    assert np.allclose([scores[i] for i in range(300)], z @ fitted.loadings.T)


def test_component_scores_by_batch_equal_the_expression(spark):
    """Bit for bit the column expression, with constant columns and nulls;
    bounds are Spark's own, also for nulls, NaN and columns without values."""
    rng = np.random.default_rng(11)
    rows = [("E", i, *map(float, r), 3.0, None) for i, r in enumerate(rng.normal(size=(200, 4)))]
    names = ["a", "b.c", "c", "d", "e", "f"]
    df = spark.createDataFrame(rows, "Instrument string, Year int, a double, `b.c` double, c double, d double, e double, f double").repartition(3)
    cols = names[:5]
    fitted = segments.fit_components(df, cols, 3)
    odd = df.union(spark.createDataFrame([("N", 900, None, 1.0, 2.0, 3.0, 3.0, None), ("N", 901, float("nan"), 1.0, 2.0, 3.0, 3.0, None)], df.schema))
    want = {r.Year: r.x for r in odd.select("Year", fitted.scores().alias("x")).collect()}
    got = {r.Year: r.x for r in fitted.scored(odd, ("Instrument", "Year")).collect()}
    assert set(got) == set(want) and got[900] == want[900] == [None] * 3 and np.isnan(got[901]).all()
    assert all(got[k] == want[k] for k in want if k != 901)
    plain = odd.agg(*[x for c in names for x in (F.min(f"`{c}`"), F.max(f"`{c}`"))]).first()
    assert repr([v for pair in segments.column_bounds(odd, names) for v in pair]) == repr(list(plain))


def test_dense_fits_planted_relation(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 3))
    y = x @ np.array([1.0, -2.0, 0.5]) + 0.3
    df = spark.createDataFrame([([float(v) for v in xi], float(yi)) for xi, yi in zip(x, y)], "x array<double>, y double")
    hist: list = []
    w = dense.fit_dense(df.repartition(4), 3, hidden=(16, 16), epochs=6, lr=0.01, batch=32, dropout=0.0,
                        val=df.limit(500), history=hist)
    pred = dense.forward(w, x, 3, hidden=(16, 16))
    assert np.mean((pred - y) ** 2) < 0.1 * np.var(y)
    assert [e for e, _ in hist] == [1, 2, 3, 4, 5, 6] and hist[-1][1] < 0.1 * np.var(y)


def test_dense_results_do_not_depend_on_partitions_or_batches(spark):
    """As on another number of cores: other input and shuffle partitions and
    other Arrow batches give the same weights, bit for bit."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 3))
    y = x @ np.array([1.0, -2.0, 0.5])
    df = spark.createDataFrame([([float(v) for v in xi], float(yi)) for xi, yi in zip(x, y)], "x array<double>, y double")
    got = []
    for parts, shuffle, batch in ((4, "4", "10000"), (8, "13", "37")):
        old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        got.append(dense.fit_dense(df.repartition(parts), 3, hidden=(8, 8), epochs=3, batch=32, shard_rows=200))
        for k, v in old.items():
            spark.conf.set(k, v)
    assert (got[0] == got[1]).all()


def test_dense_shards_share_tasks_and_held_rows_are_made_once(spark, monkeypatch):
    """Many small shards are trained by few tasks an epoch, with the weights
    that a task for each shard gives; validation rows are not made anew in
    each epoch."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 3))
    y = x @ np.array([1.0, -2.0, 0.5])
    df = spark.createDataFrame([([float(v) for v in xi], float(yi)) for xi, yi in zip(x, y)], "x array<double>, y double")
    tasks, made, plain = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0), dense._epoch

    def counted(*args):
        run = plain(*args)

        def each(batches):
            for state in run(batches):
                tasks.add(1)
                yield state

        return each

    def seen(batches):
        for one in batches:
            made.add(one.num_rows)
            yield one

    monkeypatch.setattr(dense, "_epoch", counted)
    cores, got, used = spark.sparkContext.defaultParallelism, [], []
    for per_core in (1, 1000):
        monkeypatch.setattr(dense, "TASKS_PER_CORE", per_core, raising=False)
        before, history = tasks.value, []
        got.append(dense.fit_dense(df.repartition(4), 3, hidden=(8, 8), epochs=2, batch=8, shard_rows=20,
                                   val=df.mapInArrow(seen, df.schema), history=history))
        used.append(tasks.value - before)
    assert used[0] <= 2 * cores < used[1] and (got[0] == got[1]).all()
    assert len(history) == 2 and made.value == 2 * 1500


def test_dense_state_survives_epochs_and_batches(spark):
    """One shard: the epochs are one plain run of Adam over the same order."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(100, 2))
    y = x[:, 0] - x[:, 1]
    df = spark.createDataFrame([([float(v) for v in xi], float(yi)) for xi, yi in zip(x, y)], "x array<double>, y double")
    got = dense.fit_dense(df.repartition(3), 2, hidden=(4,), epochs=2, batch=30, dropout=0.0)
    flat = dense.init_weights(2, (4,))
    one = dense.Adam(np.concatenate([flat, np.zeros(2 * len(flat) + 1)]), 2, (4,), 0.01, 0.0, None)
    key = F.xxhash64("x", "y")
    for epoch in range(2):
        rows = df.orderBy(F.xxhash64(key, F.lit(epoch)), key).collect()
        for k in range(0, 100, 30):
            part = rows[k:k + 30]
            one.step(np.array([r.x for r in part], np.float32), np.array([r.y for r in part], np.float32))
    assert one.t == 8 and np.allclose(got, one.state()[:len(flat)], atol=1e-6)
    assert len(dense.fit_dense(df.limit(0), 2, hidden=(4,), epochs=2)) == len(flat)


def test_forecaster_tracks_a_smooth_series(spark):
    start = dt.date(2010, 1, 1)
    rows = []
    for e, slope in (("A", 1.0), ("B", -0.5)):
        for i in range(300):
            rows.append((e, start + dt.timedelta(days=i), float(500.0 + slope * i + 10 * np.sin(i / 10)), 100.0 + i % 7))
    rows += [("T", start + dt.timedelta(days=i), 10.0 + i, 1.0) for i in range(20)]  # too short to model
    df = spark.createDataFrame(rows, "Instrument string, Date date, Price_Close double, Volume double")
    p = ForecastParams(n_in=20, n_out=5, block=30, ridge=1e-6, tail_forecast=5, tail_price=5)
    res, details = forecast_entities(df, p, SplitParams(window=30), chunk=64)
    got = {r.Instrument: r for r in res.collect()}
    assert set(got) == {"A", "B", "T"}
    assert got["A"].test_pct_err < 2.0 and got["B"].val_pct_err < 2.0
    assert got["T"].test_pct_err is None and got["T"].n_rows == 20
    # growth baseline on the same rows: one calendar year only -> no baseline
    assert "simple_model_pct_err" in res.columns and got["A"].simple_model_pct_err is None
    # 10 blocks: 6 train, 2 test, 2 val; n_out days evaluated per block
    counts = {r.split: r["count"] for r in details.where("Instrument = 'A'").groupBy("split").count().collect()}
    assert counts == {"test": 10, "val": 10}
    assert details.where(F.col("predicted").isNull()).count() == 0
    # training-only scaling bounds and the reference's percent-error form
    res3, _ = forecast_entities(df, p, SplitParams(window=30), chunk=64, fit_on="train", pct_denominator="prediction")
    alt = {r.Instrument: r for r in res3.collect()}
    assert alt["A"].test_pct_err < 5.0 and alt["T"].test_pct_err is None
    # an extra input column on the anchor day
    df_ex = df.withColumn("Extra", F.col("Volume") * 2.0)
    res4, _ = forecast_entities(df_ex, p, SplitParams(window=30), chunk=64, exog=["Extra"])
    ex = {r.Instrument: r for r in res4.collect()}
    assert ex["A"].test_pct_err < 2.0 and ex["A"].n_samples == got["A"].n_samples
    # rows handled in smaller blocks change nothing
    res2, _ = forecast_entities(df, p, SplitParams(window=30), chunk=32)
    again = {r.Instrument: r for r in res2.collect()}
    for e in ("A", "B"):
        assert abs(again[e].test_pct_err - got[e].test_pct_err) < 1e-6
        assert again[e].n_samples == got[e].n_samples


def test_native_prediction_matches_numpy(spark):
    from tickframe.operators.forecast import _predict_expr

    rng = np.random.default_rng(3)
    d, h = 6, 4
    feats = rng.normal(size=(20, d))
    coefs = rng.normal(size=(20, d * h))
    df = spark.createDataFrame([([float(v) for v in f], [float(v) for v in w]) for f, w in zip(feats, coefs)],
                               "feat array<double>, coef array<double>")
    got = [r.y for r in df.select(_predict_expr(d, h, F.col("feat"), F.col("coef")).alias("y")).collect()]
    want = [f @ w.reshape(d, h) for f, w in zip(feats, coefs)]
    assert all(np.allclose(g, w_, rtol=1e-12, atol=1e-12) for g, w_ in zip(got, want))
