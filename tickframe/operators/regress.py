"""Price regression.

Splits and filters are plain predicates on one plan; model fitting is Spark
ML (distributed gradient steps, only coefficients reach the driver); per-
entity scoring is one ``transform`` and one grouped aggregate instead of a
driver loop over companies.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import STAT_SCALE, exact_sum, pct_error
from ..sources.staging import staged
from .gram import Moments, moments
from .sequence import sequence_index

# Columns the reference excludes from the regression features.
NON_FEATURES = ("Date", "Company_Common_Name", "Exchange_Name", "Country_of_Headquarters", "Year",
                "TRBC_Economic_Sector_Name", "Instrument")
TARGET = "Price_Close"
SECTOR_COL = "TRBC_Economic_Sector_Name"


def split_by_year(df: DataFrame, year: int, col: str = "Year"):
    """(rows before ``year``, rows from ``year`` on)."""
    return df.where(F.col(col) < year), df.where(F.col(col) >= year)


def sector_filter(df: DataFrame, sector: str, col: str = SECTOR_COL) -> DataFrame:
    """B11."""
    return df.where(F.col(col) == sector)


def entity_filter(df: DataFrame, entities, col: str = "Instrument") -> DataFrame:
    """One ``isin`` predicate; absent entities simply match nothing."""
    return df.where(F.col(col).isin(list(entities)))


def scope_frames(joined: DataFrame, split_year: int, sector: str, train_scope_sector: bool = True,
                 test_scope_sector: bool = True) -> dict:
    """The reference's two runs: ``False`` = all entities, ``True`` = one
    sector (by default filtering train and test, as its linear model did)."""
    train, test = split_by_year(joined, split_year)
    s_train = sector_filter(train, sector) if train_scope_sector else train
    s_test = sector_filter(test, sector) if test_scope_sector else test
    return {False: (train, test), True: (s_train, s_test)}


def feature_columns(df: DataFrame, drop=NON_FEATURES, target: str = TARGET) -> list:
    return [c for c in df.columns if c not in drop and c != target]


def prepare(df: DataFrame, features, target: str = TARGET, keep=("Instrument", "Date")) -> DataFrame:
    """I7 (B2, B9): features and label as float, nulls -> 0, ids kept."""
    cols = [F.col(c).cast("float").alias(c) for c in list(features) + [target]]
    out = df.select(*[c for c in keep if c in df.columns], *cols)
    return out.na.fill(0, subset=list(features) + [target])


def regression_metrics(pred: DataFrame, actual: str, predicted: str, by=("Instrument",)) -> DataFrame:
    """Per group n, SSE, MSE, RMSE, sum of absolute errors and the
    centred R^2, all from one pass of order-independent decimal sums
    (SST = sum(a^2) - sum(a)^2 / n, evaluated exactly before the final
    conversion to double)."""
    c = F.col
    a, p = c(actual), c(predicted)
    e = a - p
    g = pred.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), exact_sum(e * e, STAT_SCALE).alias("sse"),
                              exact_sum(F.abs(e), STAT_SCALE).alias("sum_abs_error"),
                              exact_sum(a, STAT_SCALE).alias("_sa"), exact_sum(a * a, STAT_SCALE).alias("_saa"))
    n = c("n").cast("double")
    mse = F.try_divide(c("sse"), n)
    sst = c("_saa") - F.try_divide(c("_sa") * c("_sa"), n)
    return g.select(*by, "n", "sse", mse.alias("mse"), F.sqrt(mse).alias("rmse"), "sum_abs_error",
                    (F.lit(1.0) - F.try_divide(c("sse"), sst)).alias("r2"))


def fit_lasso(train: DataFrame, features, target: str = TARGET, max_iter: int = 300, reg: float = 1.0,
              elastic_net: float = 1.0):
    """I8: assemble, standardise (fitted on train only), L1 regression.
    Returns the fitted ``PipelineModel``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.regression import LinearRegression

    stages = [VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"),
              StandardScaler(inputCol="features", outputCol="scaledFeatures", withMean=True, withStd=True),
              LinearRegression(featuresCol="scaledFeatures", labelCol=target, maxIter=max_iter,
                               regParam=reg, elasticNetParam=elastic_net)]
    return Pipeline(stages=stages).fit(train)


def lasso_from_moments(m: Moments, reg: float = 1.0, elastic_net: float = 1.0, sweeps: int = 50_000, tolerance: float = 1e-8):
    """I8 from product sums of (features, target): the same penalised
    problem as ``fit_lasso`` in one pass over the rows, whatever the number
    of iterations, which go over the columns' product matrix. Coordinate
    descent runs until no coefficient's gradient is off by more than
    ``tolerance`` of the target's scale. Returns (coefficients on the
    standardised features, feature means, standard deviations, intercept,
    training R^2, RMSE); a constant feature has coefficient 0."""
    cov, std = m.covariance * ((m.n - 1) / m.n), m.std
    scale = np.where(std > 0, std, 1.0)[:-1]
    live = std[:-1] > 1e-12 * np.maximum(np.abs(m.mean[:-1]), 1e-300)
    q = np.where(live, cov[:-1, -1] / scale, 0.0)
    gram = np.where(np.outer(live, live), cov[:-1, :-1] / np.outer(scale, scale), 0.0)
    l1, l2 = reg * elastic_net, reg * (1.0 - elastic_net)
    coef, off = np.zeros(len(q)), tolerance * max(std[-1], 1e-300)
    gradient = q.copy()  # q - gram @ coef
    for _ in range(sweeps):
        worst = 0.0
        for j in np.flatnonzero(live):
            pull = gradient[j] + gram[j, j] * coef[j]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (gram[j, j] + l2)
            move = new - coef[j]
            if move:
                gradient -= gram[:, j] * move
                coef[j] = new
                worst = max(worst, abs(move) * (gram[j, j] + l2))
        if worst <= off:
            break
    mean = m.mean[:-1]
    coef = coef + 0.0  # no negative zeros
    explained = 2 * coef @ q - coef @ gram @ coef
    mse = max(cov[-1, -1] - explained, 0.0)
    return coef, mean, np.where(live, scale, 0.0), float(m.mean[-1]), float(1.0 - mse / cov[-1, -1]) if cov[-1, -1] > 0 else float("nan"), float(np.sqrt(mse))


def optimality(m: Moments, mean, std, coefficients, intercept: float, reg: float) -> list[tuple[float, float]]:
    """Gradient and residual of each coefficient of a lasso over standardised
    features, from product sums of (features, target) alone. At the optimum
    the gradient, mean(z * error), is ``reg`` with the coefficient's sign, or
    at most ``reg`` in size where the coefficient is 0; the residual is how
    far it is from that. Constant features have gradient and residual 0."""
    mean, std, coef = (np.asarray(v, float) for v in (mean, std, coefficients))
    d, safe = len(coef), np.where(std > 0, std, 1.0)
    raw = coef / safe * (std > 0)
    offset = intercept - raw @ mean
    # sum over rows of feature * error, and of error
    cross = m.products[:d, d] - m.products[:d, :d] @ raw - m.n * m.mean[:d] * offset
    error = m.n * (m.mean[d] - raw @ m.mean[:d] - offset)
    gradient = np.where(std > 0, (cross - mean * error) / safe / m.n, 0.0)
    residual = np.where(coef != 0, np.abs(gradient - reg * np.sign(coef)), np.maximum(np.abs(gradient) - reg, 0.0))
    return list(zip(gradient.tolist(), residual.tolist(), strict=True))


def lasso_scopes(joined: DataFrame, split_year: int, sector: str, target: str = TARGET, entities=None,
                 max_iter: int = 300, reg: float = 1.0, solver: str = "moments"):
    """Fit and score both scopes, from product sums
    (``lasso_from_moments``) or by Spark ML (``solver="spark"``, as the
    reference: at most ``max_iter`` passes, which need not reach the optimum
    where features are collinear; ``residual`` shows it). Returns ``(summary, coefficients,
    predictions)``: ``summary`` has one row per scope (coefficients,
    intercept, training R^2 and RMSE); ``coefficients`` one per scope and
    feature (coefficient on the standardised feature, its training mean and
    standard deviation, gradient and optimality residual, see
    ``optimality``); ``predictions`` per-row results for every test entity,
    computed from those coefficients."""
    from concurrent.futures import ThreadPoolExecutor

    spark = joined.sparkSession
    features = feature_columns(joined, target=target)
    # both scopes read train and test rows: keep one column-pruned copy
    keep = [c for c in ("Instrument", "Date", "Year", SECTOR_COL) if c in joined.columns]
    joined = staged(joined.select(*keep, *features, target), "lasso-input")

    def run(item):
        flag, (train, test) = item
        if entities is not None:
            test = entity_filter(test, entities)
        tr = prepare(train, features, target)
        m = moments(tr, [*features, target])
        if m.n < 2:
            raise ValueError("fewer than two training rows")
        if solver == "moments":
            coef, mean, std, intercept, r2, rmse = lasso_from_moments(m, reg)
        else:
            tr = tr.persist()
            model = fit_lasso(tr, features, target, max_iter=max_iter, reg=reg)
            lr, scaler, fit = model.stages[-1], model.stages[1], model.stages[-1].summary
            coef, mean, std = lr.coefficients.toArray(), scaler.mean.toArray(), scaler.std.toArray()
            intercept, r2, rmse = float(lr.intercept), float(fit.r2), float(fit.rootMeanSquaredError)
            tr.unpersist()
        residuals = optimality(m, mean, std, coef, intercept, reg)
        summary = (bool(flag), intercept, [float(c) for c in coef], len(features), r2, rmse)
        rows = [(bool(flag), f, float(b), float(mu), float(v), g, r) for f, b, mu, v, (g, r) in zip(features, coef, mean, std, residuals, strict=True)]
        return summary, rows, scored(prepare(test, features, target), rows, intercept, target).withColumn("Tech_Only_Pred", F.lit(bool(flag)))

    # the two scopes are independent fits: submit their jobs concurrently
    items = list(scope_frames(joined, split_year, sector).items())
    with ThreadPoolExecutor(max_workers=len(items)) as pool:
        done = list(pool.map(run, items))
    summary = spark.createDataFrame(
        [d[0] for d in done], "Tech_Only_Pred boolean, intercept double, coefficients array<double>, n_features int, "
                              "train_r2 double, train_rmse double")
    coefficients = spark.createDataFrame(
        [r for d in done for r in d[1]], "Tech_Only_Pred boolean, feature string, coefficient double, feature_mean double, "
                                         "feature_std double, gradient double, residual double")
    allp = done[0][2].unionByName(done[1][2])
    allp = allp.withColumn("Error_Pct", pct_error(F.col(target), F.col("prediction")).cast("float"))
    return summary, coefficients, allp


def scored(rows: DataFrame, coefficients, intercept: float, target: str = TARGET) -> DataFrame:
    """Ids, label and prediction from coefficient rows (scope, feature,
    coefficient, mean, std, ...): one native expression of the features whose
    coefficient isn't 0."""
    prediction = F.lit(float(intercept))
    for _, feature, coef, mean, std, *_ in coefficients:
        if coef != 0.0 and std > 0.0:
            prediction = prediction + (F.col(feature).cast("double") - mean) * (coef / std)
    return rows.select("Instrument", "Date", F.col(target).alias(target), prediction.cast("float").alias("prediction"))


def number_rows(pred: DataFrame) -> DataFrame:
    """``row_num`` within (scope, entity) in date order."""
    keyed = pred.withColumn("_ek", F.concat_ws("|", F.col("Tech_Only_Pred").cast("string"), F.col("Instrument")))
    out = sequence_index(keyed, entity="_ek", order=("Date", "prediction", TARGET))
    return out.withColumn("row_num", F.col("seq").cast("int")).drop("_ek", "seq", "n_rows")
