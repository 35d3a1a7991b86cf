"""Segmentation (I3-I6): min-max scaling, PCA, k-means, silhouette.

Fitting is distributed: column bounds and product sums are one aggregate
each, k-means keeps partial sums per task and broadcasts its centres. Models
are published as small tables (bounds, components, centres) and applied as
native column expressions, so assignments need no second fit and can be
recomputed from the tables alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from .features import KEYS, ratio_names
from .gram import moments


def squared_distance(x: Column, y: Column) -> Column:
    """Between two arrays of doubles."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v)


def nearest(x: Column, centres) -> Column:
    """Number of the nearest centre; of equally near ones, the first."""
    distances = F.array(*[squared_distance(x, F.array(*[F.lit(float(v)) for v in centre])) for centre in centres])
    return F.array_position(distances, F.array_min(distances)).cast("int") - 1


@dataclass(frozen=True)
class Components:
    """Min-max bounds and principal components of columns."""

    cols: tuple
    lo: np.ndarray
    hi: np.ndarray
    loadings: np.ndarray   # (component, column)
    variance: np.ndarray   # of each component
    total_variance: float

    def scaled(self) -> list[Column]:
        """Each column mapped to 0..1 (a constant one to 0.5)."""
        return [F.lit(0.5) if b == a else (F.col(f"`{c}`") - float(a)) / float(b - a) for c, a, b in zip(self.cols, self.lo, self.hi, strict=True)]

    def scores(self) -> Column:
        """I4: the scaled columns on each component, as an array."""
        x = F.array(*self.scaled())
        return F.array(*[F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in row]), lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
                         for row in self.loadings])

    def scored(self, df: DataFrame, keys, name: str = "x") -> DataFrame:
        """``keys`` and ``scores()`` as ``name``, by Arrow batch: the same sums
        in the same order, over whole columns instead of row by row. A row
        with a null has null scores."""
        keys, cols, k = list(keys), [f"c{i}" for i in range(len(self.cols))], len(self.loadings)

        def tasks(batches):
            for one in batches:
                n = one.num_rows
                out, null = np.zeros((n, k)), np.zeros(n, bool)
                for c, a, b, weights in zip(cols, self.lo, self.hi, self.loadings.T, strict=True):
                    if b == a:
                        out += 0.5 * weights
                        continue
                    x = one.column(c)
                    if x.null_count:
                        null |= x.is_null().to_numpy(zero_copy_only=False)
                    scaled = (x.to_numpy(zero_copy_only=False) - a) / (b - a)
                    for j in range(k):
                        out[:, j] += scaled * weights[j]
                values = pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k, dtype=np.int32)), pa.array(out.ravel(), mask=np.repeat(null, k)))
                yield one.drop_columns(cols).append_column(name, values)

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)
        picked = df.select(*keys, *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(self.cols, cols, strict=True)])
        return picked.mapInArrow(tasks, f"{schema}, `{name}` array<double>")

    def rows(self, spark) -> DataFrame:
        """(component, feature, loading, variance, variance_ratio)."""
        out = [(k + 1, c, float(v), float(self.variance[k]), float(self.variance[k] / self.total_variance) if self.total_variance else None)
               for k, row in enumerate(self.loadings) for c, v in zip(self.cols, row, strict=True)]
        return spark.createDataFrame(out, "component int, feature string, loading double, variance double, variance_ratio double")


def column_bounds(df: DataFrame, cols) -> list[tuple]:
    """(smallest, largest) value of each column, (None, None) without values;
    as in Spark's ``max``, NaN is above all numbers. Per Arrow batch, then one
    small aggregate: two aggregates a column over all rows would be one
    generated function too long to be compiled."""
    names = [f"c{i}" for i in range(len(cols))]

    def tasks(batches):
        for one in batches:
            lo, hi = [], []
            for c in names:
                x = one.column(c).drop_null()
                numbers = x.filter(pc.invert(pc.is_nan(x)))
                found = pc.min_max(numbers if len(numbers) else x)
                lo.append(found["min"])
                hi.append(found["max"] if len(numbers) == len(x) else pa.scalar(float("nan")))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(names)), pa.int32()), *(pa.array([v.as_py() for v in side], pa.float64()) for side in (lo, hi))],
                                             ["i", "lo", "hi"])

    picked = df.select(*[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(cols, names, strict=True)])
    found = {r.i: (r.lo, r.hi) for r in picked.mapInArrow(tasks, "i int, lo double, hi double").groupBy("i").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()}
    return [found.get(i, (None, None)) for i in range(len(names))]


def fit_components(df: DataFrame, cols, n_components: int = 5) -> Components:
    """I3 + I4: bounds by one aggregate, the covariance of the scaled columns
    by another; its eigenvectors, largest variance first, each with its
    largest loading (the first of equal ones) positive."""
    cols = tuple(cols)
    lo, hi = zip(*column_bounds(df, cols), strict=True)
    if lo[0] is None:
        raise ValueError("no rows to fit components on")
    one = Components(cols, np.array(lo, float), np.array(hi, float), np.zeros((0, len(cols))), np.zeros(0), 0.0)
    m = moments(df.select(*[x.alias(c) for x, c in zip(one.scaled(), cols, strict=True)]), cols)
    values, vectors = np.linalg.eigh(m.covariance if m.n > 1 else np.zeros((len(cols), len(cols))))
    order = np.argsort(values)[::-1][:n_components]
    loadings = vectors[:, order].T
    strongest = loadings[np.arange(len(loadings)), np.argmax(np.abs(loadings).round(12), axis=1)]
    return Components(cols, one.lo, one.hi, loadings * np.where(strongest < 0, -1.0, 1.0)[:, None], np.maximum(values[order], 0.0), float(values.sum()))


def pca_features(ratios: DataFrame, n_components: int = 5, keys=KEYS, cols=None) -> DataFrame:
    """I4: keys and the principal-component scores ``pc1..pcN``."""
    cols = list(cols or ratio_names())
    data = staged(ratios.select(*keys, *cols), "segments-input")
    fitted = fit_components(data, cols, n_components)
    return fitted.scored(data, keys, "s").select(*keys, *[F.col("s")[k].alias(f"pc{k + 1}") for k in range(n_components)])


def pca_components(ratios: DataFrame, n_components: int = 5, cols=None) -> DataFrame:
    """The components as rows, see ``Components.rows``."""
    cols = list(cols or ratio_names())
    return fit_components(staged(ratios.select(*cols), "segments-input"), cols, n_components).rows(ratios.sparkSession)


def fit_centres(df: DataFrame, x: str, k: int, seed: int = 1) -> list[list[float]]:
    """Centres of a k-means over an array column."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    model = KMeans(k=k, seed=seed, featuresCol="v").fit(df.select(array_to_vector(x).alias("v")))
    return [[float(v) for v in c] for c in model.clusterCenters()]


def fit_segments(ratios: DataFrame, k: int = 5, seed: int = 1, n_components: int = 5, cols=None, keys=KEYS):
    """``(centres, scored)``; ``scored`` has keys, the component scores
    ``x`` (array) and ``cluster``."""
    cols = list(cols or ratio_names())
    data = staged(ratios.select(*keys, *cols), "segments-input")
    scores = staged(fit_components(data, cols, n_components).scored(data, keys), "segments-scores")
    centres = fit_centres(scores, "x", k, seed)
    return centres, scores.withColumn("cluster", nearest(F.col("x"), centres))


def kmeans_segments(ratios: DataFrame, k: int = 5, seed: int = 1, n_components: int = 5, keys=KEYS) -> DataFrame:
    """``Instrument, Year, Quarter, cluster``."""
    return fit_segments(ratios, k, seed, n_components, keys=keys)[1].select(*keys, "cluster")


def centre_rows(spark, centres) -> DataFrame:
    """(cluster, dimension, value)."""
    return spark.createDataFrame([(c, d + 1, v) for c, row in enumerate(centres) for d, v in enumerate(row)],
                                 "cluster int, dimension int, value double")


def silhouette_rows(df: DataFrame, x: str, cluster: str, by=()) -> DataFrame:
    """``df`` with ``silhouette`` of each row, on squared distances. The
    mean squared distance of a row to a cluster follows from the cluster's
    count n, vector sum S and sum of squared norms Q:
    |x|^2 - 2 x.S/n + Q/n, so no pairs of rows are formed. A row alone in
    its cluster has 0; with a single cluster (of ``by``) all are null."""
    by, c = list(by), F.col
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)
    size = df.select(F.size(x).alias("d")).first()
    d = size.d if size else 0
    clusters = df.groupBy(*by, cluster).agg(F.count("*").alias("n"), F.sum(dot(c(x), c(x))).alias("q"),
                                            F.array(*[F.sum(c(x)[i]) for i in range(d)]).alias("s"))
    # one row for each ``by``: as many entries as it has clusters
    table = clusters.groupBy(*by).agg(F.collect_list(F.struct(c(cluster).alias("c"), "n", "q", "s")).alias("_clusters"))
    rows = df.join(F.broadcast(table), by) if by else df.crossJoin(F.broadcast(table))
    norm = dot(c(x), c(x))
    far = F.transform("_clusters", lambda k: F.struct(k["c"].alias("c"), k["n"].alias("n"), F.greatest(
        norm - 2.0 * dot(c(x), k["s"]) / k["n"] + k["q"] / k["n"], F.lit(0.0)).alias("m")))
    rows = rows.withColumn("_far", far)
    own = F.filter("_far", lambda k: k["c"] == c(cluster))[0]
    a = F.when(own["n"] > 1, own["m"] * own["n"] / (own["n"] - 1))
    b = F.array_min(F.transform(F.filter("_far", lambda k: k["c"] != c(cluster)), lambda k: k["m"]))
    value = F.when(F.size("_clusters") > 1, F.when(own["n"] == 1, 0.0).otherwise(F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0))))
    return rows.withColumn("silhouette", value).drop("_far", "_clusters")


def kmeans_sweep(table: DataFrame, cols, ks=(2, 8, 15, 25, 45), seed: int = 1, key: str = "Instrument") -> DataFrame:
    """K-means for each k: every row with its ``k`` and ``prediction``
    (one DataFrame; write it partitioned by ``k``)."""
    from concurrent.futures import ThreadPoolExecutor

    data = staged(table.select(key, *cols, F.array(*[F.col(c).cast("double") for c in cols]).alias("x")), "sweep-input")
    # independent fits over one table: submit their jobs concurrently
    with ThreadPoolExecutor(max_workers=min(len(ks), 8)) as pool:
        fitted = list(pool.map(lambda k: fit_centres(data, "x", k, seed), ks))
    runs = F.array(*[F.struct(F.lit(int(k)).alias("k"), nearest(F.col("x"), centres).alias("prediction")) for k, centres in zip(ks, fitted, strict=True)])
    return data.select(key, *cols, F.explode(runs).alias("r")).select(key, *cols, "r.k", "r.prediction")


def sweep_scores(assignments: DataFrame, cols) -> DataFrame:
    """(k, silhouette), the mean over all rows, from ``kmeans_sweep``
    output; null where a k yields a single cluster."""
    x = F.array(*[F.col(c).cast("double") for c in cols])
    rows = silhouette_rows(assignments.select("k", "prediction", x.alias("x")), "x", "prediction", by=("k",))
    return rows.groupBy("k").agg(F.avg("silhouette").alias("silhouette"))
