"""Product sums of columns in one pass.

``gram_rows`` adds up [1, x]'[1, x] per Arrow batch and sums the cells in
Spark: whatever the number of rows, a task emits one small triangle. Means,
covariances, correlations, principal components and the optimality of a
linear model all follow from it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gram_rows(df: DataFrame, cols) -> DataFrame:
    """(i, j, value) for i <= j: the sums of products of the columns, number
    0 being the constant 1, so that (0, 0) is the row count. A row with a
    null or NaN in any column makes its cells NaN, as in a plain sum."""
    cols = list(cols)

    def tasks(batches):
        total = np.zeros((len(cols) + 1, len(cols) + 1))
        for one in batches:
            x = np.column_stack([np.ones(one.num_rows), *(one.column(k).to_numpy(zero_copy_only=False).astype(np.float64) for k in range(len(cols)))])
            total += x.T @ x
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "value"])

    picked = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    return picked.mapInArrow(tasks, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))


@dataclass(frozen=True)
class Moments:
    """Row count, means and product sums of columns; columns squared in
    size, whatever the data."""

    n: int
    mean: np.ndarray
    products: np.ndarray  # sums of products, uncentred

    @property
    def covariance(self) -> np.ndarray:
        """Sample covariance."""
        return (self.products - self.n * np.outer(self.mean, self.mean)) / (self.n - 1)

    @property
    def std(self) -> np.ndarray:
        return np.sqrt(np.maximum(np.diag(self.covariance), 0.0))


def moments(df: DataFrame, cols) -> Moments:
    cols = list(cols)
    full = np.zeros((len(cols) + 1, len(cols) + 1))
    for r in gram_rows(df, cols).collect():
        full[r.i, r.j] = full[r.j, r.i] = r.value
    n = int(full[0, 0])
    return Moments(n, full[0, 1:] / n if n else full[0, 1:], full[1:, 1:])


def correlations(df: DataFrame, cols) -> DataFrame:
    """(feature, other, n, correlation) for every pair of columns; null
    where a column is constant. From the cells alone, without the driver."""
    cols = list(cols)
    cells = gram_rows(df, cols)
    names = F.array(*[F.lit(c) for c in cols])
    c = F.col
    sums = cells.where("i = 0 AND j > 0").select(c("j").alias("k"), c("value").alias("s"))
    squares = cells.where("i = j AND i > 0").select(c("i").alias("k"), c("value").alias("q"))
    one = F.broadcast(sums.join(squares, "k").crossJoin(cells.where("j = 0").select(c("value").alias("n"))))  # a row a column
    pairs = cells.where("i > 0 AND i < j").join(one.selectExpr("k AS i", "s AS si", "q AS qi", "n"), "i").join(
        one.selectExpr("k AS j", "s AS sj", "q AS qj"), "j")
    spread = F.sqrt((c("qi") - c("si") * c("si") / c("n")) * (c("qj") - c("sj") * c("sj") / c("n")))
    return pairs.select(names[c("i") - 1].alias("feature"), names[c("j") - 1].alias("other"), c("n").cast("long").alias("n"),
                        F.try_divide(c("value") - c("si") * c("sj") / c("n"), spread).alias("correlation"))
