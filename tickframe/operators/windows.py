"""Multi-channel supervised windows (B6, E5) as blocks of rows with halos.

``row_blocks`` packs each (entity, block of row numbers) with the rows that
windows starting or ending in it also need into one row-major array of
doubles. A task reads such an array as a matrix without copying it, and its
windows are views of that matrix. Groups hold one block and its halos,
however long an entity's history is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 2048


def row_blocks(seq_df: DataFrame, cols, before: int, after: int, block: int = BLOCK, entity: str = "Instrument", keep=()) -> DataFrame:
    """(entity, block, first_seq, n_rows, *keep, values): the rows numbered
    ``block*B - before`` to ``(block+1)*B + after - 1`` of ``sequence_index``
    output, in order, as the row-major doubles of ``cols``. ``keep`` names
    columns that are constant in an entity. Row numbers with a gap or a
    repeat fail the job instead of giving wrong windows."""
    c = F.col
    lo = F.greatest(F.floor((c("seq") - after) / block), F.lit(0))
    hi = F.least(F.floor((c("seq") + before) / block), F.floor((c("n_rows") - 1) / block))
    cells = F.array(*[c(x).cast("double") for x in cols])
    rows = seq_df.select(entity, "n_rows", *keep, F.struct("seq", cells.alias("v")).alias("row"), F.explode(F.sequence(lo, hi)).alias("block"))
    packed = rows.groupBy(entity, "block").agg(F.array_sort(F.collect_list("row")).alias("rows"), F.max("n_rows").alias("n_rows"),
                                               *[F.max(k).alias(k) for k in keep])
    first, last = c("rows")[0]["seq"], F.element_at("rows", -1)["seq"]
    values = F.when(last - first + 1 == F.size("rows"), F.flatten(F.transform("rows", lambda r: r["v"])))
    broken = F.raise_error(F.concat(F.lit("row numbers have a gap or a repeat: "), c(entity).cast("string"))).cast("array<double>")
    return packed.select(entity, "block", first.alias("first_seq"), "n_rows", *keep, F.coalesce(values, broken).alias("values"))


def matrices(batch: pa.RecordBatch, n_cols: int):
    """The ``values`` of each row of an Arrow batch as a (rows, n_cols) view."""
    column = batch.column("values")
    flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
    for i in range(batch.num_rows):
        yield flat[ends[i]:ends[i + 1]].reshape(-1, n_cols)


def windows(matrix: np.ndarray, size: int) -> np.ndarray:
    """All windows of ``size`` rows as a view (window, channel, step)."""
    return np.lib.stride_tricks.sliding_window_view(matrix, size, axis=0)


def window_summary(seq_df: DataFrame, cols, n_in: int, n_out: int, label: str = "Price_Close", block: int = BLOCK,
                   entity: str = "Instrument") -> DataFrame:
    """Per entity and channel over all complete samples: their number, the
    mean of the inputs, their mean weighted by the step (1..n_in, which
    tells windows apart that hold the same rows in another order), and, for
    the label's channel, the mean of the labels."""
    cols, span = list(cols), n_in + n_out
    at = cols.index(label)

    def tasks(batches):
        step = np.arange(1, n_in + 1) / (n_in * (n_in + 1) / 2)
        for batch in batches:
            out = []
            for name, number, first, matrix in zip(batch.column(entity).to_pylist(), batch.column("block").to_pylist(),
                                                   batch.column("first_seq").to_pylist(), matrices(batch, len(cols)), strict=True):
                own = matrix[number * block - first:][:block + span - 1]  # samples that start in this block
                if len(own) < span:
                    continue
                view = windows(own, span)
                inputs = view[:, :, :n_in]
                mean, weighted = inputs.mean(axis=2).sum(axis=0), (inputs @ step).sum(axis=0)
                labels = view[:, at, n_in:].mean(axis=1).sum()
                out += [(name, col, len(view), float(mean[k]), float(weighted[k]), float(labels) if k == at else None) for k, col in enumerate(cols)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(
                (pa.string(), pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.float64()))], [entity, "channel", "n", "a", "b", "y"])

    blocks = row_blocks(seq_df, cols, 0, span - 1, block, entity)
    sums = blocks.mapInArrow(tasks, f"`{entity}` string, channel string, n long, a double, b double, y double").groupBy(entity, "channel").agg(
        F.sum("n").alias("n_windows"), *[F.sum(k).alias(k) for k in "aby"])
    return sums.select(entity, "channel", "n_windows", (F.col("a") / F.col("n_windows")).alias("input_mean"),
                       (F.col("b") / F.col("n_windows")).alias("input_weighted_mean"), (F.col("y") / F.col("n_windows")).alias("label_mean"))
