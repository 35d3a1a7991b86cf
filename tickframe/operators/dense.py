"""Data-parallel dense regressor (I11, I12), re-aimed.

The reference trained a Keras network with an asynchronous parameter
server. Here the training rows are dealt to shards by a hash of their
content, so many that a shard holds about ``SHARD_ROWS`` rows (``MAX_SHARDS``
at most). Each epoch is one Spark job: every shard reads its rows in an
order keyed by row and epoch, and runs mini-batch Adam steps on them as the
Arrow batches come in, from the broadcast state (weights, both moments, step
count). The shards' states are averaged by row count with a tree aggregate
on the executors, and the average is the next epoch's state.

A task holds one Arrow batch, the rows left over from the one before (fewer
than a mini-batch) and the state, whatever the size of its shard. Shards,
orders and random numbers depend on the rows alone and the averages are sums
of multiples of a fixed step, which floating-point adds exactly, so results
are the same on any number of cores or partitions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from .regress import SECTOR_COL, TARGET, feature_columns, prepare, scope_frames

SHARD_ROWS, MAX_SHARDS = 8192, 1024
#: Shards are dealt to so many tasks for each core, at most.
TASKS_PER_CORE = 4
#: States are averaged in multiples of this.
STEP = 2.0 ** -36


def _shapes(d: int, hidden: tuple):
    dims = [d, *hidden, 1]
    return [((dims[i], dims[i + 1]), (dims[i + 1],)) for i in range(len(dims) - 1)]


def init_weights(d: int, hidden=(256, 256), seed: int = 0) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = []
    for (wi, wo), _ in _shapes(d, hidden):
        parts.append(rng.normal(0.0, np.sqrt(2.0 / wi), size=wi * wo))
        parts.append(np.zeros(wo))
    return np.concatenate(parts)


def _unflatten(flat: np.ndarray, d: int, hidden: tuple):
    out, k = [], 0
    for (wi, wo), _ in _shapes(d, hidden):
        w = flat[k:k + wi * wo].reshape(wi, wo)
        k += wi * wo
        b = flat[k:k + wo]
        k += wo
        out.append((w, b))
    return out


def forward(flat: np.ndarray, x: np.ndarray, d: int, hidden=(256, 256)) -> np.ndarray:
    layers = _unflatten(flat, d, hidden)
    h = x
    for w, b in layers[:-1]:
        h = np.maximum(h @ w + b, 0.0)
    w, b = layers[-1]
    return (h @ w + b)[:, 0]


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """An Arrow list column of ``d`` numbers a row as a matrix, uncopied."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, d)


class Adam:
    """Weights with both moments and the step count, moved by mini-batches;
    in single precision, as the reference's network."""

    def __init__(self, state: np.ndarray, d: int, hidden: tuple, lr: float, dropout: float, rng):
        size = (len(state) - 1) // 3
        self.flat, self.m, self.v = (state[k * size:(k + 1) * size].astype(np.float32) for k in range(3))
        self.grad, self.work = np.empty(size, np.float32), np.empty(size, np.float32)
        self.params, self.grads = _unflatten(self.flat, d, hidden), _unflatten(self.grad, d, hidden)  # views
        self.wide, self.buffers = hidden, {}
        self.t, self.lr, self.dropout, self.rng = int(round(state[-1])), lr, dropout, rng

    def step(self, xb: np.ndarray, yb: np.ndarray, b1: float = 0.9, b2: float = 0.999, eps: float = 1e-7) -> None:
        acts, h, n = [xb], xb, len(yb)
        if n not in self.buffers:  # two sizes a shard: a whole batch and its last
            self.buffers[n] = [[np.empty((n, k), t) for t in (np.float32, np.float32, np.float32, bool, bool)] for k in self.wide]
        for (w, b), (out, mask, _, on, kept) in zip(self.params[:-1], self.buffers[n], strict=True):
            h = np.matmul(h, w, out=out)
            h += b
            np.greater(h, 0, out=on)
            if self.dropout > 0:
                self.rng.random(out=mask, dtype=np.float32)
                on &= np.greater_equal(mask, self.dropout, out=kept)
            h *= np.multiply(on, np.float32(1.0 / (1.0 - self.dropout)), out=mask)
            acts.append(h)
        w, b = self.params[-1]
        g = np.float32(2.0 / n) * ((h @ w + b)[:, 0] - yb)[:, None]
        for li in range(len(self.params) - 1, -1, -1):
            gw, gb = self.grads[li]
            np.matmul(acts[li].T, g, out=gw)
            np.sum(g, axis=0, out=gb)
            if li > 0:
                _, mask, back, _, _ = self.buffers[n][li - 1]
                g = np.matmul(g, self.params[li][0].T, out=back)
                g *= mask
        self.t += 1
        self.m *= b1
        self.m += np.multiply(self.grad, 1 - b1, out=self.work)
        np.multiply(self.grad, self.grad, out=self.grad)
        self.v *= b2
        self.v += np.multiply(self.grad, 1 - b2, out=self.work)
        np.sqrt(np.divide(self.v, 1 - b2 ** self.t, out=self.work), out=self.work)
        self.work += eps
        np.divide(self.m, self.work, out=self.work)
        self.flat -= np.multiply(self.work, self.lr / (1 - b1 ** self.t), out=self.work)

    def state(self) -> np.ndarray:
        return np.concatenate([self.flat, self.m, self.v, [self.t]], dtype=np.float64)


def _epoch(bw, epoch: int, rows: int, d: int, hidden: tuple, lr: float, batch: int, dropout: float, seed: int):
    """Task: rows sorted by shard and order, to the shards' share of the next
    state, summed over the task's shards."""

    def tasks(batches):
        total, now, model, left, n = None, None, None, None, 0

        def close(total):
            if len(left[1]):
                model.step(*left)
            share = np.round(model.state() * (n / rows) / STEP) * STEP
            return share if total is None else total + share

        for one in batches:
            shards, x = one.column("shard").to_numpy(), _matrix(one.column("x"), d)
            y = one.column("y").to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(shards)) + 1, [len(shards)]])
            for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                if first == last:
                    continue
                if shards[first] != now:
                    if now is not None:
                        total = close(total)
                    now, n, left = shards[first], 0, (x[:0], y[:0])
                    model = Adam(bw.value, d, hidden, lr, dropout, np.random.default_rng([seed, epoch, int(now)]))
                n += last - first
                xs, ys = np.concatenate([left[0], x[first:last]]), np.concatenate([left[1], y[first:last]])
                whole = len(ys) // batch * batch
                for k in range(0, whole, batch):
                    model.step(xs[k:k + batch], ys[k:k + batch])
                left = xs[whole:].copy(), ys[whole:].copy()
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([close(total).tobytes()], pa.binary())], ["state"])

    return tasks


def validation_mse(val: DataFrame, flat: np.ndarray, d: int, hidden=(256, 256)) -> float | None:
    """Mean squared error of ``flat`` on rows ``(x, y)``: sums per batch, one
    small aggregate (no rows reach the driver)."""
    bw = val.sparkSession.sparkContext.broadcast(flat)

    def sse(batches):
        for one in batches:
            if one.num_rows:
                e = forward(bw.value, _matrix(one.column("x"), d), d, hidden) - one.column("y").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array([float(e @ e)]), pa.array([len(e)], pa.int64())], ["sse", "n"])

    r = val.select("x", "y").mapInArrow(sse, "sse double, n long").agg(F.sum("sse"), F.sum("n")).first()
    bw.unpersist()
    return float(r[0]) / r[1] if r[1] else None


def fit_dense(train: DataFrame, d: int, hidden=(256, 256), epochs: int = 25, lr: float = 0.01, batch: int = 64,
              dropout: float = 0.05, seed: int = 0, val: DataFrame | None = None,
              history: list | None = None, shard_rows: int = SHARD_ROWS) -> np.ndarray:
    """Train on rows ``(x array<double>, y double)``; returns flat weights.
    With ``val``, the validation MSE after each epoch is appended to
    ``history`` as ``(epoch, mse)``."""
    sc = train.sparkSession.sparkContext
    rows = train.count()
    flat = init_weights(d, hidden, seed)
    if rows == 0:
        return flat
    shards = min(-(-rows // shard_rows), MAX_SHARDS)
    key = F.xxhash64("x", "y")
    # one shuffle; the dealt rows stay for all epochs, in the precision that
    # the steps use. A task takes several shards and hands on one sum of their
    # states, as what a task costs by itself (worker, weights, state) would
    # otherwise be paid by each shard in each epoch.
    data = train.select(F.col("x").cast("array<float>").alias("x"), F.col("y").cast("float").alias("y"), key.alias("key"),
                        F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(shards)).cast("int").alias("shard"))
    parts = min(shards, TASKS_PER_CORE * sc.defaultParallelism)
    data = data.repartitionById(parts, F.pmod(F.col("shard"), F.lit(parts))).persist(StorageLevel.MEMORY_AND_DISK)
    if val is not None:
        val = val.select("x", "y").persist(StorageLevel.MEMORY_AND_DISK)
    state = np.concatenate([flat, np.zeros(2 * len(flat) + 1)])
    for epoch in range(epochs):
        bw = sc.broadcast(state)
        ordered = data.sortWithinPartitions("shard", F.xxhash64("key", F.lit(epoch)), "key").select("shard", "x", "y")
        states = ordered.mapInArrow(_epoch(bw, epoch, rows, d, hidden, lr, batch, dropout, seed), "state binary")
        state = states.rdd.map(lambda r: np.frombuffer(r.state)).treeReduce(lambda a, b: a + b, depth=2)
        bw.unpersist()
        if val is not None and history is not None:
            history.append((epoch + 1, validation_mse(val, state[:len(flat)], d, hidden)))
    data.unpersist()
    if val is not None:
        val.unpersist()
    return state[:len(flat)]


def predict_dense(df: DataFrame, flat: np.ndarray, d: int, hidden=(256, 256), keep=("Instrument", "Date"),
                  y_mean: float = 0.0, y_std: float = 1.0, target: str = TARGET) -> DataFrame:
    """Prediction with broadcast weights, by Arrow batch."""
    bw = df.sparkSession.sparkContext.broadcast(flat)
    keep = [k for k in keep if k in df.columns]

    def pred(batches):
        for one in batches:
            p = forward(bw.value, _matrix(one.column("x"), d), d, hidden) * y_std + y_mean
            yield one.drop_columns(["x"]).append_column("prediction", pa.array(p))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep, target).schema.fields)
    return df.select(*keep, target, "x").mapInArrow(pred, schema + ", prediction double")


def dense_scope(joined: DataFrame, split_year: int, sector: str, epochs: int = 25, hidden=(256, 256),
                seed: int = 0, shard_rows: int = SHARD_ROWS, validation_frac: float = 0.2):
    """Train on the sector's rows before ``split_year`` (train-only
    filter, as the reference's dense script), score all later rows. A
    ``validation_frac`` share of the training days (hash of entity and date,
    so repeated rows of one day stay together) is held out and scored after
    every epoch. Returns ``(predictions, history)``, history being
    ``(epoch, val_mse)`` rows."""
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    feats = feature_columns(joined)
    keep = [c for c in ("Instrument", "Date", "Year", SECTOR_COL) if c in joined.columns]
    # train and test read it: the sector's rows before the split, all later ones
    needed = (F.col("Year") >= split_year) | (F.col(SECTOR_COL) == sector)
    joined = staged(joined.select(*keep, *feats, TARGET).where(needed), "dense-input")
    scopes = scope_frames(joined, split_year, sector, train_scope_sector=True, test_scope_sector=False)
    train, test = scopes[True]
    asm = VectorAssembler(inputCols=feats, outputCol="raw", handleInvalid="keep")
    tr = asm.transform(prepare(train, feats))
    scaler = StandardScaler(inputCol="raw", outputCol="sf", withMean=True, withStd=True).fit(tr)
    stats = tr.agg(F.avg(TARGET).alias("m"), F.stddev_samp(TARGET).alias("s")).first()
    y_mean = float(stats["m"] or 0.0)
    y_std = float(stats["s"] or 1.0) or 1.0

    def rows(df):
        return scaler.transform(asm.transform(prepare(df, feats))).select(
            "Instrument", "Date", TARGET, vector_to_array("sf").alias("x"), ((F.col(TARGET) - y_mean) / y_std).alias("y"))

    bucket = F.pmod(F.xxhash64("Instrument", "Date"), F.lit(1000)) < int(round(validation_frac * 1000))
    all_rows = staged(rows(train).select("x", "y", bucket.alias("held")), "dense-train")
    history: list = []
    flat = fit_dense(all_rows.where("not held"), len(feats), hidden, epochs=epochs, seed=seed, shard_rows=shard_rows,
                     val=all_rows.where("held") if validation_frac > 0 else None, history=history)
    hist = joined.sparkSession.createDataFrame(history, "epoch int, val_mse double")
    # the network learns standardised labels: report the MSE in price units
    hist = hist.withColumn("val_mse", F.col("val_mse") * (y_std * y_std))
    return predict_dense(rows(test), flat, len(feats), hidden, y_mean=y_mean, y_std=y_std), hist
