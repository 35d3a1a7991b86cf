"""Per-entity forecasting (I13-I16, I19, I20) and its naive reference."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import STAT_SCALE, exact_avg, exact_sum, minmax, pct_error, relative_upside
from ..sources.staging import staged
from ..specs import ForecastParams, SplitParams
from .baseline import growth_baseline, growth_baseline_error
from .lagstats import LagLayout
from .sequence import sequence_index
from .windows import BLOCK, matrices, row_blocks


def walk_forward_naive(blocks: DataFrame, n_out: int, window: int, value: str = "Price_Close",
                       entity: str = "Instrument") -> DataFrame:
    """I15 with the naive model: at the start of each test or validation
    block, predict the last observed value for the next ``n_out`` rows.
    ``blocks`` is ``chrono_block_split`` output; the last observation is
    fetched by an equi-join on (entity, row number)."""
    c = F.col
    rows = (blocks.where(c("split") != "train")
                  .withColumn("block_start", c("block_id") * window)
                  .where(c("seq") < c("block_start") + n_out))
    # only a block's last row can be the last seen one: filter before the join
    hist = blocks.where((c("seq") + 1) % window == 0).select(entity, (c("seq") + 1).alias("block_start"), c(value).alias("last_seen"))
    j = rows.join(hist, [entity, "block_start"])
    return j.groupBy(entity, "split").agg(
        F.count(F.lit(1)).alias("n_pred"),
        exact_sum(F.abs(c(value) - c("last_seen"))).alias("sum_abs_error"),
        exact_avg(pct_error(c(value), c("last_seen")), STAT_SCALE).alias("mean_pct_error"))


# ---------------------------------------------------------------------------
# Direct multi-horizon ridge forecaster (I13, I14, I16, I19, I20), re-aimed
# from the reference's per-company LSTM.
#
# Features of an anchor day t: the entity's min-max scaled closes of days
# t-n_in+1..t, its other scaled channels on all of these days or
# (channels="anchor") on day t alone, and a bias; targets: scaled closes of
# days t+1..t+n_out. The fit needs only X'X and X'Y, which follow from lagged
# products (``lagstats``): each block of rows emits its sums per scope
# (train / +test / +val), Spark adds the vectors per entity, and one
# step per entity solves; where an entity has fewer samples than features,
# its rows go to that step instead, which solves the smaller XX'. Walk-forward evaluation uses the model of the
# scope before each block, fed with the observed history, as the reference
# does; a timeline of the evaluated days, made without any model, is what
# predictions are joined to, so a day without a prediction shows as a null.
# ---------------------------------------------------------------------------


def block_bounds(seq_df: DataFrame, block: int, split: SplitParams) -> DataFrame:
    """E6 as row numbers: where each entity's training, test and validation
    blocks end."""
    c = F.col
    nb = F.floor(c("n_rows") / block)
    nt = F.floor(nb * split.train_frac)
    ns = F.ceil((nb - nt) * split.test_frac_of_rest)
    return seq_df.select("*", (nt * block).alias("train_end"), ((nt + ns) * block).alias("test_end"),
                         (nb * block).alias("all_end"))


def walk_forward_timeline(bounded: DataFrame, n_out: int, block: int, value: str = "Price_Close", entity: str = "Instrument",
                          date: str = "Date") -> DataFrame:
    """The days that a walk-forward evaluation predicts, from
    ``block_bounds`` output alone: the first ``n_out`` rows from each test or
    validation block's start on (they may reach into later rows). One row per
    (entity, block_start, step ``h``) with the row's date, value and number."""
    c = F.col
    first, last = F.floor((c("seq") - n_out) / block) + 1, F.floor(c("seq") / block)
    rows = bounded.where((c("seq") >= c("train_end")) & (last >= first))
    rows = rows.select(entity, date, "seq", c(value).alias("actual"), "train_end", "test_end", "all_end",
                       F.explode(F.sequence(first, last)).alias("block_start"))
    rows = rows.withColumn("block_start", c("block_start") * block).where((c("block_start") >= c("train_end")) & (c("block_start") < c("all_end")))
    split = F.when(c("block_start") < c("test_end"), "test").otherwise("val")
    return rows.select(entity, split.alias("split"), "block_start", (c("seq") - c("block_start")).alias("h"), date, "actual",
                       c("seq").alias("row_number"))


_PASS = ("kind string, Instrument string, scope int, n long, sums array<double>, split string, block_start long, "
         "feat array<double>, lo double, hi double")


def _block_pass(layout: LagLayout, n_cols: int, rows_per_block: int, block: int):
    """One NumPy pass per block of rows: ``stat`` rows (lag sums and sample
    count per scope) and ``anchor`` rows (features of each walk-forward or
    future anchor in the block)."""
    n_in, n_out = layout.n_in, layout.n_out
    schema = pa.schema([("kind", pa.string()), ("Instrument", pa.string()), ("scope", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.float64())),
                        ("split", pa.string()), ("block_start", pa.int64()), ("feat", pa.list_(pa.float64())), ("lo", pa.float64()), ("hi", pa.float64())])

    def one(name, number, base, ends, lo, hi, rows):
        first, last = number * rows_per_block, (number + 1) * rows_per_block - 1  # anchors of this block
        at = n_in - 1
        for scope, end in enumerate(ends if layout.samples(ends[-1]) > layout.width else ()):
            start, stop = max(first, at), min(last, end - 1 - n_out) + 1
            if start < stop:
                sums = layout.sums(rows, start - n_in + 1 - base, stop - n_in + 1 - base)
                yield {"kind": "stat", "Instrument": name, "scope": scope, "n": stop - start, "sums": sums}
            at = max(at, end - n_out)
        wanted = [(b, 0, "test") for b in range(ends[0], ends[1], block)] + [(b, 1, "val") for b in range(ends[1], ends[2], block)]
        wanted += [(ends[2], 2, "future")] if ends[2] > 0 else []
        for b, scope, split in wanted:
            if first <= b - 1 <= last and b >= n_in:
                yield {"kind": "anchor", "Instrument": name, "scope": scope, "split": split, "block_start": b,
                       "feat": layout.features(rows, b - 1 - base), "lo": lo, "hi": hi}

    def tasks(batches):
        for batch in batches:
            names = ("Instrument", "block", "first_seq", "train_end", "test_end", "all_end", "Price_Close_min", "Price_Close_max")
            for (name, number, base, *ends, lo, hi), rows in zip(zip(*(batch.column(x).to_pylist() for x in names), strict=True),
                                                                  matrices(batch, n_cols), strict=True):
                out = list(one(name, number, base, ends, lo, hi, rows))
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    return tasks


_MODELS = ("Instrument string, scope int, n_samples long, coef array<double>, anchors "
           "array<struct<split: string, block_start: long, feat: array<double>, lo: double, hi: double>>")


def _solve(layout: LagLayout, ridge: float, channels: int):
    """Per entity: the models of the three scopes, each over all samples up
    to its end, with the anchors that each is to predict from. Input rows
    hold the rows up to the last end where these make no more samples than
    features; else the summed lag sums by scope, the first rows and the rows
    around each scope's end."""
    span = layout.span
    anchor = pa.struct([("split", pa.string()), ("block_start", pa.int64()), ("feat", pa.list_(pa.float64())), ("lo", pa.float64()), ("hi", pa.float64())])
    schema = pa.schema([("Instrument", pa.string()), ("scope", pa.int32()), ("n_samples", pa.int64()), ("coef", pa.list_(pa.float64())),
                        ("anchors", pa.list_(anchor))])

    def models(row):
        edge = {r["seq"]: r["v"] for r in row["edge"]}
        take = lambda first, n: np.array([edge[first + i] for i in range(n)]).reshape(n, channels)
        ends = [row[x] for x in ("train_end", "test_end", "all_end")]
        counts = [layout.samples(end) for end in ends]
        if counts[-1] <= layout.width:
            return list(zip(counts, layout.fit_rows(take(0, ends[-1]), counts, ridge), strict=True))
        by_scope = {r["scope"]: r for r in row["stats"] or []}
        total, n, out = np.zeros(layout.size), 0, []
        for scope, end in enumerate(ends):
            if scope in by_scope:
                total, n = total + np.array(by_scope[scope]["sums"]), n + by_scope[scope]["n"]
            head, tail = (take(first, span - 1)[:, :layout.n_window] if n else None for first in (0, end - span + 1))
            out.append((n, layout.fit(total, head, tail, ridge) if n else None))
        return out

    def tasks(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]  # one entity's numbers at a time
                yield pa.RecordBatch.from_pylist([
                    {"Instrument": row["Instrument"], "scope": scope, "n_samples": n, "coef": None if coef is None else coef.ravel(),
                     "anchors": [x for x in row["anchors"] or [] if x["scope"] == scope]} for scope, (n, coef) in enumerate(models(row))], schema)

    return tasks


def _predict_expr(d: int, n_out: int, feat, coef):
    """``feat @ W`` with ``W`` stored row-major (d x n_out) in ``coef``, as
    nested higher-order functions: evaluated in the JVM, no Python worker."""
    steps = F.sequence(F.lit(0), F.lit(n_out - 1))
    rows = F.sequence(F.lit(0), F.lit(d - 1))
    return F.when(F.size(feat) == d, F.transform(steps, lambda h: F.aggregate(
        rows, F.lit(0.0), lambda acc, i: acc + F.element_at(feat, i + 1) * F.element_at(coef, i * n_out + h + 1))))


def forecast_entities(series: DataFrame, p: ForecastParams = ForecastParams(),
                      split: SplitParams | None = None, chunk: int = BLOCK, entity: str = "Instrument",
                      fit_on: str = "all", pct_denominator: str = "actual", exog=()):
    """Fit, walk forward and forecast every entity. Returns ``(results,
    details)``: one row per entity (metrics, forecast, upside; entities too
    short to model keep null metrics) and one row per evaluated day of the
    timeline, ``predicted`` null where there is no model or not enough
    history. ``n_eval_days`` and ``n_predicted_days`` count them.

    ``exog`` adds other columns' scaled values (the reference fed its model
    ten statement measures): volume and exog on all ``n_in`` days, or with
    ``p.channels = "anchor"`` on the anchor day alone. Rows with
    a null or a number that isn't finite in any used column are left out and
    counted (``rows_left_out``). ``chunk`` is the number of rows that a task
    handles at once. ``pct_denominator='prediction'`` reproduces the
    reference's swapped percent-error arguments (S17)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    c = F.col
    if entity != "Instrument":  # the grouped NumPy steps use the column name
        res, det = forecast_entities(series.withColumnRenamed(entity, "Instrument"), p, split, chunk,
                                     "Instrument", fit_on, pct_denominator, exog)
        return res.withColumnRenamed("Instrument", entity), det.withColumnRenamed("Instrument", entity)
    split = split or SplitParams(window=p.block)
    exog = list(exog)
    used = ["Price_Close", "Volume", *exog]
    numbers = [c(x).cast("double") for x in used]
    whole = c("Date").isNotNull()
    for x in numbers:
        whole = whole & x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    # counted, numbered in two passes: what made the series runs once
    rows_in = staged(series.select(entity, "Date", *[x.alias(n) for x, n in zip(numbers, used, strict=True)],
                                   F.coalesce(whole, F.lit(False)).alias("_whole")), "forecast-series")
    left_out = rows_in.groupBy(entity).agg(F.count_if(~c("_whole")).alias("rows_left_out"))
    # min-max bounds per entity (S18: the reference fitted them on all rows,
    # test and validation included; ``fit_on='train'`` uses training rows)
    base = sequence_index(rows_in.where("_whole").drop("_whole"), entity=entity, order=("Date", *used), bounds=used if fit_on == "all" else ())
    base = block_bounds(base, p.block, split)
    if fit_on != "all":
        bounds = base.where(c("seq") < c("train_end")).groupBy(entity).agg(
            *[a for col in used for a in (F.min(col).alias(f"{col}_min"), F.max(col).alias(f"{col}_max"))])
        base = base.join(bounds, entity, "left")
    # an entity without training rows has no bounds to scale by, and no model
    cells = [F.coalesce(minmax(x, f"{x}_min", f"{x}_max"), F.lit(0.0)).alias(f"x{k}") for k, x in enumerate(used)]
    seq = staged(base.select(entity, "Date", "seq", "n_rows", "train_end", "test_end", "all_end", "Price_Close", *cells,
                             "Price_Close_min", "Price_Close_max"), "forecast-rows")

    wide = p.channels == "window"
    layout = LagLayout(p.n_in, p.n_out, len(used) if wide else 1, 0 if wide else len(used) - 1)
    ends = ("train_end", "test_end", "all_end")
    blocks = row_blocks(seq, [f"x{k}" for k in range(len(used))], p.n_in - 1, p.n_out, chunk, entity,
                        keep=(*ends, "Price_Close_min", "Price_Close_max"))
    passed = staged(blocks.mapInArrow(_block_pass(layout, len(used), chunk, p.block), _PASS), "forecast-pass")

    # lag sums: vectors added per entity and scope, combined in each task first
    stats = (passed.where(c("kind") == "stat").select(entity, "scope", "n", array_to_vector("sums").alias("sums"))
             .groupBy(entity, "scope").agg(F.sum("n").alias("n"), vector_to_array(Summarizer.sum(c("sums"))).alias("sums"))
             .groupBy(entity).agg(F.collect_list(F.struct("scope", "n", "sums")).alias("stats")))
    # the rows at the start and before each scope's end; all of them where
    # they make no more samples than features, so a bounded number
    near = (c("seq") < layout.span - 1) | ((c("all_end") - (layout.span - 1) <= layout.width) & (c("seq") < c("all_end")))
    for end in ends:
        near = near | ((c("seq") >= c(end) - layout.span + 1) & (c("seq") < c(end)))
    row_cells = F.array(*[c(f"x{k}") for k in range(len(used))])
    edges = seq.where(near).groupBy(entity).agg(F.collect_list(F.struct("seq", row_cells.alias("v"))).alias("edge"),
                                                *[F.max(e).alias(e) for e in ends])
    anchors = (passed.where(c("kind") == "anchor").groupBy(entity)
               .agg(F.collect_list(F.struct("scope", "split", "block_start", "feat", "lo", "hi")).alias("anchors")))
    # anchors travel with their entity: coefficients (thousands by n_out, per
    # scope) are used where they were solved, neither shuffled nor written
    models = edges.join(stats, entity, "left").join(anchors, entity, "left").mapInArrow(_solve(layout, p.ridge, len(used)), _MODELS)
    pred = models.select(entity, "scope", "n_samples", "coef", F.explode_outer("anchors").alias("a")).select(
        entity, "scope", "n_samples", "coef", "a.*")
    yhat = F.when(c("coef").isNotNull(), _predict_expr(layout.width, p.n_out, c("feat"), c("coef")))
    pred = staged(pred.select(entity, "scope", "n_samples", "split", "block_start", yhat.alias("yhat"), "lo", "hi"), "forecast-predicted")
    steps = pred.select(entity, "split", "block_start", F.posexplode("yhat").alias("h", "ps"), "lo", "hi").select(
        entity, "split", "block_start", c("h").cast("long").alias("h"), (c("ps") * (c("hi") - c("lo")) + c("lo")).alias("predicted"))
    ent = seq.where(c("seq") == 0).select(entity, "n_rows")  # one row per entity, no shuffle

    # every evaluated day, with its prediction if there is one
    timeline = walk_forward_timeline(seq, p.n_out, p.block, entity=entity)
    details = timeline.join(steps.where(c("split") != "future").drop("split"), [entity, "block_start", "h"], "left").select(
        entity, "split", "block_start", "h", "Date", "row_number", "actual", "predicted")
    err = F.abs(c("predicted") - c("actual"))
    pct = F.try_divide(err * 100.0, c("predicted") if pct_denominator == "prediction" else c("actual"))
    metrics = details.groupBy(entity).agg(
        F.count("*").alias("n_eval_days"), F.count("predicted").alias("n_predicted_days"),
        F.avg(F.when(c("split") == "test", pct)).alias("test_pct_err"),
        F.avg(F.when(c("split") == "val", pct)).alias("val_pct_err"),
        F.sum(F.when(c("split") == "test", err)).alias("test_sum_abs_error"),
        F.sum(F.when(c("split") == "val", err)).alias("val_sum_abs_error"))
    future = (steps.where((c("split") == "future") & (c("h") >= p.n_out - p.tail_forecast))
              .groupBy(entity).agg(F.avg("predicted").alias("future_predicted_price")))
    recent = (seq.where(c("seq") >= c("n_rows") - p.tail_price)
              .groupBy(entity).agg(exact_avg("Price_Close").alias("recent_price")))
    nsamp = pred.where(c("scope") == 2).select(entity, "n_samples")  # at most one anchor: the future's
    res = (ent.join(left_out, entity, "left").join(nsamp, entity, "left").join(metrics, entity, "left")
           .join(future, entity, "left").join(recent, entity, "left").fillna(0, ["n_eval_days", "n_predicted_days", "n_samples"]))
    res = res.withColumn("potential_upside", relative_upside("future_predicted_price", "recent_price"))
    # the simple model on the same rows the forecaster used (the reference
    # scored its growth baseline on the model's own cleaned data)
    simple = growth_baseline_error(growth_baseline(seq.select(entity, "Date", "Price_Close")), entity)
    res = res.join(simple.select(entity, c("mean_pct_error").alias("simple_model_pct_err")), entity, "left")
    return res, details


def entity_forecast_result(res: DataFrame, baseline_err: DataFrame | None = None,
                           entity: str = "Instrument") -> DataFrame:
    """The reference's eight declared float columns (its ``training_*``
    columns held test-block results and ``test_*`` validation results) next
    to correctly named ones."""
    c = F.col
    if baseline_err is not None:  # replace the baseline computed on the model rows
        res = res.drop("simple_model_pct_err").join(
            baseline_err.select(entity, c("mean_pct_error").alias("simple_model_pct_err")), entity, "left")
    return res.select(
        entity, "n_rows", "rows_left_out", "n_samples", "n_eval_days", "n_predicted_days", "test_pct_err", "val_pct_err", "test_sum_abs_error", "val_sum_abs_error",
        c("test_pct_err").cast("float").alias("training_pct_err"),
        c("val_pct_err").cast("float").alias("val_pct_err_f"),
        c("simple_model_pct_err").cast("float").alias("simple_model_pct_err"),
        c("test_sum_abs_error").cast("float").alias("training_RMSE_sum"),
        c("val_sum_abs_error").cast("float").alias("test_RMSE_sum"),
        c("future_predicted_price").cast("float").alias("future_predicted_price"),
        c("potential_upside").cast("float").alias("potential_upside"))
