"""Per-entity sequence operators (D13, D16, E5, E6, H10, H11) without
entity-wide windows.

A window partitioned by entity sends each entity's whole history to one
task, so an entity holding a third of the rows would serialise a third of
the job. Instead rows are numbered with a two-level prefix sum: counts
(and running sums) per (entity, month) are aggregated map-side, offsets
are a window over the small per-month table, and rows are numbered
within their (entity, month). Sliding sums are then differences of prefix
sums, read with ``lead`` inside (entity, block of row numbers) groups that
carry a small halo of the next block, so a single entity is spread over
many bounded groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import exact_avg, exact_parts, minmax, minmax_inverse
from ..specs import SplitParams

_UNB = Window.unboundedPreceding


def month_bucket(date_col: str = "Date"):
    return F.year(date_col) * 100 + F.month(date_col)


def sequence_index(df: DataFrame, entity: str = "Instrument", order=("Date",), bucket=None,
                   running: dict | None = None, bounds=()) -> DataFrame:
    """Add ``seq`` (0-based position in the entity's ``order``), ``n_rows``
    (entity length) and, for each ``running[name] = column``, its running
    sum up to and including the row: whole cents in ``name`` (decimal, 2
    places) and what is left in ``name_rest`` (double); and for each column
    in ``bounds`` the entity's ``{c}_min`` and ``{c}_max``, which come with
    the offsets and so need no join of their own.

    ``order`` must be a total order within an entity; ``bucket`` is a
    coarse, order-compatible column expression (default: month of the
    first order column)."""
    running = running or {}
    bucket = bucket if bucket is not None else month_bucket(order[0])
    base = df.withColumn("_bkt", bucket)
    zero = F.lit(0).cast("decimal(38,2)")
    # each running sum in two parts: cents in decimal, the rest as a double
    parts = {n: e for k, c in running.items() for n, e in zip((k, f"{k}_rest"), exact_parts(c), strict=True)}
    none = {n: F.lit(0.0) if n.endswith("_rest") else zero for n in parts}
    per_bkt = base.groupBy(entity, "_bkt").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(e).alias(f"_s_{n}") for n, e in parts.items()],
                                            *[f(c).alias(f"{c}_{f.__name__}") for c in bounds for f in (F.min, F.max)])
    we = Window.partitionBy(entity).orderBy("_bkt").rowsBetween(_UNB, -1)
    offsets = per_bkt.select(
        entity, "_bkt",
        F.coalesce(F.sum("_n").over(we), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy(entity)).alias("n_rows"),
        *[f(f"{c}_{f.__name__}").over(Window.partitionBy(entity)).alias(f"{c}_{f.__name__}") for c in bounds for f in (F.min, F.max)],
        *[F.coalesce(F.sum(f"_s_{n}").over(we), none[n]).alias(f"_o_{n}") for n in parts])
    wl = Window.partitionBy(entity, "_bkt").orderBy(*order)
    local = base.select(
        "*", (F.row_number().over(wl) - 1).alias("_local"),
        *[F.coalesce(F.sum(e).over(wl.rowsBetween(_UNB, 0)), none[n]).alias(f"_r_{n}") for n, e in parts.items()])
    out = local.join(offsets, [entity, "_bkt"], "inner")
    return out.select(*df.columns, (F.col("_off") + F.col("_local")).alias("seq"), "n_rows",
                      *[(F.col(f"_o_{n}") + F.col(f"_r_{n}")).alias(n) for n in parts],
                      *[f"{c}_{m}" for c in bounds for m in ("min", "max")])


def chrono_block_split(seq_df: DataFrame, p: SplitParams = SplitParams()) -> DataFrame:
    """Cut each entity's history into whole blocks of ``p.window`` rows
    (the incomplete tail is dropped) and label them in time order: the first
    floor(65 %) ``train``, then ceil(half the rest) ``test``, then ``val``."""
    c = F.col
    n_blocks = F.floor(c("n_rows") / p.window)
    n_train = F.floor(n_blocks * p.train_frac)
    n_test = F.ceil((n_blocks - n_train) * p.test_frac_of_rest)
    block = F.floor(c("seq") / p.window)
    out = seq_df.select("*", block.alias("block_id"), n_blocks.alias("n_blocks"),
                        n_train.alias("_nt"), n_test.alias("_ns"))
    out = out.where(c("block_id") < c("n_blocks"))
    split = (F.when(c("block_id") < c("_nt"), F.lit("train"))
              .when(c("block_id") < c("_nt") + c("_ns"), F.lit("test"))
              .otherwise(F.lit("val")))
    return out.withColumn("split", split).drop("_nt", "_ns")


def sliding_window_stats(seq_df: DataFrame, n_in: int, n_out: int, running: str = "cum_price",
                         entity: str = "Instrument", date: str = "Date", value: str = "Price_Close",
                         block: int = 4096) -> DataFrame:
    """E5 in aggregated form: for every complete supervised sample (inputs
    rows i..i+n_in-1, labels the next n_out rows) its dates and the means of
    the input and label values (exact for values in whole cents). ``seq_df`` comes from
    ``sequence_index(..., running={running: value})``; the sample count per
    entity is ``n_rows - n_in - n_out + 1``.

    One shuffle: rows are grouped by (entity, block of ``block`` row
    numbers), and each block also receives the first ``n_in + n_out - 1``
    rows of the next block (a halo), so ``lead`` inside a group sees every
    row a sample starting in that block needs. Groups stay bounded however
    long an entity's history is."""
    c = F.col
    span = n_in + n_out - 1
    block = max(block, span)  # a sample may then reach at most one block ahead
    blk = F.floor(c("seq") / block)
    own = F.array(blk)
    # rows near the start of a block are also needed by the previous block
    halo = F.when((c("seq") % block < span) & (blk > 0), F.array(blk, blk - 1)).otherwise(own)
    rest = f"{running}_rest"
    rows = seq_df.select(entity, "seq", date, running, rest, value, F.explode(halo).alias("_blk"))
    own_cents, own_rest = exact_parts(value)
    w = Window.partitionBy(entity, "_blk").orderBy("seq")
    out = rows.select(
        entity, "_blk", c("seq").alias("sample_start"), c(date).alias("input_start_date"),
        (c(running) - F.coalesce(own_cents, F.lit(0))).alias("_p0"), (c(rest) - own_rest).alias("_q0"),
        F.lead(date, n_in - 1).over(w).alias("input_end_date"),
        F.lead(running, n_in - 1).over(w).alias("_p1"), F.lead(rest, n_in - 1).over(w).alias("_q1"),
        F.lead(date, span).over(w).alias("label_end_date"),
        F.lead(running, span).over(w).alias("_p2"), F.lead(rest, span).over(w).alias("_q2"),
        F.lead("seq", span).over(w).alias("_s2"))
    # keep each sample once (in its own block) and only complete ones
    out = out.where((F.floor(c("sample_start") / block) == c("_blk"))
                    & (c("_s2") == c("sample_start") + span))
    return out.select(
        entity, "sample_start", "input_start_date", "input_end_date", "label_end_date",
        (((c("_p1") - c("_p0")).cast("double") + (c("_q1") - c("_q0"))) / float(n_in)).alias("input_mean"),
        (((c("_p2") - c("_p1")).cast("double") + (c("_q2") - c("_q1"))) / float(n_out)).alias("label_mean"))


def tail_mean(seq_df: DataFrame, n: int, value: str = "Price_Close", entity: str = "Instrument",
              name: str = "tail_mean") -> DataFrame:
    """Mean of each entity's last ``n`` rows (a row filter on the
    sequence number, then a map-side combined aggregate)."""
    last = seq_df.where(F.col("seq") >= F.col("n_rows") - n)
    return last.groupBy(entity).agg(exact_avg(value).alias(name), F.count(F.lit(1)).alias("tail_rows"))


def minmax_scale(df: DataFrame, cols, entity: str = "Instrument") -> DataFrame:
    """Per-entity min-max scaling (constant column -> 0), with the
    bounds kept as ``{c}_min``/``{c}_max`` for ``minmax_restore``. Bounds
    are a grouped aggregate joined back on the entity (AQE broadcasts the
    one-row-per-entity side when it is measured small)."""
    cols = list(cols)
    bounds = df.groupBy(entity).agg(*[a for c in cols for a in
                                      (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))])
    out = df.join(bounds, entity, "inner")
    return out.select("*", *[minmax(c, f"{c}_min", f"{c}_max").alias(f"{c}_scaled") for c in cols])


def minmax_restore(scaled: DataFrame, cols) -> DataFrame:
    """Map ``{c}_scaled`` back to the original units."""
    return scaled.select("*", *[minmax_inverse(f"{c}_scaled", f"{c}_min", f"{c}_max").alias(f"{c}_restored")
                                for c in cols])
