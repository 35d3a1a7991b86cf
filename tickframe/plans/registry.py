"""Registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and, for
the SQL-expressible ones, ``ORACLES[name]`` (DuckDB text over the same
parquet tables). Every query reads the driver's tables through the fixture
definitions, so its work grows with the data."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from ..functions.calendar import price_quarter, statement_quarter, statement_year
from ..functions.numeric import pct_error, relative_upside
from ..operators import baseline as bl
from ..operators import features as fe
from ..operators import profile as pr
from ..operators import rollup as ru
from ..operators import screen as sc
from ..operators import sequence as sq
from ..operators.regress import NON_FEATURES, TARGET
from ..operators.cleaning import clean_table, clean_technicals, coerce, dedup, fill_zero, with_statement_calendar
from ..operators.returns import yoy_return
from ..sources.staging import shared_folder, staged
from ..sources.tables import read_csv_checked, write_by_year
from ..specs import FUNDAMENTALS, TECHNICALS
from . import oracle as O
from .inputs import BLOCKS, ENTITIES, FORECAST, SCREEN, SECTOR, SPLIT_YEAR, Inputs

QUERIES: dict = {}
ORACLES: dict = {}


def register(name, oracle=None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


W = O.with_ctes

# ---------------------------------------------------------------- P1 profile / clean / join


@register("null_profile")
def _null_profile(i):
    return pr.null_profile(i.fundamentals_raw)


def _null_profile_sql(table, cols):
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(COUNT_IF({c} IS NULL) AS BIGINT) AS nulls, CAST(COUNT(*) AS BIGINT) AS total_rows FROM {table}"
        for c in cols)
    return (f"SELECT column_name, nulls, total_rows, CAST(nulls AS DOUBLE) * 100 / NULLIF(CAST(total_rows AS DOUBLE), 0) "
            f"AS null_pct FROM ({parts}) u")


FUND_RAW_COLS = ["Instrument", "Date", "Total_Revenue", "Total_Current_Assets", "Total_Current_Liabilities",
                 "Total_Long_Term_Debt", "Total_Debt", "Total_Equity", "Total_Liabilities", "Total_Assets__Reported",
                 "Operating_Expenses", "EBIT", "Net_Income_Before_Taxes", "Normalized_Income_Avail_to_Cmn_Shareholders",
                 "Gross_Dividends___Common_Stock", "Total_Common_Shares_Outstanding", "Revenue_Per_Share",
                 "Book_Value_Per_Share", "Tangible_Book_Value_Per_Share", "Company_Common_Name",
                 "Country_of_Headquarters", "TRBC_Economic_Sector_Name"]
TECH_RAW_COLS = ["Instrument", "Date", "Price_Close", "Volume"]
JOINED_COLS = ["Instrument", "Quarter", "Year", "Date", "Price_Close", "Volume"] + \
    [c for c in FUND_RAW_COLS if c not in ("Instrument", "Date")]

ORACLES["null_profile"] = W(["fundamentals_raw"], _null_profile_sql("fundamentals_raw", FUND_RAW_COLS))


@register("null_profile_technicals", W(["technicals_raw"], _null_profile_sql("technicals_raw", TECH_RAW_COLS)))
def _null_profile_t(i):
    return pr.null_profile(i.technicals_raw)


@register("null_profile_joined", W(["joined"], _null_profile_sql("joined", JOINED_COLS)))
def _null_profile_j(i):
    return pr.null_profile(i.joined)


def _any_sql(table, cols, subset):
    anyc = " OR ".join(f"{c} IS NULL" for c in cols)
    sub = " OR ".join(f"{c} IS NULL" for c in subset)
    return (f"SELECT total_rows, any_null_rows, CAST(any_null_rows AS DOUBLE) * 100 / NULLIF(CAST(total_rows AS DOUBLE), 0) AS any_null_pct, "
            f"subset_null_rows, CAST(subset_null_rows AS DOUBLE) * 100 / NULLIF(CAST(total_rows AS DOUBLE), 0) AS subset_null_pct FROM ("
            f"SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, CAST(COUNT_IF({anyc}) AS BIGINT) AS any_null_rows, "
            f"CAST(COUNT_IF({sub}) AS BIGINT) AS subset_null_rows FROM {table}) c")


@register("null_profile_any", W(["fundamentals_raw"], _any_sql("fundamentals_raw", FUND_RAW_COLS, FUNDAMENTALS.or_cols)))
def _null_any(i):
    return pr.null_profile_any(i.fundamentals_raw, FUNDAMENTALS.or_cols)


@register("null_profile_any_technicals", W(["technicals_raw"], _any_sql("technicals_raw", TECH_RAW_COLS, TECHNICALS.or_cols)))
def _null_any_t(i):
    return pr.null_profile_any(i.technicals_raw, TECHNICALS.or_cols)


@register("coerce_types", W(["technicals_typed"], "SELECT * FROM technicals_typed"))
def _coerce(i):
    return i.technicals_typed


@register("coerce_types_full", W(["technicals_full_typed"], "SELECT * FROM technicals_full_typed"))
def _coerce_full(i):
    """All nine mis-typed columns of the raw daily table."""
    return coerce(i.technicals_full, TECHNICALS.types)


@register("clean_technicals_full", W(["technicals_full_typed"], """SELECT * EXCLUDE (int64_field_0), CAST(YEAR(Date) AS INTEGER) AS Year,
    CAST(CASE WHEN MONTH(Date) = 1 THEN 4 ELSE QUARTER(Date) END AS INTEGER) AS Quarter FROM technicals_full_typed
    WHERE Date IS NOT NULL AND Instrument IS NOT NULL AND Price_Close IS NOT NULL AND Volume IS NOT NULL"""))
def _clean_full(i):
    return clean_technicals(i.technicals_full)


def _checked_csv(i):
    """The raw daily table as text files, read against its declared types."""
    path = f"{shared_folder(i.spark)}/raw-daily-{uuid.uuid4().hex}"
    i.technicals_full.write.option("header", True).csv(path)
    declared = ", ".join(f"{c} {TECHNICALS.types.get(c, t)}" for c, t in i.technicals_full.dtypes)
    return read_csv_checked(i.spark, path, declared)


@register("typed_csv_rows", W(["technicals_full", "technicals_full_typed"], """SELECT * FROM technicals_full_typed
    WHERE int64_field_0 NOT IN (SELECT int64_field_0 FROM technicals_full WHERE Price_Close = 'n/a')"""))
def _typed_csv(i):
    return _checked_csv(i)[0]


@register("rejected_rows", W(["technicals_full"], """SELECT CAST(int64_field_0 AS STRING) AS int64_field_0, Instrument, Date, Price_Close,
    NULL::DOUBLE AS read_price FROM technicals_full WHERE Price_Close = 'n/a'"""))
def _rejected(i):
    """Rows whose price isn't a number, by their text."""
    field = lambda k: F.nullif(F.split("_line", ",", -1)[k], F.lit(""))
    return _checked_csv(i)[1].select(field(0).alias("int64_field_0"), field(1).alias("Instrument"), field(2).alias("Date"),
                                     field(3).alias("Price_Close"), F.col("Price_Close").alias("read_price"))


@register("clean_technicals", W(["technicals"], "SELECT * FROM technicals"))
def _clean_t(i):
    return i.technicals


@register("clean_fundamentals", W(["fund_clean"], "SELECT * FROM fund_clean"))
def _clean_f(i):
    return with_statement_calendar(clean_table(i.fundamentals_raw, FUNDAMENTALS))


@register("dedup_statements", W(["fundamentals"], "SELECT * FROM fundamentals"))
def _dedup(i):
    return i.fundamentals


@register("price_quarter", W(["technicals_typed"], """SELECT Instrument, Date,
    CAST(YEAR(Date) AS INTEGER) AS Year,
    CAST(CASE WHEN MONTH(Date) = 1 THEN 4 WHEN MONTH(Date) <= 3 THEN 1 WHEN MONTH(Date) <= 6 THEN 2
              WHEN MONTH(Date) <= 9 THEN 3 ELSE 4 END AS INTEGER) AS Quarter,
    CAST(QUARTER(Date) AS INTEGER) AS calendar_quarter
    FROM technicals_typed WHERE Date IS NOT NULL"""))
def _price_quarter(i):
    t = i.technicals_typed.where(F.col("Date").isNotNull())
    return t.select("Instrument", "Date", F.year("Date").alias("Year"), price_quarter("Date").alias("Quarter"),
                    price_quarter("Date", calendar=True).alias("calendar_quarter"))


@register("statement_quarter", W(["fundamentals_raw"], """SELECT Instrument, Date,
    CAST(YEAR(Date) + CASE WHEN MONTH(Date) = 12 THEN 1 ELSE 0 END AS INTEGER) AS Year,
    CAST(CASE WHEN MONTH(Date) IN (12, 1, 2) THEN 1 WHEN MONTH(Date) IN (3, 4, 5) THEN 2
              WHEN MONTH(Date) IN (6, 7, 8) THEN 3 ELSE 4 END AS INTEGER) AS Quarter
    FROM fundamentals_raw WHERE Date IS NOT NULL"""))
def _statement_quarter(i):
    f = i.fundamentals_raw.where(F.col("Date").isNotNull())
    return f.select("Instrument", "Date", statement_year("Date").alias("Year"), statement_quarter("Date").alias("Quarter"))


@register("join_tech_fund", W(["joined"], "SELECT * FROM joined"))
def _join(i):
    return i.joined


@register("join_one_per_quarter", W(["technicals", "fundamentals"], """SELECT * FROM technicals JOIN (
    SELECT * EXCLUDE (Date, rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY Instrument, Year, Quarter
      ORDER BY Date DESC) AS rn FROM fundamentals) d WHERE rn = 1) f USING (Instrument, Quarter, Year)"""))
def _join_one(i):
    from ..operators.joins import join_tech_fund
    one = dedup(i.fundamentals, ("Instrument", "Year", "Quarter"), ("Date",), keep="last")
    return join_tech_fund(i.technicals, one)


# ---------------------------------------------------------------- P3 returns


@register("quarterly_avg_price", W(["quarterly"], "SELECT * FROM quarterly"))
def _quarterly(i):
    return ru.quarterly_avg_price(i.technicals)


YOY_SQL = """SELECT *, (avg_price_close - prev_year_price) * 100 / NULLIF(prev_year_price, 0) AS yearly_return
  FROM (SELECT *, LAG(avg_price_close, 4) OVER (PARTITION BY Instrument ORDER BY Year, Quarter) AS prev_year_price
        FROM quarterly) q"""


@register("yoy_return", W(["quarterly"], YOY_SQL))
def _yoy(i):
    return yoy_return(ru.quarterly_avg_price(i.technicals))


@register("yoy_return_calendar", W(["quarterly"], """SELECT q.*, p.avg_price_close AS prev_year_price,
    (q.avg_price_close - p.avg_price_close) * 100 / NULLIF(p.avg_price_close, 0) AS yearly_return
  FROM quarterly q LEFT JOIN quarterly p ON q.Instrument = p.Instrument AND q.Year = p.Year + 1 AND q.Quarter = p.Quarter"""))
def _yoy_cal(i):
    return yoy_return(ru.quarterly_avg_price(i.technicals), calendar=True)


# ---------------------------------------------------------------- P4 value screen


# means of long fractions are rounded in the output, on both sides; inputs are not
@register("annual_rollup", W(["annual"], "SELECT * REPLACE (ROUND(book_per_share_avg, 6) AS book_per_share_avg) FROM annual"))
def _annual(i):
    return ru.annual_rollup(i.fundamentals).withColumn("book_per_share_avg", F.round("book_per_share_avg", 6))


@register("latest_price", W(["latest"], "SELECT * FROM latest"))
def _latest(i):
    return ru.latest_price(i.technicals, SCREEN.current_year)


@register("endpoint_growth", W(["annual"], f"""SELECT *, (last_value - first_value) / NULLIF(ABS(first_value), 0) AS growth FROM (
    SELECT Instrument, MIN_BY(v, actual_year) AS first_value, MAX_BY(v, actual_year) AS last_value FROM (
      SELECT Instrument, actual_year, COALESCE(earnings_sum, 0) AS v FROM annual
      WHERE actual_year IN ({SCREEN.base_year}, {SCREEN.current_year})) e GROUP BY Instrument) g"""))
def _endpoint(i):
    return ru.endpoint_growth(ru.annual_rollup(i.fundamentals), SCREEN.base_year, SCREEN.current_year)


@register("anti_join_negative_years", W(["annual"], f"""SELECT DISTINCT p.Instrument FROM annual p
    ANTI JOIN (SELECT DISTINCT Instrument FROM annual WHERE actual_year >= {SCREEN.since_year} AND earnings_sum < 0) n
    ON p.Instrument = n.Instrument
    WHERE p.actual_year >= {SCREEN.since_year} AND p.earnings_avg > 0"""))
def _anti(i):
    return ru.earnings_record(ru.annual_rollup(i.fundamentals), SCREEN.since_year)


@register("value_screen", W(["annual", "latest"], O.screen_body()))
def _screen(i):
    return sc.value_screen(i.fundamentals, i.technicals, SCREEN)


_METRIC_KEYS = {"metric1": "metric1_size", "metric2": "metric2_liquidity", "metric3": "metric3_working_capital",
                "metric4": "metric4_earnings_stability", "metric5": "metric5_dividend_record",
                "metric6": "metric6_earnings_growth", "metric7": "metric7_price_earnings", "metric8": "metric8_price_book"}

for _m, _key in _METRIC_KEYS.items():
    def _mk(metric):
        def q(i):
            return sc.single_metric(i.fundamentals, i.technicals, metric, SCREEN)
        return q
    register(_key, W(["annual", "latest"], f"SELECT DISTINCT Instrument, CAST({_m} AS INTEGER) AS {_m} FROM ({O.SCREEN_FLAGS[_m]}) m"))(_mk(_m))


@register("combine_flags", W(["annual", "latest"], O.screen_body()))
def _combine(i):
    # eight branches read the flags: computed once
    flags = staged(sc.screen_flags(sc.screen_inputs(i.fundamentals, i.technicals, SCREEN), SCREEN), "screen-flags")
    frames = [flags.where(F.col(m) == 1).select("Instrument", m) for m in sc.METRICS]
    return sc.combine_flags(frames)


# ---------------------------------------------------------------- P9 growth baseline


@register("growth_baseline", W(["baseline"], "SELECT * FROM baseline"))
def _baseline(i):
    return bl.growth_baseline(i.technicals)


def _rounded(df, **digits):
    """Statistics of doubles depend on the order of sums in their last bits:
    registered queries round them in the output, as their SQL does."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


@register("growth_baseline_error", W(["baseline"], """SELECT Instrument, COUNT(*) AS n_days,
    ROUND(FAVG((Price_Close - next_year_price) * (Price_Close - next_year_price)), 3) AS mse,
    ROUND(FAVG(ABS(Price_Close - next_year_price) * 100 / NULLIF(Price_Close, 0)), 6) AS mean_pct_error
    FROM baseline GROUP BY Instrument"""))
def _baseline_err(i):
    return _rounded(bl.growth_baseline_error(bl.growth_baseline(i.technicals)), mse=3, mean_pct_error=6)


_LISTED = ", ".join(f"'{e}'" for e in ENTITIES)


@register("growth_baseline_test_rows", W(["joined"], f"""SELECT Instrument, COUNT(*) AS n_days,
    ROUND(FAVG((p - m) * (p - m)), 3) AS mse, ROUND(FAVG(ABS(p - m) * 100 / NULLIF(p, 0)), 6) AS mean_pct_error FROM (
      WITH r AS (SELECT Instrument, YEAR(Date) AS y, COALESCE(Price_Close, 0) AS p FROM joined
                 WHERE Year >= {SPLIT_YEAR} AND Instrument IN ({_LISTED})),
      a AS (SELECT Instrument, y, {O.AVG2('p')} AS mean FROM r GROUP BY Instrument, y),
      g AS (SELECT *, (mean - LAG(mean) OVER (PARTITION BY Instrument ORDER BY y)) / NULLIF(mean, 0) AS growth FROM a),
      k AS (SELECT Instrument, AVG(growth) AS mean_growth FROM g GROUP BY Instrument)
      SELECT r.Instrument, r.p, g.mean * (1 + k.mean_growth) AS m FROM r JOIN g ON g.Instrument = r.Instrument AND g.y + 1 = r.y
      JOIN k ON k.Instrument = r.Instrument) b
    WHERE m IS NOT NULL GROUP BY Instrument"""))
def _baseline_test_rows(i):
    rows = bl.test_rows(i.joined, SPLIT_YEAR, ENTITIES)
    return _rounded(bl.growth_baseline_error(bl.growth_baseline(rows)), mse=3, mean_pct_error=6)


@register("pct_error", W(["baseline"], """SELECT Instrument, Date, Price_Close, next_year_price,
    ABS(Price_Close - next_year_price) * 100 / NULLIF(Price_Close, 0) AS Error_Pct FROM baseline"""))
def _pct_error(i):
    b = bl.growth_baseline(i.technicals)
    return b.select("Instrument", "Date", "Price_Close", "next_year_price",
                    pct_error("Price_Close", "next_year_price").alias("Error_Pct"))


@register("regression_metrics", W(["baseline"], """SELECT Instrument, n, ROUND(sse, 0) AS sse, ROUND(sse / n, 3) AS mse,
    ROUND(SQRT(sse / n), 6) AS rmse, ROUND(sum_abs_error, 4) AS sum_abs_error, ROUND(1 - sse / NULLIF(saa - sa * sa / n, 0), 9) AS r2 FROM (
    SELECT Instrument, COUNT(*) AS n, FSUM(e * e) AS sse, FSUM(ABS(e)) AS sum_abs_error, FSUM(a) AS sa, FSUM(a * a) AS saa
    FROM (SELECT Instrument, Price_Close AS a, Price_Close - next_year_price AS e FROM baseline) x
    GROUP BY Instrument) g"""))
def _reg_metrics(i):
    from ..operators.regress import regression_metrics
    return _rounded(regression_metrics(bl.growth_baseline(i.technicals), "Price_Close", "next_year_price"),
                    sse=0, mse=3, rmse=6, sum_abs_error=4, r2=9)


# ---------------------------------------------------------------- sequences and scaling


@register("minmax_scale", W(["technicals"], """SELECT Instrument, Date, Price_Close, Volume,
    COALESCE((Price_Close - pmin) / NULLIF(pmax - pmin, 0), Price_Close * 0) AS Price_Close_scaled,
    COALESCE((Volume - vmin) / NULLIF(vmax - vmin, 0), Volume * 0) AS Volume_scaled
  FROM (SELECT *, MIN(Price_Close) OVER w AS pmin, MAX(Price_Close) OVER w AS pmax,
               MIN(Volume) OVER w AS vmin, MAX(Volume) OVER w AS vmax
        FROM technicals WINDOW w AS (PARTITION BY Instrument)) s"""))
def _minmax(i):
    s = sq.minmax_scale(i.technicals, ["Price_Close", "Volume"])
    return s.select("Instrument", "Date", "Price_Close", "Volume", "Price_Close_scaled", "Volume_scaled")


@register("minmax_inverse", W(["technicals"], """SELECT Instrument, Date, Price_Close, s AS Price_Close_scaled,
    s * (pmax - pmin) + pmin AS Price_Close_restored FROM (
    SELECT *, COALESCE((Price_Close - pmin) / NULLIF(pmax - pmin, 0), Price_Close * 0) AS s FROM (
      SELECT *, MIN(Price_Close) OVER w AS pmin, MAX(Price_Close) OVER w AS pmax
      FROM technicals WINDOW w AS (PARTITION BY Instrument)) a) b"""))
def _minmax_inv(i):
    s = sq.minmax_restore(sq.minmax_scale(i.technicals, ["Price_Close"]), ["Price_Close"])
    return s.select("Instrument", "Date", "Price_Close", "Price_Close_scaled", "Price_Close_restored")


def _seq(i, running=None):
    return sq.sequence_index(i.technicals, running=running)


@register("chrono_block_split", W(["seqd"], f"""SELECT Instrument, Date, seq, block_id,
    CASE WHEN block_id < nt THEN 'train' WHEN block_id < nt + ns THEN 'test' ELSE 'val' END AS split FROM (
      SELECT *, CAST(CEIL((nb - nt) * 0.5) AS BIGINT) AS ns FROM (
        SELECT Instrument, Date, CAST(seq AS BIGINT) AS seq, CAST(FLOOR(seq / {BLOCKS.window}) AS BIGINT) AS block_id,
               CAST(FLOOR(n_rows / {BLOCKS.window}) AS BIGINT) AS nb,
               CAST(FLOOR(FLOOR(n_rows / {BLOCKS.window}) * {BLOCKS.train_frac}) AS BIGINT) AS nt FROM seqd) a) b
    WHERE block_id < nb"""))
def _blocks(i):
    return sq.chrono_block_split(_seq(i), BLOCKS).select("Instrument", "Date", "seq", "block_id", "split")


_NI, _NO = FORECAST.n_in, FORECAST.n_out


@register("sliding_windows", W(["countries"], f"""SELECT * FROM (
    SELECT Instrument, ROW_NUMBER() OVER w - 1 AS sample_start, Date AS input_start_date,
      LEAD(Date, {_NI - 1}) OVER w AS input_end_date, LEAD(Date, {_NI + _NO - 1}) OVER w AS label_end_date,
      ROUND(AVG(Price_Close) OVER (w ROWS BETWEEN CURRENT ROW AND {_NI - 1} FOLLOWING), 6) AS input_mean,
      ROUND(AVG(Price_Close) OVER (w ROWS BETWEEN {_NI} FOLLOWING AND {_NI + _NO - 1} FOLLOWING), 6) AS label_mean
    FROM countries WINDOW w AS (PARTITION BY Instrument ORDER BY Date)) s WHERE label_end_date IS NOT NULL"""))
def _sliding(i):
    seq = sq.sequence_index(i.countries, running={"cum_price": "Price_Close"})
    return _rounded(sq.sliding_window_stats(seq, _NI, _NO), input_mean=6, label_mean=6)


_CHANNELS = ["Price_Close", "Volume", *fe.PER_SHARE_MEASURES]
_SPAN = _NI + _NO


@register("window_checksums", W(["country_seq"], f"""SELECT Instrument, channel, n_windows, ROUND(a / n_windows, 2) AS input_mean,
    ROUND(b / n_windows, 2) AS input_weighted_mean, CASE WHEN channel = 'Price_Close' THEN ROUND(y / n_windows, 2) END AS label_mean FROM (
      SELECT Instrument, channel, MAX(n_rows) - {_SPAN} + 1 AS n_windows,
        FSUM(CASE WHEN i < {_NI} THEN value END) / {_NI} AS a, FSUM(CASE WHEN i < {_NI} THEN value * (i + 1) END) / ({_NI} * ({_NI} + 1) / 2) AS b,
        FSUM(CASE WHEN i >= {_NI} THEN value END) / {_NO} AS y
      FROM (SELECT s.Instrument, s.seq, s.n_rows, c.channel, c.value, steps.i FROM country_seq s,
              LATERAL (VALUES {", ".join(f"('{c}', s.{c})" for c in _CHANNELS)}) c(channel, value), range({_SPAN}) steps(i)
            WHERE s.n_rows >= {_SPAN} AND s.seq - steps.i BETWEEN 0 AND s.n_rows - {_SPAN}) r
      GROUP BY Instrument, channel) g"""))
def _window_checksums(i):
    from ..operators.windows import window_summary
    return _rounded(window_summary(sq.sequence_index(i.countries), _CHANNELS, _NI, _NO), input_mean=2, input_weighted_mean=2, label_mean=2)


@register("tail_mean", W(["seqd"], f"""SELECT Instrument, {O.AVG2('Price_Close')} AS tail_mean, COUNT(*) AS tail_rows
    FROM seqd WHERE seq >= n_rows - {FORECAST.tail_price} GROUP BY Instrument"""))
def _tail(i):
    return sq.tail_mean(_seq(i), FORECAST.tail_price)


@register("upside", W(["seqd", "growth"], f"""SELECT t.Instrument, f.forecast, t.tail_mean AS recent,
    (f.forecast - t.tail_mean) * 100 / NULLIF(t.tail_mean, 0) AS upside FROM (
      SELECT Instrument, {O.AVG2('Price_Close')} AS tail_mean FROM seqd WHERE seq >= n_rows - {FORECAST.tail_price}
      GROUP BY Instrument) t JOIN (
      SELECT g.Instrument, MAX_BY(g.avg_price * (1 + mg.mean_growth), g.year) AS forecast FROM growth g JOIN (
        SELECT Instrument, AVG(growth) AS mean_growth FROM growth GROUP BY Instrument) mg USING (Instrument)
      WHERE mg.mean_growth IS NOT NULL GROUP BY g.Instrument) f USING (Instrument)"""))
def _upside(i):
    model = bl.growth_model(bl.yearly_means(i.technicals))
    fc = (model.where(F.col("next_year_price").isNotNull()).groupBy("Instrument")
               .agg(F.max_by("next_year_price", "year").alias("forecast")))
    recent = sq.tail_mean(_seq(i), FORECAST.tail_price, name="recent").drop("tail_rows")
    return fc.join(recent, "Instrument").select(
        "Instrument", "forecast", "recent", relative_upside("forecast", "recent").alias("upside"))


@register("walk_forward_naive", W(["country_seq"], f"""SELECT Instrument, split, COUNT(*) AS n_pred,
    ROUND(FSUM(ABS(Price_Close - last_seen)), 4) AS sum_abs_error,
    ROUND(FAVG(ABS(Price_Close - last_seen) * 100 / NULLIF(Price_Close, 0)), 6) AS mean_pct_error FROM (
      SELECT b.*, h.Price_Close AS last_seen FROM (
        SELECT *, CASE WHEN block_id < nt THEN 'train' WHEN block_id < nt + ns THEN 'test' ELSE 'val' END AS split,
               block_id * {BLOCKS.window} AS block_start FROM (
          SELECT *, CAST(CEIL((nb - nt) * 0.5) AS BIGINT) AS ns FROM (
            SELECT *, CAST(FLOOR(seq / {BLOCKS.window}) AS BIGINT) AS block_id, CAST(FLOOR(n_rows / {BLOCKS.window}) AS BIGINT) AS nb,
                   CAST(FLOOR(FLOOR(n_rows / {BLOCKS.window}) * {BLOCKS.train_frac}) AS BIGINT) AS nt FROM country_seq) a) c
        WHERE block_id < nb) b
      JOIN country_seq h ON h.Instrument = b.Instrument AND h.seq = b.block_start - 1
      WHERE b.split <> 'train' AND b.seq < b.block_start + {FORECAST.n_out}) x
    GROUP BY Instrument, split"""))
def _walk_naive(i):
    from ..operators.forecast import walk_forward_naive
    errors = walk_forward_naive(sq.chrono_block_split(sq.sequence_index(i.countries), BLOCKS), FORECAST.n_out, BLOCKS.window)
    return _rounded(errors, sum_abs_error=4, mean_pct_error=6)


# ---------------------------------------------------------------- P2 features


@register("per_share_features", W(["fundamentals"], O.per_share_select()))
def _per_share(i):
    return fe.per_share_features(i.fundamentals)


@register("pairwise_ratios", W(["fundamentals"], O.ratios_select()))
def _ratios(i):
    return fe.pairwise_ratios(fe.per_share_features(i.fundamentals))


_STD_COLS = ["Revenue_Per_Share", "Book_Value_Per_Share", "EBIT_per_share"]


@register("standardize", W(["fundamentals"], "SELECT p.*, " + ", ".join(
    f"ROUND(({c} - m{k}) / NULLIF(s{k}, 0), 6) AS {c}_z" for k, c in enumerate(_STD_COLS)) + f" FROM ({O.per_share_select()}) p, ("
    "SELECT " + ", ".join(f"FAVG({c}) AS m{k}, STDDEV_SAMP({c}) AS s{k}" for k, c in enumerate(_STD_COLS))
    + f" FROM ({O.per_share_select()}) t WHERE Year < {SPLIT_YEAR}) st"))
def _standardize(i):
    ps = fe.per_share_features(i.fundamentals)
    return _rounded(fe.standardize(ps, _STD_COLS, fit=ps.where(F.col("Year") < SPLIT_YEAR)), **{f"{c}_z": 6 for c in _STD_COLS})


# ---------------------------------------------------------------- P6 splits and filters


@register("train_test_split_year", W(["joined"], f"""SELECT Instrument, Date, Year,
    CASE WHEN Year < {SPLIT_YEAR} THEN 'train' ELSE 'test' END AS part FROM joined"""))
def _split_year(i):
    from ..operators.regress import split_by_year
    train, test = split_by_year(i.joined, SPLIT_YEAR)
    return (train.select("Instrument", "Date", "Year", F.lit("train").alias("part"))
            .unionByName(test.select("Instrument", "Date", "Year", F.lit("test").alias("part"))))


@register("sector_filter", W(["joined"], f"SELECT * FROM joined WHERE TRBC_Economic_Sector_Name = '{SECTOR}'"))
def _sector(i):
    from ..operators.regress import sector_filter
    return sector_filter(i.joined, SECTOR)


@register("entity_filter", W(["technicals"], "SELECT * FROM technicals WHERE Instrument IN ("
                             + ", ".join(f"'{e}'" for e in ENTITIES) + ")"))
def _entities(i):
    from ..operators.regress import entity_filter
    return entity_filter(i.technicals, ENTITIES)


@register("fill_zero", W(["fundamentals_raw"], "SELECT " + ", ".join(
    f"COALESCE({c}, 0) AS {c}" if c not in ("Instrument", "Date", "Company_Common_Name", "Country_of_Headquarters",
                                            "TRBC_Economic_Sector_Name") else c for c in FUND_RAW_COLS)
    + " FROM fundamentals_raw"))
def _fill(i):
    return fill_zero(i.fundamentals_raw)


@register("scan_filter", W(["technicals"], f"""SELECT Instrument, Date, Price_Close FROM technicals
    WHERE Year >= {SPLIT_YEAR} AND Price_Close > 1000"""))
def _scan_filter(i):
    return i.technicals.where((F.col("Year") >= SPLIT_YEAR) & (F.col("Price_Close") > 1000)).select(
        "Instrument", "Date", "Price_Close")


def _by_year(i):
    return write_by_year(i.technicals, f"{shared_folder(i.spark)}/technicals-by-year-{uuid.uuid4().hex}")


@register("pruned_scan", W(["technicals"], f"""SELECT Instrument, Date, Price_Close FROM technicals
    WHERE Year >= {SPLIT_YEAR} AND Price_Close > 1000"""))
def _pruned_scan(i):
    """``scan_filter`` over a table with a folder per year: the year filter
    selects folders, the price filter reaches the files."""
    return _by_year(i).where((F.col("Year") >= SPLIT_YEAR) & (F.col("Price_Close") > 1000)).select("Instrument", "Date", "Price_Close")


@register("pruned_join", W(["joined"], f"""SELECT Instrument, Date, Year, Quarter, Price_Close, Total_Revenue FROM joined
    WHERE TRBC_Economic_Sector_Name = '{SECTOR}' AND Total_Revenue > 1000000"""))
def _pruned_join(i):
    """Daily rows of the quarters that selected statements name: the join
    tells the scan at run time which years to read."""
    from ..operators.joins import join_tech_fund
    from ..operators.regress import sector_filter
    chosen = sector_filter(i.fundamentals, SECTOR).where(F.col("Total_Revenue") > 1000000)
    return join_tech_fund(_by_year(i), chosen).select("Instrument", "Date", "Year", "Quarter", "Price_Close", "Total_Revenue")


@register("global_sort", W(["technicals_typed"], """SELECT *, ROW_NUMBER() OVER (ORDER BY Price_Close DESC NULLS LAST, Date ASC NULLS FIRST,
    Instrument, Volume ASC NULLS FIRST) - 1 AS position FROM technicals_typed"""))
def _global_sort(i):
    from ..operators.order import global_sort
    return global_sort(i.technicals_typed, F.col("Price_Close").desc_nulls_last(), F.col("Date").asc_nulls_first(), "Instrument")


@register("union_scopes", W(["joined"], f"""SELECT Instrument, Date, Price_Close, FALSE AS Tech_Only_Pred FROM joined
    WHERE Year >= {SPLIT_YEAR} UNION ALL SELECT Instrument, Date, Price_Close, TRUE AS Tech_Only_Pred FROM joined
    WHERE Year >= {SPLIT_YEAR} AND TRBC_Economic_Sector_Name = '{SECTOR}'"""))
def _union_scopes(i):
    from ..operators.regress import scope_frames
    parts = [df.select("Instrument", "Date", "Price_Close", F.lit(flag).alias("Tech_Only_Pred"))
             for flag, (_, df) in scope_frames(i.joined, SPLIT_YEAR, SECTOR).items()]
    return parts[0].unionByName(parts[1])


@register("segments_with_returns", W(["fundamentals", "quarterly"], f"""SELECT s.Instrument, s.Year, s.Quarter, s.segment,
    y.avg_price_close, y.prev_year_price, y.yearly_return FROM (
      SELECT Instrument, Year, Quarter, CAST(FLOOR(Revenue_Per_Share / 100) AS INTEGER) AS segment FROM ({O.per_share_select()}) p) s
    JOIN ({YOY_SQL}) y USING (Instrument, Year, Quarter)"""))
def _seg_returns(i):
    from ..operators.joins import join_on_period
    seg = fe.per_share_features(i.fundamentals).select(
        "Instrument", "Year", "Quarter", F.floor(F.col("Revenue_Per_Share") / 100).cast("int").alias("segment"))
    return join_on_period(seg, yoy_return(ru.quarterly_avg_price(i.technicals)))


# ---------------------------------------------------------------- P2 / P3 / P5 segments (model outputs: rows check)


@register("kmeans_segments")
def _kmeans(i):
    from ..operators.segments import kmeans_segments
    return kmeans_segments(_ratios(i))


@register("kmeans_centres")
def _kmeans_centres(i):
    from ..operators.segments import centre_rows, fit_segments
    return centre_rows(i.spark, fit_segments(_ratios(i))[0])


@register("kmeans_at_nearest", W(["fundamentals"], f"SELECT Instrument, Year, Quarter, TRUE AS at_nearest FROM ({O.ratios_select()}) r"))
def _kmeans_at_nearest(i):
    """Is each row's published centre one of the nearest? From the tables of
    centres and of assignments alone."""
    from ..operators.segments import centre_rows, fit_segments, squared_distance
    centres, scored = fit_segments(_ratios(i))
    rows = centre_rows(i.spark, centres).groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("dimension", "value"))),
                                                                            lambda c: c["value"]).alias("centre"))
    table = rows.agg(F.collect_list(F.struct("cluster", "centre")).alias("centres"))  # one row
    far = F.transform("centres", lambda c: F.struct(squared_distance(F.col("x"), c["centre"]).alias("d"), c["cluster"].alias("c")))
    own = F.filter(far, lambda f: f["c"] == F.col("cluster"))[0]["d"]
    return scored.crossJoin(F.broadcast(table)).select("Instrument", "Year", "Quarter", (own == F.array_min(F.transform(far, lambda f: f["d"]))).alias("at_nearest"))


@register("pca_features")
def _pca(i):
    from ..operators.segments import pca_features
    return pca_features(_ratios(i))


@register("pca_components")
def _pca_components(i):
    from ..operators.segments import pca_components
    return pca_components(_ratios(i))


@register("pca_orthonormal", """SELECT CAST(a AS INTEGER) AS component, CAST(b AS INTEGER) AS other, CASE WHEN a = b THEN 1.0::DOUBLE ELSE 0.0 END AS product
    FROM range(1, 6) x(a), range(1, 6) y(b)""")
def _pca_orthonormal(i):
    """Products of the published components with one another."""
    rows = _pca_components(i)
    other = rows.select(F.col("component").alias("other"), "feature", F.col("loading").alias("l2"))
    return rows.join(other, "feature").groupBy("component", "other").agg((F.round(F.abs(F.sum(F.col("loading") * F.col("l2"))), 9)).alias("product"))


@register("pca_variance", W(["fundamentals"], f"""SELECT CAST(c AS INTEGER) AS component, COUNT(*) AS n, TRUE AS variance_matches
    FROM ({O.ratios_select()}) r, range(1, 6) x(c) GROUP BY c"""))
def _pca_variance(i):
    """Does the variance of the scores equal the published variance of each
    component?"""
    from ..operators.features import KEYS, ratio_names
    from ..operators.segments import fit_components
    ratios = staged(_ratios(i), "pca-variance")
    fitted = fit_components(ratios, ratio_names())
    scores = ratios.select(*KEYS, F.posexplode(fitted.scores()).alias("p", "score"))
    got = scores.groupBy((F.col("p") + 1).alias("component")).agg(F.count("*").alias("n"), F.var_samp("score").alias("v"))
    stated = fitted.rows(i.spark).select("component", "variance").distinct()
    return got.join(stated, "component").select("component", "n", (F.abs(F.col("v") - F.col("variance")) <= 1e-9 * F.col("variance")).alias("variance_matches"))


@register("clusters_with_returns")
def _clusters_returns(i):
    from ..operators.joins import join_on_period
    from ..operators.segments import kmeans_segments
    return join_on_period(kmeans_segments(_ratios(i)), yoy_return(ru.quarterly_avg_price(i.technicals)))


@register("kmeans_sweep")
def _kmeans_sweep(i):
    from ..operators.segments import kmeans_sweep
    return kmeans_sweep(sc.value_screen(i.fundamentals, i.technicals, SCREEN), list(sc.METRICS))


@register("kmeans_silhouette")
def _kmeans_sil(i):
    from ..operators.segments import sweep_scores
    return sweep_scores(_kmeans_sweep(i), list(sc.METRICS))


_SIL = ["Revenue_Per_Share", "Book_Value_Per_Share", "EBIT_per_share"]


@register("segment_silhouette", W(["fundamentals"], f"""SELECT * FROM (WITH p AS (SELECT *, CAST(FLOOR(Revenue_Per_Share / 400) AS INTEGER) AS segment,
      ROW_NUMBER() OVER () AS id FROM ({O.per_share_select()}) f),
    d AS (SELECT a.id, a.segment, b.segment AS other, COUNT(*) AS n, SUM({' + '.join(f'(a.{c} - b.{c}) * (a.{c} - b.{c})' for c in _SIL)}) AS total
          FROM p a, p b WHERE a.id <> b.id GROUP BY a.id, a.segment, b.segment),
    m AS (SELECT id, segment, MAX(CASE WHEN other = segment THEN total / n END) AS a, MIN(CASE WHEN other <> segment THEN total / n END) AS b
          FROM d GROUP BY id, segment)
    SELECT segment, COUNT(*) AS n, ROUND(AVG(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / GREATEST(a, b) END), 6) AS silhouette FROM m GROUP BY segment) z"""))
def _segment_silhouette(i):
    """Silhouette of plain value bands; its SQL goes through all pairs."""
    from ..operators.segments import silhouette_rows
    rows = fe.per_share_features(i.fundamentals).select(F.floor(F.col("Revenue_Per_Share") / 400).cast("int").alias("segment"),
                                                        F.array(*_SIL).alias("x"))
    scored = silhouette_rows(rows, "x", "segment")
    return scored.groupBy("segment").agg(F.count("*").alias("n"), F.round(F.avg("silhouette"), 6).alias("silhouette"))


# ---------------------------------------------------------------- P6 linear model


def _lasso(i):
    from ..operators.regress import lasso_scopes
    return lasso_scopes(i.joined, SPLIT_YEAR, SECTOR)


_FEATURES = [c for c in JOINED_COLS if c not in NON_FEATURES and c != TARGET]
_SCOPE_SQL = f"SELECT * FROM (VALUES (FALSE), (TRUE)) s(Tech_Only_Pred), (VALUES {', '.join(f'({c!r})' for c in _FEATURES)}) f(feature)"


@register("lasso_fit_summary")
def _lasso_summary(i):
    return _lasso(i)[0]


@register("lasso_coefficients")
def _lasso_coefficients(i):
    return _lasso(i)[1]


#: How far a coefficient's gradient may be from the optimum, as a share of the penalty.
OPTIMAL_WITHIN = 0.01


@register("lasso_optimality", f"SELECT Tech_Only_Pred, feature, TRUE AS optimal FROM ({_SCOPE_SQL}) t")
def _lasso_optimality(i):
    """Does each published coefficient satisfy the optimality condition of
    the penalised problem on the training rows?"""
    return _lasso(i)[1].select("Tech_Only_Pred", "feature", (F.col("residual") <= OPTIMAL_WITHIN).alias("optimal"))


_CORR = [c for c in _FEATURES if c not in ("Quarter",)] + [TARGET]


@register("feature_correlations", W(["joined"], f"""SELECT split_part(pair, '|', 1) AS feature, split_part(pair, '|', 2) AS other, n,
    ROUND(correlation, 6) AS correlation FROM (UNPIVOT (SELECT COUNT(*) AS n, """ + ", ".join(
        f'CORR({a}, {b}) AS "{a}|{b}"' for k, a in enumerate(_CORR) for b in _CORR[k + 1:]) + f""" FROM (SELECT {", ".join(
        f"COALESCE({c}, 0)::FLOAT::DOUBLE AS {c}" for c in _CORR)} FROM joined WHERE Year < {SPLIT_YEAR}) j) ON COLUMNS(* EXCLUDE (n))
    INTO NAME pair VALUE correlation) u"""))
def _feature_correlations(i):
    from ..operators.gram import correlations
    from ..operators.regress import prepare
    rows = prepare(i.joined.where(F.col("Year") < SPLIT_YEAR), _CORR[:-1])
    return _rounded(correlations(rows, _CORR), correlation=6)


@register("lasso_predictions")
def _lasso_pred(i):
    from ..operators.regress import number_rows
    return number_rows(_lasso(i)[2])


@register("lasso_entity_scores")
def _lasso_scores(i):
    from ..operators.regress import regression_metrics
    return regression_metrics(_lasso(i)[2], "Price_Close", "prediction", by=("Tech_Only_Pred", "Instrument"))


# ---------------------------------------------------------------- P7 dense model (rows check)

DENSE_EPOCHS = 25


@register("dense_entity_scores")
def _dense_scores(i):
    from ..operators.dense import dense_scope
    from ..operators.regress import regression_metrics
    pred, _ = dense_scope(i.joined, SPLIT_YEAR, SECTOR, epochs=DENSE_EPOCHS)
    return regression_metrics(pred, "Price_Close", "prediction")


@register("dense_training_history")
def _dense_history(i):
    from ..operators.dense import dense_scope
    return dense_scope(i.joined, SPLIT_YEAR, SECTOR, epochs=DENSE_EPOCHS)[1]


# ---------------------------------------------------------------- P8 forecaster (rows check)


def _forecast(i, **changed):
    # as the reference: daily rows with the ten statement measures as further
    # inputs, at its windows; the series that are long enough are countries'
    from ..operators.forecast import forecast_entities
    return forecast_entities(i.countries, replace(FORECAST, **changed), BLOCKS, exog=fe.PER_SHARE_MEASURES)


@register("entity_forecast")
def _entity_forecast(i):
    from ..operators.forecast import entity_forecast_result
    res, _ = _forecast(i)
    return entity_forecast_result(res)


@register("forecast_vs_actual")
def _forecast_vs_actual(i):
    return _forecast(i)[1]


@register("forecast_actuals", W(["country_seq"], f"""SELECT Instrument, CASE WHEN block_id < nt + ns THEN 'test' ELSE 'val' END AS split,
    block_id * {BLOCKS.window} AS block_start, seq - block_id * {BLOCKS.window} AS h, Date, Price_Close AS actual, seq AS row_number FROM (
      SELECT *, CAST(CEIL((nb - nt) * {BLOCKS.test_frac_of_rest}) AS BIGINT) AS ns FROM (
        SELECT *, seq // {BLOCKS.window} AS block_id, n_rows // {BLOCKS.window} AS nb,
               CAST(FLOOR(n_rows // {BLOCKS.window} * {BLOCKS.train_frac}) AS BIGINT) AS nt FROM country_seq) a) b
    WHERE block_id >= nt AND block_id < nb AND seq - block_id * {BLOCKS.window} < {FORECAST.n_out}"""))
def _forecast_actuals(i):
    from ..operators.forecast import block_bounds, walk_forward_timeline
    return walk_forward_timeline(block_bounds(sq.sequence_index(i.countries), BLOCKS.window, BLOCKS), FORECAST.n_out, BLOCKS.window)


@register("forecast_coverage", W(["country_seq"], f"""SELECT Instrument, n_rows, 0 AS rows_left_out,
    GREATEST(nb * {BLOCKS.window} - {_SPAN} + 1, 0) AS n_samples, COUNT_IF(evaluated) AS n_eval_days,
    COUNT_IF(evaluated AND block_id * {BLOCKS.window} >= {_NI}
      AND (CASE WHEN block_id < nt + ns THEN nt ELSE nt + ns END) * {BLOCKS.window} >= {_SPAN}) AS n_predicted_days FROM (
      SELECT *, block_id >= nt AND block_id < nb AND seq - block_id * {BLOCKS.window} < {_NO} AS evaluated FROM (
        SELECT *, CAST(CEIL((nb - nt) * {BLOCKS.test_frac_of_rest}) AS BIGINT) AS ns FROM (
          SELECT *, seq // {BLOCKS.window} AS block_id, n_rows // {BLOCKS.window} AS nb,
                 CAST(FLOOR(n_rows // {BLOCKS.window} * {BLOCKS.train_frac}) AS BIGINT) AS nt FROM country_seq) a) b) d
    GROUP BY Instrument, n_rows, nb"""))
def _forecast_coverage(i):
    return _forecast(i)[0].select("Instrument", "n_rows", "rows_left_out", "n_samples", "n_eval_days", "n_predicted_days")


@register("entity_forecast_window")
def _entity_forecast_window(i):
    """All twelve channels on all 360 days."""
    from ..operators.forecast import entity_forecast_result
    res, _ = _forecast(i, channels="window")
    return entity_forecast_result(res)
