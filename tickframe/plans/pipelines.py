"""End-to-end jobs (P1-P9): the reference's scripts as parameterised Spark
jobs that read tables and write tables. Intermediate results are written
and read back, which cuts lineage at stage boundaries (a lost executor only
re-runs the current job) and lets later jobs prune by ``Year``.

    python -m tickframe.plans.pipelines all --fixture /root/testdata/sf0.01 --out /shared/run1
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ..operators import baseline as bl
from ..operators import profile as pr
from ..operators.cleaning import clean_fundamentals, clean_technicals
from ..operators.features import PER_SHARE_MEASURES, pairwise_ratios, per_share_features
from ..operators.joins import join_on_period, join_tech_fund
from ..operators.rollup import quarterly_avg_price
from ..operators.returns import yoy_return
from ..operators.screen import METRICS, value_screen
from ..sources.sinks import write_by_key, write_csv, write_table
from ..sources.staging import staged
from ..specs import FUNDAMENTALS, TECHNICALS, ForecastParams, ScreenParams, SplitParams


def _profiles(name: str, df: DataFrame, or_cols, out: str, stage: str) -> None:
    """Both profiles from one pass over the table."""
    patterns = staged(pr.null_patterns(df), "null-patterns")
    write_table(pr.column_profile(patterns, df.columns), f"{out}/profile/{stage}_{name}_columns")
    write_table(pr.row_profile(patterns, df.columns, or_cols), f"{out}/profile/{stage}_{name}_any")


def profile_clean_join(spark: SparkSession, technicals_raw: DataFrame, fundamentals_raw: DataFrame, out: str,
                       one_per_quarter: bool = False) -> dict:
    """Profile -> clean -> profile -> join -> profile. Cleaned tables and
    the joined fact are written partitioned by ``Year``."""
    _profiles("technicals", technicals_raw, TECHNICALS.or_cols, out, "raw")
    _profiles("fundamentals", fundamentals_raw, FUNDAMENTALS.or_cols, out, "raw")
    paths = {"technicals": f"{out}/technicals_cleaned", "fundamentals": f"{out}/fundamentals_cleaned",
             "combined": f"{out}/combined_technicals_fundamentals"}
    by = ("Instrument", "Date")
    write_table(clean_technicals(technicals_raw), paths["technicals"], partition_by=("Year",), sort_within=by)
    write_table(clean_fundamentals(fundamentals_raw, one_per_quarter=one_per_quarter), paths["fundamentals"],
                partition_by=("Year",), sort_within=by)
    tech, fund = spark.read.parquet(paths["technicals"]), spark.read.parquet(paths["fundamentals"])
    _profiles("technicals", tech, TECHNICALS.or_cols, out, "clean")
    _profiles("fundamentals", fund, FUNDAMENTALS.or_cols, out, "clean")
    write_table(join_tech_fund(tech, fund), paths["combined"], partition_by=("Year",), sort_within=by)
    _profiles("combined", spark.read.parquet(paths["combined"]), (), out, "joined")
    return paths


def segment_statements(fund: DataFrame, out: str, k: int = 5, seed: int = 1) -> str:
    """Per-share features, pairwise ratios, min-max, PCA, k-means; the
    centres are written too."""
    from ..operators.segments import centre_rows, fit_segments

    path = f"{out}/k_means_data"
    centres, scored = fit_segments(pairwise_ratios(per_share_features(fund)), k=k, seed=seed)
    write_table(scored.drop("x"), path)
    write_table(centre_rows(fund.sparkSession, centres), f"{out}/k_means_centres")
    return path


def segment_returns(tech: DataFrame, clusters: DataFrame, out: str, calendar: bool = False) -> str:
    """Quarterly mean price, year-over-year return, joined to clusters."""
    path = f"{out}/clustered_data_with_historical_returns"
    write_table(join_on_period(clusters, yoy_return(quarterly_avg_price(tech), calendar=calendar)), path)
    return path


def screen(fund: DataFrame, tech: DataFrame, out: str, params: ScreenParams = ScreenParams()) -> str:
    """Eight value tests per entity."""
    path = f"{out}/graham_metrics"
    write_table(value_screen(fund, tech, params), path)
    return path


def screen_clusters(metrics: DataFrame, out: str, ks=(2, 8, 15, 25, 45), seed: int = 1) -> dict:
    """P5: k-means for each k over the flags; assignments partitioned by k,
    silhouette per k as a table."""
    from ..operators.segments import kmeans_sweep, sweep_scores

    paths = {"assignments": f"{out}/graham_metrics_clustering", "silhouette": f"{out}/graham_metrics_silhouette"}
    write_by_key(kmeans_sweep(metrics, list(METRICS), ks=ks, seed=seed), paths["assignments"], key="k")
    write_table(sweep_scores(metrics.sparkSession.read.parquet(paths["assignments"]), list(METRICS)), paths["silhouette"])
    return paths


def linear_model(combined: DataFrame, out: str, split_year: int = 2018, sector: str = "Technology",
                 entities=None) -> dict:
    """Lasso for all entities and for one sector; per-row results,
    per-entity scores and the fit summaries."""
    from ..operators.regress import lasso_scopes, number_rows, regression_metrics

    summary, coefficients, pred = lasso_scopes(combined, split_year, sector, entities=entities)
    paths = {"results": f"{out}/Lin_Reg_Results", "scores": f"{out}/Lin_Reg_Scores",
             "summary": f"{out}/Lin_Reg_Summary", "coefficients": f"{out}/Lin_Reg_Coefficients"}
    write_table(number_rows(pred), paths["results"])
    write_table(regression_metrics(pred, "Price_Close", "prediction", by=("Tech_Only_Pred", "Instrument")),
                paths["scores"])
    write_table(summary, paths["summary"])
    write_table(coefficients, paths["coefficients"])
    return paths


def dense_model(combined: DataFrame, out: str, split_year: int = 2018, sector: str = "Technology",
                epochs: int = 25) -> str:
    """Sector-trained dense regressor, scored per entity."""
    from ..operators.dense import dense_scope
    from ..operators.regress import regression_metrics

    path = f"{out}/DNN_Model_Results"
    pred, history = dense_scope(combined, split_year, sector, epochs=epochs)
    write_table(history, f"{out}/DNN_Training_History")
    write_table(regression_metrics(pred, "Price_Close", "prediction"), path)
    return path


def forecast(combined: DataFrame, out: str, params: ForecastParams = ForecastParams(),
             single_csv: bool = False, exog=PER_SHARE_MEASURES) -> dict:
    """Per-entity forecasts from the joined daily rows (close, volume and
    the statement measures in ``exog``) and the predicted-vs-actual days;
    the result table is also written as CSV with a header, as the reference
    did."""
    from ..operators.forecast import entity_forecast_result, forecast_entities

    res, details = forecast_entities(combined, params, SplitParams(window=params.block), exog=exog)
    result = entity_forecast_result(res)
    paths = {"results": f"{out}/forecast_results", "csv": f"{out}/forecast_csv",
             "details": f"{out}/forecast_vs_actual"}
    write_table(result, paths["results"])
    write_csv(result.sparkSession.read.parquet(paths["results"]), paths["csv"], single_file=single_csv)
    write_table(details, paths["details"])
    return paths


def growth_baseline(prices: DataFrame, out: str) -> str:
    """Average-growth baseline and its per-entity errors, over the rows
    of ``baseline.test_rows``; daily prices of all years work too."""
    path = f"{out}/growth_baseline_errors"
    write_table(bl.growth_baseline_error(bl.growth_baseline(prices)), path)
    return path


def run_all(spark: SparkSession, technicals_raw: DataFrame, fundamentals_raw: DataFrame, out: str,
            screen_params: ScreenParams = ScreenParams(), split_year: int = 2018, sector: str = "Technology",
            forecast_params: ForecastParams = ForecastParams(), dense_epochs: int = 25) -> dict:
    """The reference's job order: P1, then P2-P9 over the written tables."""
    p = profile_clean_join(spark, technicals_raw, fundamentals_raw, out)
    tech, fund = spark.read.parquet(p["technicals"]), spark.read.parquet(p["fundamentals"])
    comb = spark.read.parquet(p["combined"])
    p["k_means"] = segment_statements(fund, out)
    p["returns"] = segment_returns(tech, spark.read.parquet(p["k_means"]), out)
    p["screen"] = screen(fund, tech, out, screen_params)
    p.update(screen_clusters(spark.read.parquet(p["screen"]), out))
    p.update(linear_model(comb, out, split_year, sector))
    p["dense"] = dense_model(comb, out, split_year, sector, epochs=dense_epochs)
    p.update(forecast(comb, out, forecast_params))
    p["baseline"] = growth_baseline(bl.test_rows(comb, split_year), out)
    return p


def run_job(spark: SparkSession, job: str, out: str, screen_params: ScreenParams = ScreenParams(),
            split_year: int = 2018, sector: str = "Technology",
            forecast_params: ForecastParams = ForecastParams(), dense_epochs: int = 25):
    """Run one of P2-P9 over the tables P1 wrote under ``out``."""
    read = spark.read.parquet
    tech = read(f"{out}/technicals_cleaned")
    fund = read(f"{out}/fundamentals_cleaned")
    comb = read(f"{out}/combined_technicals_fundamentals")
    if job == "p2":
        return segment_statements(fund, out)
    if job == "p3":
        return segment_returns(tech, read(f"{out}/k_means_data"), out)
    if job == "p4":
        return screen(fund, tech, out, screen_params)
    if job == "p5":
        return screen_clusters(read(f"{out}/graham_metrics"), out)
    if job == "p6":
        return linear_model(comb, out, split_year, sector)
    if job == "p7":
        return dense_model(comb, out, split_year, sector, epochs=dense_epochs)
    if job == "p8":
        return forecast(comb, out, forecast_params)
    if job == "p9":
        return growth_baseline(bl.test_rows(comb, split_year), out)
    raise ValueError(f"unknown job {job}")


def main(argv=None):
    ap = argparse.ArgumentParser(description="Run the analytics jobs.")
    ap.add_argument("job", choices=["all", "p1", "p2", "p3", "p4", "p5", "p6", "p7", "p8", "p9"],
                    help="p1 cleans and joins; p2-p9 read the tables p1 wrote under --out")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--fixture", help="build the raw tables from the TPC-H style tables in this folder")
    ap.add_argument("--technicals", help="raw daily table: a path, or a table name for connector formats")
    ap.add_argument("--fundamentals", help="raw statement table: a path, or a table name")
    ap.add_argument("--format", default="parquet", help="any Spark source (parquet, orc, csv, a warehouse connector)")
    ap.add_argument("--option", action="append", default=[], help="reader option key=value (repeatable)")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if a.job not in ("all", "p1"):
        print(run_job(spark, a.job, a.out))
        return
    if a.fixture:
        from ..sources.fixtures import fundamentals_raw, technicals_raw
        from .inputs import FORECAST, SCREEN, SECTOR, SPLIT_YEAR
        tr, fr = technicals_raw(spark, a.fixture), fundamentals_raw(spark, a.fixture)
        kw = dict(screen_params=SCREEN, split_year=SPLIT_YEAR, sector=SECTOR, forecast_params=FORECAST)
    else:
        opts = dict(o.split("=", 1) for o in a.option)

        def read(target):
            r = spark.read.format(a.format).options(**opts)
            return r.option("table", target).load() if a.format not in ("parquet", "orc", "csv", "json") \
                else r.load(target)

        tr, fr, kw = read(a.technicals), read(a.fundamentals), {}
    if a.job == "p1":
        print(profile_clean_join(spark, tr, fr, a.out))
    else:
        print(run_all(spark, tr, fr, a.out, **kw))


if __name__ == "__main__":
    main()
