import os

import pytest

from tickframe.plans import pipelines as pl
from tickframe.plans.inputs import FORECAST, SCREEN, SECTOR, SPLIT_YEAR
from tickframe.sources.fixtures import fundamentals_raw, technicals_raw

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_all_jobs_end_to_end(spark, scratch):
    p = pl.run_all(spark, technicals_raw(spark, SF), fundamentals_raw(spark, SF), scratch, SCREEN, SPLIT_YEAR,
                   SECTOR, FORECAST, dense_epochs=1)
    read = spark.read.parquet
    assert read(p["combined"]).count() == 3637
    assert read(p["technicals"]).count() == 3911 and read(p["fundamentals"]).count() == 260
    assert any(d.startswith("Year=") for d in os.listdir(p["combined"]))
    assert read(p["screen"]).count() == 10
    assert read(p["k_means"]).count() == 235
    assert read(p["silhouette"]).count() == 5
    assert read(p["results"]).count() == read(p["baseline"]).count()
    assert read(f"{scratch}/profile/raw_fundamentals_columns").count() == 22
    # partition pruning reaches the scan of the written fact
    plan = read(p["combined"]).where("Year = 2000")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan
    # the screen's year bounds reach the written tables as partition filters
    from tickframe.operators.screen import screen_inputs
    scr = screen_inputs(read(p["fundamentals"]), read(p["technicals"]), SCREEN)
    plan = scr._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(Year") >= 2
    # a single job re-run over the written tables
    assert pl.run_job(spark, "p9", scratch, split_year=SPLIT_YEAR) == p["baseline"]
    assert read(p["baseline"]).count() > 0
