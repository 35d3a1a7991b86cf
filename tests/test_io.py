import datetime as dt
import os

from tickframe.sources import write_by_key, write_csv, write_table
from tickframe.sources.tables import drop_view, load_table, read_csv_checked, read_csv_typed, register_view, write_by_year
from tickframe.streaming import start_clean_stream


def test_sinks_round_trip(spark, scratch):
    df = spark.createDataFrame([("S1", 2019, 1.5), ("S2", 2020, 2.5)], "Instrument string, Year int, v double")
    write_table(df, f"{scratch}/t.parquet", partition_by=("Year",))
    back = load_table(spark, scratch, "t")
    assert sorted((r.Instrument, r.Year, r.v) for r in back.collect()) == [("S1", 2019, 1.5), ("S2", 2020, 2.5)]
    write_csv(df, f"{scratch}/c", single_file=True)
    assert len([f for f in os.listdir(f"{scratch}/c") if f.endswith(".csv")]) == 1
    again = read_csv_typed(spark, f"{scratch}/c", "Instrument string, Year int, v double")
    assert again.count() == 2
    write_by_key(df.withColumnRenamed("Year", "k"), f"{scratch}/k")
    assert sorted(d for d in os.listdir(f"{scratch}/k") if d.startswith("k=")) == ["k=2019", "k=2020"]
    register_view(df, "tf_view")
    assert spark.sql("select count(*) c from tf_view").first().c == 2
    assert drop_view(spark, "tf_view")


def test_streaming_clean(spark, scratch):
    src = f"{scratch}/in"
    raw = spark.createDataFrame([("S1", "2019-03-01", "12.5", 1.0), ("S1", "2019-03-02", "n/a", 1.0),
                                 ("S2", None, "3", 1.0)],
                                "Instrument string, Date string, Price_Close string, Volume double")
    raw.write.parquet(src)
    q = start_clean_stream(spark, src, f"{scratch}/out", f"{scratch}/ckpt", raw.schema)
    q.awaitTermination(120)
    out = spark.read.parquet(f"{scratch}/out").collect()
    assert [(r.Instrument, r.Date, r.Price_Close, r.Quarter, r.Year) for r in out] == \
        [("S1", dt.date(2019, 3, 1), 12.5, 1, 2019)]


def test_checked_csv_keeps_what_it_rejects(spark, scratch):
    os.mkdir(f"{scratch}/c")
    with open(f"{scratch}/c/a.csv", "w") as f:
        f.write("id,Instrument,Date,Price_Close\n1,S1,2020-01-02,1.5\n2,S2,,n/a\n3,S3,2020-01-03\n4,S4,,\n5,S5,not a day,2.5\n6,S6,2020-01-04,3.5,9\n")
    good, bad = read_csv_checked(spark, f"{scratch}/c", "id long, Instrument string, Date date, Price_Close double")
    assert sorted((r.id, r.Price_Close) for r in good.collect()) == [(1, 1.5), (4, None)]
    assert {r.id: r._line for r in bad.collect()} == {2: "2,S2,,n/a", 3: "3,S3,2020-01-03", 5: "5,S5,not a day,2.5", 6: "6,S6,2020-01-04,3.5,9"}
    # the same rows fit whichever columns are asked for
    assert good.select("Instrument").count() == 2 and bad.select("_line").count() == 4 and good.count() + bad.count() == 6


def test_year_folders_are_pruned(spark, scratch):
    rows = [("S%d" % (i % 5), "%d-0%d-11" % (2015 + i % 6, 1 + i % 9), float(i)) for i in range(300)] + [("S1", None, 1.0), ("S1", "x", 2.0)]
    df = spark.createDataFrame(rows, "Instrument string, Date string, Price_Close double")
    scan = write_by_year(df, f"file://{scratch}/y")
    assert scan.count() == 302 and scan.where("Year IS NULL").count() == 2 and os.path.isdir(f"{scratch}/y/Year=2019")
    plan = scan.where("Year >= 2019 AND Price_Close > 100").select("Instrument")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan and "GreaterThan(Price_Close,100.0)" in plan and "ReadSchema: struct<Instrument:string,Price_Close:double>" in plan
    # a join with a filtered small side selects folders at run time
    small = spark.createDataFrame([(2016, "a"), (2017, "b")], "Year int, tag string")
    small.write.parquet(f"{scratch}/s")
    plan = scan.join(spark.read.parquet(f"{scratch}/s").where("tag = 'b'"), "Year")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
