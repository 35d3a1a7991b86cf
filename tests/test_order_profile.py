import random

from pyspark.sql import functions as F

from tickframe.operators import profile as pr
from tickframe.operators.order import global_sort


def test_global_sort_positions(spark):
    r = random.Random(1)
    rows = [(r.choice([None, 1.0, 2.0, float("nan"), -1.0]), r.choice(["a", "b", None]), i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "x double, s string, k int").repartition(6)
    got = sorted(global_sort(df, F.col("x").desc_nulls_last(), F.col("s").asc_nulls_first()).collect(), key=lambda t: t.position)
    assert [t.position for t in got] == list(range(500))
    def place(v):  # NaN is the largest number
        return 9 if v is None else 0 if v != v else 1 - v / 10
    key = [(place(t.x), t.s is not None, t.s or "", t.k) for t in got]
    assert key == sorted(key)
    named = sorted(global_sort(df, "k", position="at").collect(), key=lambda t: t["at"])
    assert [t.k for t in named] == sorted(t.k for t in named)
    assert global_sort(df.limit(0), "k").count() == 0


def test_ties_and_repeated_rows_have_one_position_each(spark):
    df = spark.createDataFrame([("same", 1)] * 40 + [("other", 1)] * 3, "a string, b int").repartition(5)
    got = global_sort(df, "b").collect()
    assert sorted(t.position for t in got) == list(range(43)) and {t.position for t in got if t.a == "other"} == {0, 1, 2}


def test_patterns_answer_every_profile(spark):
    r = random.Random(2)
    cols = [f"c {i}" for i in range(130)]  # three words of bits
    rows = [[None if r.random() < 0.02 else i for i in range(130)] for _ in range(300)] + [[0] * 130, [None] * 130]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` int" for c in cols)).repartition(4)
    counts = {p.column_name: (p.nulls, p.total_rows) for p in pr.null_profile(df).collect()}
    assert counts == {c: (sum(row[i] is None for row in rows), 302) for i, c in enumerate(cols)}
    subset = [cols[0], cols[61], cols[129]]
    one = pr.null_profile_any(df, subset).first()
    assert one.any_null_rows == sum(any(v is None for v in row) for row in rows)
    assert one.subset_null_rows == sum(any(row[i] is None for i in (0, 61, 129)) for row in rows)
    assert pr.null_profile_any(df, [cols[0]]).first().subset_null_rows is None
    empty = pr.null_profile_any(df.limit(0), subset).first()
    assert (empty.total_rows, empty.any_null_rows, empty.any_null_pct) == (0, 0, None)
    assert {(p.nulls, p.null_pct) for p in pr.null_profile(df.limit(0)).collect()} == {(0, None)}


def test_one_pass_over_the_rows(spark, scratch):
    spark.range(100).selectExpr("id", "IF(id % 3 = 0, NULL, id) AS v").write.parquet(f"{scratch}/t")
    df = spark.read.parquet(f"{scratch}/t")
    for profile in (pr.null_profile(df), pr.null_profile_any(df, ["id", "v"])):
        plan = profile._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1
