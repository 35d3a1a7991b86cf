import hashlib
import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
from test_joins import brute_contamination, brute_lines  # noqa: E402
from test_ngram_join import brute  # noqa: E402
from test_tokens import library  # noqa: E402

from tickframe.llm import lines, quality  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_pipeline_against_brute_force(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = corpus_pipeline.quality_stage(spark, given, SF)
    assert kept.columns == given.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    judged = {r.doc_id: r.quality for r in labels.collect()}
    assert sum((d in texts) == bool(q) for d, q in judged.items()) / len(judged) > 0.9
    steps = dict(corpus_pipeline.STAGES)
    after = {r.doc_id: r.text for r in steps["lines"](spark, kept, SF).collect()}
    want = brute_lines(list(texts.items()), lines.THRESHOLD)
    nothing = {hashlib.sha256(("\n" * n).encode()).hexdigest() for n in range(1000)}
    emptied = {d for d, (n, h) in want.items() if n and h in nothing}
    assert emptied and {d: hashlib.sha256(t.encode()).hexdigest() for d, t in after.items()} == {d: h for d, (_, h) in want.items() if d not in emptied}
    one = {d for d, (_, c) in brute(list(after.items())).items() if c == d}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {d for d, x in brute_contamination([(d, after[d]) for d in one], items).items() if not x[1]}
    rows = corpus_pipeline.run(spark, SF).collect()
    own = library()
    assert {r.doc_id for r in rows} == clean and all(r.n_tokens for r in rows)
    first: dict[str, int] = {}
    for d, t in sorted(texts.items()):
        first.setdefault(t, d)
    copies = {d for d, t in texts.items() if first[t] != d}
    assert copies and not copies & {r.doc_id for r in rows}
    for r in rows:
        ids = own.encode_ordinary(after[r.doc_id])
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(after[r.doc_id].encode()).hexdigest()


def test_quality_cases(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rules = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    odd = spark.createDataFrame([(1, None, 0.5), (1, None, 0.5), (2, "", 1.0), (None, "word " * 50_000, 2.0)], "doc_id long, text string, stat double")
    rows = quality.report(quality.score(odd, rules)).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert quality.keep(odd, rules, 0.0).columns == odd.columns and quality.keep(odd, rules, 0.0).count() == 4
    assert quality.score(odd.limit(0), rules).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.score(odd, quality.fit(docs, none)).select(F.min("score"), F.max("score")).first() == (0.5, 0.5)


def test_tree_paths():
    dump = "Forest\n  Tree 0 (weight 1.0):\n    If (feature 0 <= 2.5)\n     If (feature 0 <= 1.5)\n      Predict: 0.0\n     Else (feature 0 > 1.5)\n      Predict: 1.0\n    Else (feature 0 > 2.5)\n     Predict: 1.0\n"
    first = quality.STATS[0]
    assert set(quality.tree_rules(dump)) == {((first, True, 2.5),), ((first, True, 1.5),), ((first, False, 1.5), (first, True, 2.5)), ((first, False, 2.5),)}


def test_fit_runs_few_tasks_a_job(spark):
    """The sample's partitions don't follow those of the documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(64)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    tracker, group = spark.sparkContext.statusTracker(), "few tasks"
    spark.sparkContext.setJobGroup(group, group)
    try:
        quality.fit(docs, labels)
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
    wide = [s for s in stages if s and s.numTasks > 2 * quality.FIT_TASKS]
    assert len(stages) > 50 and len(wide) < 10
