"""Quality classifier: a sparse ensemble of rules over text statistics.

A forest is grown on a bounded sample of labelled rows; every path from its
roots becomes a conjunctive rule over the statistics; a lasso logistic
regression gives the rules weights, most of them zero; the rules that stay
are compiled into one Spark column expression, which scores every document.
Only the statistics of the text are inputs.

The statistics of a row are counted on its UTF-8 bytes, vectorised over
slices of Arrow batches.

Cases: a null text counts as empty and is scored as such; every row,
repeated or with a null doc_id, has its own score; an empty table gives no
rows; other columns play no part. Without labelled rows, or with rows of one
label only, the score is the smoothed share of label 1.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import release, stage, whole_texts
from .shingles import slices, utf8, word_hashes

#: Labelled rows that a fit takes at most, those of smallest hash.
FIT_ROWS = 20_000
TREES, DEPTH, LASSO = 24, 4, 0.001
#: Tasks of each of the fit's jobs. The sample is a few MB at most, whatever
#: the number of files it came from.
FIT_TASKS = 4
#: Bytes of text whose statistics are counted at once.
SLICE_BYTES = 1 << 19
KEEP_SCORE = 0.7

STATS = tuple(f"stat_{x}" for x in ("log_words", "word_bytes", "upper", "digit", "mark", "pipe", "bang", "stop", "unique", "repeat", "pair_repeat", "line_bytes", "control"))

_UPPER, _DIGIT, _MARK, _STOP = np.arange(65, 91), np.arange(48, 58), [ord(c) for c in "#$%&*@^~<>{}[]=_\\"], [ord(c) for c in ".,;:?"]


def _table(codes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[codes] = True
    return t


_CLASSES = [_table(c) for c in (_UPPER, _DIGIT, _MARK, [ord("|")], [ord("!")], _STOP)]


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def statistics_of(texts: pa.Array) -> np.ndarray:
    """One row of STATS for each text."""
    data, at = utf8(texts)
    words, word_at = word_hashes(texts)
    n_bytes, n_words = np.diff(at).astype(float), np.diff(word_at).astype(float)
    bytes_, words_ = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    space = _per_row(np.isin(data, [9, 10, 11, 12, 13, 32]), at)
    letters = np.maximum(_per_row((data >= 128) | ((data | 32) >= 97) & ((data | 32) <= 122), at), 1)
    upper, digit, mark, pipe, bang, stop = (_per_row(c[data], at) for c in _CLASSES)
    rows = np.repeat(np.arange(len(texts)), np.diff(word_at))

    def distinct(values, rows):
        order = np.lexsort((values, rows))
        v, r = values[order], rows[order]
        fresh = np.ones(len(v), bool)
        fresh[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
        return np.bincount(r[fresh], minlength=len(texts)).astype(float)

    same_row = rows[1:] == rows[:-1]
    pairs = (words[1:] * np.uint64(3) + words[:-1])[same_row]
    n_pairs = np.maximum(np.bincount(rows[1:][same_row], minlength=len(texts)), 1)
    repeat = np.bincount(rows[1:][same_row & (words[1:] == words[:-1])], minlength=len(texts))
    lines = _per_row(data == 10, at) + 1
    word_bytes = (n_bytes - space) / words_
    return np.column_stack([
        np.log1p(n_words), word_bytes, upper / letters, digit / bytes_, mark / words_, pipe / words_, bang / words_, stop / words_,
        distinct(words, rows) / words_, repeat / n_pairs, 1 - distinct(pairs, rows[1:][same_row]) / n_pairs, np.log1p(n_bytes / lines),
        _per_row(data < 9, at) / bytes_])


def with_statistics(rows: DataFrame, returned: list[str]) -> DataFrame:
    """The ``returned`` columns of ``rows`` and the statistics of ``text``."""
    kept = StructType([rows.schema[c] for c in returned])
    schema = StructType([*kept.fields, *(StructField(c, DoubleType()) for c in STATS)])
    read = returned if "text" in returned else [*returned, "text"]

    def tasks(batches):
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(texts, SLICE_BYTES):
                stats = statistics_of(texts.slice(a, b - a))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in returned), *(pa.array(np.ascontiguousarray(x)) for x in stats.T)],
                                                 [*returned, *STATS])

    return rows.select(*read).mapInArrow(tasks, schema)


@dataclass(frozen=True)
class Rules:
    """Weighted conjunctions of (statistic, at most?, limit), and a bias."""

    bias: float
    rules: tuple[tuple[float, tuple[tuple[str, bool, float], ...]], ...]

    def score(self) -> Column:
        total = F.lit(self.bias)
        for weight, terms in self.rules:
            total = total + F.when(_holds(terms), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _holds(terms) -> Column:
    out = F.lit(True)
    for name, low, limit in terms:
        out = out & ((F.col(name) <= limit) if low else (F.col(name) > limit))
    return out


def tree_rules(dump: str) -> list[tuple[tuple[str, bool, float], ...]]:
    """Every path from a root in Spark's text form of a forest, as a
    conjunction in which a statistic has one lower and one upper limit."""
    found: dict[tuple, None] = {}
    path: list[tuple[int, tuple[str, bool, float]]] = []
    for line in dump.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, (STATS[int(m[2])], m[3] == "<=", float(m[4])))]
        limits: dict[tuple[str, bool], float] = {}
        for _, (name, low, limit) in path:
            old = limits.get((name, low), limit)
            limits[name, low] = min(old, limit) if low else max(old, limit)
        found[tuple(sorted((name, low, limit) for (name, low), limit in limits.items()))] = None
    return list(found)


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def _dealt(sample: DataFrame) -> DataFrame:
    """``sample`` in few partitions: a fit runs hundreds of short jobs, each
    with a task for every partition. Ordered, so that a model depends on the
    rows alone."""
    return sample.orderBy("label", *STATS).coalesce(FIT_TASKS)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Rules:
    """Rules from labelled rows that are not held out: at most ``fit_rows``
    of them, those whose doc_id has the smallest hash."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("long").alias("label"))
              .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~is_held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    sample = stage(with_statistics(whole_texts(docs).join(F.broadcast(chosen), "doc_id"), ["label"]), "quality-sample")
    rows = _dealt(sample).persist()
    try:
        sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
        if len(sizes) < 2:
            share = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
            return Rules(math.log(share / (1 - share)), ())
        assembled = VectorAssembler(inputCols=list(STATS), outputCol="x").transform(rows)
        forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=11, featureSubsetStrategy="onethird").fit(assembled)
        paths = tree_rules(forest.toDebugString)
        if not paths:
            share = sizes[1] / sum(sizes.values())
            return Rules(math.log(share / (1 - share)), ())
        flags = [F.when(_holds(p), 1.0).otherwise(0.0).alias(f"r{k}") for k, p in enumerate(paths)]
        table = rows.select("label", F.array(*flags).alias("flags"))
        model = LogisticRegression(featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=LASSO, maxIter=100, standardization=False).fit(
            table.select("label", array_to_vector("flags").alias("x")))
        weights = model.coefficients.toArray()
        return Rules(float(model.intercept), tuple((float(w), p) for w, p in zip(weights, paths, strict=True) if w))
    finally:
        rows.unpersist()
        release(sample)


def score(docs: DataFrame, rules: Rules) -> DataFrame:
    """(doc_id, score) of every row."""
    return with_statistics(whole_texts(docs), ["doc_id"]).select("doc_id", rules.score().alias("score"))


def keep(docs: DataFrame, rules: Rules, least: float = KEEP_SCORE) -> DataFrame:
    """The rows of ``docs``, with their columns, that reach the score."""
    return with_statistics(docs, docs.columns).where(rules.score() >= least).select(*docs.columns)


def report(scored: DataFrame, least: float = KEEP_SCORE) -> DataFrame:
    return scored.select("doc_id", F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= least).cast("int").alias("predicted"))
