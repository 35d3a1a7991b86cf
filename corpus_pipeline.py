"""Corpus pipeline: quality, line dedup, near-duplicate documents, benchmark
passages, token ids.

Each stage takes (spark, docs, sf_dir), reads all of its predecessor's
documents, and returns a DataFrame; all but the last return the columns of
``documents``. ``run`` writes each stage as Parquet in the folder shared by
the cluster and reads it back for the next, so a lost executor costs one
stage at most.

Cases: null texts count as empty, rows with a null doc_id are kept by stages
that decide on the text alone; an empty table passes through; extra columns
pass through the filtering stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickframe.llm import bpe, decontaminate, lines, ngram_join, quality
from tickframe.llm.common import stage, table
from tickframe.llm.queries import RANKS


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts."""
    return quality.keep(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line repeats; documents
    that consist of such lines alone, copies of earlier ones, go."""
    return lines.drop_emptied(lines.remove_repeated(docs)).select(*docs.columns)


def document_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first, of each group of near duplicates."""
    return ngram_join.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document's whole text, and digests of the ids and of what they decode to."""
    import public_tokenizers

    return bpe.round_trip_digest(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near_duplicates", document_stage), ("benchmark", benchmark_stage), ("tokens", token_stage)]

#: Learned scores and set joins are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
