"""Registered queries of the corpus operators, ``opN_<name>``, and their
DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from . import bpe, collocations, decontaminate, graph_search, lexical, lines, ngram_join, oracles, packing, pii, quality, secrets, suffixes, warc
from .common import table

RANKS, TOKENIZER = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
END_ID = 2


def op1_benchmark_index(spark, sf_dir) -> DataFrame:
    return decontaminate.report(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op2_secret_scan(spark, sf_dir) -> DataFrame:
    return secrets.report(secrets.scan(table(spark, sf_dir, "documents")))


def op3_pii_bootstrap(spark, sf_dir) -> DataFrame:
    return pii.report(pii.extract(table(spark, sf_dir, "documents")))


def op4_count_vector_join(spark, sf_dir) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_rule_ensemble(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.report(quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels"))))


def op6_byte_bpe(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op7_line_join(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.report(lines.remove_repeated(docs))


def op8_suffix_array(spark, sf_dir) -> DataFrame:
    return suffixes.report(suffixes.remove_repeats(table(spark, sf_dir, "documents")))


def op9_pruned_graph(spark, sf_dir) -> DataFrame:
    return graph_search.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op10_packed_tokens(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    path = packing.new_file(spark)
    packing.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN, END_ID, path)
    return packing.crc_of(packing.read_documents(spark, path))


def op11_quotient_collocations(spark, sf_dir) -> DataFrame:
    return collocations.report(collocations.collocations(table(spark, sf_dir, "documents")))


def op12_warc_archive(spark, sf_dir) -> DataFrame:
    warc.register(spark)
    folder = warc.new_folder(spark)
    warc.as_records(table(spark, sf_dir, "pages")).write.format("warc").mode("append").save(folder)
    return warc.report(spark.read.format("warc").option("payload", "false").load(folder))


def op13_interval_search(spark, sf_dir) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_benchmark_index, op2_secret_scan, op3_pii_bootstrap, op4_count_vector_join, op5_rule_ensemble,
                                   op6_byte_bpe, op7_line_join, op8_suffix_array, op9_pruned_graph, op10_packed_tokens,
                                   op11_quotient_collocations, op12_warc_archive, op13_interval_search)}
ORACLES = {"op11_quotient_collocations": oracles.COLLOCATIONS, "op12_warc_archive": oracles.WARC, "op13_interval_search": oracles.LEXICAL}
