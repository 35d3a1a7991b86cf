"""Benchmark passages in documents, by a positional inverted index.

``build_index`` stores the postings (term, document, position) of every
document word that occurs in the queried items, and one end posting for each
document, at its length. A query window is looked up from its rarest terms,
by their number of postings: lists are shifted by the term's offset in the
window, and intersected on (document, start), the rarest first. Starts that the rarest terms
agree on are checked against the postings of the other terms. A window
matches exactly where all terms have the same shifted start, and nearly
where its rarest terms' shifted starts lie within ``slop``.

Everything is joins and aggregations on postings; no text is read after the
index is written. Only tables of a counted size are broadcast.

Cases: null texts have no words and match nothing; rows without a doc_id
can't be named and give none; rows that share a doc_id are one document, with
the words of each different text, and no passage runs from one into another;
items without words or item_id are left out; empty tables
give no matches; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small, stage, whole_texts

WINDOW = 10
RAREST = 3
SLOP = 2

_BREAKS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Term of the posting that ends a document; no word holds a space.
_END = " "


def words(text) -> Column:
    """Words of a text: A-Z lower-cased, cut at ASCII characters that are
    neither letters nor digits."""
    return F.array_remove(F.split(F.translate(text, _BREAKS + _UPPER, " " * len(_BREAKS) + _LOWER), " "), "")


def windows_of(items: DataFrame, width: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window, n, terms), and (window, item_id)."""
    rows = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), words(F.coalesce("text", F.lit(""))).alias("w")).where(F.size("w") > 0)
    cut = rows.select("item_id", F.explode(F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - width, F.lit(0))), lambda i: F.slice("w", i + 1, width))).alias("terms")).distinct()
    cut = stage(cut, "windows-cut")
    ids = stage(cut.select("terms").distinct().select(F.monotonically_increasing_id().alias("window"), F.size("terms").alias("n"), "terms"), "windows")
    return ids, stage(cut.join(ids, "terms").select("window", "item_id"), "window-items")


def versions(docs: DataFrame) -> DataFrame:
    """(doc_id, version, text) of the rows with a doc_id; the version of a
    text that shares its doc_id with different ones is its hash, else 0."""
    rows = whole_texts(docs).where(F.col("doc_id").isNotNull())
    hashed = F.xxhash64("text")
    shared = rows.groupBy("doc_id").agg(F.min(hashed).alias("a"), F.max(hashed).alias("b")).where("a != b").select(F.col("doc_id").alias("shared_id"))
    shared = small(stage(shared, "shared-ids"))
    return rows.join(shared, F.col("doc_id") == F.col("shared_id"), "left").select(
        "doc_id", F.when(F.col("shared_id").isNull(), F.lit(0).cast("long")).otherwise(hashed).alias("version"), "text")


def build_index(docs: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Terms (term, term_id), and postings (doc_id, pos, term_id) of all
    documents; term_id -1 is the end posting. ``doc_id`` names a text: it is
    the pair of id and version, 0 but for texts that share their id with
    others, whose words must not be laid over each other."""
    vocabulary = windows.select(F.explode("terms").alias("term")).distinct().select(F.monotonically_increasing_id().alias("term_id"), "term")
    end = windows.sparkSession.createDataFrame([(-1, _END)], "term_id long, term string")
    terms = stage(vocabulary.unionByName(end), "terms")
    tokens = (versions(docs).select(F.struct(F.col("doc_id").alias("id"), "version").alias("doc_id"), F.posexplode(F.concat(words("text"), F.array(F.lit(_END)))).alias("pos", "term")))
    return terms, stage(tokens.join(small(terms), "term").select("doc_id", "pos", "term_id"), "postings")


def rank_terms(windows: DataFrame, terms: DataFrame, postings: DataFrame) -> DataFrame:
    """(window, n, offset, term_id, rank): each window's terms, rarest first;
    a term that no document has is the rarest."""
    counts = postings.groupBy("term_id").agg(F.count(F.lit(1)).alias("postings"))
    placed = windows.select("window", "n", F.posexplode("terms").alias("offset", "term")).join(terms, "term").join(counts, "term_id", "left")
    rarest_first = Window.partitionBy("window").orderBy(F.coalesce("postings", F.lit(0)), "offset")
    return stage(placed.withColumn("rank", F.row_number().over(rarest_first)).select("window", "n", "offset", "term_id", "rank"), "window-terms")


def search(postings: DataFrame, ranked: DataFrame, rarest: int = RAREST, slop: int = SLOP) -> tuple[DataFrame, DataFrame]:
    """Exact matches (doc_id, window, n, start) and near ones (doc_id,
    window); exact ones are among the near."""
    def placed(rank):
        return small(ranked.where(F.col("rank") == rank).select("window", "n", "offset", "term_id"))

    agreed = stage(postings.join(placed(1), "term_id").select("doc_id", "window", "n", (F.col("pos") - F.col("offset")).alias("start"), F.lit(True).alias("exact")).distinct(), "agreed")
    for rank in range(2, rarest + 1):  # the next rarer list: its shifted starts have to agree
        at = placed(rank).drop("n")
        by = F.explode(F.sequence(F.lit(-slop), F.lit(slop))).alias("by")
        wanted = (agreed.where(F.col("n") >= rank).join(at, "window").select("doc_id", "window", "n", "start", "exact", "term_id", "offset", by)
                  .withColumn("pos", F.col("start") + F.col("offset") + F.col("by")).drop("offset"))
        lists = postings.join(small(ranked.where(F.col("rank") == rank).select("term_id").distinct()), "term_id", "left_semi")
        both = (wanted.join(lists, ["doc_id", "term_id", "pos"]).groupBy("doc_id", "window", "n", "start")
                .agg((F.first("exact") & F.max(F.col("by") == 0)).alias("exact")))
        agreed = stage(both.unionByName(agreed.where(F.col("n") < rank)), "agreed")
    near = agreed.select("doc_id", "window").distinct()
    starts = agreed.where("exact").select("doc_id", "window", "n", "start")
    rest = ranked.where(F.col("rank") > rarest).select("window", "offset", "term_id")
    wanted = starts.where(F.col("n") > rarest).join(rest, "window").select("doc_id", "window", "n", "start", (F.col("start") + F.col("offset")).alias("pos"), "term_id")
    in_docs = stage(starts.select("doc_id").distinct(), "agreed-docs")
    known = postings.where("term_id >= 0").join(small(in_docs), "doc_id", "left_semi").distinct()
    checked = (wanted.join(known, ["doc_id", "pos", "term_id"]).groupBy("doc_id", "window", "n", "start").agg(F.count(F.lit(1)).alias("found"))
               .where(F.col("found") == F.col("n") - rarest).drop("found"))
    return stage(checked.unionByName(starts.where(F.col("n") <= rarest)), "matches"), near


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, items, n_near_items) of every document:
    words, words inside an exact match, the items with exact matches as
    sorted strings, and the number of items with near ones."""
    windows, of_items = windows_of(items, width)
    terms, postings = build_index(docs, windows)
    exact, near = search(postings, rank_terms(windows, terms, postings))
    own = F.col("doc_id.id").alias("doc_id")
    # a text that a document holds twice has its postings twice: counted once
    lengths = postings.where("term_id = -1").distinct().groupBy(own).agg(F.sum("pos").cast("long").alias("n_words"))
    hit = (exact.select("doc_id", "start", "n").distinct().select("doc_id", F.explode(F.expr("sequence(start, start + n - 1)")).alias("pos")).distinct()
           .groupBy(own).agg(F.count(F.lit(1)).alias("n_hit")))
    found = exact.select(own, "window").distinct().join(of_items, "window").groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    close = near.join(of_items, "window").select(own, "item_id").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_near_items"))
    zero = F.lit(0).cast("long")
    return (lengths.join(hit, "doc_id", "left").join(found, "doc_id", "left").join(close, "doc_id", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    F.coalesce("n_near_items", zero).alias("n_near_items")))


def report(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "n_near_items")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document has no exact match."""
    hit = stage(contamination(docs, items).where("n_hit > 0").select(F.col("doc_id").alias("hit_id")), "contaminated")
    return docs.join(small(hit), F.col("doc_id") == F.col("hit_id"), "left_anti")
