"""Ranked lexical search with range-maximum tables.

The query set (``items``) is searched against all documents, in blocks of
items whose terms fit a stated bound.

1. A pass over the texts gives each document's length and its counts of the
   block's terms (postings of other terms can't be looked up); from these
   follow N, L, df and the term weights.
2. Each task turns up to ``SHARD_POSTINGS`` postings (whole documents, in
   doc_id order) into posting lists with their exact impacts and a sparse
   table of range maxima per list.
3. For an item, a document interval is bounded by the sum of its terms'
   range maxima. The interval of the highest bound is split at the document
   with the largest single impact, which is scored in full; the two rests
   are kept while their bounds can still reach the item's k-th place. All
   items of a shard advance together, in numpy.
4. The shards' first k are ranked; equal scores by ascending doc_id.

Results are exact: an interval is left only when its bound is below the k-th
score found, or equal to it with no smaller doc_id inside.

Cases: null and empty texts have no terms and are in no count; an item
without known terms has no rows; item rows that share an item_id are ranked
each on their own; documents that share a doc_id are documents each; a null
doc_id ranks after others of its score; empty tables give no rows; other
columns play no part.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytewords import byte_words
from .common import stage
from .shingles import slices

TOP = 10
#: Terms of the items searched together; postings of one shard; intervals that an item splits in one step.
BLOCK_TERMS, SHARD_POSTINGS, SPLITS = 200_000, 1 << 20, 4
#: Constants of the score: length share in percent, its scale, and the scale of a term's share.
LENGTH_SHARE, SATURATION, SCALE = 90, 8, 1_000_000_000
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_SEPARATOR = np.ones(256, np.uint8)
_SEPARATOR[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 0
_POSTINGS = "doc_id long, n long, terms array<int>, tfs array<long>"


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, terms): distinct terms of each item row, which ``item`` names."""
    low = F.translate(F.coalesce(F.col("text"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"),
                        F.array_distinct(F.regexp_extract_all(low, F.lit(TERM), F.lit(0))).alias("terms"))


def postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, n, terms, tfs) of each document with terms: its length and
    its counts of the vocabulary's terms, which are named by their places."""
    known = pa.array(vocabulary, pa.large_string())

    def tasks(batches):
        for batch in batches:
            names, texts = batch.column("doc_id"), batch.column("text")
            for first, last in slices(texts):
                words, starts, _, offsets = byte_words(texts.slice(first, last - first), _SEPARATOR)
                rows = np.searchsorted(offsets, starts, "right") - 1
                n = np.bincount(rows, minlength=last - first)
                place = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                hit = place >= 0
                keys, tfs = np.unique(rows[hit] * len(known) + place[hit], return_counts=True)
                some = np.flatnonzero(n)
                at = np.append(np.searchsorted(keys, some * len(known)), len(keys)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [names.slice(first, last - first).take(pa.array(some)), pa.array(n[some], pa.int64()),
                     pa.ListArray.from_arrays(at, pa.array(keys % len(known), pa.int32())), pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))],
                    ["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(tasks, _POSTINGS)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, w: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Exact share of a term in the score of a document of ``n`` terms."""
    if len(n) and LENGTH_SHARE * int(n.max()) * n_docs >= 1 << 63:
        m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * int(x) * n_docs // n_terms for x in n], np.int64)
    else:
        m = 100 - LENGTH_SHARE + LENGTH_SHARE * n * n_docs // n_terms
    return w * (SCALE * tf // (1000 * tf + SATURATION * m))


class Shard:
    """Posting lists of some documents, in the order of their places, with
    a sparse table of range maxima for each list."""

    def __init__(self, n_docs: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray):
        order = np.lexsort((doc, term))
        self.n, self.doc, self.impact = n_docs, doc[order], impact[order]
        self.key = term[order] * n_docs + self.doc
        lists = np.bincount(term[order]) if len(term) else np.zeros(0, np.int64)
        self.table = [np.arange(len(order), dtype=np.int32)]
        for j in range(1, max(int(lists.max()) if len(lists) else 0, 1).bit_length()):
            below, step = self.table[-1], 1 << (j - 1)
            other = np.concatenate([below[step:], below[-step:]])[:len(below)]
            self.table.append(np.where(self.impact[other] > self.impact[below], other, below))
        self.flat = np.concatenate(self.table) if len(order) else np.zeros(0, np.int32)

    def highest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of the largest impact in each range of places [a, b), which
        lies in one list and isn't empty; the first of equal ones."""
        j = np.frexp(b - a)[1].astype(np.int64) - 1
        base = j * len(self.doc)
        left, right = self.flat[base + a], self.flat[base + b - (1 << j)]
        return np.where(self.impact[right] > self.impact[left], right, left)

    def bounds(self, a: np.ndarray, b: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For intervals, given as runs (from ``cuts`` on) of their terms'
        ranges: the sum of the maxima and the document of the largest one."""
        some = np.flatnonzero(a < b)
        best, doc = np.zeros(len(a), np.int64), np.full(len(a), self.n, np.int64)
        at = self.highest(a[some], b[some])
        best[some], doc[some] = self.impact[at], self.doc[at]
        top = np.maximum.reduceat(best, cuts)
        doc = np.where(best == np.repeat(top, np.diff(np.append(cuts, len(best)))), doc, self.n)
        return np.add.reduceat(best, cuts), np.minimum.reduceat(doc, cuts)

    def search(self, queries: list[np.ndarray], k: int, splits: int = SPLITS) -> list[list[tuple[int, int]]]:
        """For each query (terms) its ``k`` best (score, place of document),
        scores above 0, equal scores by ascending place."""
        found: list[list] = [[] for _ in queries]  # heaps of (score, -place), the worst first
        open_: list[list] = [[] for _ in queries]  # heaps of (-bound, first place, document to split at, a, b)
        lists = [np.searchsorted(self.key, q * self.n) for q in queries], [np.searchsorted(self.key, (q + 1) * self.n) for q in queries]
        new = [(q, 0, a, b) for q, (a, b) in enumerate(zip(*lists, strict=True)) if (a < b).any()]
        terms = queries
        while new:
            # bound the new intervals
            sizes = np.array([len(x[2]) for x in new])
            cuts = np.cumsum(sizes) - sizes
            bound, split = self.bounds(np.concatenate([x[2] for x in new]), np.concatenate([x[3] for x in new]), cuts)
            for (q, low, a, b), top, doc in zip(new, bound.tolist(), split.tolist(), strict=True):
                if top > 0 and self._open(found[q], k, top, low):
                    heapq.heappush(open_[q], (-top, low, doc, a, b))
            # split the best intervals of each query
            taken = []
            for q, heap in enumerate(open_):
                for _ in range(splits):
                    if not heap:
                        break
                    top, low, doc, a, b = heapq.heappop(heap)
                    if not self._open(found[q], k, -top, low):
                        # equal bounds may hide a smaller first place further on
                        heap[:] = [x for x in heap if self._open(found[q], k, -x[0], x[1])]
                        heapq.heapify(heap)
                        continue
                    taken.append((q, low, doc, a, b))
            if not taken:
                break
            sizes = np.array([len(x[3]) for x in taken])
            docs = np.repeat(np.array([x[2] for x in taken]), sizes)
            key = np.concatenate([terms[x[0]] for x in taken]) * self.n + docs
            at = np.searchsorted(self.key, key)
            inside = np.minimum(at, len(self.key) - 1)
            hit = self.key[inside] == key
            cuts = np.cumsum(sizes) - sizes
            score = np.add.reduceat(np.where(hit, self.impact[inside], 0), cuts).tolist()
            new = []
            for (q, low, doc, a, b), s, at_q, hit_q in zip(taken, score, np.split(at, cuts[1:]), np.split(hit, cuts[1:]), strict=True):
                if len(found[q]) < k:
                    heapq.heappush(found[q], (s, -doc))
                elif (s, -doc) > found[q][0]:
                    heapq.heapreplace(found[q], (s, -doc))
                new += [(q, low, a, at_q), (q, doc + 1, at_q + hit_q, b)]
        return [sorted(((s, -d) for s, d in one if s > 0), key=lambda x: (-x[0], x[1])) for one in found]

    @staticmethod
    def _open(found: list, k: int, bound: int, low: int) -> bool:
        return len(found) < k or bound > found[0][0] or (bound == found[0][0] and low < -found[0][1])


def _rank_block(docs: DataFrame, block: list, top: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = sorted({t for r in block for t in r["terms"]})
    place = {t: i for i, t in enumerate(vocabulary)}
    held = stage(postings(docs, vocabulary), "lexical-postings")
    n_docs, n_terms = held.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in held.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
    names, queries = [r["item"] for r in block], [np.array(sorted(place[t] for t in r["terms"]), np.int64) for r in block]
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def answers(parts):
        ids = pa.chunked_array([p[0] for p in parts]).combine_chunks()
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        rank_of = np.empty(len(order), np.int64)
        rank_of[order] = np.arange(len(order))
        size = np.concatenate([p[2] for p in parts])
        doc = np.repeat(rank_of, size)
        term, tf = np.concatenate([p[3] for p in parts]).astype(np.int64), np.concatenate([p[4] for p in parts])
        n = np.repeat(np.concatenate([p[1] for p in parts]), size)
        shard = Shard(len(order), doc, term, impacts(tf, n, weights[term], n_docs, n_terms))
        best = shard.search(queries, top)
        sorted_ids = ids.take(pa.array(order))
        rows = [(name, d, s) for name, one in zip(names, best, strict=True) for s, d in one]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), sorted_ids.take(pa.array([r[1] for r in rows], pa.int64())),
                                           pa.array([r[2] for r in rows], pa.int64())], schema=schema)

    def tasks(batches):
        parts, size = [], 0
        for batch in batches:
            terms, tfs = batch.column("terms"), batch.column("tfs")
            ends = terms.offsets.to_numpy().astype(np.int64)
            n, first = batch.column("n").to_numpy(zero_copy_only=False), 0
            while first < batch.num_rows:
                last = max(int(np.searchsorted(ends, ends[first] + SHARD_POSTINGS - size, "right")) - 1, first + 1)
                last = min(last, batch.num_rows)
                a, b = ends[first], ends[last]
                parts.append((batch.column("doc_id").slice(first, last - first), n[first:last], np.diff(ends[first:last + 1]),
                              terms.values.slice(a, b - a).to_numpy(zero_copy_only=False), tfs.values.slice(a, b - a).to_numpy(zero_copy_only=False)))
                size, first = size + int(b - a), last
                if size >= SHARD_POSTINGS or first < batch.num_rows:
                    yield answers(parts)
                    parts, size = [], 0
        if size:
            yield answers(parts)

    best = held.where(F.size("terms") > 0).mapInArrow(tasks, "item long, doc_id long, score long")
    block_items = spark.createDataFrame([(r["item"], r["item_id"]) for r in block], "item long, item_id long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(block_items), "item").select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item
    with a score above 0. Items go in blocks of about ``block_terms`` terms."""
    spark = docs.sparkSession
    named = stage(item_terms(items), "lexical-items").where(F.size("terms") > 0)
    total = named.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(-(-total // block_terms), 1)
    out = None
    for b in range(blocks):
        block = named.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()
        if block:
            one = _rank_block(docs, block, top)
            out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
