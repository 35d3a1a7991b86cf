import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickframe.llm import ngram_join
from tickframe.llm.components import components
from tickframe.llm.ngram_join import CountTree
from tickframe.llm.queries import QUERIES
from tickframe.llm.shingles import SLICE_BYTES, shingle_hashes


def shingles(t):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    return frozenset([tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else [])


def brute(docs):
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    by = {}
    for d, s in sets.items():
        for g in s:
            by.setdefault(g, []).append(d)
    for a, b in {(a, b) for g in by.values() for i, a in enumerate(g) for b in g[i + 1:]}:
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_corpus(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op4_count_vector_join"](spark, sf).collect()
    assert len(rows) == len(docs)
    want = brute(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want and any(c != d for d, (_, c) in want.items())


def test_cases(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 7)  # groups dealt to blocks
    r = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    docs = [(1, None), (2, ""), (3, "Two words"), (4, "two\tWORDS"), (5, "two words more"), (6, " \n ")]
    docs += [(100 + i, " ".join("x" if r.random() < 0.025 else w for w in base)) for i in range(60)]
    docs += [(200 + i, " ".join(base[:30] + [f"{i}v{j}" for j in range(30)])) for i in range(20)]
    docs += [(300 + i, " ".join(base[i:] + base[:i])) for i in range(0, 60, 3)]
    d = spark.createDataFrame([(*x, 1, "z") for x in docs] + [(3, "Two words", 1, "z"), (None, "two words", None, None)], "doc_id long, text string, n long, point string")
    rows = ngram_join.near_duplicates(d).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in rows} == brute(docs) and len(rows) == len(docs)
    assert ngram_join.keep_one(d).count() == 1 + sum(c == k for k, (_, c) in brute(docs).items()) + 1
    assert ngram_join.near_duplicates(d.limit(0)).count() == 0


def test_tree_keeps_every_pair_the_bound_allows():
    g = np.random.default_rng(1)
    points = g.poisson(g.uniform(0.3, 1.2, (40, 1)), (40, 16)).astype(np.int32).repeat(7, axis=0) + g.binomial(1, 0.05, (280, 16)).astype(np.int32)
    n = points.sum(1)
    x, y = CountTree(points, n).pairs()
    low = np.minimum(points[:, None], points[None]).sum(2)
    want = {(i, j) for i in range(280) for j in range(i + 1, 280) if 100 * low[i, j] >= 75 * (n[i] + n[j] - low[i, j])}
    assert set(zip(x.tolist(), y.tolist(), strict=True)) == want


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 139)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}, 200: 100}


@pytest.mark.parametrize("n", range(7))
def test_slices_of_few_words(n):
    text = " ".join(f"w{i}" for i in range(n))
    alone, at = shingle_hashes(pa.array([text]), ngram_join.SHINGLE)
    beside, ends = shingle_hashes(pa.array([text, "one two three four five six seven"]), ngram_join.SHINGLE)
    assert len(at) == 2 and len(alone) == (max(1, n - 4) if n else 0)
    assert alone.tolist() == beside[:ends[1]].tolist()


def test_short_documents_alone(spark):
    schema = "doc_id long, text string"
    one = ngram_join.near_duplicates(spark.createDataFrame([(1, "two words")], schema)).collect()
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in one] == [(1, 1, 1)]
    long = " ".join(f"word{i}" for i in range(300_000))
    d = spark.createDataFrame([(1, "two words"), (2, long), (3, "just three words"), (4, long)], schema).coalesce(1)
    assert len(long) > SLICE_BYTES
    assert sorted(r.doc_id for r in ngram_join.keep_one(d).collect()) == [1, 2, 3]


def test_texts_of_one_doc_id_are_compared_as_themselves(spark):
    r = random.Random(8)
    texts = {k: [f"{k}{r.randrange(10**6)}" for _ in range(60)] for k in "abcdefgh"}
    near = {k: [*w[:57], "x", "y", "z"] for k, w in texts.items()}
    docs = [(10 * i, " ".join(texts[k])) for i, pair in enumerate(("ab", "cd", "ef", "gh"), 1) for k in pair]
    docs += [(100 + i, " ".join(near[k])) for i, k in enumerate("abcdefgh")]
    rows = ngram_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {x.doc_id: x.component_id for x in rows} == {**{10 * i: 10 * i for i in range(1, 5)}, **{100 + i: 10 * (i // 2 + 1) for i in range(8)}}


def test_similar_sets_share_enough_of_their_first_shingles(spark):
    r, rows = random.Random(5), []
    for _ in range(3000):
        base, other = r.sample(range(1000), r.randint(1, 90)), r.sample(range(1000, 2000), 40)
        x = sorted({*base, *other[:r.randint(0, 12)]}, key=lambda t: t * 7919 % 2003)
        y = sorted({*base, *other[20:20 + r.randint(0, 12)]}, key=lambda t: t * 7919 % 2003)
        if 100 * len({*x} & {*y}) >= ngram_join.NEED * len({*x, *y}):
            first = [set(s[:len(s) - -(-ngram_join.NEED * len(s) // 100) + 1]) for s in (x, y)]
            rows.append((len(x), len(y), len(first[0] & first[1])))
    least = ngram_join._least_shared(F.col("x"), F.col("y"))
    found = spark.createDataFrame(rows, "x long, y long, shared long").select(F.min(F.col("shared") - least), F.max(least)).first()
    assert found[0] >= 0 and found[1] > 5
