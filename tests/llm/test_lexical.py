import math
import random
import re

import numpy as np

from tickframe.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, top=10):
    held = [(d, terms(t)) for d, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for d, t in held:
            m = 10 + 90 * len(t) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * t.count(x) // (1000 * t.count(x) + 8 * m))
                    for x in set(terms(text)) if x in t)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def tables(seed, n):
    r = random.Random(seed)
    words = ["The", "the", "of", "été", "x1", "Ünï", "漢字"] + [f"w{i}" for i in range(40)]
    text = lambda k: "".join(r.choice(words) + r.choice([" ", "-", "\x00", "'", "\n", ", "]) for _ in range(r.randrange(k)))
    docs = [(i, text(60)) for i in range(n)]
    docs += [(1000 + i, "same w1 w2 text") for i in range(60)] + [(None, "same w1 w2 text"), (7, "w3 w3 w3"), (7, "w4"), (None, None), (5000, ""), (5001, " .-")]
    items = [(i, text(20)) for i in range(25)] + [(50, "same w1 w2 text"), (51, None), (52, ""), (53, "unknown"), (54, "w1 W1 w1"), (None, "w2 w9"), (55, "the of")]
    return docs, items


def frames(spark, docs, items):
    r = random.Random(3)
    r.shuffle(docs)
    return (spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id long, text string, item_id string, n int, score int").repartition(4),
            spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_brute_force(spark, monkeypatch):
    docs, items = tables(1, 400)
    d, i = frames(spark, docs, items)
    want = brute(docs, items)
    assert rows(lexical.rank(d, i)) == want and len(want) > 200
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", 300)  # many shards, documents longer than one
    assert rows(lexical.rank(d, i)) == want
    assert rows(lexical.rank(d, i, top=3, block_terms=30)) == brute(docs, items, 3)  # several blocks of items


def test_empty(spark):
    d, i = frames(spark, [(1, "a b")], [(1, "a")])
    assert rows(lexical.rank(d.limit(0), i)) == [] and rows(lexical.rank(d, i.limit(0))) == []
    assert rows(lexical.rank(d, i)) == brute([(1, "a b")], [(1, "a")])


def test_long_text(spark):
    docs = [(1, "alpha beta " * 400_000), (2, "alpha"), (3, "gamma")]
    d, i = frames(spark, docs, [(1, "alpha gamma")])
    assert rows(lexical.rank(d, i)) == brute(docs, [(1, "alpha gamma")])


def test_range_maxima():
    g = np.random.default_rng(4)
    doc, term = np.divmod(np.unique(g.integers(0, 200 * 6, 700)), 6)
    impact = g.integers(0, 9, len(doc))
    s = lexical.Shard(200, doc, term, impact)
    for t in range(6):
        a, b = np.searchsorted(s.key, [t * 200, (t + 1) * 200])
        for _ in range(200):
            x, y = sorted(g.integers(a, b + 1, 2).tolist())
            if x < y:
                assert s.highest(np.array([x]), np.array([y]))[0] == x + int(np.argmax(s.impact[x:y]))
    assert lexical.impacts(np.array([3]), np.array([10**7]), np.array([5]), 10**12, 10**15)[0] == 5 * (3 * 10**9 // (3000 + 8 * (10 + 90 * 10**19 // 10**15)))
