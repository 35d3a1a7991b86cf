import random
import re
from collections import Counter

import numpy as np
import pytest

from tickframe.llm import collocations, quotient


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, least, longest=5, cover=100, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    f = Counter({p: c for p, c in f.items() if c >= least})
    best = {}
    for (lang, p), a in f.items():
        if len(p) < 2:
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        covered = any(100 * c >= cover * a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                      for (other, q), c in f.items() if other == lang)
        if not covered:
            best[lang, p] = (lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score)
    out = []
    for lang in n:
        rows = sorted((r for r in best.values() if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(rows[:top])]
    return sorted(out)


def corpus(seed, n):
    r = random.Random(seed)
    words = ["the", "The", "of", "a", "été", "x\x01", "漢字", "b c", "zz", "q-w"]
    def text():
        return "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "!", "\r\n", "?x "]) for _ in range(r.randrange(40)))
    return [(r.choice(["en", "fr", None, "und", ""]), text()) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "w", 2) for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, n int, word string, f int")


def check(spark, rows, **k):
    found = collocations.report(collocations.collocations(frame(spark, rows).repartition(3), **k))
    got = sorted(tuple(x) for x in found.collect())
    assert got == brute(rows, k.get("min_count", 100), k.get("max_words", 5), k.get("cover", 100), k.get("top", 2000))
    return got


def test_brute_force(spark):
    rows = corpus(1, 250) + [(None, None), ("en", ""), ("en", " . ,"), ("de", "one two three four five six " * 30), ("de", "word")] + [("en", "Same again here, twice")] * 9
    got = check(spark, rows, min_count=4)
    assert len(got) > 100 and {g[0] for g in got} >= {"en", "und", "", "de"}
    check(spark, rows, min_count=3, max_words=3, cover=80, top=7)


def test_small_buffers_and_rounds(spark, monkeypatch):
    """Many filters, merges and dealing rounds give the same counts."""
    for name, value in (("PART_GRAMS", 1), ("ROUND_BITS", 2), ("SHARD_GRAMS", 50), ("MERGE_ENTRIES", 40)):
        monkeypatch.setattr(collocations, name, value)
    check(spark, corpus(2, 120), min_count=3)


def test_empty(spark):
    rows = frame(spark, [("en", "a b c")])
    assert collocations.collocations(rows.limit(0)).collect() == [] and collocations.collocations(rows).collect() == []
    assert collocations.collocations(frame(spark, [(None, None)])).collect() == []


def test_long_text(spark):
    text = "alpha beta gamma " * 400_000
    rows = collocations.collocations(frame(spark, [("en", text), ("en", "alpha beta")])).collect()
    assert {(r.phrase, r.a) for r in rows} >= {("alpha beta", 400_001)} and all(r.n == 1_200_002 for r in rows)


@pytest.mark.parametrize("n,bits", [(2, 1), (2, 32), (3, 21), (4, 16), (5, 13), (5, 40)])
def test_filter_is_lossless(n, bits):
    g = np.random.default_rng(n * bits)
    ids = [g.integers(0, 1 << bits, 3000).astype(np.uint64) for _ in range(n)]
    there = quotient.permute(ids, bits)
    assert all((a == b).all() for a, b in zip(quotient.restore(there, bits), ids, strict=True))
    columns, counts = quotient.count(quotient.pack(there, bits))
    counts = counts * g.integers(1, 10**9, len(counts))
    for part_bits in (0, min(n * bits, 3)):
        parts = quotient.parts_of(columns, part_bits)
        for p in np.unique(parts):
            own = [c[parts == p] for c in columns]
            back, k = quotient.read(quotient.write(own, counts[parts == p], n * bits, int(p), part_bits), int(p), part_bits)
            assert (k == counts[parts == p]).all() and all((a == b).all() for a, b in zip(back, own, strict=True))
    grams = Counter(zip(*(x.tolist() for x in ids), strict=True))
    back = zip(*(x.tolist() for x in quotient.restore(quotient.unpack(columns, n, bits), bits)), strict=True)
    assert set(back) == set(grams)
