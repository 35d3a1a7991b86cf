import hashlib
import random

import numpy as np

from tickframe.llm import suffixes
from tickframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(docs):
    seen, out = set(), {}
    for doc, t in sorted(docs, key=lambda d: d[0]):
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - 99):
            w = data[i:i + 100]
            if w in seen:
                gone[i:i + 100] = True
            seen.add(w)
        edges = np.diff(np.concatenate([[False], gone]).astype(int))
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        out[doc] = (len(data), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def result(rows):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}


def test_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op8_suffix_array"](spark, SF).collect()
    assert len(rows) == len(docs)
    want = brute(docs)
    assert result(rows) == want and sum(x[1] > 0 for x in want.values()) > 5


def test_cases(spark):
    r = random.Random(5)
    text = lambda n: "".join(r.choice("abcdefgh é漢") for _ in range(n))
    shared, line = text(300), text(130)
    docs = [(1, None), (2, ""), (3, "x" * 99), (4, "x" * 250), (5, "ab" * 200), (6, shared + text(50)), (7, text(40) + shared[20:200] + "|" + shared[100:260]), (8, shared + shared), (9, "x" * 99),
            (11, shared + shared), (12, line + text(5) + line), (13, shared[:99])]
    docs += [(100 + i, text(20) + line + text(i) + line[:i + 60]) for i in range(40)]
    d = spark.createDataFrame([(*x, 1, "z") for x in docs] + [(12, docs[10][1], 1, "z"), (None, shared, None, None)], "doc_id long, text string, pos int, lead string")
    cut = suffixes.remove_repeats(d)
    rows = suffixes.report(cut).collect()
    assert result(rows) == brute(docs) and len(rows) == len(docs)
    assert suffixes.remove_repeats(d.limit(0)).count() == 0


def test_order_and_minimizers():
    g = np.random.default_rng(2)
    keys = g.integers(0, 3, (500, 6)).astype(np.uint64)
    assert (keys[suffixes.multikey_order(keys)] == keys[np.lexsort(keys.T[::-1])]).all()
    data = np.frombuffer(("the cat sat on the mat " * 20).encode() + g.integers(0, 256, 3000).astype(np.uint8).tobytes(), np.uint8)
    at, _ = suffixes.minimizers(data)
    for i in range(len(data) - 99):
        assert ((at >= i) & (at <= i + suffixes.SPAN)).any()


def test_repeats_within_a_task_are_told_once():
    told = np.array([2, 9])
    known, news = suffixes._split_repeats(np.array([5, 2, 7, 5, -3, 7, 5]), told)
    assert known.tolist() == [True, True, True, True, False, True, True] and news.tolist() == [5, 7]
    known, news = suffixes._split_repeats(np.zeros(0, np.int64), told)
    assert len(known) == 0 and len(news) == 0


def test_a_passage_that_fills_the_corpus(spark):
    r = random.Random(8)
    text = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    passage, rare = text(240), text(160)
    docs = [(i, text(30) + passage + text(r.randrange(20))) for i in range(200)]  # every task holds it several times
    docs[3] = (3, docs[3][1] + rare)
    docs[150] = (150, rare + docs[150][1])  # once in each of two tasks
    docs += [(300, passage * 40)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartitionByRange(4, "doc_id")
    assert result(suffixes.report(suffixes.remove_repeats(d)).collect()) == brute(docs)
