import numpy as np

from tickframe.llm import graph_search
from tickframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows, k=10):
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], np.float64)
    out = {}
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((points - points[q]) ** 2).sum(1))
        order = [x for x in np.lexsort((ids, d)) if x != q][:k]
        out[int(ids[q])] = [(int(ids[x]), float(d[x])) for x in order]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


def test_recall_on_given_vectors(spark):
    for sf in (SF, "/root/testdata/sf0.1"):
        rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
        want, got = brute(rows), found(QUERIES["op9_pruned_graph"](spark, sf).collect())
        assert set(got) == set(want) and all(len(got[q]) == 10 for q in want)
        assert recall(got, want) >= 0.95
        for q, w in got.items():
            exact = dict(brute([r for r in rows if r[0] in {q, *(i for i, _ in w)}])[q])
            assert all(abs(exact[i] - s) < 1e-12 for i, s in w)


def test_cases(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(0, 350)] + [(400, None), (500, [0.0, 0.0]), (600, [float("nan"), 1.0]), (700, [None, 1.0]), (800, []), (900, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (350, [2.5, 1.0]),
                                                                (1000, [float("inf"), 1.0]), (1100, [3.0, 1.0]), (1100, [3.0, 1.0])]
    d = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, embedding array<double>, node string, rank int")
    used = [(i, v) for i, v in rows[:350]] + [(350, [2.5, 1.0]), (1100, [3.0, 1.0])]
    assert found(graph_search.nearest(d, lambda v: v % 100 == 0).collect()) == brute(used)
    assert graph_search.nearest(d.limit(0), lambda v: v % 100 == 0).count() == 0
    assert graph_search.nearest(d.where("vec_id = 100"), lambda v: v % 100 == 0).count() == 0


def test_shards_cover_all(spark, monkeypatch):
    g = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(g.normal(size=(1500, 24)))]
    monkeypatch.setattr(graph_search.build_index, "__defaults__", (400,))
    got = found(graph_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda v: v % 100 == 0).collect())
    assert recall(got, brute(rows)) >= 0.9


def test_prune_keeps_diverse_edges():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 1], [0, 1.2], [-3, 0]], np.float32)
    kept = graph_search.robust_prune(points, np.array([0]), np.array([[1, 2, 3, 4, 5, 1, 0, -1]]), 4, 1.2)
    assert kept.tolist() == [[1, 3, 5, -1]]
