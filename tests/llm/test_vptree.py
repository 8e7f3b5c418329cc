import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.llm import vptree


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int, id string").repartition(3)


def brute(rows, k, step):
    fine = {}
    for i, v, *_ in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            fine[(i, tuple(np.float32(x) for x in v))] = None
    found = []
    for qi, q in fine:
        if qi % step == 0:
            scored = [
                (-float(np.cumsum(np.float64(q) * np.float64(c))[-1]), ci) for ci, c in fine if ci != qi and len(c) == len(q)
            ]
            found += [(qi, r + 1, ci, -s) for r, (s, ci) in enumerate(sorted(scored)[:k])]
    return sorted(found)


@pytest.mark.parametrize("leaf", [4, 256])
@pytest.mark.parametrize("small", [True, False])
def test_exact_with_ties_copies_and_unusable_vectors(spark, monkeypatch, leaf, small):
    monkeypatch.setattr(vptree, "LEAF", leaf)
    rng = np.random.default_rng(leaf)
    rows = []
    for i in range(300):
        v = rng.integers(-2, 3, 4).tolist() if small else rng.normal(size=4).astype(np.float32).tolist()
        rows.append((i, [float(x) for x in v], 1, "x"))
    rows += [(i, [1.0, 1.0, 1.0, 1.0], 1, "x") for i in range(300, 400)]
    rows += rows[:5] + [
        (500, None, 1, "x"), (520, [], 1, "x"), (540, [0.0] * 4, 1, "x"), (560, [1.0, None, 1.0, 1.0], 1, "x"),
        (580, [float("nan"), 1.0, 1.0, 1.0], 1, "x"), (600, [float("inf")] * 4, 1, "x"), (None, [1.0] * 4, 1, "x"),
        (620, [2.0, 1.0], 1, "x"), (621, [1.0, 1.0], 1, "x"),
    ]
    got = vptree.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, k=7, shard_rows=90, cell_rows=20)
    assert sorted(map(tuple, got.collect())) == brute(rows, 7, 20)


def test_relaxed_search_keeps_recall(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16)) * 4
    rows = [(i, (centres[i % 20] + rng.normal(size=16)).astype(np.float32).tolist(), 1, "x") for i in range(2000)]
    rows = [(i, [float(x) for x in v], a, b) for i, v, a, b in rows]
    exact = {(q, v) for q, _, v, _ in brute(rows, 10, 20)}
    found = vptree.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, k=10, factor=1.5).collect()
    assert len(exact & {(r.query_id, r.vec_id) for r in found}) >= 0.9 * len(exact)


def test_fewer_candidates_and_empty(spark):
    rows = [(0, [1.0, 0.0], 1, "x"), (1, [0.5, 0.5], 1, "x")]
    found = vptree.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 0.5)]
    assert vptree.neighbours(table(spark, []), F.col("vec_id") % 20 == 0).collect() == []


@pytest.mark.parametrize("leaf", [4, 256])
def test_several_vectors_of_one_id_take_no_places(spark, monkeypatch, leaf):
    monkeypatch.setattr(vptree, "LEAF", leaf)
    rows = [(0, [10.0, x], 1, "x") for x in (0.0, 0.5, 1.0)] + [(i, [float(i), 1.0], 1, "x") for i in range(1, 10)]
    got = vptree.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, k=3, shard_rows=5, cell_rows=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 20) and len(brute(rows, 3, 20)) == 9
    rng = np.random.default_rng(leaf)  # shared vectors and ties as well
    rows = [(int(i), [float(x) for x in rng.integers(-2, 3, 3)], 1, "x") for i in rng.integers(0, 30, 400)]
    got = vptree.neighbours(table(spark, rows), F.col("vec_id") % 5 == 0, k=4, shard_rows=30, cell_rows=10)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 5)


def clustered(spark, n, seed=3):
    """Clusters of about 50 vectors each, so that their number grows with the table."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, n // 50), 8)) * 10
    centres *= 30 / np.linalg.norm(centres, axis=1, keepdims=True)
    vectors = centres[np.arange(n) % len(centres)] + rng.normal(size=(n, 8)) * 0.3
    return [(i, [float(x) for x in v], 1, "x") for i, v in enumerate(vectors.astype(np.float32))]


@pytest.mark.parametrize("n", [300, 1500])
def test_routes_are_exact_on_clusters_and_few(spark, monkeypatch, n):
    routes = []
    whole = vptree._routed

    def counted(*given):
        routes.append(vptree.materialise(whole(*given)))
        return routes[-1]

    monkeypatch.setattr(vptree, "_routed", counted)
    rows = clustered(spark, n)
    got = vptree.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, k=7, shard_rows=60, cell_rows=30)
    assert sorted(map(tuple, got.collect())) == brute(rows, 7, 20)
    cells, queries = n // 30, len(range(0, n, 20))
    assert routes[0].count() <= queries * max(2, cells // 3)  # of each query's other cells


def test_relaxed_routes_keep_recall_on_clusters(spark):
    rows = clustered(spark, 2000)
    exact = {(q, v) for q, _, v, _ in brute(rows, 10, 20)}
    found = vptree.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, k=10, factor=1.5, cell_rows=40).collect()
    assert len(exact & {(r.query_id, r.vec_id) for r in found}) >= 0.9 * len(exact)
