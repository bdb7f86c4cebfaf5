import time

import numpy as np
import pyarrow as pa
from cases import SF

from fleetlens.llm import forest
from fleetlens.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, node int, leaf int"


def brute(ids, vectors):
    x = np.array(vectors, float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = x @ x.T >= forest.COSINE
    np.fill_diagonal(links, False)
    root = dict(zip(ids, ids, strict=True))
    for _ in range(len(ids)):
        new = {ids[i]: min([root[ids[i]], *[root[ids[j]] for j in np.flatnonzero(links[i])]]) for i in range(len(ids))}
        if new == root:
            break
        root = new
    return {ids[i]: (int(links[i].sum()), root[ids[i]]) for i in range(len(ids))}


def frame(spark, ids, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0, 1, 2) for i, v in zip(ids, vectors, strict=True)], SCHEMA).repartition(3)


def clusters(rng, groups, size, members, spread):
    out = []
    for _ in range(groups):
        base = rng.standard_normal(size)
        out += [base / np.linalg.norm(base) + spread * rng.standard_normal(size) / np.sqrt(size) for _ in range(members)]
    return np.array(out, np.float32)


def test_query(spark):
    rows = QUERIES["op8_embedding_forest"](spark, SF).collect()
    source = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want = brute([r.vec_id for r in source], [r.embedding for r in source])
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


def test_recall_and_precision(spark):
    rng = np.random.default_rng(2)
    vectors = np.vstack([clusters(rng, 150, 64, 6, 0.2), clusters(rng, 1, 64, 300, 0.15), rng.standard_normal((800, 64)).astype(np.float32)])
    ids = list(range(len(vectors)))
    want = brute(ids, vectors)
    got = {r.vec_id: (r.n_links, r.component_id) for r in forest.near_vectors(frame(spark, ids, vectors), leaf=64).collect()}
    assert all(got[i][0] <= want[i][0] for i in ids)
    assert sum(g[0] for g in got.values()) >= 0.98 * sum(w[0] for w in want.values())
    assert sum(got[i][1] == want[i][1] for i in ids) >= 0.99 * len(ids)


def test_leaf_that_cannot_be_split_is_compared_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vectors = clusters(rng, 1, 16, 200, 0.05)
    monkeypatch.setattr(forest, "BLOCK", 32)
    got = forest.near_vectors(frame(spark, list(range(200)), vectors), leaf=20).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(199, 0)}


def test_pairs_count_in_their_smallest_leaf():
    """A dense leaf is counted by matrices: 1500 vectors of which all are linked take seconds, not minutes."""
    rng = np.random.default_rng(5)
    n, here = 1500, 50
    leaves = [sorted({here, *map(int, rng.choice(np.r_[20:50, 51:90], 24, replace=False))}) if i % 3 else [here] for i in range(n)]
    x, weight = clusters(rng, 1, 16, n, 0.05), rng.integers(1, 4, n)
    table = pa.table({"leaf": [here] * n, "one": [0] * n, "two": [0] * n, "node": np.arange(n), "weight": weight, "block": [0] * n, "vector": list(x.astype(float)), "leaves": leaves})
    begun = time.process_time()
    found = forest.compare(table, 0.9)
    assert time.process_time() - begun < 6
    got = {r["a"]: r["n"] for r in found.to_pylist() if r["a"] == r["b"]}
    small = np.zeros((n, here))
    for i, own in enumerate(leaves):
        small[i, [v for v in own if v < here]] = 1
    first = (small @ small.T == 0) & ~np.eye(n, dtype=bool)
    want = (first * weight[None, :]).sum(axis=1)
    assert got == {i: int(w) for i, w in enumerate(want) if w}


def test_a_batch_gives_one_frame_per_tree():
    found = forest.placed(8, np.array([5, 6, 7]), iter([(2, np.array([0, 1])), (3, np.array([1, 2]))]), 1, 6)
    assert found.to_dict("list") == {"size": [8] * 4, "node": [5, 6, 6, 7], "leaf": [13, 13, 19, 19]}


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [0, 0], [1, None], [nan, 1], [inf, 1], [1, 0], [2, 0], [1, 0], [1e-30, 0], [-1, 0], [0.95, 0.3], [1, 2, 3], [], [1, 0]]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, None]
    got = forest.near_vectors(frame(spark, ids, vectors)).collect()
    assert len(got) == len(ids)
    by = {r.vec_id: (r.n_links, r.component_id) for r in got}
    assert all(by[i] == (0, i) for i in (0, 1, 2, 3, 4, 9, 11, 12))
    # 5, 6, 7, 8 and the null id point the same way; so nearly does 10
    assert all(by[i] == (5, 5) for i in (5, 6, 7, 8, 10))
    assert forest.near_vectors(frame(spark, [], []).filter("false")).count() == 0
    assert {(r.n_links, r.component_id) for r in forest.near_vectors(frame(spark, [1], [[0.0]])).collect()} == {(0, 1)}


def test_repeated_rows(spark):
    got = forest.near_vectors(frame(spark, [3, 3, 4], [[1, 1], [1, 1], [1, -1]])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(3, 1, 3), (3, 1, 3), (4, 0, 4)]


def test_every_length_is_compared(spark):
    rng = np.random.default_rng(6)
    parts = {64: clusters(rng, 30, 64, 6, 0.15), 32: clusters(rng, 20, 32, 5, 0.1), 7: clusters(rng, 1, 7, 20, 0.05), 1: np.array([[1], [2], [-1]], np.float32)}
    parts[32][1] = parts[32][0]
    want, vectors = {}, []
    for x in parts.values():
        want |= brute(list(range(len(vectors), len(vectors) + len(x))), x)
        vectors += list(x)
    got = forest.near_vectors(frame(spark, list(range(len(vectors))), vectors), leaf=16).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
