import math

import numpy as np
from cases import table

from fleetlens.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, components=32):
    """The same figures with whole numbers of any size and one local matrix."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in vectors]
    n, size = len(x), len(x[0])
    total = [sum(row[i] for row in x) for i in range(size)]
    away = [[n * row[i] - total[i] for i in range(size)] for row in x]
    deviation = [sum(a * a for a in row) for row in away]
    centred = np.array(away, float) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    keep = min(components, int((values > 1e-9 * values[0]).sum()))
    return n, deviation, centred @ basis[:, :keep] / np.sqrt(values[:keep]), values[:keep] / values.sum()


def check(rows, vectors, components=32):
    n, deviation, white, explained = brute(vectors, components)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == n and len(rows) == white.size
    signs = {}
    for (vec_id, _), want_deviation, want in zip(vectors, deviation, white):
        for k in range(white.shape[1]):
            r = got[vec_id][k + 1]
            assert (r.n, r.deviation) == (n, want_deviation)
            assert abs(r.explained - explained[k]) <= 1e-8 * explained[k] and r.identity_error < 1e-8
            if abs(want[k]) > 0.1:
                assert signs.setdefault(k, np.sign(r.whitened * want[k])) == np.sign(r.whitened * want[k])
            assert abs(abs(r.whitened) - abs(want[k])) < 1e-6


def test_whole_table(spark):
    vectors = [(r.vec_id, r.embedding) for r in table(spark, "embeddings").collect() if r.embedding is not None]
    vectors = [(i, v) for i, v in vectors if all(c is not None and math.isfinite(c) for c in v)]
    check(whitening.whiten(table(spark, "embeddings")).collect(), vectors)


def test_edges(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(size=4)], i) for i in range(40)]
    bad = [(100, None, 1), (101, [1.0, None, 0.0, 2.0], 1), (102, [1.0, float("nan"), 0.0, 2.0], 1), (103, [float("inf"), 0.0, 0.0, 0.0], 1), (104, [], 1)]
    good = rows + [(200, [0.0] * 4, 1), (201, [-1.5, 1 / 64, -1 / 64, 3.0], 1)]
    df = spark.createDataFrame(good + bad, SCHEMA).repartition(5).selectExpr("*", "1 AS row", "2 AS x", "3 AS size", "4 AS v", "5 AS part")
    vectors = [(i, [float(np.float32(c)) for c in v]) for i, v, _ in good]
    check(whitening.whiten(df).collect(), vectors)
    check(whitening.whiten(df, components=2).collect(), vectors, 2)
    # other lengths among themselves
    short = [(300 + i, [float(i), float(i * i % 7)], 1) for i in range(9)]
    mixed = whitening.whiten(spark.createDataFrame(good + short + bad, SCHEMA)).collect()
    check([r for r in mixed if r.vec_id < 300], vectors)
    check([r for r in mixed if r.vec_id >= 300], [(i, v) for i, v, _ in short])
    # fewer directions than entries, repeated and null ids, equal rows
    flat = [(i, [float(i), float(2 * i), 1.0], 1) for i in range(6)]
    check(whitening.whiten(spark.createDataFrame(flat, SCHEMA)).collect(), [(i, v) for i, v, _ in flat])
    again = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 1), (1, [3.0, 1.0], 1), (None, [0.0, 5.0], 1)], SCHEMA)).collect()
    assert sorted((r.vec_id is None, r.component) for r in again) == [(False, 1)] * 2 + [(False, 2)] * 2 + [(True, 1), (True, 2)]
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, 1), (2, [], 1)], SCHEMA)).count() == 0


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 3)
    monkeypatch.setattr(whitening, "BLOCKS_EACH", 2)
    rng = np.random.default_rng(6)
    rows = [(i, [float(c) for c in rng.normal(size=8) * range(1, 9)], 1) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    check(whitening.whiten(df).collect(), [(i, [float(np.float32(c)) for c in v]) for i, v, _ in rows])
