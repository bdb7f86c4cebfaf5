import numpy as np

from fleetlens.llm.components import components


def test_chains_stars_and_loops(spark):
    rng = np.random.default_rng(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(6, 60)] + [(7, 7), (6, 5)] + [tuple(map(int, rng.integers(1000, 1100, 2))) for _ in range(80)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {n: n for link in links for n in link}
    for _ in range(200):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {n: r for n, r in root.items() if sum(1 for x in root.values() if x == r) > 1}


def test_none(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
