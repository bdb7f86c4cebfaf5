import zlib

import numpy as np
import pytest
from cases import EDGES, SF, docs, edges, empty
from tokenizers import Tokenizer

from fleetlens.llm import packing, tokens
from fleetlens.llm.queries import QUERIES


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == list(np.cumsum([0, *[r.length for r in own]])[:-1])
        assert sum(r.length for r in own) <= capacity
    return len(by)


def test_query(spark):
    rows = QUERIES["op2_pack_sequences"](spark, SF).collect()
    used = check_places(rows, packing.CAPACITY)
    assert used <= -(-sum(r.length for r in rows) // packing.CAPACITY) + 2
    tok = Tokenizer.from_file(tokens.place(tokens.VOCABULARY))
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    source = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert set(by_doc) == {d.doc_id for d in source}
    for d in source:
        ids = np.array([*tok.encode(d.text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by_doc[d.doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == list(np.cumsum([0, *[r.length for r in own]])[:-1])
        assert all(r.length == packing.CAPACITY for r in own[1:])
        assert [r.ids_crc32 for r in own] == [zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own]
        assert sum(r.length for r in own) == len(ids)


def test_edges(spark):
    rows = packing.pack(edges(spark)).collect()
    check_places(rows, packing.CAPACITY)
    assert {r.doc_id for r in rows} == {d for d, *_ in EDGES}
    # the repeated row is packed twice, an empty text is its end id alone
    assert sum(r.doc_id == 8 and r.piece == 0 for r in rows) == 2
    assert [r.length for r in rows if r.doc_id == 1] == [1]
    assert packing.pack(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_evolution_keeps_every_item_and_helps(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.integers(200, 700, 300))
    plain = np.empty(len(lengths), np.int64)
    first = packing.best_fit(lengths.tolist(), np.argsort(-lengths, kind="stable").tolist(), plain, packing.Bins(1000), 0)
    best = packing.evolve(lengths, 1000, seed, [], generations=30)
    assert np.bincount(best, weights=lengths).max() <= 1000
    assert packing.fitness(best, lengths, 1000)[0] <= first


def test_cross_is_a_packing():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 400, 200)
    a, b = (packing.evolve(lengths, 1000, s, [], generations=0, population=1) for s in (1, 2))
    for _ in range(20):
        child = packing.cross(a, b, lengths, 1000, rng)
        assert len(child) == 200 and child.min() == 0 and np.bincount(child, weights=lengths).max() <= 1000


def test_shards_and_loose_sequences(spark, monkeypatch):
    rows = [(i, "word " * (1 + (i * 37) % 900), "en", "s", 0) for i in range(400)]
    monkeypatch.setattr(packing, "SHARD_PIECES", 50)
    got = packing.pack(docs(spark, rows), capacity=1024).collect()
    used = check_places(got, 1024)
    assert len({(r.doc_id, r.piece) for r in got}) == len(got)
    assert used <= 1.05 * sum(r.length for r in got) / 1024 + 2


def fewest(lengths, capacity):
    """The least number of bins, over all subsets of the items: (bins, room used in the last one) of each subset."""
    n = len(lengths)
    best = [(1, 0)] + [None] * ((1 << n) - 1)
    for subset in range(1, 1 << n):
        options = []
        for i in range(n):
            if subset >> i & 1:
                bins, used = best[subset ^ (1 << i)]
                options.append((bins, used + lengths[i]) if used + lengths[i] <= capacity else (bins + 1, lengths[i]))
        best[subset] = min(options)
    return best[-1][0]


@pytest.mark.parametrize("seed", range(4))
def test_as_few_as_possible_on_small_cases(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(220, 480, 12)
    found = min(packing.fitness(packing.evolve(lengths, 1000, island, [], generations=200), lengths, 1000)[0] for island in range(8))
    assert found == fewest(lengths.tolist(), 1000)


def test_islands_need_fewer_sequences_than_best_fit(spark):
    """Lengths of a quarter to under a half of a sequence: best-fit decreasing is off the bound, and evolution with migration is nearer."""
    rng = np.random.default_rng(9)
    lengths = rng.integers(250, 450, 600)
    plain = np.empty(len(lengths), np.int64)
    first = packing.best_fit(lengths.tolist(), np.argsort(-lengths, kind="stable").tolist(), plain, packing.Bins(1000), 0)
    items = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "row long, length int")
    rows = packing.pack_lengths(items, 1000, label="test").collect()
    assert sorted(r.row for r in rows) == list(range(600))
    fill = {}
    for r in rows:
        fill[r.shard, r.bin] = fill.get((r.shard, r.bin), 0) + int(lengths[r.row])
    assert max(fill.values()) <= 1000 and len(fill) < first
