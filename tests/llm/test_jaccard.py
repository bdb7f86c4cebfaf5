import re
import tracemalloc
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import EDGES, SF, docs, edges, empty, texts

from fleetlens import session
from fleetlens.llm import jaccard
from fleetlens.llm.queries import QUERIES
from fleetlens.llm.scan import HASHED_AT_ONCE, shingle_sets, word_hashes, words

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def grams(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    return frozenset([tuple(words)] if 0 < len(words) < width else [tuple(words[i : i + width]) for i in range(len(words) - width + 1)])


def brute(rows, width, percent):
    sets = {doc: grams(text, width) for doc, text in rows}
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for doc, own in sets.items():
        for g in own:
            holders.setdefault(g, []).append(doc)
    for doc, own in sets.items():
        for other, common in Counter(o for g in own for o in holders[g] if o < doc).items():
            if 100 * common >= percent * (len(own) + len(sets[other]) - common):
                a, b = find(doc), find(other)
                root[max(a, b)] = min(a, b)
    return {doc: (len(own), find(doc)) for doc, own in sets.items()}


def got(frame, **settings):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_groups(frame, **settings).collect()}


def test_query(spark):
    rows = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op6_ngram_jaccard"](spark, SF).collect()}
    assert rows == brute(texts(spark.read.parquet(f"{SF}/documents.parquet")), 3, 90)


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80), (1, 80)])
def test_near_copies_of_all_sizes(spark, width, percent):
    rng = np.random.default_rng(width * 100 + percent)
    rows = []
    for base in range(60):
        words = [f"v{rng.integers(400)}" for _ in range(int(rng.integers(1, 140)))]
        for copy in range(6):
            own = list(words)
            for _ in range(int(rng.integers(0, 4))):
                place = int(rng.integers(0, len(own) + 1))
                if rng.random() < 0.4 and len(own) > 1:
                    del own[min(place, len(own) - 1)]
                else:
                    own.insert(place, f"n{rng.integers(9)}")
            rows.append((len(rows), (" " if copy % 2 else "\n").join(own), "en", "s", 0))
    want = brute([(r[0], r[1]) for r in rows], width, percent)
    assert got(docs(spark, rows), width=width, percent=percent) == want
    assert len({c for _, c in want.values()}) < 300


def test_members_the_leader_does_not_link(spark):
    """A chain: neighbours are similar, its ends are not; all is one component."""
    words = [f"w{i}" for i in range(200)]
    rows = [(100 - i, " ".join(words[: 60 + i] + words[150:]), "en", "s", 0) for i in range(0, 60)]
    want = brute([(r[0], r[1]) for r in rows], 3, 90)
    assert got(docs(spark, rows), width=3, percent=90) == want


def test_hot_group_stays_linear(spark):
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(base[:40] + [f"x{i}"] + base[40:]), "en", "s", 0) for i in range(300)]
    found = jaccard.stars(docs(spark, rows).select("doc_id", "text"), 3, jaccard.Cut(90), 16)
    # every signature ties its members to one of them
    assert found.count() <= 300 * 30 and found.select("a", "b").distinct().count() < 3000
    assert {c for _, c in got(docs(spark, rows), width=3, percent=90).values()} == {0}


def test_sets_that_share_a_passage_are_not_all_compared(spark, monkeypatch):
    """Half of each set is in all of them, the rest only in a near copy: signatures are hot, similar sets few."""
    common = [f"c{i}" for i in range(12)]
    rows = []
    for base in range(120):
        own = [f"o{base}-{i}" for i in range(12)]
        for copy in range(2):
            rows.append((len(rows), " ".join(common + own[: 12 - copy]), "en", "s", 0))
    compared, possible = [], jaccard.possible

    def counted(pairs, *more):
        compared.append(pairs.count())
        return possible(pairs, *more)

    monkeypatch.setattr(jaccard, "possible", counted)
    want = brute([(r[0], r[1]) for r in rows], 1, 80)
    assert got(docs(spark, rows), width=1, percent=80) == want and len({c for _, c in want.values()}) == 120
    assert sum(compared) < 40 * len(rows)


def test_members_that_met_all_others_are_done(spark, monkeypatch):
    """Four sets share signatures and no two are similar: after three of them have met all others no pair is left."""
    passage = [f"c{i}" for i in range(40)]
    rows = []
    for base in range(3):
        rows += [(4 * base + copy, " ".join([f"p{base}-{w}" for w in passage] + [f"o{base}-{copy}-{i}" for i in range(12)]), "en", "s", 0) for copy in range(4)]
    found = jaccard.stars(docs(spark, rows).select("doc_id", "text"), 1, jaccard.Cut(80), 16).groupBy("sig").count()
    assert found.filter("count > 1").count() > 0
    left = []

    def rare(member, parts, cut, whole=jaccard.rare_grams):
        left.append(member.count())
        return whole(member, parts, cut)

    monkeypatch.setattr(jaccard, "rare_grams", rare)
    want = brute([(r[0], r[1]) for r in rows], 1, 80)
    assert got(docs(spark, rows), width=1, percent=80) == want and len({c for _, c in want.values()}) == 12
    assert not left


def test_rare_grams_keep_every_link(spark):
    """Each pair of similar sets in different components shares a rare n-gram at places that pass."""
    rng = np.random.default_rng(11)
    sets = [sorted(int(v) for v in rng.choice(30, int(rng.integers(1, 14)), replace=False)) for _ in range(150)]
    member = spark.createDataFrame([(i, int(rng.integers(4)), len(s)) for i, s in enumerate(sets)], "node long, component long, n long")
    parts = spark.createDataFrame([(i, p, [v for v in s if v % 2 == p]) for i, s in enumerate(sets) for p in range(2)], "node long, part int, grams array<long>")
    # twice the least sketch: folded, its second half falls on the first
    half = [[sum(1 << v for v in s if v % 2 == p), *[0] * 7] for s in sets for p in range(2)]
    nodes = spark.createDataFrame([(i, half[2 * i] + half[2 * i + 1]) for i in range(len(sets))], "node long, sketch array<long>")
    component = {r.node: r.component for r in member.collect()}
    for percent in (60, 80, 90):
        cut = jaccard.Cut(percent)
        found = jaccard.across(jaccard.rare_grams(member, parts, cut), nodes, cut).selectExpr("x.node AS a", "y.node AS b").collect()
        found = {(min(r), max(r)) for r in found}
        similar = {
            (a, b)
            for b, t in enumerate(sets)
            for a, s in enumerate(sets[:b])
            if component[a] != component[b] and 100 * len({*s} & {*t}) >= percent * len({*s} | {*t})
        }
        assert similar and similar <= found and len(found) < 150 * 149 / 8
        assert all(component[a] != component[b] for a, b in found)


def test_fragments_outnumber_differences():
    for percent in (80, 90):
        cut = jaccard.Cut(percent)
        first, last = cut.classes(np.arange(1, 5000))
        assert (last >= first).all()
        apart = (2 * cut.bounds * (100 - percent)) // (100 + percent)
        assert (cut.fragments > apart + 3).all()


def test_shingle_sets_across_rows():
    data = [b"a b c d", b"", b"  x ", b"A B c", b"a b", b"\xc3\xa9 \xf0\x9f\x98\x80 z"]
    raw = np.frombuffer(b"".join(data), np.uint8)
    row, value = shingle_sets(raw, np.cumsum([0, *map(len, data)]), 3)
    assert np.bincount(row, minlength=6).tolist() == [2, 0, 1, 1, 1, 1]
    assert set(value[row == 3]) < set(value[row == 0]) and not set(value[row == 4]) & set(value[row == 0])


def most_held(work):
    """Result of ``work`` and the most bytes that it held at once."""
    work()
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_word_hashes_hold_little():
    """A slice's words are hashed in blocks: no array of eight bytes per byte of text, and the same hash wherever a word stands."""
    rng = np.random.default_rng(7)
    data = [b"%d" % i for i in rng.integers(1, 10 ** rng.integers(1, 12, 250_000))]
    data[1000] = b"Long" * HASHED_AT_ONCE
    raw = np.frombuffer(b" ".join(data), np.uint8)
    start, end, _ = words(raw, np.array([0, len(raw)]))
    alone = {w: word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] for w in data[:2000]}
    got = word_hashes(raw, start, end)
    assert len(got) == len(data) and all(g == alone[w] for w, g in zip(data, got.tolist(), strict=True) if w in alone)
    plain = np.frombuffer(b" ".join(data[:1000] + data[1001:]), np.uint8)
    start, end, _ = words(plain, np.array([0, len(plain)]))
    got, held = most_held(lambda: word_hashes(plain, start, end))
    assert len(plain) > 1 << 20 and held < 8 * len(plain)


@pytest.mark.parametrize("rows", [1, 5])
def test_bucket_of_signatures_holds_little(rows):
    """A bucket is sorted in parts, so it takes less than its signatures do again; ties are those of a plain sort."""
    rng = np.random.default_rng(rows)
    n, own, buckets = 400_000, 4000, 16
    sigs = [rng.integers(0, 1 << 64, n, np.uint64) for _ in range(rows)]
    # some signatures twice and more, one in every fiftieth place
    for sig in sigs:
        sig[: n // 50] = sigs[0][n // 100 : n // 100 + n // 50]
        sig[::50] = sigs[0][5]
    nodes = [rng.integers(-(1 << 62), 1 << 62, own) for _ in range(rows)]
    more = np.full(own, n // own, np.uint32)
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array([3]), pa.array([s.tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary()), pa.array([more.tobytes()], pa.binary())],
            names=["bucket", "sigs", "nodes", "more"],
        )
        for s, v in zip(sigs, nodes, strict=True)
    ]
    table = pa.Table.from_batches(batches)
    found, held = most_held(lambda: jaccard.tied_in_bucket(table, buckets))
    holders = {}
    for s, v in zip(sigs, nodes, strict=True):
        for sig, node in zip(s.view(np.int64).tolist(), np.repeat(v, n // own).tolist(), strict=True):
            holders.setdefault(sig, set()).add(node)
    want = {(sig, least, node) for sig, own in holders.items() for least in [min(own)] for node in own if node != least}
    got = list(zip(*(found.column(c).to_pylist() for c in ("sig", "a", "b")), strict=True))
    assert len(got) == len(set(got)) and set(got) == want
    assert held < 8 * n * rows * 1.5

    # ties found in a slice of text come through as they are
    ties = pa.table({"bucket": [buckets], "sigs": [sigs[0][:9].tobytes()], "nodes": [nodes[0][:9].tobytes()], "more": [nodes[0][9:18].tobytes()]})
    rows = jaccard.tied_in_bucket(ties, buckets).to_pylist()
    assert {(r["sig"], r["a"], r["b"]) for r in rows} == set(zip(sigs[0][:9].view(np.int64).tolist(), nodes[0][:9].tolist(), nodes[0][9:18].tolist(), strict=True))


def test_edges(spark):
    rows = jaccard.similar_groups(edges(spark), 5, 80).collect()
    assert len(rows) == len(EDGES)
    by = {r.doc_id: r for r in rows}
    assert all(by[d].n_shingles == 0 and by[d].component_id == d for d in (1, 2, 3))
    assert by[7].component_id == 6 and by[11].component_id == by[10].component_id == 10
    assert by[None].component_id is None and by[5].component_id == 5
    assert jaccard.similar_groups(empty(spark)).count() == 0


def test_stage(spark):
    source = edges(spark)
    kept = jaccard.keep_first(source)
    assert kept.columns == source.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "6", "8", "8", "None", "10"])
    assert jaccard.keep_first(empty(spark)).count() == 0


@pytest.mark.parametrize("percent", [80, 90])
def test_chance_of_a_lost_link(percent):
    """For every pair of sizes that may be similar: all common n-grams fall among the fragments of the others."""
    cut = jaccard.Cut(percent)
    worst = 0.0
    for t in range(int(cut.bounds[0]) + 1, 400):
        fragments = int(cut.fragments[np.searchsorted(cut.bounds, t)])
        for s in range(-(-t * percent // 100), t + 1):
            common = -(-(s + t) * percent // (100 + percent))
            if common <= s:
                apart = s + t - 2 * common
                worst = max(worst, (min(apart, fragments) / fragments) ** common)
    assert worst < 1e-9


def test_nothing_is_left_behind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    jaccard.keep_first(edges(spark)).collect()
    assert [p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()] == ["gone"]
