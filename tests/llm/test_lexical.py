import math
import re
from collections import Counter

from cases import docs, edges, empty, table

from fleetlens.llm import lexical

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ITEMS = "item_id long, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(texts, items, top=50):
    """Every document scored for every query, without an index."""
    held = [(doc_id, Counter(words(text))) for doc_id, text in texts]
    n_docs, n_terms = sum(1 for _, h in held if h), sum(sum(h.values()) for _, h in held)
    df = Counter(t for _, h in held for t in h)
    out = []
    for item_id, text in items:
        terms = set(words(text))
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in terms}
        scored = []
        for doc_id, h in held:
            if not h:
                continue
            m = 100 - 50 + (50 * sum(h.values()) * n_docs) // n_terms
            score = sum(w[t] * ((1000000000 * h[t]) // (1000 * h[t] + 20 * m)) for t in terms if h[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scored)[:top], 1):
            out.append((item_id, rank, None if null else doc_id, -score))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def rows_of(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


def test_against_brute_force(spark):
    corpus, bench = table(spark, "documents"), table(spark, "benchmark")
    want = brute(rows_of(corpus, "doc_id", "text"), rows_of(bench, "item_id", "text"))
    assert found(lexical.search(corpus, bench)) == want
    # queries in several groups
    assert found(lexical.search(corpus, bench, terms_each=100)) == want


def test_small_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "TOP", 5)
    monkeypatch.setattr(lexical, "SHARD_DOCS", 64)
    monkeypatch.setattr(lexical, "BLOCK", 4)
    corpus, bench = table(spark, "documents"), table(spark, "benchmark")
    want = brute(rows_of(corpus, "doc_id", "text"), rows_of(bench, "item_id", "text"), 5)
    assert found(lexical.search(corpus, bench)) == want
    monkeypatch.setattr(lexical, "WIDEST", 20)
    assert found(lexical.search(corpus, bench)) == want


def test_blocks_are_skipped_and_bounds_hold(spark):
    """In one shard: no document scores over its block's bound, and some blocks stay unread."""
    corpus = rows_of(table(spark, "documents"), "doc_id", "text")
    items = rows_of(table(spark, "benchmark"), "item_id", "text")
    plan = lexical.Plan([(i, [w.encode() for w in words(text)]) for i, (_, text) in enumerate(items)])
    held = [(doc_id, Counter(w for w in words(text) if w.encode() in plan.numbers), len(words(text))) for doc_id, text in corpus]
    plan.learn(sum(1 for h in held if h[2]), sum(h[2] for h in held), Counter(plan.numbers[w.encode()] for _, h, _ in held for w in h))
    rows = []
    for doc_id, h, n in held:
        own = sorted((plan.numbers[w.encode()], c) for w, c in h.items())
        if own:
            rows.append((doc_id, [t for t, _ in own], plan.impacts(n, [c for _, c in own])))
    import numpy as np
    import pyarrow as pa

    signs = np.random.default_rng(1).choice(np.array([-1, 1], np.float32), (len(plan.numbers), lexical.SIGNS))
    built = lexical.build_shard(rows, plan, signs)
    shard = lexical.Shard(pa.RecordBatch.from_arrays([pa.array([v.tolist()]) for v in built.values()], names=list(built)), 0, plan)
    # every posting is in one block of its list
    assert sorted(zip(np.repeat(shard.list_terms, np.diff(shard.list_starts)), shard.postings)) == sorted(zip(shard.terms, np.repeat(np.arange(len(rows)), np.diff(shard.starts))))
    read = there = 0
    for _, terms in plan.queries:
        exact = shard.table[:, terms].astype(np.int64) @ plan.weights[terms]
        least = np.sort(exact)[-5]
        for number in shard.lists(terms)[0]:
            bounds = shard.bounds(number, shard.asking(terms))
            if bounds is None:
                continue
            blocks = np.arange(shard.list_blocks[number], shard.list_blocks[number + 1])
            assert all(exact[m].max() <= b for m, b in zip(shard.members(blocks), bounds))
            read += int((bounds >= least).sum())
            there += len(bounds)
    assert 0 < read < 0.8 * there


def test_edges(spark):
    items = [(1, "one Two, text"), (1, "one Two, text"), (2, None), (3, " ., "), (None, "東京 größe"), (4, "nowhere"), (5, "W1 w2 x3 x3 end")]
    bench = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 AS query", "2 AS doc_id", "3 AS score")
    rows = edges(spark)
    assert found(lexical.search(rows, bench)) == brute(rows_of(rows, "doc_id", "text"), items)
    assert lexical.search(empty(spark), bench).count() == 0
    assert lexical.search(rows, bench.limit(0)).count() == 0
    assert lexical.search(docs(spark, [(1, None, None, None, None), (2, " .", None, None, None)]), bench).count() == 0
    # equal scores by id, and more of them than are returned
    same = docs(spark, [(i, "the same words here", "en", "s", 1) for i in range(120, 0, -1)] + [(500 + i, f"filler {i}", "en", "s", 1) for i in range(200)])
    one = [(9, "same words")]
    assert found(lexical.search(same, spark.createDataFrame(one, ITEMS))) == brute(rows_of(same, "doc_id", "text"), one)
