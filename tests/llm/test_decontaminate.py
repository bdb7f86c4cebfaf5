import hashlib
import re

from cases import docs, edges, empty, table

from fleetlens.llm import decontaminate

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ITEMS = "item_id long, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(texts, items, window=10):
    """Every window of every item tried at every word of every text."""
    out = []
    for doc_id, text in texts:
        own, hit, names = words(text), set(), set()
        for name, item in items:
            w = words(item)
            for run in [w[i : i + window] for i in range(max(1, len(w) - window + 1))] if w else []:
                for at in range(len(own) - len(run) + 1):
                    if own[at] == run[0] and own[at : at + len(run)] == run:
                        hit.update(range(at, at + len(run)))
                        names.update([] if name is None else [str(name)])
        out.append((doc_id, len(own), len(hit), sorted(names)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in df.collect()), key=repr)


def test_against_brute_force(spark):
    corpus, bench = table(spark, "documents").limit(150), table(spark, "benchmark")
    want = brute([(r.doc_id, r.text) for r in corpus.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert found(decontaminate.find_hits(corpus, bench)) == want
    whole = decontaminate.report(table(spark, "documents"), bench).collect()
    assert any(r.contaminated for r in whole) and not all(r.contaminated for r in whole)
    one = decontaminate.find_hits(table(spark, "documents"), bench)
    for r in one.filter("n_hit > 0").join(table(spark, "documents"), "doc_id").collect():
        # spans lead to the hit words of the original text
        assert sum(len(words(r.text[s.start : s.end])) for s in r.spans) == r.n_hit
    digests = {r.doc_id: r.items_sha256 for r in whole}
    for r in one.collect():
        assert digests[r.doc_id] == hashlib.sha256(",".join(r["items"]).encode()).hexdigest()


def test_short_overlapping_and_strange_items(spark):
    rows = [
        (1, "A b c d e f g h i j k", "en", "s", 1),
        (2, "x one-TWO  three.", "en", "s", 1),
        (3, "b c d e f g h i j", "en", "s", 1),
        (4, "ÄÖ straße 東京 stop, ÄÖ Straße", "de", "s", 1),
        (5, "one two one two three one", "en", "s", 1),
        (None, "one two three", "en", "s", 1),
    ]
    items = [(7, "a b c d e f g h i j"), (8, "B c d e f g h i j k"), (9, "one two three"), (9, "one two three"), (10, "straße 東京"), (11, None), (12, " .,"), (None, "x one"), (13, "ÄÖ straße")]
    bench = spark.createDataFrame(items, ITEMS)
    corpus = docs(spark, rows)
    want = brute([r[:2] for r in rows], items)
    assert found(decontaminate.find_hits(corpus, bench)) == want
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in decontaminate.find_hits(corpus, bench).collect()}
    assert spans[1] == [(0, 21)] and spans[2] == [(0, 16)] and spans[3] == [] and spans[4] == [(0, 12), (19, 28)] and spans[None] == [(0, 13)]
    # several automata find the same, with an item longer than the bound too
    for bound in (1, 11):
        many = decontaminate.find_hits(corpus, bench, words_each=bound)
        assert found(many) == want
        assert {r.doc_id: [tuple(s) for s in r.spans] for r in many.collect()} == spans


def test_edges(spark):
    bench = spark.createDataFrame([(1, "one"), (2, "a text without a number of its own, which is long"), (3, "Größe 東京")], ITEMS)
    rows = edges(spark)
    want = brute([(r.doc_id, r.text) for r in rows.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert found(decontaminate.find_hits(rows, bench)) == want
    none = decontaminate.report(rows, bench.limit(0)).collect()
    assert len(none) == rows.count() and not any(r.contaminated for r in none)
    assert {r.items_sha256 for r in none} == {hashlib.sha256(b"").hexdigest()}
    assert decontaminate.report(empty(spark), bench).count() == 0
    clashing = bench.selectExpr("item_id", "text", "1 AS name", "2 AS doc_id", "3 AS n_hit")
    assert found(decontaminate.find_hits(rows, clashing)) == want
