import duckdb
from cases import SF, docs, edges, empty
from compare import compare

from fleetlens.llm import mixing
from fleetlens.llm.queries import ORACLES, QUERIES


def test_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    problems, rows = compare(QUERIES["op1_mix_sources"](spark, SF), con, ORACLES["op1_mix_sources"])
    assert not problems and rows > 0


def fill(given, children):
    """Plain water filling: children are (name, weight, holds); whole tokens, rounded down."""
    order = sorted(children, key=lambda c: (c[2] / c[1], c[0]))
    out, weights = {}, sum(c[1] for c in children)
    for i, (name, weight, holds) in enumerate(order):
        if holds * weights <= given * weight:
            out[name] = holds
            given -= holds
            weights -= weight
        else:
            out.update({n: given * w // weights for n, w, _ in order[i:]})
            break
    return out


def test_shortage_goes_to_siblings_first(spark):
    leaves = [("web", "en", "a", 10), ("web", "en", "b", 1000), ("web", "fr", "c", 500), ("books", "en", "d", 5000)]
    frame = spark.createDataFrame([(*x, 0) for x in leaves], "domain string, lang string, source string, capacity long, goal long")
    from pyspark.sql import functions as F

    got = {r.source: r.budget for r in mixing.budgets(frame, {"domain": {"web": 1, "books": 1}, "lang": {}, "source": {}}, F.lit(1200)).collect()}
    web = fill(1200, [("web", 1, 1510), ("books", 1, 5000)])
    en = fill(web["web"], [("en", 1, 1010), ("fr", 1, 500)])
    want = fill(en["en"], [("a", 1, 10), ("b", 1, 1000)]) | {"c": en["fr"], "d": web["books"]}
    assert got == want
    # the sibling takes what `a` lacks; the other domain gets no more than its share
    assert got["a"] == 10 and got["a"] + got["b"] == 300 and got["d"] == 600


def test_epochs_and_prefixes(spark):
    rows = [(i, "w " * (1 + i % 5), "en", "src0" if i % 3 else "src1", 0) for i in range(900)]
    got = mixing.select_mix(docs(spark, rows), budget_percent=150, max_epochs=2).collect()
    seen = {}
    for r in got:
        seen.setdefault((r.source, r.epoch), []).append(r)
    for (source, epoch), part in seen.items():
        assert len({r.doc_id for r in part}) == len(part)
    for source in ("src0", "src1"):
        used = sum(r.n_tokens for (s, _), part in seen.items() if s == source for r in part)
        budget = seen[source, 1][0].leaf_budget
        assert budget - 5 < used <= budget


def test_blocks_do_not_change_the_prefix(spark, monkeypatch):
    rows = [(i, "w " * (1 + i % 7), "en", "src0", 0) for i in range(500)]
    want = sorted(tuple(r) for r in mixing.select_mix(docs(spark, rows), budget_percent=40).collect())
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 16)
    assert sorted(tuple(r) for r in mixing.select_mix(docs(spark, rows), budget_percent=40).collect()) == want


def test_edges(spark):
    got = mixing.select_mix(edges(spark), budget_percent=100, max_epochs=1).collect()
    # every row with a token is there once; the leaf without tokens gives nothing
    assert sorted(str(r.doc_id) for r in got if r.n_tokens) == sorted(["4", "5", "6", "7", "8", "8", "None", "10", "11"])
    assert mixing.select_mix(empty(spark)).count() == 0
    source = edges(spark)
    assert mixing.mixed_documents(source).columns == source.columns
    assert mixing.mixed_documents(empty(spark)).count() == 0


def test_stage_states_budget_and_weights():
    import corpus_pipeline

    said = corpus_pipeline.mix_sources.__doc__
    assert f"{mixing.BUDGET_PERCENT} percent" in said
    assert all(f"{name} {weight}" in said for level in mixing.WEIGHTS.values() for name, weight in level.items())
