import hashlib
import re
from collections import defaultdict

import duckdb
from cases import EDGES, SF, docs, edges, empty, table
from compare import compare

from fleetlens.llm import exact
from fleetlens.llm.queries import ORACLES, QUERIES


def key(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()


def test_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    problems, rows = compare(QUERIES["op4_exact_dedup"](spark, SF), con, ORACLES["op4_exact_dedup"])
    assert not problems and rows > 0


def test_edges(spark):
    got = exact.keepers(edges(spark)).collect()
    assert len(got) == len(EDGES)
    groups = defaultdict(list)
    for doc, text, *_ in EDGES:
        groups[key(text)].append((-len(text or ""), doc if doc is not None else 1 << 62))
    for r in got:
        group = groups[r.text_sha256]
        assert r.group_size == len(group)
        assert (r.keep_id if r.keep_id is not None else 1 << 62) == min(group)[1]
    # one row of each group stays, of the repeated id 8 too
    assert sum(r.kept for r in got) == len(groups)


def test_hot_and_light_groups_agree(spark):
    rows = [(i, "hot text" if i % 3 == 0 else f"pair {i // 7}", "en", "s", 1) for i in range(600)]
    got = exact.keepers(docs(spark, rows), support=0.1).collect()
    want = exact.keepers(docs(spark, rows), support=1.0).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    hot = [r for r in got if r.group_size == 200]
    assert len(hot) == 200 and {r.keep_id for r in hot} == {0}


def test_stage_keeps_columns(spark):
    source = edges(spark)
    got = exact.drop_exact(source)
    assert got.columns == source.columns
    best = {}
    for doc, text, *_ in EDGES:
        rank = (-len(text or ""), doc is None, doc or 0)
        best[key(text)] = min(best.get(key(text), rank), rank)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == sorted(rank[1:] for rank in best.values())
    unique = source.filter("doc_id IS NULL OR doc_id <> 8")
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in exact.drop_exact(unique).collect()) == sorted(rank[1:] for rank in best.values() if rank[2] != 8)
    assert exact.drop_exact(empty(spark)).count() == 0 and exact.keepers(empty(spark)).count() == 0


def test_plan_is_native(spark):
    plan = exact.keepers(table(spark, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_texts_are_not_shuffled(spark):
    """Few dropped ids are broadcast: the texts stay where they are."""
    plan = exact.drop_exact(table(spark, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_smallest_id(spark):
    rows = [(-(1 << 63), "same", "en", "s", 1), (5, "same", "en", "s", 1)]
    assert {(r.doc_id, r.keep_id) for r in exact.keepers(docs(spark, rows)).collect()} == {(-(1 << 63), -(1 << 63)), (5, -(1 << 63))}
