import re
from pathlib import Path

import corpus_pipeline
import numpy as np
import pandas as pd
from cases import SF, edges, empty
from pyspark.sql import functions as F

from fleetlens.llm.queries import QUERIES


def test_stages_in_turn(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/{i}"
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if i < 4:
            assert docs.columns == columns
            assert docs.select("doc_id").distinct().count() == docs.count()
            counts.append(docs.count())
    assert all(a >= b > 0 for a, b in zip(counts, counts[1:]))
    assert counts[2] < counts[1] and counts[3] < counts[2] and counts[4] < counts[3]
    assert docs.select("doc_id").distinct().count() == counts[4]
    once = sorted(map(tuple, docs.drop("sequence_id", "offset").collect()))
    again = sorted(map(tuple, QUERIES["pipeline"](spark, SF).drop("sequence_id", "offset").collect()))
    assert once == again


def test_edges(spark):
    """Nulls, empty and long texts, repeats and clashing names through every stage; the kept rows are told by hand."""
    want = {
        # texts without a letter go; rows 10 and 11 and both rows 8 are exact copies
        "language": ["4", "5", "6", "7", "8", "8", "None", "10", "11"],
        "exact_dedup": ["4", "5", "6", "7", "8", "11"],
        # 7 is 6 with one more word
        "ngram_jaccard": ["4", "5", "6", "8", "11"],
    }
    docs = edges(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF)
        assert docs.columns == before.columns
        ids = [str(r.doc_id) for r in docs.collect()]
        if name in want:
            assert sorted(ids) == sorted(want[name]), name
        assert set(ids) <= {str(r.doc_id) for r in before.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    # every kept document whole, in pieces that follow one another
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    for doc_id in {r.doc_id for r in packed}:
        own = sorted((r.piece, r.start, r.length) for r in packed if r.doc_id == doc_id)
        assert [p for p, *_ in own] == list(range(len(own)))
        assert all(a[1] + a[2] == b[1] for a, b in zip(own, own[1:]))


def test_empty_tables(spark):
    docs = empty(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns and stage(spark, docs, SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_memory_of_workers(spark):
    """After a stage batches are small, and what a Python worker frees is given back, other than its smallest pieces."""

    def held():
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024

    def work(frames):
        for frame in frames:
            np.ones(3 << 20)
            before, large, pins = held(), [], []
            for _ in range(8):
                large.append(np.ones(1 << 20))
                pins.append(bytearray(4000))
            full = held()
            large.clear()
            yield pd.DataFrame({"rows": [len(frame)], "mb": [frame["text"].str.len().sum() / (1 << 20)], "taken": [full - before], "left": [held() - before], "pins": [len(pins)]})

    corpus_pipeline.STAGES[1][1](spark, edges(spark), SF)
    long = spark.range(0, 3000, 1, 1).select(F.when(F.col("id") < 100, F.repeat(F.lit("x"), 200_000)).otherwise("y").alias("text"))
    found = long.mapInPandas(work, "rows long, mb double, taken double, left double, pins long").collect()
    assert sum(r.rows for r in found) == 3000
    assert max(r.rows for r in found) <= 1024
    assert max(r.mb for r in found) < 5
    assert all(r.taken > 60 and r.left < 8 for r in found)
