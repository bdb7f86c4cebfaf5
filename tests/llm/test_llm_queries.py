"""Queries with check SQL, on the smallest supplied tables."""

import duckdb
import pytest
from cases import SF
from compare import compare

from fleetlens.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ["op6_ngram_jaccard", "op8_embedding_forest", "op10_suffix_dedup", "op11_decontaminate", "op13_lexical_search"])
def test_check_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    problems, rows = compare(QUERIES[name](spark, SF), con, ORACLES[name])
    assert not problems and rows > 0


def test_every_operator_is_there():
    numbers = [name.split("_")[0] for name in QUERIES if name != "pipeline"]
    assert sorted(numbers) == sorted(f"op{n}" for n in range(1, 14)) and "pipeline" in QUERIES
