"""From documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm import exact, jaccard, language, mixing, packing
from fleetlens.llm.common import prepare
from fleetlens.session import materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; texts without a letter go, and those without any evidence for a language.

    Null and empty texts have no letter, so they go.  Rows that repeat an id are
    judged each by itself; without labels every text with a letter stays; an
    empty table gives no rows.
    """
    return language.keep_known(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts.

    Texts are equal without their blanks; the longest stays, then the smallest
    id, a null id last.  A null text is an empty one.  A row that repeats an id
    and text stays once; an empty table gives no rows.
    """
    return exact.drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more on five-word shingles.

    The one with the group's smallest id stays.  Texts without a word (null,
    empty) link with nothing and stay, rows with a null id stay too; an empty
    table gives no rows.
    """
    return jaccard.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the target weights select, each once at most.

    The budget is 75 percent of all tokens (``mixing.BUDGET_PERCENT``), so
    about a quarter goes at every size; ``mixing.WEIGHTS`` deals it out: web 5,
    books 3, forum 2; en 6, fr 2, de 2, es 1; src0 2; any other node 1.
    A null language or source is a node of its own, texts without a token come
    along in their place, an empty table gives no rows.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 2048 tokens.

    A null text is an empty one (its end id alone); rows that repeat an id are
    packed each; an empty table gives no rows.
    """
    return packing.pack(docs)


def _stage(work):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return work(prepare(spark, lean=True), docs, sf_dir)

    run_stage.__doc__ = work.__doc__
    return run_stage


STAGES = [
    ("language", _stage(known_language)),
    ("exact_dedup", _stage(exact_dedup)),
    ("ngram_jaccard", _stage(near_dedup)),
    ("mix_sources", _stage(mix_sources)),
    ("pack", _stage(pack_sequences)),
]

#: Learned models, similarity joins and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
