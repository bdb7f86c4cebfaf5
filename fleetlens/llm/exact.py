"""Exact duplicates with a heavy-hitter split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import col, few, fresh
from fleetlens.session import materialize, scratch

#: Characters that do not count when texts are compared.
BLANKS = " \t\n\x0b\f\r"
#: A digest with this share of the rows is frequent; at most ``1 / SUPPORT`` digests can be.
SUPPORT = 1 / 1024


def digest(text_col: str = "text") -> Column:
    """SHA-256 of the text without blanks, as bytes; null counts as empty."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    return F.unhex(F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "").cast("binary"), 256))


def keepers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the most code points stays, then the smallest
    id, then one of the repeated rows.  Misra-Gries counters name the digests
    that may be frequent; their exact winners, at most ``1 / support`` rows, are
    broadcast, so rows of a hot group find their keeper without being shuffled.
    All other digests go through one shuffle.

    Null text is an empty text, all blank texts are one group, null ids rank
    last, other columns are ignored, an empty table gives no rows.
    """
    rows = materialize(
        docs.select(
            col(id_col).cast("long").alias("doc_id"),
            digest(text_col).alias("digest"),
            F.char_length(F.coalesce(col(text_col).cast("string"), F.lit(""))).cast("long").alias("size"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "exact",
    )
    # smaller is better: longest, smallest id with nulls last, first row
    rank = F.struct((-F.col("size")).alias("size"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    # the counters compare keys as values only if they are text
    found = rows.select(F.hex("digest").alias("digest")).stat.freqItems(["digest"], support)
    found = found.select(F.explode("digest_freqItems").alias("digest")).distinct().select(F.unhex("digest").alias("digest"))
    # broadcasts without a count: the counters hold at most 1 / support digests
    best = [F.min(rank).alias("best"), F.count("*").alias("group_size")]
    counted = rows.join(F.broadcast(found), "digest").groupBy("digest").agg(*best)
    winners = counted.filter(F.col("group_size") >= F.lit(rows.count() * support))
    hot = rows.join(F.broadcast(winners), "digest")
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    rest = rest.join(rest.groupBy("digest").agg(*best), "digest")
    return hot.unionByName(rest).select(
        "doc_id",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("best.row") == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns.

    Rows leave by the ids of the dropped ones.  While these are few enough to
    be broadcast (``common.few``) no text is shuffled; beyond that the same
    join shuffles the texts once.  If an id repeats, rows stay by id and digest
    instead, and a repeated row (same id, same text) stays once.
    """
    with scratch(docs.sparkSession) as keep:
        found = materialize(keepers(docs, id_col, text_col, support), "kept")
        repeated = not found.groupBy("doc_id").count().filter("count > 1").isEmpty()
        ids = keep(found.filter("kept" if repeated else "NOT kept").select("doc_id", F.unhex("text_sha256").alias("digest")), "ids")
    key, mark, own = fresh(docs.columns, "marked_id", "marked_digest", "own_digest")
    ids = ids.select(F.col("doc_id").alias(key), F.col("digest").alias(mark))
    same = col(id_col).cast("long").eqNullSafe(F.col(key))
    if not repeated:
        return docs.join(few(ids.select(key)), same, "left_anti")
    out = docs.withColumn(own, digest(text_col)).join(ids, same & (F.col(own) == F.col(mark)), "left_semi")
    return out.dropDuplicates([id_col, own]).drop(own)
