"""Mixing sources to target weights by hierarchical budgets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import col, fresh
from fleetlens.session import materialize

#: Levels of the tree, root first.
LEVELS = ("domain", "lang", "source")
#: Weights of nodes by level; a node that is not named has weight 1.
WEIGHTS: Mapping[str, Mapping[str, int]] = {
    "domain": {"web": 5, "books": 3, "forum": 2},
    "lang": {"en": 6, "fr": 2, "de": 2, "es": 1},
    "source": {"src0": 2},
}
#: Domains dealt to sources by their number; a source without a number is ``other``.
DOMAINS = ("web", "books", "forum")
#: Times that a document may be taken.
MAX_EPOCHS = 2
#: Budget as hundredths of the tokens there are.
BUDGET_PERCENT = 75
#: Rows per block of a leaf in which running sums are made.
BLOCK_ROWS = 2048
SEED = 17


def domain_of(source: str = "source") -> Column:
    """Domain of a source name that ends in a number; any other is ``other``."""
    number = f"try_cast(right(regexp_extract(`{source}`, '([0-9]+)$', 1), 9) AS INT)"
    names = ", ".join(f"'{d}'" for d in DOMAINS)
    return F.expr(f"coalesce(element_at(array({names}), {number} % {len(DOMAINS)} + 1), 'other')")


def word_tokens(text: str = "text") -> Column:
    """Default token count: words between blanks."""
    return F.regexp_count(F.coalesce(col(text).cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def weight_of(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    named = weights.get(level, {})
    value = F.lit(1)
    for name, weight in named.items():
        value = F.when(F.col(level) == name, F.lit(int(weight))).otherwise(value)
    return value.cast("long")


def budgets(leaves: DataFrame, weights: Mapping[str, Mapping[str, int]], budget: Column) -> DataFrame:
    """``leaves`` (levels, capacity) with the tokens each leaf may give, as ``budget``.

    Every node hands its budget to its children in proportion to their
    weights, none above what its subtree holds; what a child can't use goes to
    its siblings, so an ancestor's siblings get only what the whole subtree
    lacks.  Amounts are whole tokens, rounded down.
    """
    plan = leaves.withColumn("budget", F.least(budget.cast("long"), F.sum("capacity").over(Window.partitionBy(F.lit(0)))))
    for i, level in enumerate(LEVELS):
        keys = list(LEVELS[: i + 1])
        nodes = plan.groupBy(*keys).agg(F.sum("capacity").alias("holds"), F.first("budget").alias("given")).withColumn("weight", weight_of(level, weights))
        # children by the level at which they run dry; those before the cut are used up
        parent = keys[:-1] or [F.lit(0)]
        order = Window.partitionBy(*parent).orderBy((F.col("holds") / F.col("weight")), *keys)
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        nodes = nodes.select(
            "*",
            (F.col("given") - F.coalesce(F.sum("holds").over(before), F.lit(0))).alias("left"),
            F.sum("weight").over(rest).alias("weights"),
        )
        nodes = nodes.withColumn("dry", F.expr("CAST(holds AS DECIMAL(38,0)) * weights <= CAST(left AS DECIMAL(38,0)) * weight"))
        cut = Window.partitionBy(*parent)
        nodes = nodes.withColumn("first_wet", F.max(F.when(~F.col("dry"), F.struct("weights", "left"))).over(cut))
        share = F.expr("CAST((CAST(first_wet.left AS DECIMAL(38,0)) * weight) div first_wet.weights AS BIGINT)")
        nodes = nodes.withColumn("share", F.when(F.col("dry"), F.col("holds")).otherwise(share)).select(*keys, "share")
        plan = plan.join(nodes, keys).withColumn("budget", F.col("share")).drop("share")
    return plan


def select_mix(
    docs: DataFrame,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    tokens: Column | None = None,
    domain: Column | None = None,
    budget_percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    id_col: str = "doc_id",
) -> DataFrame:
    """Rows taken: ``doc_id, epoch, domain, lang, source, n_tokens, leaf_budget``.

    The budget is a share of all tokens, handed down the tree
    domain-language-source (see ``budgets``).  A leaf orders its documents anew
    in every epoch by a seeded hash, gives whole epochs while the budget covers
    them, and of the next epoch the longest prefix that stays within it.

    Null language or source is a node of its own (``?``), null ids hash like 0,
    a text without tokens costs nothing and comes along in its place (but a leaf
    without any token gives nothing), repeated rows are separate rows, an empty table gives no rows.  Running sums are
    made inside blocks of a leaf only, so no leaf has to fit into one task.
    """
    rows = materialize(
        docs.select(
            col(id_col).cast("long").alias("doc_id"),
            (domain if domain is not None else domain_of()).alias("domain"),
            F.coalesce(col("lang").cast("string"), F.lit("?")).alias("lang"),
            F.coalesce(col("source").cast("string"), F.lit("?")).alias("source"),
            (tokens if tokens is not None else word_tokens()).cast("long").alias("n_tokens"),
        ),
        "mix",
    )
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("supply"), F.count("*").alias("n_rows"))
    leaves = leaves.withColumn("capacity", F.col("supply") * max_epochs)
    total = F.expr(f"(sum(supply) OVER (PARTITION BY 0) * {int(budget_percent)}) div 100")
    leaves = leaves.withColumn("goal", total)
    plan = budgets(leaves, weights, F.col("goal")).select(
        *LEVELS,
        F.col("budget").alias("leaf_budget"),
        F.expr("CASE WHEN supply > 0 THEN least(budget div supply, capacity div supply) ELSE 0 END").cast("int").alias("whole"),
        F.expr("CASE WHEN supply > 0 THEN budget % supply ELSE 0 END").alias("part"),
        F.greatest(F.lit(1), F.ceil(F.col("n_rows") / BLOCK_ROWS)).cast("long").alias("blocks"),
    )
    plan = materialize(plan, "mixplan")
    taken = rows.join(plan, list(LEVELS))
    whole = taken.filter("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("whole"))))

    order = F.md5(F.concat_ws(":", F.lit(seed), F.col("whole") + 1, F.coalesce(F.col("doc_id"), F.lit(0))).cast("binary"))
    order = F.conv(F.substring(order, 1, 7), 16, 10).cast("long")
    partial = taken.filter("part > 0").withColumn("place", order).withColumn("block", F.expr(f"(place * blocks) div {1 << 28}"))
    blocks = partial.groupBy(*LEVELS, "block").agg(F.sum("n_tokens").alias("block_tokens"), F.first("part").alias("part"))
    upto = Window.partitionBy(*LEVELS).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("start", F.coalesce(F.sum("block_tokens").over(upto), F.lit(0)))
    # blocks past the budget give nothing, those within it come whole; one block per leaf is cut
    blocks = blocks.filter("start <= part").select(*LEVELS, "block", "start", (F.col("start") + F.col("block_tokens") <= F.col("part")).alias("inside"))
    near = partial.join(materialize(blocks, "mixblocks"), [*LEVELS, "block"])
    running = Window.partitionBy(*LEVELS, "block").orderBy("place", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = near.filter(~F.col("inside")).withColumn("end", F.col("start") + F.sum("n_tokens").over(running)).filter("end <= part")
    columns = ["doc_id", "epoch", *LEVELS, "n_tokens", "leaf_budget"]
    last = (F.col("whole") + 1).alias("epoch")
    return (
        whole.select(columns)
        .union(near.filter("inside").withColumn("epoch", last).select(columns))
        .union(cut.withColumn("epoch", last).select(columns))
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` that one epoch at most selects, with their columns.

    Repeats would undo a deduplication before it, so a leaf without enough
    text gives all it has and its relatives fill in.
    """
    taken = materialize(select_mix(docs, id_col=id_col, **{**settings, "max_epochs": 1}), "mixed")
    key = fresh(docs.columns, "mixed_id")[0]
    ids = taken.select(F.col("doc_id").alias(key))
    return docs.join(ids, col(id_col).cast("long").eqNullSafe(F.col(key)), "left_semi")
