"""Near-duplicate vectors by a forest of random-projection trees with overlapping halves."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import col
from fleetlens.llm.components import components
from fleetlens.session import materialize

#: Least cosine of a link.
COSINE = 0.95
TREES = 6
#: Vectors up to which a node stays a leaf.
LEAF = 256
#: Half the overlap of two halves, as a share of the typical gap of the farthest link along a random direction.
SPILL = 0.5
#: Vectors per block when a leaf that can't be split is compared.
BLOCK = 1024
#: Leaves whose vectors are looked up at once.
LEAVES_AT_ONCE = 2048
#: Vectors of each length, and of each dense leaf, that splits are learned from.
SAMPLE, LEAF_SAMPLE = 20_000, 4096
#: Learned vectors that a node needs to be split; times ``leaf`` that make a leaf dense; levels of a tree at most.
FEWEST, DENSE, LEVELS = 32, 4, 48
#: Lines of (tree, length) that a process keeps.
LINES = 256
SEED = 29


def usable(vector: str = "vector"):
    """A vector without null or non-finite components that is not zero."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & ~bad & F.exists(vector, lambda v: v != 0), F.lit(False))


@lru_cache(LINES)
def directions(tree: int, depth: int, size: int) -> np.ndarray:
    """The unit vectors along which a tree splits, one per level."""
    out = np.random.default_rng([SEED, tree, size]).standard_normal((depth, size))
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by their largest component first, so nothing over- or underflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def margin_of(size: int, cosine: float) -> float:
    """Half the width of the strip around a split whose vectors go to both halves."""
    return SPILL * math.sqrt(2 - 2 * cosine) / math.sqrt(size)


def fit(x: np.ndarray, number: int, tree: int, share: float, leaf: int, margin: float) -> dict[int, float]:
    """Splits below node ``number`` learned from some of its vectors: the median of each node that is split.

    ``share`` is how many vectors of the node each given one stands for.  A node
    is split while it stands for more than ``leaf`` vectors, has enough of the
    given ones to tell a median, and its middle half is wider than the strip.
    """
    lines, splits, todo = directions(tree, LEVELS, x.shape[1]), {}, [(number, np.arange(len(x)))]
    while todo:
        number, rows = todo.pop()
        level = number.bit_length() - 1
        if len(rows) * share <= leaf or len(rows) < FEWEST or level >= LEVELS:
            continue
        along = x[rows] @ lines[level]
        low, middle, high = np.quantile(along, [0.25, 0.5, 0.75])
        if high - low <= 2 * margin:
            continue
        splits[number] = float(middle)
        todo += [(2 * number, rows[along <= middle + margin]), (2 * number + 1, rows[along > middle - margin])]
    return splits


def descend(x: np.ndarray, number: int, tree: int, splits: dict[int, float], margin: float) -> Iterator[tuple[int, np.ndarray]]:
    """``(node, rows)`` of every node below ``number`` that is not split and holds some of the rows."""
    lines, todo = directions(tree, LEVELS, x.shape[1]), [(number, np.arange(len(x)))]
    while todo:
        number, rows = todo.pop()
        if not len(rows):
            continue
        middle = splits.get(number)
        if middle is None:
            yield number, rows
            continue
        along = x[rows] @ lines[number.bit_length() - 1]
        todo += [(2 * number, rows[along <= middle + margin]), (2 * number + 1, rows[along > middle - margin])]


def placed(size: int, node: np.ndarray, found: Iterator[tuple[int, np.ndarray]], tree: int, trees: int) -> pd.DataFrame:
    """``size, node, leaf`` of all that a descent has found, as one frame."""
    numbers, rows = zip(*found, strict=True)
    leaf = np.repeat(np.array(numbers, np.int64) * trees + tree, [len(r) for r in rows])
    return pd.DataFrame({"size": np.int32(size), "node": node[np.concatenate(rows)], "leaf": leaf})


def matrix(frame: pd.DataFrame, size: int) -> np.ndarray:
    return unit(np.concatenate(frame["vector"].to_numpy()).astype(float).reshape(len(frame), size))


def grow(nodes: DataFrame, cosine: float, trees: int, leaf: int) -> DataFrame:
    """``size, node, leaf`` for every leaf of every tree that a vector is in.

    Vectors of each length (``size``) have a forest of their own; a leaf's
    number tells it only from the others of its length.  The splits of all trees
    come from about ``SAMPLE`` vectors, picked by hash, and one pass gives every
    vector its leaves: at each split the half of its projection, or both
    halves when it lies close to the median.  Leaves that turn out larger than
    ``DENSE`` times ``leaf`` are split further, all at once, each by a sample of
    its own; what has too narrow a middle stays as it is.
    """
    spark = nodes.sparkSession
    forests: dict[int, list[dict[int, float]]] = {}
    # one row per length
    for size, n in nodes.groupBy("size").agg(F.count("*")).collect():
        picked = nodes.filter((F.col("size") == size) & (F.pmod(F.xxhash64("k1", F.lit(SEED)), F.lit(n)) < SAMPLE)).select("vector").toPandas()
        x = matrix(picked, size) if len(picked) else np.empty((0, size))
        forests[size] = [fit(x, 1, t, n / max(1, len(x)), leaf, margin_of(size, cosine)) for t in range(trees)]
    shared = spark.sparkContext.broadcast(forests)

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for mixed in frames:
            for size, frame in mixed.groupby("size"):
                x, node = matrix(frame, int(size)), frame["node"].to_numpy()
                for t, splits in enumerate(shared.value[int(size)]):
                    yield placed(int(size), node, descend(x, 1, t, splits, margin_of(int(size), cosine)), t, trees)

    member = materialize(nodes.select("size", "node", "vector").mapInPandas(first, "size int, node long, leaf long"), "member0")
    settled = spark.createDataFrame([], "size int, leaf long")
    for turn in range(1, LEVELS):
        counts = member.groupBy("size", "leaf").agg(F.count("*").alias("n")).filter(F.col("n") > DENSE * leaf)
        dense = materialize(counts.join(settled, ["size", "leaf"], "left_anti"), f"dense{turn}")
        if dense.isEmpty():
            return member
        # the vectors of dense leaves; of each leaf a bounded sample meets in one task
        inside = member.join(dense, ["size", "leaf"]).join(nodes.select("node", "vector"), "node")
        sample = inside.filter(F.pmod(F.xxhash64("node", "leaf"), F.col("n")) < LEAF_SAMPLE).select("size", "leaf", "n", "vector")

        def learn(frame: pd.DataFrame) -> pd.DataFrame:
            size, own, n = int(frame["size"].iloc[0]), int(frame["leaf"].iloc[0]), int(frame["n"].iloc[0])
            splits = fit(matrix(frame, size), own // trees, own % trees, n / len(frame), leaf, margin_of(size, cosine))
            return pd.DataFrame({"size": [size], "leaf": [own], "numbers": [list(splits)], "middles": [list(splits.values())]})

        def further(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for mixed in frames:
                for (size, own), frame in mixed.groupby(["size", "leaf"]):
                    splits = dict(zip(map(int, frame["numbers"].iloc[0]), frame["middles"].iloc[0], strict=True))
                    node = frame["node"].to_numpy()
                    found = descend(matrix(frame, int(size)), int(own) // trees, int(own) % trees, splits, margin_of(int(size), cosine))
                    yield placed(int(size), node, found, int(own) % trees, trees)

        learned = materialize(sample.groupBy("size", "leaf").applyInPandas(learn, "size int, leaf long, numbers array<long>, middles array<double>"), f"splits{turn}")
        split = learned.filter(F.size("numbers") > 0)
        settled = settled.union(learned.filter(F.size("numbers") == 0).select("size", "leaf"))
        if split.isEmpty():
            return member
        deeper = inside.join(split, ["size", "leaf"]).select("size", "node", "leaf", "vector", "numbers", "middles").mapInPandas(further, "size int, node long, leaf long")
        member = materialize(member.join(split.select("size", "leaf"), ["size", "leaf"], "left_anti").select("size", "node", "leaf").union(deeper), f"member{turn}")
    return member


def roots(linked: np.ndarray) -> np.ndarray:
    """For a symmetric matrix of links, the smallest row that each row reaches."""
    label = np.arange(len(linked))
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label)))
        low = low[low]
        if (low == label).all():
            return label
        label = low


def compare(table: pa.Table, cosine: float) -> pa.Table:
    """Links inside one block pair of a leaf: a spanning set of them, and how many links each vector has.

    A link counts only in the smallest leaf that its two vectors share, so no
    pair leaves the task and none counts twice.
    """
    here, first, second = (table.column(c)[0].as_py() for c in ("leaf", "one", "two"))
    table = table.take(pc.sort_indices(table, sort_keys=[("node", "ascending")])).combine_chunks()
    node, weight, block = (table.column(c).to_numpy() for c in ("node", "weight", "block"))
    x = unit(table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(node), -1))
    links = x @ x.T >= cosine
    np.fill_diagonal(links, False)
    if first != second:
        links &= block[:, None] != block[None, :]
    label = roots(links)
    tied = np.flatnonzero(label != np.arange(len(label)))
    out = [(node[label[tied]], node[tied], np.zeros(len(tied), np.int64))]
    linked = np.flatnonzero(links.any(axis=1))
    if len(linked):
        # leaves smaller than this one that several linked vectors are in; two that share none of them count here
        own = table.column("leaves").combine_chunks()
        offsets, leaves = own.offsets.to_numpy(), own.flatten().to_numpy()
        row = np.repeat(np.arange(len(node)), np.diff(offsets))
        place = np.full(len(node), -1)
        place[linked] = np.arange(len(linked))
        inside = (leaves < here) & (place[row] >= 0)
        _, number, often = np.unique(leaves[inside], return_inverse=True, return_counts=True)
        several = often[number] > 1
        _, number = np.unique(number[several], return_inverse=True)
        row = place[row[inside][several]]
        met = np.zeros((len(linked), len(linked)), np.float32)
        for at in range(0, int(number.max(initial=-1)) + 1, LEAVES_AT_ONCE):
            now = (number >= at) & (number < at + LEAVES_AT_ONCE)
            holds = np.zeros((len(linked), LEAVES_AT_ONCE), np.float32)
            holds[row[now], number[now] - at] = 1
            met += holds @ holds.T
        count = np.zeros(len(node), np.int64)
        count[linked] = np.where(links[np.ix_(linked, linked)] & (met == 0), weight[linked], 0).sum(axis=1)
        some = np.flatnonzero(count)
        out.append((node[some], node[some], count[some]))
    return pa.table(dict(zip(("a", "b", "n"), (np.concatenate(c) for c in zip(*out, strict=True)), strict=True)))


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES, leaf: int = LEAF
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Rows link when the cosine of their vectors, in double precision, is
    ``cosine`` or more and some tree has both in a leaf.  Equal vectors are one
    node, so a hot group of copies is compared once.  Leaves that can't be
    split are compared in blocks.

    Vectors of each length are compared among themselves.  Null and zero
    vectors and vectors with null or non-finite components link with nothing.  Rows that
    repeat an id are separate vectors; null ids never name a component but a
    null one; other columns are ignored; an empty table gives no rows.
    """
    rows = vectors.select(col(id_col).cast("long").alias("vec_id"), col(vector_col).cast("array<double>").alias("vector")).withColumn("usable", usable())
    rows = rows.select("vec_id", "vector", F.col("usable"), F.xxhash64("vector").alias("k1"), F.xxhash64(F.lit(SEED), "vector").alias("k2"))
    rows = materialize(rows.withColumn("size", F.size("vector")), "vectors")
    if rows.filter("usable").isEmpty():
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    nodes = rows.filter("usable").groupBy("size", "k1", "k2").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"), F.first("vector").alias("vector"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "vecnodes")

    member = materialize(grow(nodes, cosine, trees, leaf), "leaves")
    counts = member.groupBy("size", "leaf").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = counts.select("size", "leaf", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    of = member.groupBy("node").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))
    full = nodes.select("node", "weight", "vector").join(of, "node")
    dealt = member.join(blocks, ["size", "leaf"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # a block meets every block of its leaf, itself included
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("size", "node", "leaf", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")).join(full, "node")
    found = dealt.groupBy("size", "leaf", "one", "two").applyInArrow(lambda table: compare(table, cosine), "a long, b long, n long")
    found = materialize(found, "near")

    links = components(found.filter("a <> b").select("a", "b"), "vecs")
    number = found.filter("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    named = nodes.select("size", "k1", "k2", "node", "least", "weight").join(links, "node", "left").join(number, "node", "left")
    named = materialize(named.withColumn("component", F.coalesce("component", "node")), "vecnamed")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("size", "k1", "k2", "component_id", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.lit(True).alias("usable"))
    out = rows.select("vec_id", "usable", "size", "k1", "k2").join(named, ["size", "k1", "k2", "usable"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
