"""Connected components of links: stars inside each partition first, then joins that converge in a few rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.session import materialize, scratch

#: Rounds after which something is wrong; each halves the depth of the trees at least.
MOST_ROUNDS = 60
#: Links that a task makes stars of at once.
LINKS_AT_ONCE = 1 << 20


def stars_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as stars: ``(least node, node)`` of every other node."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = place[: len(a)], place[len(a) :]
    least = np.arange(len(nodes))
    while True:
        x, y = least[one], least[two]
        if (x == y).all():
            break
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while (least[least] != least).any():
            least = least[least]
    away = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[least[away]], nodes[away]


def _local_stars(edges: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            a, b = stars_of(*(np.concatenate(c) for c in zip(*held, strict=True)))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            if sum(len(a) for a, _ in held) >= LINKS_AT_ONCE:
                yield out()
                held.clear()
        if held:
            yield out()

    return edges.mapInArrow(work, "a long, b long")


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest of its neighbourhood."""
    both = _both(edges)
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    return both.join(low, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them."""
    low = edges.groupBy("b").agg(F.min("a").alias("m"))
    handed = F.array(F.when(F.col("a") != F.col("m"), F.struct(F.col("m").alias("a"), F.col("a").alias("b"))), F.struct(F.col("m").alias("a"), F.col("b").alias("b")))
    return edges.join(low, "b").select(F.inline(F.filter(handed, lambda x: x.isNotNull()))).distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node, component`` for every node of ``links`` (a, b): the smallest node it reaches.

    Tasks first turn the links they hold into stars, which drops most of them.
    Then come rounds of large and small stars, each written to the shared
    folder; hubs are joined by key, so adaptive execution may split them.  Links
    of a node with itself and repeated links change nothing; no links give no
    rows.
    """
    with scratch(links.sparkSession) as keep:
        edges = _local_stars(links.filter("a <> b").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))).distinct()
        edges = materialize(edges, f"{label}-links")
        before = None
        for _ in range(MOST_ROUNDS):
            mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            if mark == before or not mark[0]:
                break
            before = mark
            edges = materialize(_small_star(_large_star(edges)), label)
        else:
            raise RuntimeError("components did not settle")
        rows = F.inline(F.array(F.struct(F.col("b").alias("node"), F.col("a").alias("component")), F.struct(F.col("a").alias("node"), F.col("a").alias("component"))))
        return keep(edges.select(rows).distinct(), label)
