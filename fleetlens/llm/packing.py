"""Packing documents into fixed-length sequences by a grouping genetic algorithm."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import text_rows
from fleetlens.llm.tokens import RANKS, VOCABULARY, encode
from fleetlens.session import materialize

#: Tokens that a sequence holds.
CAPACITY = 2048
#: Id that ends every document.
END = 0
#: Pieces per shard (expected); a shard is what one population packs.
SHARD_PIECES = 4096
ISLANDS = 2
#: Rounds of evolution; between two rounds each island's best moves to the next island.
ROUNDS = 2
GENERATIONS = 8
POPULATION = 6
#: Sequences emptier than this are taken apart and packed again across shards.
LOOSE = 0.985
#: Passes of taking apart.
PASSES = 2


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, ranks: str = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's tokens and the end id.

    A document longer than ``capacity`` is cut into full pieces behind a first
    one with the rest.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([END], "<u4")
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.concatenate([encode(text, vocabulary, ranks), end])
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                out += [(doc, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return text_rows(docs, id_col, text_col).mapInArrow(work, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Bins:
    """Open sequences by free space; finds the fullest one that a length fits into."""

    def __init__(self, capacity: int):
        self.capacity, self.by_free, self.mask = capacity, [[] for _ in range(capacity + 1)], 0

    def add(self, number: int, free: int) -> None:
        self.by_free[free].append(number)
        self.mask |= 1 << free

    def take(self, length: int) -> tuple[int, int] | None:
        """``(bin, free)`` of the best fit, taken out; None if none fits."""
        open_ = self.mask >> length
        if not open_:
            return None
        free = length + (open_ & -open_).bit_length() - 1
        own = self.by_free[free]
        number = own.pop()
        if not own:
            self.mask ^= 1 << free
        return number, free


def best_fit(lengths: list[int], order: list[int], genome: np.ndarray, bins: Bins, count: int) -> int:
    """Put the items of ``order`` into ``bins`` or new ones; returns the number of bins."""
    for item in order:
        length = lengths[item]
        found = bins.take(length)
        if found is None:
            found = count, bins.capacity
            count += 1
        genome[item] = found[0]
        bins.add(found[0], found[1] - length)
    return count


def fitness(genome: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Number of bins, then less the mean square of their fill: smaller is better."""
    fill = np.bincount(genome, weights=lengths)
    fill = fill[fill > 0] / capacity
    return len(fill), -float((fill * fill).mean())


def cross(base: np.ndarray, giver: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """A child of two packings.

    Some of the giver's best-filled bins come in whole; bins of the base that
    hold one of their documents go, and the documents displaced so are
    best-fitted, longest first.
    """
    fill = np.bincount(giver, weights=lengths)
    ranked = np.argsort(-fill, kind="stable")[: max(1, int((fill > 0).sum()) // 2)]
    chosen = np.zeros(len(fill), bool)
    chosen[ranked[rng.random(len(ranked)) < 0.5]] = True
    inside = chosen[giver]
    hit = np.zeros(int(base.max()) + 1, bool)
    hit[base[inside]] = True
    gone = hit[base]
    child = np.where(gone, -1, base)
    own = np.unique(child, return_inverse=True)[1].reshape(-1) - (1 if gone.any() else 0)
    count = int(own.max()) + 1
    new = np.unique(giver[inside], return_inverse=True)[1].reshape(-1)
    own[inside] = new + count
    count += int(new.max()) + 1 if len(new) else 0
    displaced = np.flatnonzero(gone & ~inside)
    placed = np.ones(len(base), bool)
    placed[displaced] = False
    free = capacity - np.bincount(own[placed], weights=lengths[placed], minlength=count).astype(int)
    bins = Bins(capacity)
    for number, space in enumerate(free.tolist()):
        bins.add(number, space)
    order = displaced[np.argsort(-lengths[displaced], kind="stable")].tolist()
    best_fit(lengths.tolist(), order, own, bins, count)
    return np.unique(own, return_inverse=True)[1].reshape(-1)


def evolve(lengths: np.ndarray, capacity: int, seed: int, elites: list[np.ndarray], generations: int = GENERATIONS, population: int = POPULATION) -> np.ndarray:
    """The best packing that an island finds, starting from ``elites`` and best-fit packings of noisy orders."""
    rng = np.random.default_rng(seed)
    least = max(-(-int(lengths.sum()) // capacity), int((lengths * 2 > capacity).sum()))
    pool: list[tuple[tuple[int, float], np.ndarray]] = [(fitness(e, lengths, capacity), e) for e in elites]
    plain = lengths.tolist()
    done = any(f[0] == least for f, _ in pool)
    while not done and len(pool) < population:
        noise = 0 if not pool else 0.15
        order = np.argsort(-lengths * (1 + noise * rng.standard_normal(len(lengths))), kind="stable").tolist()
        genome = np.empty(len(lengths), np.int64)
        best_fit(plain, order, genome, Bins(capacity), 0)
        pool.append((fitness(genome, lengths, capacity), genome))
        done = pool[-1][0][0] == least
    pool.sort(key=lambda p: p[0])
    for _ in range(0 if done else generations):
        a, b = rng.choice(min(len(pool), 4), 2, replace=False) if len(pool) > 1 else (0, 0)
        child = cross(pool[a][1], pool[b][1], lengths, capacity, rng)
        pool.append((fitness(child, lengths, capacity), child))
        pool.sort(key=lambda p: p[0])
        del pool[population:]
        if pool[0][0][0] == least:
            break
    return pool[0][1]


def pack_lengths(items: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, islands: int = ISLANDS, rounds: int = ROUNDS, label: str = "pack") -> DataFrame:
    """``row, shard, bin, place, fill``: a packing of ``items`` (row, length).

    Items are dealt to shards of bounded size by a hash of their row.  Several
    islands evolve packings of each shard; after each round an island gets the
    best of its neighbour.  The best island's packing is the shard's result.
    """
    shards = max(1, -(-items.count() // shard_pieces))
    dealt = items.groupBy(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard")).agg(F.sort_array(F.collect_list(F.struct("length", "row"))).alias("items"))
    schema = "shard long, island int, bins int, score double, genome array<int>"

    def run(turn: int):
        def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                out = []
                for shard, island, lengths, elites in zip(frame["shard"], frame["island"], frame["lengths"], frame["elites"], strict=True):
                    lengths = np.asarray(lengths, np.int64)
                    best = evolve(lengths, capacity, hash((int(shard), int(island), turn)) & 0x7FFFFFFF, [np.asarray(e, np.int64) for e in elites])
                    bins, score = fitness(best, lengths, capacity)
                    out.append((shard, island, bins, score, best.astype(np.int32)))
                yield pd.DataFrame(out, columns=["shard", "island", "bins", "score", "genome"])

        return work

    dealt = materialize(dealt, f"{label}-shards")
    state = dealt.select("shard", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "items", F.array().cast("array<array<int>>").alias("elites"))
    best = None
    for turn in range(rounds):
        lengths = F.transform("items", lambda i: i["length"].cast("int"))
        spread = state.select("shard", "island", lengths.alias("lengths"), "elites").repartition("shard", "island")
        best = materialize(spread.mapInPandas(run(turn), schema), f"{label}-{turn}")
        moved = best.select("shard", ((F.col("island") + 1) % islands).cast("int").alias("island"), F.col("genome").alias("elite"))
        elites = best.select("shard", "island", "genome").union(moved.select("shard", "island", F.col("elite"))).groupBy("shard", "island").agg(F.collect_list("genome").alias("elites"))
        state = dealt.join(elites, "shard").select("shard", "island", "items", "elites")
    chosen = best.groupBy("shard").agg(F.min_by("genome", F.struct("bins", "score", "island")).alias("genome"))

    def places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard, rows, lengths, genome in zip(frame["shard"], frame["rows"], frame["lengths"], frame["genome"], strict=True):
                rows, lengths, genome = (np.asarray(v, np.int64) for v in (rows, lengths, genome))
                order = np.argsort(genome, kind="stable")
                upto = np.cumsum(lengths[order]) - lengths[order]
                first = np.r_[True, genome[order][1:] != genome[order][:-1]]
                place = upto - np.maximum.accumulate(np.where(first, upto, 0))
                fill = np.bincount(genome, weights=lengths).astype(np.int64)
                yield pd.DataFrame({"row": rows[order], "shard": shard, "bin": genome[order], "place": place, "fill": fill[genome[order]]})

    ready = dealt.join(chosen, "shard").select("shard", F.transform("items", lambda i: i["row"]).alias("rows"), F.transform("items", lambda i: i["length"]).alias("lengths"), "genome")
    return materialize(ready.mapInPandas(places, "row long, shard long, bin long, place long, fill long"), f"{label}-places")


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, ranks: str = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    Full pieces are sequences of their own; the others are packed by
    ``pack_lengths``.  Sequences that stay loose are taken apart and packed
    anew, together with those of other shards, as long as that saves some.
    Null text is an empty text (its end id alone), repeated rows are packed
    each, other columns are ignored, an empty table gives no rows.
    """
    rows = pieces(docs, capacity, vocabulary, ranks, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "pieces")
    loose = rows.filter(F.col("length") < capacity).select("row", F.col("length").cast("int").alias("length"))
    placed = None
    for level in range(1 + PASSES):
        found = pack_lengths(loose, capacity, label=f"pack{level}")
        tight = (F.col("fill") >= LOOSE * capacity) if level < PASSES else F.lit(True)
        done = found.filter(tight).select("row", F.lit(level).alias("level"), "shard", "bin", F.col("place").alias("offset"))
        placed = done if placed is None else placed.union(done)
        if level == PASSES or found.filter(~tight).isEmpty():
            break
        loose = materialize(loose.join(found.filter(~tight).select("row"), "row", "left_semi"), f"loose{level}")
    # even numbers for packed sequences, odd ones for full pieces
    number = ((F.col("level") * (1 << 58)) + F.col("shard") * (1 << 20) + F.col("bin") * 2).cast("long")
    packed = rows.join(placed.select("row", number.alias("sequence_id"), "offset"), "row")
    full = rows.filter(F.col("length") == capacity).select("*", (F.col("row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return packed.select(columns).union(full.select(columns))
