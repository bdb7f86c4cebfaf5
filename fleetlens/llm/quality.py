"""Quality scores learned from preference pairs (Bradley-Terry)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import BROADCAST_ROWS, col, held_out, ids_column, mix, slices, text_rows
from fleetlens.llm.scan import distinct, shingles, word_hashes, words
from fleetlens.session import materialize

#: ASCII marks that are counted one by one.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Partners of the other label that each labelled row is compared with.
PARTNERS = 6
#: Rows (expected) among which a row finds its partners, and least ones of either label among them.
GROUP_ROWS, GROUP_LEAST = 4096, 32
#: Weight of the penalty, and passes over the pairs at most.
PENALTY, PASSES = 1e-3, 40
#: Bins of a pass that looks for a quantile.
BINS = 4096
#: Score at the threshold.
CUT = 0.3

_ROWS = [b"", *[m.encode() for m in MARKS]]
_CLASS = np.zeros(256, np.uint8)
for _i, _m in enumerate(_ROWS[1:], 1):
    _CLASS[ord(_m)] = _i
N_MARKS = len(MARKS)
_CLASS[ord("0") : ord("9") + 1] = N_MARKS + 1
_CLASS[ord("A") : ord("Z") + 1] = N_MARKS + 2
_CLASS[ord("a") : ord("z") + 1] = N_MARKS + 3
_CLASS[ord("\n")] = N_MARKS + 4
_CLASS[ord(" ")] = N_MARKS + 5
_CLASS[128:] = N_MARKS + 6
N_CLASSES = N_MARKS + 7
#: Features that follow the shares of the byte classes.
EXTRA = ("log_bytes", "log_words", "word_bytes", "repeat_next", "distinct_words", "distinct_pairs", "distinct_threes", "odd_ends")


def features(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of figures per text: shares of byte classes, repetition, length."""
    n = len(at) - 1
    size = np.diff(at).astype(float)
    row = np.repeat(np.arange(n), np.diff(at))
    kinds = np.bincount(row * N_CLASSES + _CLASS[raw], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    # capitals outside ASCII: 0xC3 0x80 to 0xC3 0x9E
    if len(raw) > 1:
        wide = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E))
        kinds[:, N_MARKS + 2] += np.bincount(row[wide], minlength=n)
    start, end, of = words(raw, at)
    hashes = word_hashes(raw, start, end)
    count = np.bincount(of, minlength=n).astype(float)
    again = np.flatnonzero((of[1:] == of[:-1]) & (hashes[1:] == hashes[:-1])) if len(of) else np.empty(0, int)
    odd = (_CLASS[raw[end - 1]] >= 1) & (_CLASS[raw[end - 1]] <= N_MARKS) & (raw[end - 1] != ord(".")) & (raw[end - 1] != ord(",")) if len(of) else np.empty(0, bool)

    def share(width: int) -> np.ndarray:
        r, h = shingles(hashes, of, width)
        kept, _ = distinct(r, h)
        return np.bincount(kept, minlength=n) / np.maximum(1, np.bincount(r, minlength=n))

    least = np.maximum(1, count)
    extra = [np.log1p(size), np.log1p(count), np.minimum(30, size / least), np.bincount(of[again], minlength=n) / least, share(1), share(2), share(3), np.bincount(of[odd], minlength=n) / least]
    return np.hstack([np.sqrt(kinds / np.maximum(1, size)[:, None]), np.array(extra).T])


def featured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, x`` for every row; null text counts as empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, raw, at in slices(batches):
            x = features(raw, at)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([ids_column(ids), flat], names=["doc_id", "x"])

    return text_rows(docs, id_col, text_col).mapInArrow(work, "doc_id long, x array<double>")


class Ranker:
    """Weights over standardised features and the raw score at the threshold."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, threshold: float = 0.0):
        self.mean, self.scale, self.weights, self.threshold = mean, scale, weights, threshold

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; the threshold's raw score gives ``CUT``."""
        z = np.clip(self.raw(x) - self.threshold, -500, 500) + math.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-z))


def numbers(values: np.ndarray) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def grouped(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``ids, label, x``: rows (doc_id, label, x) dealt by hash into groups, one packed row per group.

    Rows of a label too rare to be in every group go to several.
    """
    groups = max(1, sum(counts.values()) // GROUP_ROWS)
    few, least = min((n, label) for label, n in counts.items())
    copies = min(groups, -(-GROUP_LEAST * groups // few))
    copy = F.explode(F.sequence(F.lit(1), F.when(F.col("label") == least, F.lit(copies)).otherwise(F.lit(1))))
    dealt = rows.withColumn("copy", copy).withColumn("group", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(groups)))

    def pack(table: pa.Table) -> pa.Table:
        ids, label = table.column("doc_id").to_numpy(), table.column("label").to_numpy()
        x = table.column("x").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        by = np.lexsort((label, ids))
        return pa.table({"ids": [ids[by].tobytes()], "label": [label[by].astype(np.int64).tobytes()], "x": [x[by].tobytes()]})

    return dealt.select("group", "doc_id", "label", "x").groupBy("group").applyInArrow(pack, "ids binary, label binary, x binary")


def pairs(ids: np.ndarray, label: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``(better, worse)`` of a group that meet in a turn: both labels are dealt into slots."""
    better, worse = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    slots = max(1, min(len(better), len(worse)) // 2)
    slot = (mix(mix(ids) + np.uint64(turn)) % np.uint64(slots)).astype(np.int64)
    better = better[np.argsort(slot[better], kind="stable")]
    n = np.bincount(slot[better], minlength=slots)
    first, often = (np.cumsum(n) - n)[slot[worse]], n[slot[worse]]
    place = np.arange(often.sum()) - np.repeat(np.cumsum(often) - often, often) + np.repeat(first, often)
    return better[place], np.repeat(worse, often)


def slopes(groups: DataFrame, weights: np.ndarray, partners: int) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Over all pairs of all groups: their number, and sums of logistic loss, gradient and curvature."""
    width = len(weights)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + width + width * width)
        for batch in batches:
            for own, marks, flat in zip(*(batch.column(c).to_pylist() for c in ("ids", "label", "x")), strict=True):
                ids, label = np.frombuffer(own, np.int64), np.frombuffer(marks, np.int64)
                x = np.frombuffer(flat, float).reshape(len(ids), width)
                for turn in range(partners):
                    better, worse = pairs(ids, label, turn)
                    gap = x[better] - x[worse]
                    z = gap @ weights
                    miss = np.exp(-np.logaddexp(0, z))
                    total[0] += len(z)
                    total[1] += np.logaddexp(0, -z).sum()
                    total[2 : 2 + width] -= miss @ gap
                    total[2 + width :] += ((gap * (miss * (1 - miss))[:, None]).T @ gap).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["k", "v"])

    # as many rows as the model has figures, whatever the input
    out = np.zeros(2 + width + width * width)
    for k, v in groups.mapInArrow(work, "k long, v double").groupBy("k").agg(F.sum("v")).collect():
        out[k] = v
    return out[0], out[1], out[2 : 2 + width], out[2 + width :].reshape(width, width)


def learn(groups: DataFrame, width: int, partners: int) -> np.ndarray:
    """Weights of least mean logistic loss with a penalty on their squares, by Newton's steps over all pairs."""
    weights = before = np.zeros(width)
    best = math.inf
    for _ in range(PASSES):
        n, loss, slope, curve = slopes(groups, weights, partners)
        if not n:
            break
        loss = loss / n + PENALTY / 2 * weights @ weights
        if loss > best + 1e-12:
            # too far
            weights = (weights + before) / 2
            continue
        before, best = weights, loss
        slope = slope / n + PENALTY * weights
        step = np.linalg.solve(curve / n + PENALTY * np.eye(width), slope)
        if slope @ step < 1e-10:
            break
        weights = weights - step
    return before


def nth(values: DataFrame, n: int) -> float:
    """The ``n``-th smallest (from 1) of the numbers in the only column of ``values``, exactly, by counts in ever narrower bins."""
    v = col(values.columns[0])
    low, high = values.agg(F.min(v), F.max(v)).first()
    while low < high:
        place = F.least(F.floor((v - low) / (high - low) * BINS), F.lit(BINS - 1)).alias("bin")
        bins = values.filter(v.between(low, high)).groupBy(place).agg(F.count("*").alias("n"), F.min(v).alias("low"), F.max(v).alias("high"))
        for found in sorted(bins.collect(), key=lambda r: r["low"]):
            if n <= found["n"]:
                break
            n -= found["n"]
        low, high = found["low"], found["high"]
    return low


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", partners: int = PARTNERS) -> Ranker:
    """A ranker from preference pairs between all labelled rows that are not held out.

    Rows are dealt into groups, where each meets up to about ``partners`` rows
    of the other label, found by dealing both labels into slots; a pair prefers
    the row with label 1, and weights come from logistic loss on the difference
    of its features, over all pairs.  The threshold is the quantile of the
    scores of all these rows that leaves the share of label 0 below.
    Labels other than 0 and 1, and null ids, are left out; of repeated labels
    of an id the smallest counts.  Without both labels every weight is 0.
    """
    known = labels.select(col(id_col).cast("long").alias("doc_id"), col(label_col).cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
    known = materialize(known.groupBy("doc_id").agg(F.min("label").alias("label")).filter(~held_out()), "known")
    texts = text_rows(docs, id_col, text_col).filter(F.col("doc_id").isNotNull() & ~held_out())
    # a few labels choose the texts beforehand; texts are not shuffled for many
    if known.count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(known), "doc_id", "left_semi")
    rows = materialize(featured(texts).join(known, "doc_id"), "quality")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    width = N_CLASSES + len(EXTRA)
    if len(counts) < 2:
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width))
    stats = rows.select(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(width)], *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(width)]).first()
    mean = np.array([stats[f"m{i}"] for i in range(width)])
    scale = np.maximum(1e-3, np.array([stats[f"s{i}"] for i in range(width)]))
    centred = F.zip_with(F.zip_with("x", numbers(mean), lambda v, m: v - m), numbers(scale), lambda v, s: F.greatest(F.lit(-8.0), F.least(F.lit(8.0), v / s)))
    rows = rows.select("doc_id", "label", centred.alias("x"))
    ranker = Ranker(mean, scale, learn(materialize(grouped(rows, counts), "groups"), width, partners))
    raw = materialize(rows.select(F.aggregate(F.zip_with("x", numbers(ranker.weights), lambda v, w: v * w), F.lit(0.0), lambda a, v: a + v).alias("raw")), "raw")
    low = nth(raw, counts[0])
    # half way to the next score, so that ties at the quantile stay below
    high = raw.filter(F.col("raw") > low + 1e-9).agg(F.min("raw")).first()[0]
    ranker.threshold = low if high is None else (low + high) / 2
    return ranker


def rank(docs: DataFrame, ranker: Ranker, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; null text counts as empty.

    Repeated rows are scored each, other columns are ignored, an empty table
    gives no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, raw, at in slices(batches):
            yield pa.RecordBatch.from_arrays([ids_column(ids), pa.array(ranker.score(features(raw, at)))], names=["doc_id", "score"])

    scored = text_rows(docs, id_col, text_col).mapInArrow(work, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
