"""Severity rules cut into intervals, so an alarm finds its rule by binary search."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slots of an index up to which it is broadcast; beyond that Spark chooses the join.
BROADCAST_SLOTS = 1_000_000
INDEX = "namespace string, metric_name string, bounds array<double>, ids array<long>, names array<string>, any_id long, any_name string"


def intervals(rules: list[tuple[int, float | None, float | None, str]]) -> tuple[list[float], list[int | None], list[str | None]]:
    """Bounds and, for every slot between and on them, the id and severity of the first rule that covers it.

    Slot 2k lies between bounds k - 1 and k, slot 2k + 1 on bound k.  One sweep
    over the slots with the open rules in a heap.
    """
    bounds = sorted({v for _, low, high, _ in rules for v in (low, high) if v is not None})
    place = {v: 2 * k + 1 for k, v in enumerate(bounds)}
    begins: dict[int, list] = {}
    for number, low, high, name in rules:
        first, last = (0 if low is None else place[low]), (2 * len(bounds) if high is None else place[high])
        if first <= last:
            begins.setdefault(first, []).append((number, last, name))
    ids: list[int | None] = []
    names: list[str | None] = []
    live: list[tuple] = []
    for slot in range(2 * len(bounds) + 1):
        for rule in begins.get(slot, ()):
            heapq.heappush(live, rule)
        while live and live[0][1] < slot:
            heapq.heappop(live)
        ids.append(live[0][0] if live else None)
        names.append(live[0][2] if live else None)
    return bounds, ids, names


def severity_index(rules: DataFrame) -> DataFrame:
    """One row per namespace and metric name (null for rules of every metric) with the slots of its active rules."""

    def cut(frame: pd.DataFrame) -> pd.DataFrame:
        number = lambda v: None if pd.isna(v) else float(v)
        rows = [(int(r.id), number(r.threshold_min), number(r.threshold_max), r.severity) for r in frame.itertuples()]
        bounds, ids, names = intervals(rows)
        first = min(rows)
        metric = frame["metric_name"].iloc[0]
        return pd.DataFrame(
            {
                "namespace": [frame["namespace"].iloc[0]],
                "metric_name": [None if pd.isna(metric) else metric],
                "bounds": [np.array(bounds, float)],
                "ids": [ids],
                "names": [names],
                "any_id": [first[0]],
                "any_name": [first[3]],
            }
        )

    active = rules.filter(F.col("is_active")).select(
        "namespace", "metric_name", "id", F.col("threshold_min").cast("double").alias("threshold_min"), F.col("threshold_max").cast("double").alias("threshold_max"), "severity"
    )
    return active.groupBy("namespace", "metric_name").applyInPandas(cut, INDEX)


def _found(entry: str, threshold: Column, steps: int) -> Column:
    """Id and severity that an index row gives for a threshold; without one, those of its first rule."""
    bounds = F.col(f"{entry}.bounds")
    start = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))

    def halve(at: Column, _: Column) -> Column:
        low, high = at["low"], at["high"]
        middle = F.shiftright(low + high, 1)
        less = F.get(bounds, middle) < threshold
        return F.struct(
            F.when((low < high) & less, middle + 1).otherwise(low).alias("low"),
            F.when((low < high) & ~less, middle).otherwise(high).alias("high"),
        )

    k = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve)["low"]
    slot = k * 2 + F.coalesce(F.get(bounds, k) == threshold, F.lit(False)).cast("int")
    inside = F.struct(F.get(f"{entry}.ids", slot).alias("id"), F.get(f"{entry}.names", slot).alias("name"))
    return F.when(threshold.isNull(), F.struct(F.col(f"{entry}.any_id").alias("id"), F.col(f"{entry}.any_name").alias("name"))).otherwise(inside)


def classify_by_index(alarms: DataFrame, rules: DataFrame) -> DataFrame:
    """R1 with the same result as ``classify_severity``: the first active rule by id that fits, else Medium.

    An alarm looks at two index rows, its metric's and the one for every
    metric, and searches each in as many steps as the number of rules has
    binary digits.
    """
    index = severity_index(rules).persist()
    try:
        slots, widest = index.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)), F.coalesce(F.max(F.size("bounds")), F.lit(0))).first()
        rows = alarms.sparkSession.createDataFrame(index.collect(), INDEX) if slots <= BROADCAST_SLOTS else severity_index(rules)
    finally:
        index.unpersist()
    small = F.broadcast if slots <= BROADCAST_SLOTS else (lambda df: df)
    entry = F.struct("bounds", "ids", "names", "any_id", "any_name")
    own = rows.filter("metric_name IS NOT NULL").select("namespace", "metric_name", entry.alias("_own"))
    every = rows.filter("metric_name IS NULL").select("namespace", entry.alias("_every"))
    rest = [c for c in alarms.columns if c != "severity"]
    joined = alarms.select(*rest).join(small(own), ["namespace", "metric_name"], "left").join(small(every), "namespace", "left")
    steps = max(1, math.ceil(math.log2(widest + 1)) + 1)
    threshold = F.col("threshold").cast("double")
    joined = joined.select(*rest, _found("_own", threshold, steps).alias("_a"), _found("_every", threshold, steps).alias("_b"))
    first = F.when(F.col("_b.id").isNull() | (F.col("_a.id") < F.col("_b.id")), F.col("_a.name")).otherwise(F.col("_b.name"))
    return joined.select(*rest, F.coalesce(first, F.lit("Medium")).alias("severity"))
