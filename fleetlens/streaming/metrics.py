"""Metric streams: idempotent points, tumbling statistics and freshness windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlens.sources.timeseries import write_timeseries

WATERMARK = "1 hour"
#: Size of a percentile's sketch and the error of rank that goes with it.
SKETCH_SIZE, SKETCH_ERROR = 400, 0.008
#: Logarithm of the number of registers of a distinct count; 12 gives a relative error of 1.6 percent, and none for small counts.
REGISTERS = 12
STATISTICS = ("Average", "Sum", "Maximum", "Minimum", "p95")


def stream_metrics(points: DataFrame, path: str, checkpoint: str, order_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Points into the weekly table; a late or repeated point replaces the value.

    The merge is an upsert on the point's key, so lateness is unbounded; a
    micro-batch rewrites the hours it touches, once.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        write_timeseries(batch, path, order_by, (checkpoint, batch_id))

    return (
        points.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _statistic(name: str, value: str) -> Column:
    """An exact statistic of column ``value``."""
    return {
        "Average": F.avg(value),
        "Sum": F.sum(value),
        "Maximum": F.max(value),
        "Minimum": F.min(value),
        "p95": F.expr(f"percentile_disc(0.95) WITHIN GROUP (ORDER BY `{value}`)"),
    }[name]


def tumbling_metrics(
    samples: DataFrame,
    keys: tuple[str, ...] = ("account_id", "namespace", "metric_name", "resource_id"),
    time: str = "ts",
    value: str = "value",
    width: str = "5 minutes",
    watermark: str = WATERMARK,
) -> DataFrame:
    """One row per window, resource and statistic from raw samples; batch or stream.

    All statistics have partial aggregates, so a hot resource is combined before
    the shuffle; the exact percentile keeps the distinct values of one window.
    """
    base = samples.withWatermark(time, watermark) if samples.isStreaming else samples
    aggs = [_statistic(s, value).alias(s) for s in STATISTICS]
    wide = base.groupBy(F.window(time, width).alias("_w"), *keys).agg(*aggs)
    rows = F.array(
        *[F.struct(F.lit(s).alias("statistic"), F.col(s).cast("double").alias("value")) for s in STATISTICS]
    )
    return wide.select(F.col("_w.start").alias("collected_at"), *keys, F.inline(rows))


def sketched_percentile(
    samples: DataFrame,
    keys: tuple[str, ...] = ("account_id", "namespace", "metric_name", "resource_id"),
    time: str = "ts",
    value: str = "value",
    width: str = "5 minutes",
    share: float = 0.95,
    size: int = SKETCH_SIZE,
    watermark: str = WATERMARK,
) -> DataFrame:
    """T2's percentile from a mergeable sketch: ``collected_at``, the keys, ``samples`` and ``value``; batch or stream.

    The state of a window and key is one KLL sketch, whose size does not follow
    the samples; the exact percentile keeps all distinct values instead.  With
    the default size the rank of the result is off by ``SKETCH_ERROR`` at most
    (99 of 100 times); up to ``size`` samples it is exact.
    """
    base = samples.withWatermark(time, watermark) if samples.isStreaming else samples
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size)).alias("_sketch")
    wide = base.groupBy(F.window(time, width).alias("_w"), *keys).agg(F.count(value).alias("samples"), sketch)
    return wide.select(
        F.col("_w.start").alias("collected_at"), *keys, "samples", F.when(F.col("samples") > 0, F.kll_sketch_get_quantile_double("_sketch", F.lit(share))).alias("value")
    )


def recent_window(
    points: DataFrame,
    time: str = "collected_at",
    width: str = "10 minutes",
    slide: str = "5 minutes",
    watermark: str = WATERMARK,
) -> DataFrame:
    """Sliding freshness counts: points and distinct accounts and namespaces.

    Exact in a batch and in a stream.  Each point counts once for its account
    and once for its namespace; the first aggregate makes the values distinct,
    the second one counts them per window.
    """
    rows = points.withWatermark(time, watermark) if points.isStreaming else points
    values = F.array(
        F.struct(F.lit("account").alias("kind"), F.col("account_id").cast("string").alias("value")),
        F.struct(F.lit("namespace").alias("kind"), F.col("namespace").cast("string").alias("value")),
    )
    each = rows.select(time, F.inline(values))
    groups = each.groupBy(F.window(time, width, slide).alias("window"), "kind", "value").agg(F.count(F.lit(1)).alias("n"))
    named = F.col("value").isNotNull()
    out = groups.groupBy("window").agg(
        F.sum(F.when(F.col("kind") == "account", F.col("n"))).alias("points"),
        F.count_if((F.col("kind") == "account") & named).alias("accounts"),
        F.count_if((F.col("kind") == "namespace") & named).alias("namespaces"),
    )
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "points", "accounts", "namespaces")


def recent_window_sketched(
    points: DataFrame,
    time: str = "collected_at",
    width: str = "10 minutes",
    slide: str = "5 minutes",
    watermark: str = WATERMARK,
    registers: int = REGISTERS,
) -> DataFrame:
    """T7 from panes: each point is counted in one pane of ``slide``, and a window merges its panes' sketches.

    The state is two sketches of fixed size per pane and window, whatever the
    number of accounts; distinct counts are estimates (``REGISTERS``).
    """
    rows = points.withWatermark(time, watermark) if points.isStreaming else points
    sketch = lambda name: F.hll_sketch_agg(F.col(name).cast("string"), F.lit(registers))
    panes = rows.groupBy(F.window(time, slide).alias("pane")).agg(
        F.count(F.lit(1)).alias("points"), sketch("account_id").alias("accounts"), sketch("namespace").alias("namespaces")
    )
    merged = lambda name: F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name)
    windows = panes.groupBy(F.window(F.window_time("pane"), width, slide).alias("window"))
    out = windows.agg(F.sum("points").alias("points"), merged("accounts"), merged("namespaces"))
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "points", "accounts", "namespaces")
