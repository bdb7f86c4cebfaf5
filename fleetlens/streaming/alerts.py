"""Alert streams: events, rate limit, failing canaries and state changes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetlens.functions.stitched import previous_row, running_max
from fleetlens.operators.alerts import (
    MAX_MESSAGES,
    WINDOW_SECONDS,
    apply_alarm_events,
    classify_severity,
    notification_log,
    notification_message,
    parse_alarm_event,
    rate_limit,
)
from fleetlens.sources.store import TableStore
from fleetlens.sources.versions import exists, remove
from fleetlens.streaming.ordered import WATERMARK, InOrder, in_order


def _start(stream: DataFrame, each, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _to_files(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each row once: the file sink notes the files of every micro-batch."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def _forget(spark: SparkSession, path: str, batch_id: int) -> None:
    """Keep the state of this batch and of the one before it."""
    remove(spark, f"{path}/batch={batch_id - 2}")


# T3 ------------------------------------------------------------------------


def stream_alarm_events(
    events: DataFrame, rules: DataFrame, accounts: DataFrame, store: TableStore, alerts_path: str, checkpoint: str, as_of
) -> StreamingQuery:
    """Events to classified alarms in ``store`` and severe ones to ``alerts_path``.

    Rules and accounts are read again with every micro-batch.  Alerts are
    written per batch id, so a replay replaces them.  ``as_of`` may be a
    function that a long stream asks for the time of each batch.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        classified = classify_severity(parse_alarm_event(batch), rules).persist()
        try:
            severe = classified.filter(F.col("severity").isin("Critical", "High"))
            severe.write.mode("overwrite").parquet(f"{alerts_path}/batch={batch_id}")
            ids = accounts.select(F.col("id").alias("account_id"), F.col("account_id").alias("account"))
            known = classified.join(ids, "account", "left_semi")
            touched = store.part_of("alarms")
            parts = sorted(
                r[0]
                for r in known.join(ids, "account").select(touched.alias("p")).distinct().collect()
            )
            source = (checkpoint, batch_id)
            if parts and not store.committed("alarms", source):
                stored = store.read("alarms", parts)
                clock = as_of() if callable(as_of) else as_of
                store.overwrite("alarms", apply_alarm_events(stored, known, accounts, clock), parts, source)
        finally:
            classified.unpersist()

    return _start(events, each, checkpoint)


def event_alerts(classified: DataFrame) -> DataFrame:
    """Severe events in the shape of R5's alerts."""
    severe = classified.filter(F.col("severity").isin("Critical", "High"))
    return severe.select(
        F.lit(1).alias("order_no"),
        F.lit("alarm").alias("alert_type"),
        F.col("account").alias("account_id"),
        F.col("alarm_arn").alias("alert_id"),
        "severity",
        F.col("alarm_name").alias("title"),
        F.col("resource_arn").alias("detail_1"),
        F.col("namespace").alias("detail_2"),
        F.col("state_reason").alias("reason"),
        F.col("state_updated_at").alias("event_time"),
    )


def stream_notifications(
    events: DataFrame, rules: DataFrame, log_path: str, checkpoint: str, clock, n: int = MAX_MESSAGES, seconds: int = WINDOW_SECONDS
) -> StreamingQuery:
    """Events, their severity, the message budget, the messages and the log of what was sent.

    ``clock(batch_id)`` gives the time of a micro-batch.  The log is written
    per batch id; the newest ``n`` sends lie beside it and give the next batch
    its budget, so a replayed batch starts from the same point.
    """
    spark, state = events.sparkSession, f"{log_path}-state"

    def each(batch: DataFrame, batch_id: int) -> None:
        now, before = clock(batch_id), f"{state}/batch={batch_id - 1}"
        pending = event_alerts(classify_severity(parse_alarm_event(batch), rules))
        earlier = spark.createDataFrame([], "sent_at timestamp, status string")
        if exists(spark, before):
            earlier = spark.read.parquet(before)
        limited = notification_message(rate_limit(pending, earlier, now, n, seconds))
        log = notification_log(limited, now, ("message",))
        log.write.mode("overwrite").parquet(f"{log_path}/batch={batch_id}")
        sent = spark.read.schema(log.schema).parquet(f"{log_path}/batch={batch_id}").filter(F.col("status") == "sent")
        newest = earlier.unionByName(sent.select("sent_at", "status")).orderBy(F.desc("sent_at")).limit(n)
        newest.write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
        _forget(spark, state, batch_id)

    return _start(events, each, checkpoint)


# T4 ------------------------------------------------------------------------

_REPLAY_SCHEMA = "channel string, event_time timestamp, alert_id string, status string"


def rate_limit_replay(
    pending: DataFrame, sent: DataFrame | None = None, n: int = MAX_MESSAGES, seconds: int = WINDOW_SECONDS
) -> DataFrame:
    """T4 in batch: ``sent`` or ``grouped`` for every alert, channel by channel in time order.

    An alert is sent when fewer than ``n`` were sent on its channel in the
    trailing window.  Of the alerts with one channel and time only the first
    ``n`` can be, so the rest is settled without the sequential pass.  A pause
    of ``seconds`` empties the window, so each stretch of a channel between two
    pauses is a task's work of its own; that pass streams sorted batches and
    keeps ``n`` send times.  Only a channel that never pauses stays one stretch.
    ``sent`` seeds the window with earlier sends.
    """
    alerts = pending.select(F.col("channel").cast("string"), F.col("event_time").cast("timestamp"), "alert_id")
    same_time = W.partitionBy("channel", "event_time").orderBy("alert_id")
    ranked = alerts.withColumn("_rank", F.row_number().over(same_time))
    hopeless = ranked.filter(F.col("_rank") > n).drop("_rank").withColumn("status", F.lit("grouped"))
    rows = ranked.filter(F.col("_rank") <= n).drop("_rank").withColumn("seed", F.lit(1))
    if sent is not None:
        seeds = sent.select(F.col("channel").cast("string"), F.col("event_time").cast("timestamp"), "alert_id")
        rows = seeds.withColumn("seed", F.lit(0)).unionByName(rows)
    window = pd.Timedelta(seconds=seconds)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stretch, recent = None, []
        for pdf in batches:
            status = []
            for *own, when, seed in zip(pdf["channel"], pdf["stretch"], pdf["event_time"], pdf["seed"]):
                if own != stretch:
                    stretch, recent = own, []
                recent = [t for t in recent if t > when - window]
                if seed == 0 or len(recent) < n:
                    recent.append(when)
                    status.append("seed" if seed == 0 else "sent")
                else:
                    status.append("grouped")
            out = pdf[["channel", "event_time", "alert_id"]].assign(status=status)
            yield out[out["status"] != "seed"]

    order, hour = ["event_time", "seed", "alert_id"], F.date_trunc("hour", F.col("event_time"))
    rows = previous_row(rows, ["channel"], order, hour, ["event_time"])
    paused = F.col("event_time") - F.make_dt_interval(secs=F.lit(seconds)) >= F.col("previous_event_time")
    rows = rows.withColumn("_start", F.when(F.coalesce(paused, F.lit(True)), F.col("event_time")))
    rows = running_max(rows, ["channel"], order, hour, "_start", "stretch")
    rows = rows.select("channel", "stretch", *order)
    ordered = rows.repartition("channel", "stretch").sortWithinPartitions("channel", "stretch", *order)
    return ordered.mapInPandas(walk, _REPLAY_SCHEMA).unionByName(hopeless)


class Budget(InOrder):
    """T4: the sends of the trailing window are kept, ``n`` at most."""

    memory = T.StructType([T.StructField("sent_at", T.TimestampType())])

    def __init__(self, rows, key, n: int, seconds: int):
        super().__init__(rows, key)
        self.n, self.seconds = n, seconds

    def names(self) -> list[str]:
        return ["event_time", "alert_id", "status"]

    def step(self, kept, row):
        when = pd.Timestamp(row[0])
        live = [k for k in kept if pd.Timestamp(k[0]) > when - pd.Timedelta(seconds=self.seconds)]
        if len(live) < self.n:
            return [*live, (row[0],)], [(*row, "sent")]
        return live, [(*row, "grouped")]


def limited_alerts(
    pending: DataFrame, n: int = MAX_MESSAGES, seconds: int = WINDOW_SECONDS, watermark: str = WATERMARK
) -> DataFrame:
    """T4 as a stream: ``sent`` or ``grouped`` for every alert once the watermark has passed it.

    Alerts of a channel are judged in order of time, so late ones within the
    watermark count in their place and micro-batches make no difference.  A
    channel holds its waiting alerts and at most ``n`` send times; an alert that
    is later than the watermark is not judged.
    """
    rows = pending.select(F.col("channel").cast("string"), F.col("event_time").cast("timestamp"), F.col("alert_id").cast("string"))
    return in_order(rows, ("channel",), Budget, ("event_time", "alert_id"), _REPLAY_SCHEMA, watermark, n=n, seconds=seconds)


def stream_rate_limit(
    pending: DataFrame, log_path: str, checkpoint: str, n: int = MAX_MESSAGES, seconds: int = WINDOW_SECONDS, watermark: str = WATERMARK
) -> StreamingQuery:
    """T4: ``limited_alerts`` into Parquet files under ``log_path``, each alert once."""
    return _to_files(limited_alerts(pending, n, seconds, watermark), log_path, checkpoint)


# T5 ------------------------------------------------------------------------

class Failures(InOrder):
    """T5: the newest ``n`` runs of a canary are kept, for ``seconds`` at most."""

    memory = T.StructType([T.StructField("run_at", T.TimestampType()), T.StructField("run_status", T.StringType())])

    def __init__(self, rows, key, n: int, seconds: int | None):
        super().__init__(rows, key)
        self.n, self.seconds = n, seconds

    def names(self) -> list[str]:
        return ["last_run_at"]

    def step(self, kept, row):
        when, _, status = row
        if self.seconds is not None:
            kept = [k for k in kept if pd.Timestamp(k[0]) > pd.Timestamp(when) - pd.Timedelta(seconds=self.seconds)]
        kept = [*kept, (when, status)][-self.n :]
        failing = len(kept) == self.n and all(k[1] == "FAILED" for k in kept)
        return kept, [(when,)] if failing else []


def failing_runs(runs: DataFrame, n: int = 3, seconds: int | None = None, watermark: str = WATERMARK) -> DataFrame:
    """T5 as a stream: ``canary_id, last_run_at`` of each run that makes the newest ``n`` runs of its canary all failed.

    Runs are taken in order of time once the watermark has passed them, so
    neither their order of arrival nor micro-batches matter.  A canary's state
    is its waiting runs and a ring of ``n``; runs older than ``seconds`` before
    the newest one leave the ring if that is given.
    """
    rows = runs.select(F.col("canary_id").cast("long"), F.col("run_at").cast("timestamp"), F.col("id").cast("long"), "run_status")
    return in_order(rows, ("canary_id",), Failures, ("run_at", "id", "run_status"), "canary_id long, last_run_at timestamp", watermark, n=n, seconds=seconds)


def stream_consecutive_failures(
    runs: DataFrame, path: str, checkpoint: str, n: int = 3, seconds: int | None = None, watermark: str = WATERMARK
) -> StreamingQuery:
    """T5: ``failing_runs`` into Parquet files under ``path``."""
    return _to_files(failing_runs(runs, n, seconds, watermark), path, checkpoint)


# T6 ------------------------------------------------------------------------


def alarm_transitions(snapshots: DataFrame, order_by: tuple[str, ...] = ("collected_at",)) -> DataFrame:
    """T6 in batch: changes of state between consecutive snapshots of an alarm.

    The snapshots of one alarm are split by day, so an alarm with a large part
    of all rows is not sorted in one task.
    """
    rows = previous_row(
        snapshots.select("account_id", "alarm_name", "state", "state_reason", *order_by),
        ["account_id", "alarm_name"],
        list(order_by),
        F.date_trunc("day", F.col(order_by[0])),
        ["state"],
    )
    changed = F.col("previous_state").isNotNull() & (F.col("previous_state") != F.col("state"))
    return rows.filter(changed).select(
        "account_id",
        "alarm_name",
        "previous_state",
        F.col("state").alias("new_state"),
        F.col("state_reason").alias("reason"),
        F.col(order_by[0]).alias("transition_time"),
    )


class LastState(InOrder):
    """The last state of an alarm is kept."""

    memory = T.StructType([T.StructField("state", T.StringType())])

    def names(self) -> list[str]:
        return ["previous_state", "new_state", "reason", "transition_time"]

    def step(self, kept, row):
        when, state, reason = row
        before = kept[0][0] if kept else None
        changed = before is not None and state is not None and before != state
        return [(state,)], [(before, state, reason, when)] if changed else []


_CHANGES = "account_id long, alarm_name string, previous_state string, new_state string, reason string, transition_time timestamp"


def state_changes(snapshots: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """T6 as a stream: changes of state between consecutive snapshots of an alarm.

    Snapshots are compared in order of time once the watermark has passed
    them, so neither order of arrival nor micro-batches matter.
    """
    rows = snapshots.select(F.col("account_id").cast("long"), "alarm_name", F.col("collected_at").cast("timestamp"), "state", "state_reason")
    return in_order(rows, ("account_id", "alarm_name"), LastState, ("collected_at", "state", "state_reason"), _CHANGES, watermark)


def stream_alarm_transitions(snapshots: DataFrame, path: str, checkpoint: str, watermark: str = WATERMARK) -> StreamingQuery:
    """``state_changes`` into Parquet files under ``path``."""
    return _to_files(state_changes(snapshots, watermark), path, checkpoint)
