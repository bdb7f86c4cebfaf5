"""Writes and streams over the supplied tables; every stream ends with the data at hand."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.operators import upsert as U
from fleetlens.operators.metrics import cadence_check
from fleetlens.plans.alert_queries import bus
from fleetlens.plans.model import AS_OF, MODEL, S
from fleetlens.plans.registry import query
from fleetlens.schemas import TABLES
from fleetlens.session import shared_dir
from fleetlens.sources import timeseries as ts
from fleetlens.sources.store import TableStore
from fleetlens.streaming import alerts as A
from fleetlens.streaming import metrics as M
from fleetlens.streaming.progress import measured_runs


def event_stream(t, batches: int = 3, late_hours: int = 0, closing: bool = False) -> DataFrame:
    """The event table as a file stream of ``batches`` micro-batches with a zoned time.

    Batches follow the ids, or with ``late_hours`` the time of arrival: up to
    so many hours after the event, by hash.  Each batch has as many files as the
    table has partitions, and a trigger takes as many.  ``closing`` delivers one
    row of no key at last whose time lets the watermark pass all others.
    """
    spark, events = t["events"].sparkSession, t["events"]
    path, files = shared_dir(spark, "events"), max(1, events.rdd.getNumPartitions())
    clock = F.coalesce("event_id", F.lit(0))
    if late_hours:
        clock = F.coalesce(F.unix_seconds(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(3600 * late_hours)), F.lit(0))
    low, high, last = events.agg(F.min(clock), F.max(clock), F.max("ts")).first()
    low = low if late_hours else 0
    placed = events.withColumn("_batch", F.floor((clock - low) * batches / F.lit(high - low + 1)))
    for i in range(batches):
        placed.filter(F.col("_batch") == i).drop("_batch").repartition(files).write.mode("append").parquet(path)
    if closing:
        end = spark.createDataFrame([(last + dt.timedelta(days=1000),)], "ts timestamp_ntz")
        row = [F.col("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema]
        end.select(row).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


#: Batches of the streams that keep rows by key, and how late rows may come there.
_BATCHES, _LATE = 6, 6


def finished(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a stream over everything there is into shared Parquet and read the result."""
    spark, out = stream.sparkSession, shared_dir(stream.sparkSession, label)
    running = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", f"{out}-checkpoint")
        .trigger(availableNow=True)
        .start(out)
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


# S6, S8, S12, S13 ----------------------------------------------------------
MODEL.raw(
    "_status_updates",
    f"""
    SELECT user_id + 1400 AS id, 2 * user_id - (2 * user_id) % 3 AS account_id, 'probe-' || {S('2 * user_id')} AS canary_name,
      CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'view' THEN NULL ELSE 'RUNNING' END AS status,
      CASE WHEN event_type = 'click' THEN NULL ELSE CAST(value AS DECIMAL(5,2)) END AS success_percentage,
      CAST(ts AS TIMESTAMP) AS last_run_at, event_id AS arrival FROM {{events}}
    """,
)
_OUT = "account_id canary_name status success_percentage endpoint_url".split()
_STORED = "SELECT account_id, canary_name, status, success_percentage, endpoint_url FROM {canaries}"


def _merged(mode):
    def run(t):
        stored = t["canaries"]
        updates = t["_status_updates"].drop("last_run_at")
        return U.upsert(stored, updates, ("account_id", "canary_name"), mode, ("arrival",)).select(*_OUT)

    return run


def _merge_sql(pick: str, full: bool) -> str:
    value = lambda c: (
        f"CASE WHEN u.canary_name IS NOT NULL THEN u.{c} ELSE s.{c} END" if full else f"coalesce(u.{c}, s.{c})"
    )
    return f"""
    SELECT coalesce(s.account_id, u.account_id) AS account_id, coalesce(s.canary_name, u.canary_name) AS canary_name,
      {value('status')} AS status, CAST({value('success_percentage')} AS DOUBLE) AS success_percentage, s.endpoint_url
    FROM ({_STORED}) s FULL JOIN (SELECT account_id, canary_name, {pick.format(c='status')} AS status,
        {pick.format(c='success_percentage')} AS success_percentage FROM {{_status_updates}} GROUP BY ALL) u
      ON s.account_id = u.account_id AND s.canary_name = u.canary_name
    """


query("S6_upsert_full", _merge_sql("arg_max_null({c}, arrival)", True))(_merged("full"))
query("S6_upsert_partial", _merge_sql("arg_max({c}, arrival)", False))(_merged("partial"))
@query("S6_store_upsert", _merge_sql("arg_max({c}, arrival)", False))
def stored_upsert(t):
    """Two batches into a table that holds rows already, each delivered twice."""
    spark = t["canaries"].sparkSession
    store = TableStore(spark, shared_dir(spark, "store"))
    store.overwrite("canaries", t["canaries"])
    updates = t["_status_updates"].drop("last_run_at")
    end = updates.agg(F.max("arrival")).first()[0] + 1
    for number in (0, 1):
        part = updates.filter(F.expr(f"arrival * 2 div {end}") == number)
        for _ in range(2):
            store.upsert("canaries", part, "partial", ("arrival",), {}, ("account_id", "canary_name"), ("status", number))
    return store.read("canaries").select(_OUT)


query(
    "S7_upsert_stats",
    """
    SELECT created, n - created AS updated, 0 AS skipped FROM (
      SELECT count(*) AS n, count(DISTINCT u.canary_name) FILTER (s.canary_name IS NULL) AS created
      FROM {_status_updates} u LEFT JOIN (SELECT canary_name FROM {canaries}) s USING (canary_name))
    """,
)(lambda t: U.upsert_stats(t["canaries"], t["_status_updates"], ("account_id", "canary_name")))
MODEL.raw(
    "_new_links",
    "SELECT 3 * c_custkey AS account_id, (c_nationkey + c_custkey % 2) % 25 AS product_id FROM {customer}",
)
query(
    "S8_replace_links",
    """
    SELECT id, product_id, account_id FROM {product_accounts} l
    WHERE account_id NOT IN (SELECT account_id FROM {_new_links})
      OR EXISTS (SELECT 1 FROM {_new_links} n WHERE n.account_id = l.account_id AND n.product_id = l.product_id)
    """,
)(lambda t: U.replace_links(t["product_accounts"], t["_new_links"]).select("id", "product_id", "account_id"))
query(
    "S12_link_product",
    """
    SELECT product_id, account_id FROM {product_accounts} UNION ALL
    SELECT p.id, a.id FROM {products} p, {accounts} a WHERE p.name = 'NATION_3'
      AND NOT EXISTS (SELECT 1 FROM {product_accounts} l WHERE l.product_id = p.id AND l.account_id = a.id)
      AND a.account_id IN (SELECT account_id FROM {accounts} WHERE region = 'us-east-1')
    """,
)(
    lambda t: U.link_product(
        t["products"], t["accounts"], t["product_accounts"], "NATION_3", t["accounts"].filter("region = 'us-east-1'")
    ).select("product_id", "account_id")
)
query(
    "S12_remove_product",
    """
    SELECT l.id, p.name FROM {product_accounts} l JOIN {products} p ON p.id = l.product_id WHERE p.name <> 'NATION_3'
    """,
)(
    lambda t: (lambda products, links: links.join(
        products.select(F.col("id").alias("product_id"), "name"), "product_id"
    ).select("id", "name"))(*U.remove_product(t["products"], t["product_accounts"], "NATION_3"))
)
_OLD = [c for c in TABLES["cost_reports"].columns if c not in ("region", "anomalies_detected", "created_at")]
query(
    "S13_evolve_table",
    "SELECT id, 'Global' AS region, 0 AS anomalies_detected, CAST(current_period_cost AS DOUBLE) AS "
    "current_period_cost, CAST(period_start AS VARCHAR) AS period_start FROM {cost_reports}",
)(
    lambda t: U.evolve_table(t["cost_reports"].select(*_OLD), "cost_reports").select(
        "id", "region", "anomalies_detected", "current_period_cost", "period_start"
    )
)
query(
    "S13_resolve_account",
    """
    SELECT m.id, (SELECT min(a.id) FROM {accounts} a WHERE a.account_id = m.account_id) AS account_id
    FROM {cloudwatch_metrics} m
    """,
)(
    lambda t: U.resolve_account(t["cloudwatch_metrics"].select("id", "account_id"), t["accounts"])
)

# S9, S10 -------------------------------------------------------------------


def _written(t, name: str, write) -> DataFrame:
    """Two batches into a fresh weekly table; the second overlaps the first."""
    spark, path = t["events"].sparkSession, shared_dir(t["events"].sparkSession, name)
    rows = t[name]
    write(rows.filter("id % 2 = 0"), path, ("id",))
    write(rows.filter("id % 2 = 1 OR id % 10 = 0"), path, ("id",))
    return ts.read_timeseries(spark, path)


_POINT_KEY = ", ".join(ts.TIMESERIES_KEY)
query(
    "S9_write_timeseries",
    f"""
    SELECT strftime(collected_at, 'w%G%V') AS iso_week, {_POINT_KEY}, arg_min(unit, id % 2 * 1000000000 + id) AS unit,
      arg_max(value, CASE WHEN id % 2 = 1 OR id % 10 = 0 THEN 1000000000 ELSE 0 END + id) AS value
    FROM {{cloudwatch_metrics}} GROUP BY ALL
    """,
)(
    lambda t: _written(t, "cloudwatch_metrics", ts.write_timeseries).select(
        "iso_week", *ts.TIMESERIES_KEY, "unit", "value"
    )
)
query(
    "S10_write_snapshots",
    """
    SELECT strftime(collected_at, 'w%G%V') AS iso_week, collected_at, account_id, alarm_name,
      arg_min(namespace, id % 2 * 1000000000 + id) AS namespace,
      arg_max(state, CASE WHEN id % 2 = 1 OR id % 10 = 0 THEN 1000000000 ELSE 0 END + id) AS state
    FROM {alarm_states} GROUP BY ALL
    """,
)(
    lambda t: _written(t, "alarm_states", ts.write_snapshots).select(
        "iso_week", "collected_at", "account_id", "alarm_name", "namespace", "state"
    )
)



@query(
    "M8_purge_stored",
    f"""
    WITH points AS (SELECT DISTINCT {_POINT_KEY} FROM {{cloudwatch_metrics}}),
    edge AS (SELECT max(collected_at) - INTERVAL 15 DAY AS limit_at FROM points)
    SELECT count(*) FILTER (collected_at < limit_at) AS deleted, count(*) FILTER (collected_at >= limit_at) AS left_over, 0 AS deleted_again,
      count(*) FILTER (collected_at >= limit_at + INTERVAL 10 DAY) AS recent
    FROM points, edge
    """,
)
def purged(t):
    """Retention on a stored table: whole weeks go, the one at the edge is rewritten, and a second run finds nothing."""
    spark, path = t["events"].sparkSession, shared_dir(t["events"].sparkSession, "purged")
    points = t["cloudwatch_metrics"]
    ts.write_timeseries(points, path, ("id",))
    as_of = points.agg(F.max("collected_at")).first()[0]
    deleted, again = ts.purge(spark, path, as_of, 15), ts.purge(spark, path, as_of, 15)
    recent = ts.read_since(spark, path, as_of - dt.timedelta(days=5)).agg(F.count("*").alias("recent"))
    left = ts.read_timeseries(spark, path).agg(F.count("*").alias("left_over"))
    return left.join(recent, F.lit(True)).select(F.lit(deleted).alias("deleted"), "left_over", F.lit(again).alias("deleted_again"), "recent")


# T1 - T7 -------------------------------------------------------------------


def _point_stream(t) -> DataFrame:
    """The point projection evaluated over the event stream."""
    event_stream(t).createOrReplaceTempView("fl_event_stream")
    return t["events"].sparkSession.sql(MODEL.texts["cloudwatch_metrics"].replace("{events}", "fl_event_stream"))


@query(
    "T1_stream_metrics",
    f"""
    SELECT {_POINT_KEY}, arg_min(unit, id) AS unit, arg_max(value, id) AS value
    FROM {{cloudwatch_metrics}} GROUP BY ALL
    """,
)
def streamed_points(t):
    spark = t["events"].sparkSession
    path = shared_dir(spark, "stream-points")
    M.stream_metrics(_point_stream(t), path, f"{path}-checkpoint", ("id",)).awaitTermination()
    return ts.read_timeseries(spark, path).select(*ts.TIMESERIES_KEY, "unit", "value")


@query(
    "M10_measured_runs",
    """
    SELECT check_name, status, (SELECT count(*) FROM {events}) AS rows_read, 3 AS runs
    FROM (VALUES ('longest_run_seconds', 'PASS'), ('mean_spacing_minutes', 'WARN')) v(check_name, status)
    """,
)
def measured(t):
    """The cadence of T1's own runs: three micro-batches right after one another, so below the limit and not five minutes apart."""
    spark = t["events"].sparkSession
    path = shared_dir(spark, "measured-points")
    stream = M.stream_metrics(_point_stream(t), path, f"{path}-checkpoint", ("id",))
    stream.awaitTermination()
    runs = measured_runs(spark, stream)
    now = runs.agg(F.max("started_at")).first()[0]
    totals = runs.agg(F.sum("rows").alias("rows_read"), F.count("*").alias("runs"))
    return cadence_check(runs, now).select("check_name", "status").join(totals, F.lit(True))


_SAMPLES = ("account_id", "namespace")


def _samples(events: DataFrame) -> DataFrame:
    return events.select("ts", "value", F.col("user_id").alias("account_id"), F.col("event_type").alias("namespace"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.round("value", 6))


def _tumbling_sql(having: str = "") -> str:
    parts = {"Average": "avg(value)", "Sum": "sum(value)", "Maximum": "max(value)", "Minimum": "min(value)",
             "p95": "quantile_disc(value, 0.95)"}
    return " UNION ALL ".join(
        f"SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS collected_at, user_id AS account_id, event_type AS namespace, "
        f"'{name}' AS statistic, round({expr}, 6) AS value FROM {{events}} GROUP BY 1, 2, 3 {having}"
        for name, expr in parts.items()
    )


query("T2_tumbling_metrics", _tumbling_sql())(
    lambda t: _rounded(
        M.tumbling_metrics(_samples(t["events"].withColumn("ts", F.col("ts").cast("timestamp"))), _SAMPLES)
    )
)
_CLOSED = "INTERVAL 5 MINUTE <= (SELECT max(ts) FROM {events}) - INTERVAL 1 HOUR"
query("T2_stream_tumbling_metrics", _tumbling_sql("HAVING time_bucket(INTERVAL 5 MINUTE, min(ts)) + " + _CLOSED))(
    lambda t: _rounded(finished(M.tumbling_metrics(_samples(event_stream(t)), _SAMPLES), "tumbling"))
)


@query(
    "T2_stream_percentile_sketch",
    """
    SELECT time_bucket(INTERVAL 1 DAY, ts) AS collected_at, event_type AS namespace, count(value) AS samples, TRUE AS within
    FROM {events} GROUP BY ALL HAVING time_bucket(INTERVAL 1 DAY, min(ts)) + INTERVAL 1 DAY <= (SELECT max(ts) FROM {events}) - INTERVAL 1 HOUR
    """,
)
def sketched(t):
    """The sketch's 95th percentile of each day, with its rank among the day's values: off by three times the stated error at most."""
    found = finished(M.sketched_percentile(_samples(event_stream(t)), ("namespace",), width="1 day"), "sketched")
    values = _samples(t["events"].withColumn("ts", F.col("ts").cast("timestamp"))).select(
        F.col("namespace"), F.date_trunc("day", "ts").alias("collected_at"), F.col("value").alias("one")
    )
    ranked = found.join(values, ["namespace", "collected_at"]).groupBy("collected_at", "namespace", "samples").agg(
        (F.count_if(F.col("one") < F.col("value")) / F.count("one")).alias("below"), (F.count_if(F.col("one") <= F.col("value")) / F.count("one")).alias("upto")
    )
    slack = 3 * M.SKETCH_ERROR
    return ranked.select("collected_at", "namespace", "samples", ((F.col("below") <= 0.95 + slack) & (F.col("upto") >= 0.95 - slack)).alias("within"))


def _bus_stream(t) -> DataFrame:
    event_stream(t).createOrReplaceTempView("fl_event_stream")
    rows = t["events"].sparkSession.sql(MODEL.texts["_bus"].replace("{events}", "fl_event_stream"))
    return bus({"_bus": rows})


def _alarm_run(t):
    spark = t["events"].sparkSession
    path = shared_dir(spark, "stream-alarms")
    store = TableStore(spark, f"{path}/tables", 8)
    A.stream_alarm_events(
        _bus_stream(t), t["notification_rules"], t["accounts"], store, f"{path}/alerts", f"{path}/checkpoint", AS_OF
    ).awaitTermination()
    return store, f"{path}/alerts"


@query(
    "T3_stream_alarm_events",
    f"""
    SELECT a.id AS account_id, b.arn AS alarm_arn, max(b.ts) AS state_updated_at, arg_max(b.event_type, b.ts) AS kind,
      arg_max(b.namespace, -epoch_us(b.ts)) AS namespace, TRUE AS has_id, TIMESTAMP '{AS_OF}' AS created_at
    FROM {{_bus}} b JOIN {{accounts}} a ON a.account_id = b.number WHERE b.state = 'ALARM' GROUP BY ALL
    """,
)
def streamed_alarms(t):
    store, _ = _alarm_run(t)
    return store.read("alarms").select(
        "account_id",
        "alarm_arn",
        "state_updated_at",
        F.substring("state_reason", 7, 100).alias("kind"),
        "namespace",
        F.col("id").isNotNull().alias("has_id"),
        "created_at",
    )


@query(
    "T3_stream_alarm_alerts",
    """
    SELECT b.event_id, b.arn AS alarm_arn, coalesce((SELECT r.severity FROM {notification_rules} r WHERE r.is_active
        AND r.namespace = b.namespace AND (r.metric_name IS NULL OR r.metric_name = b.metric_name)
        AND (b.event_id % 9 = 0 OR ((r.threshold_min IS NULL OR b.value >= r.threshold_min)
          AND (r.threshold_max IS NULL OR b.value <= r.threshold_max))) ORDER BY r.id LIMIT 1), 'Medium') AS severity
    FROM {_bus} b WHERE b.state = 'ALARM' AND severity IN ('Critical', 'High')
    """,
)
def streamed_alerts(t):
    _, path = _alarm_run(t)
    return t["events"].sparkSession.read.parquet(path).select("event_id", "alarm_arn", "severity")


_STEP = 200


@query(
    "T3_notifications",
    f"""
    WITH severe AS (
      SELECT b.*, b.event_id * 3 // ((SELECT max(event_id) FROM {{events}}) + 1) AS batch,
        coalesce((SELECT r.severity FROM {{notification_rules}} r WHERE r.is_active
          AND r.namespace = b.namespace AND (r.metric_name IS NULL OR r.metric_name = b.metric_name)
          AND (b.event_id % 9 = 0 OR ((r.threshold_min IS NULL OR b.value >= r.threshold_min)
            AND (r.threshold_max IS NULL OR b.value <= r.threshold_max))) ORDER BY r.id LIMIT 1), 'Medium') AS severity
      FROM {{_bus}} b WHERE b.state = 'ALARM' AND severity IN ('Critical', 'High')),
    found AS (SELECT b.n AS batch, count(s.event_id) AS n FROM range(0, 3) b(n) LEFT JOIN severe s ON s.batch = b.n GROUP BY b.n),
    first AS (SELECT least(10, n) AS n FROM found WHERE batch = 0),
    second AS (SELECT least(10 - (SELECT n FROM first), n) AS n FROM found WHERE batch = 1),
    third AS (SELECT least(10 - (SELECT n FROM second), n) AS n FROM found WHERE batch = 2),
    fits AS (SELECT batch, n, CASE batch WHEN 0 THEN (SELECT n FROM first) WHEN 1 THEN (SELECT n FROM second)
      ELSE (SELECT n FROM third) END AS budget, TIMESTAMP '{AS_OF}' + batch * INTERVAL {_STEP} SECOND AS sent_at FROM found),
    placed AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY ts, arn, number) AS place FROM severe)
    SELECT batch, 'alarm' AS alert_type, arn AS alert_id, severity, name AS message_summary, sent_at, 'sent' AS status,
      TRUE AS has_message FROM placed JOIN fits USING (batch) WHERE place <= budget
    UNION ALL
    SELECT batch, 'grouped', '', '', concat(n - budget, ' alerts grouped'), sent_at, 'grouped', TRUE FROM fits WHERE n > budget
    """,
)
def notified(t):
    """The second batch comes inside the window of the first, the third after it."""
    spark = t["events"].sparkSession
    path = shared_dir(spark, "notifications")
    start = dt.datetime.fromisoformat(AS_OF)
    clock = lambda batch: start + dt.timedelta(seconds=_STEP * batch)
    A.stream_notifications(_bus_stream(t), t["notification_rules"], f"{path}/log", f"{path}/checkpoint", clock).awaitTermination()
    log = spark.read.parquet(f"{path}/log")
    return log.withColumn("has_message", F.col("message").contains("blocks")).drop("message")


def _pending(events: DataFrame) -> DataFrame:
    """Alerts on five channels."""
    return events.select(
        F.col("event_type").alias("channel"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id").cast("string").alias("alert_id"),
    )


_WINDOW = 36_000
# The greedy walk as a recursion: one step per alert of a channel, with the live send times as a list.
_REPLAY = f"""
    WITH RECURSIVE pending AS (
      SELECT event_type AS channel, ts AS event_time, CAST(event_id AS VARCHAR) AS alert_id,
        row_number() OVER (PARTITION BY event_type ORDER BY ts, CAST(event_id AS VARCHAR)) AS place FROM {{events}}),
    walk AS (
      SELECT *, 'sent' AS status, [event_time] AS recent FROM pending WHERE place = 1
      UNION ALL
      SELECT channel, event_time, alert_id, place, CASE WHEN len(live) < 10 THEN 'sent' ELSE 'grouped' END,
        CASE WHEN len(live) < 10 THEN list_append(live, event_time) ELSE live END
      FROM (SELECT p.*, list_filter(w.recent, lambda x: x > p.event_time - INTERVAL {_WINDOW} SECOND) AS live
            FROM walk w JOIN pending p ON p.channel = w.channel AND p.place = w.place + 1))
    SELECT channel, event_time, alert_id, status FROM walk
"""
query("T4_rate_limit_replay", _REPLAY)(lambda t: A.rate_limit_replay(_pending(t["events"]), seconds=_WINDOW))


@query("T4_stream_rate_limit", _REPLAY)
def streamed_limit(t):
    spark = t["events"].sparkSession
    path = shared_dir(spark, "stream-limit")
    events = event_stream(t, _BATCHES, _LATE, closing=True)
    A.stream_rate_limit(_pending(events), f"{path}/log", f"{path}/checkpoint", seconds=_WINDOW).awaitTermination()
    return spark.read.parquet(f"{path}/log")


@query(
    "T5_stream_consecutive_failures",
    """
    SELECT user_id AS canary_id, ts AS last_run_at
    FROM (SELECT *, row_number() OVER runs AS place, bool_and(event_type IN ('error', 'view')) OVER (runs ROWS 2 PRECEDING) AS failing
          FROM {events} WINDOW runs AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE place >= 3 AND failing
    """,
)
def streamed_failures(t):
    spark = t["events"].sparkSession
    path = shared_dir(spark, "stream-failures")
    runs = event_stream(t, _BATCHES, _LATE, closing=True).select(
        F.col("user_id").alias("canary_id"),
        F.col("event_id").alias("id"),
        F.col("ts").alias("run_at"),
        F.when(F.col("event_type").isin("error", "view"), "FAILED").otherwise("PASSED").alias("run_status"),
    )
    A.stream_consecutive_failures(runs, path, f"{path}-checkpoint").awaitTermination()
    return spark.read.parquet(path)


MODEL.raw(
    "_snapshots",
    f"""
    SELECT user_id % 30 AS account_id, 'a' || {S('user_id')} AS alarm_name, CAST(ts AS TIMESTAMP) AS collected_at,
      CASE event_type WHEN 'error' THEN 'ALARM' WHEN 'signup' THEN 'INSUFFICIENT_DATA' ELSE 'OK' END AS state,
      'value ' || event_type AS state_reason FROM {{events}}
    """,
)
_TRANSITIONS = """
    SELECT account_id, alarm_name, previous_state, state AS new_state, state_reason AS reason,
      collected_at AS transition_time
    FROM (SELECT *, lag(state) OVER (PARTITION BY account_id, alarm_name ORDER BY collected_at) AS previous_state
          FROM {_snapshots}) WHERE previous_state <> state
"""
query("T6_alarm_transitions", _TRANSITIONS)(lambda t: A.alarm_transitions(t["_snapshots"]))


@query("T6_stream_alarm_transitions", _TRANSITIONS)
def streamed_transitions(t):
    spark = t["events"].sparkSession
    path = shared_dir(spark, "stream-transitions")
    event_stream(t, _BATCHES, _LATE, closing=True).createOrReplaceTempView("fl_event_stream")
    rows = spark.sql(MODEL.texts["_snapshots"].replace("{events}", "fl_event_stream"))
    A.stream_alarm_transitions(rows, path, f"{path}-checkpoint").awaitTermination()
    return spark.read.parquet(path)


_SLIDING = """
    SELECT start AS window_start, start + INTERVAL 10 MINUTE AS window_end, count(*) AS points{more}
    FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - i * INTERVAL 5 MINUTE AS start, user_id, event_type
          FROM {{events}}, range(0, 2) r(i)) GROUP BY ALL {having}
"""


def _fresh(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").cast("timestamp").alias("collected_at"),
        F.col("user_id").alias("account_id"),
        F.col("event_type").alias("namespace"),
    )


query(
    "T7_recent_window",
    _SLIDING.format(
        more=", count(DISTINCT user_id) AS accounts, count(DISTINCT event_type) AS namespaces", having=""
    ).replace("{{", "{").replace("}}", "}"),
)(lambda t: M.recent_window(_fresh(t["events"])))
query(
    "T7_stream_recent_window",
    _SLIDING.format(
        more=", count(DISTINCT user_id) AS accounts, count(DISTINCT event_type) AS namespaces",
        having="HAVING start + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM {events}) - INTERVAL 1 HOUR",
    ).replace("{{", "{").replace("}}", "}"),
)(lambda t: finished(M.recent_window(_fresh(event_stream(t))), "recent"))
query(
    "T7_stream_recent_window_sketched",
    _SLIDING.format(
        more=", count(DISTINCT user_id) AS accounts, count(DISTINCT event_type) AS namespaces",
        having="HAVING start + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM {events}) - INTERVAL 1 HOUR",
    ).replace("{{", "{").replace("}}", "}"),
)(lambda t: finished(M.recent_window_sketched(_fresh(event_stream(t))), "recent-sketched"))
