"""Metric pipeline operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions import timecalc
from fleetlens.operators import metrics
from fleetlens.operators.metrics import ExclusionRule, MetricConfig
from fleetlens.plans.model import AS_OF, METRIC_OF, MODEL, NAMESPACE_OF, S, padded
from fleetlens.plans.registry import query
from fleetlens.sources.timeseries import week_ranges

OVERRIDES = {"AWS/Lambda": "us-east-1", "CWAgent": "eu-west-1"}
DEFAULT_REGION = "ap-southeast-1"
RULES = [
    ExclusionRule("AWS/.*", ".*", empty_dimensions=True),
    ExclusionRule("AWS/EC2", ".*", dimensions={"InstanceId": ("r1$", "r2.*")}),
    ExclusionRule("AWS/RDS", "Free", dimensions={"DBInstanceIdentifier": (".*7",)}),
    ExclusionRule("CWAgent", "cpu", dimensions={"path": (".*",)}),
]
DEFINITIONS = [
    {"namespace": "AWS/EC2", "metric_name": "CPUUtilization", "statistic": "Average", "category": "capacity"},
    {"namespace": "AWS/EC2", "metric_name": "CPUUtilization", "statistic": "Maximum", "category": "performance"},
    {"namespace": "AWS/RDS", "metric_name": "FreeableMemory", "statistic": "Minimum", "category": "availability"},
    {"namespace": "AWS/Lambda", "metric_name": "Duration", "statistic": "p95", "category": ""},
    {"namespace": "CWAgent", "metric_name": "disk_used_percent", "statistic": "Average", "category": "capacity"},
]
CONFIG = MetricConfig([], DEFAULT_REGION, OVERRIDES, DEFINITIONS)

# Discovered metrics: no, one or two dimensions, the primary one not always first.
MODEL.raw(
    "_discovered",
    f"""
    SELECT event_id, ts, value, {padded('user_id')} AS account_id, {NAMESPACE_OF} AS namespace,
      {METRIC_OF} AS metric_name, event_id % 10 AS shape,
      CASE event_type WHEN 'click' THEN 'InstanceId' WHEN 'error' THEN 'DBInstanceIdentifier'
        WHEN 'purchase' THEN 'FunctionName' WHEN 'signup' THEN 'path' ELSE 'Host' END AS dim_name,
      'r' || {S('user_id % 40')} AS dim_value
    FROM {{events}}
    """,
)


def discovered(t):
    own = F.struct(F.col("dim_name").alias("Name"), F.col("dim_value").alias("Value"))
    other = F.struct(F.lit("Zone").alias("Name"), F.lit("z1").alias("Value"))
    dims = (
        F.when(F.col("shape") == 0, F.array().cast(metrics.DIMENSIONS_DDL))
        .when(F.col("shape") <= 3, F.array(other, own))
        .otherwise(F.array(own))
    )
    return t["_discovered"].withColumn("dimensions", dims)


_EXCLUDED = (
    "((namespace IN ('AWS/EC2', 'AWS/RDS', 'AWS/Lambda') AND shape = 0) OR (shape > 0 AND ("
    "(namespace = 'AWS/EC2' AND (dim_value = 'r1' OR dim_value LIKE 'r2%')) "
    "OR (namespace = 'AWS/RDS' AND dim_value LIKE '%7%'))))"
)
_RESOURCE = (
    "CASE WHEN shape = 0 THEN '' WHEN shape <= 3 AND namespace IN ('CWAgent', 'Custom/App') THEN 'z1' "
    "ELSE dim_value END"
)
_REGION = "CASE namespace WHEN 'AWS/Lambda' THEN 'us-east-1' WHEN 'CWAgent' THEN 'eu-west-1' ELSE 'ap-southeast-1' END"

query("M1_region_for_namespace", f"SELECT event_id, namespace, {_REGION} AS region FROM {{_discovered}}")(
    lambda t: metrics.with_region(t["_discovered"].select("event_id", "namespace"), OVERRIDES, DEFAULT_REGION)
)
query("M2_exclude_metrics", f"SELECT event_id, namespace, dim_value FROM {{_discovered}} WHERE NOT {_EXCLUDED}")(
    lambda t: metrics.exclude_metrics(discovered(t), RULES).select("event_id", "namespace", "dim_value")
)
query("M3_resource_id", f"SELECT event_id, namespace, {_RESOURCE} AS resource_id FROM {{_discovered}}")(
    lambda t: discovered(t).select(
        "event_id",
        "namespace",
        metrics.resource_id(F.col("dimensions"), F.col("namespace")).alias("resource_id"),
    )
)
_DEFS = " UNION ALL ".join(
    f"SELECT '{d['namespace']}' AS namespace, '{d['metric_name']}' AS metric_name, '{d['statistic']}' AS statistic, "
    f"'{d['category']}' AS category"
    for d in DEFINITIONS
)
query(
    "M4_enrich_metrics",
    f"SELECT x.event_id, namespace, metric_name, f.statistic, f.category FROM {{_discovered}} x "
    f"JOIN ({_DEFS}) f USING (namespace, metric_name)",
)(
    lambda t: metrics.enrich_metrics(
        t["_discovered"].select("event_id", "namespace", "metric_name"),
        CONFIG.definitions(t["_discovered"].sparkSession),
    )
)


@query(
    "M5_align_window",
    "SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE AS window_start, "
    "time_bucket(INTERVAL 5 MINUTE, ts) AS window_end FROM {events}",
)
def windows(t):
    start, end = metrics.align_window(F.col("ts").cast("timestamp"))
    return t["events"].select("event_id", start.alias("window_start"), end.alias("window_end"))


@query(
    "M6_flatten_points",
    """
    SELECT event_id, ts - CAST(i AS INT) * INTERVAL 5 MINUTE AS collected_at, value + i AS value
    FROM {events}, range(0, 3) r(i) WHERE i < event_id % 4
    """,
)
def points(t):
    ts = F.col("ts").cast("timestamp")
    back = lambda i: F.timestamp_micros(F.unix_micros(ts) - F.lit(i * 300_000_000))
    rows = t["events"].select(
        "event_id",
        F.array(*[back(i) for i in range(3)]).alias("timestamps"),
        F.slice(F.array(*[F.col("value") + i for i in range(4)]), 1, (F.col("event_id") % 4).cast("int")).alias(
            "values"
        ),
    )
    return metrics.flatten_points(rows)


_ALARM_ACCOUNT = (
    f"CASE WHEN event_id % 4 = 0 THEN {padded('user_id * 3')} WHEN event_id % 4 = 1 THEN '' "
    f"ELSE {padded('user_id * 3 + event_id % 2')} END"
)


@query(
    "M7_alarm_snapshots",
    f"""
    SELECT TIMESTAMP '{AS_OF}' AS collected_at, account_id, alarm_name, namespace, metric_name, dimensions,
      CASE WHEN dimensions = '[]' THEN '' ELSE 'r' || CAST(user_id % 40 AS VARCHAR) END AS resource_id,
      state, state_reason, state_updated_at
    FROM (SELECT {_ALARM_ACCOUNT} AS account_id, user_id,
            CASE WHEN event_id % 10 = 0 THEN '[]' ELSE dimensions END AS dimensions,
            s.alarm_name, s.namespace, s.metric_name, s.state, s.state_reason, s.state_updated_at
          FROM {{alarm_states}} s JOIN {{events}} e ON e.event_id = s.id) x
    WHERE (namespace, metric_name) IN (SELECT (namespace, metric_name) FROM ({_DEFS}))
      AND (account_id = '' OR account_id IN (SELECT account_id FROM {{accounts}}))
    """,
)
def snapshots(t):
    number = F.col("account_id").cast("bigint") * 3
    padded_number = lambda c: F.lpad(c.cast("string"), 12, "0")
    arn = F.concat(F.lit("arn:aws:cloudwatch:x:"), padded_number(number + F.col("id") % 2), F.lit(":alarm:a"))
    raw = t["alarm_states"].select(
        F.when(F.col("id") % 4 == 0, padded_number(number)).otherwise("").alias("owning_account"),
        F.when(F.col("id") % 4 == 1, "no-arn").otherwise(arn).alias("alarm_arn"),
        "alarm_name",
        "namespace",
        "metric_name",
        F.from_json("dimensions", metrics.DIMENSIONS_DDL).alias("dimensions"),
        "state",
        "state_reason",
        "state_updated_at",
    )
    return metrics.alarm_snapshots(raw, CONFIG.definitions(raw.sparkSession), t["accounts"], AS_OF)


@query(
    "M1_M6_collect_points",
    f"""
    SELECT x.ts AS collected_at, x.account_id, {_REGION} AS region, x.namespace, x.metric_name,
      x.resource_id, f.statistic, x.value, 'label ' || x.namespace AS unit, f.category AS dashboard_category
    FROM (SELECT *, {_RESOURCE} AS resource_id FROM {{_discovered}} WHERE NOT {_EXCLUDED}) x
    JOIN ({_DEFS}) f USING (namespace, metric_name)
    """,
)
def collected(t):
    # every event is one discovered metric; resources have many of them, with several dimension sets
    found = discovered(t).withColumn("query_id", F.col("event_id"))
    fetched = metrics.enrich_metrics(
        found.withColumn("resource_id", metrics.resource_id(F.col("dimensions"), F.col("namespace"))),
        CONFIG.definitions(t["_discovered"].sparkSession),
    ).select(
        "query_id",
        "statistic",
        F.concat(F.lit("label "), F.col("namespace")).alias("label"),
        F.array("ts").alias("timestamps"),
        F.array("value").alias("values"),
    )
    out = metrics.collect_points(
        found.select("query_id", "namespace", "metric_name", "account_id", "dimensions"), fetched, CONFIG, RULES
    )
    return out.drop("dimensions")


query("M8_retain", f"SELECT id, collected_at FROM {{cloudwatch_metrics}} WHERE collected_at >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY")(
    lambda t: metrics.retain(t["cloudwatch_metrics"], AS_OF, 10).select("id", "collected_at")
)
query(
    "M8_expired_count",
    f"SELECT count(*) AS deleted FROM {{cloudwatch_metrics}} WHERE collected_at < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY",
)(lambda t: metrics.expired_count(t["cloudwatch_metrics"], AS_OF, 10))

_CLOCK = "2024-01-20 12:00:00"
_LATE = f"collected_at > TIMESTAMP '{_CLOCK}' - INTERVAL 600 MINUTE"
_FRESH = (
    ("metric_points", "count(*)", "cloudwatch_metrics", 1, "FAIL"),
    ("metric_accounts", "count(DISTINCT account_id)", "cloudwatch_metrics", 1, "FAIL"),
    ("metric_namespaces", "count(DISTINCT namespace)", "cloudwatch_metrics", 5, "FAIL"),
    ("metric_categories", "count(DISTINCT coalesce(dashboard_category, 'null'))", "cloudwatch_metrics", 3, "FAIL"),
    ("alarm_records", "count(*)", "alarm_states", 1, "FAIL"),
    ("alarm_states", "count(DISTINCT state)", "alarm_states", 1, "WARN"),
    ("alarm_accounts", "count(DISTINCT account_id)", "alarm_states", 1, "WARN"),
)
query(
    "M9_freshness_checks",
    " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, n AS observed, CASE WHEN n >= {good} THEN 'PASS' WHEN n >= 1 THEN 'WARN' "
        f"ELSE '{otherwise}' END AS status FROM (SELECT {expr} AS n FROM {{{table}}} WHERE {_LATE})"
        for name, expr, table, good, otherwise in _FRESH
    ),
)(lambda t: metrics.freshness_checks(t["cloudwatch_metrics"], t["alarm_states"], _CLOCK, 600))
for _column, _table in (("dashboard_category", "cloudwatch_metrics"), ("account_id", "cloudwatch_metrics"), ("state", "alarm_states")):

    def _breakdown(t, column=_column, table=_table):
        return metrics.recent_breakdown(t[table], column, _CLOCK, 600)

    query(
        f"M9_recent_by_{_column}",
        f"SELECT coalesce({_column}, 'null') AS {_column}, count(*) AS n FROM {{{_table}}} WHERE {_LATE} GROUP BY 1",
    )(_breakdown)

query(
    "M10_cadence_check",
    f"""
    SELECT 'longest_run_seconds' AS check_name, longest AS observed,
      CASE WHEN longest >= 300 THEN 'FAIL' WHEN longest > 0 THEN 'PASS' ELSE 'WARN' END AS status FROM (
        SELECT CAST(round_even(max(value * 100) / 1000, 0) AS BIGINT) AS longest FROM {{events}}
        WHERE ts >= TIMESTAMP '{_CLOCK}' - INTERVAL 600 MINUTE)
    UNION ALL
    SELECT 'mean_spacing_minutes', spacing, CASE WHEN spacing BETWEEN 4 AND 6 THEN 'PASS' ELSE 'WARN' END FROM (
        SELECT ((epoch_ms(max(ts)) - epoch_ms(min(ts))) // 60000) // (count(*) - 1) AS spacing FROM {{events}}
        WHERE ts >= TIMESTAMP '{_CLOCK}' - INTERVAL 600 MINUTE)
    """,
)(
    lambda t: metrics.cadence_check(
        t["events"].select(F.col("ts").cast("timestamp").alias("started_at"), (F.col("value") * 100).alias("duration_ms")),
        _CLOCK,
        600,
    )
)

query(
    "S11_iso_week",
    "SELECT o_orderkey, strftime(o_orderdate, 'w%G%V') AS iso_week FROM {orders}",
)(lambda t: t["orders"].select("o_orderkey", timecalc.iso_week(F.col("o_orderdate")).alias("iso_week")))

query(
    "S11_week_ranges",
    """
    SELECT o_orderkey, strftime(monday + CAST(7 * i AS INT), 'w%G%V') AS iso_week,
      CAST(CAST(monday + CAST(7 * i AS INT) AS DATE) AS VARCHAR) AS week_start,
      CAST(CAST(monday + CAST(7 * i + 7 AS INT) AS DATE) AS VARCHAR) AS week_end
    FROM (SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS monday FROM {orders}), range(0, 3) r(i)
    """,
)(
    lambda t: t["orders"].select("o_orderkey", F.inline(week_ranges(F.col("o_orderdate").cast("date"), 3)))
)
