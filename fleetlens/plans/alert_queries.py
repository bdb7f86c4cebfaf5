"""Alerting operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.operators import alerts
from fleetlens.operators.severity_index import classify_by_index
from fleetlens.plans.model import AS_OF, METRIC_OF, MODEL, NAMESPACE_OF, S, STATE_OF, padded
from fleetlens.plans.registry import query

# Rules with open bounds, overlapping ranges, an inactive one and a default for a namespace.
RULES = [
    (1, "AWS/RDS", "FreeableMemory", None, 20, "Critical", True),
    (2, "AWS/RDS", "FreeableMemory", 10, 60, "High", True),
    (3, "AWS/RDS", "Other", None, None, "Critical", True),
    (4, "AWS/RDS", None, 90, None, "Low", True),
    (5, "AWS/EC2", "CPUUtilization", 50, None, "High", False),
    (6, "CWAgent", None, None, None, "High", True),
    (7, "CWAgent", "mem_used_percent", None, None, "Critical", True),
    (8, "AWS/Lambda", "Duration", 30, 40, "Critical", True),
]
_lit = lambda v, t: f"CAST({'NULL' if v is None else repr(v)} AS {t})"
MODEL.raw(
    "notification_rules",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS id, '{ns}' AS namespace, {_lit(metric, 'STRING')} AS metric_name, "
        f"{_lit(lo, 'DECIMAL(20,6)')} AS threshold_min, {_lit(hi, 'DECIMAL(20,6)')} AS threshold_max, "
        f"'{sev}' AS severity, {str(active).upper()} AS is_active"
        for i, ns, metric, lo, hi, sev, active in RULES
    ),
)
MODEL.raw(
    "_classified",
    """
    SELECT a.* EXCLUDE (severity), coalesce((SELECT r.severity FROM {notification_rules} r
        WHERE r.is_active AND r.namespace = a.namespace
          AND (r.metric_name IS NULL OR r.metric_name = a.metric_name)
          AND (a.threshold IS NULL OR ((r.threshold_min IS NULL OR a.threshold >= r.threshold_min)
            AND (r.threshold_max IS NULL OR a.threshold <= r.threshold_max)))
        ORDER BY r.id LIMIT 1), 'Medium') AS severity
    FROM {alarms} a
    """,
)
query("R1_classify_severity", "SELECT id, namespace, severity FROM {_classified}")(
    lambda t: alerts.classify_severity(t["alarms"], t["notification_rules"]).select("id", "namespace", "severity")
)

query("R1_severity_index", "SELECT id, namespace, severity FROM {_classified}")(
    lambda t: classify_by_index(t["alarms"], t["notification_rules"]).select("id", "namespace", "severity")
)

MODEL.raw(
    "_failing",
    """
    SELECT canary_id FROM (SELECT canary_id, run_status,
        row_number() OVER (PARTITION BY canary_id ORDER BY run_at DESC, id DESC) AS k FROM {canary_runs})
    WHERE k <= 3 GROUP BY canary_id HAVING count(*) = 3 AND min(run_status) = 'FAILED' AND max(run_status) = 'FAILED'
    """,
)
query("R2_consecutive_failures", "SELECT canary_id FROM {_failing}")(
    lambda t: alerts.consecutive_failures(t["canary_runs"])
)

# Alarm state changes as they arrive on the bus: one JSON document per event.
MODEL.raw(
    "_bus",
    f"""
    SELECT event_id, ts, {padded('user_id * 3')} AS number, {STATE_OF} AS state, {NAMESPACE_OF} AS namespace,
      {METRIC_OF} AS metric_name, value, event_type,
      'arn:' || {S('user_id % 60')} || ':' || {S('event_id % 5')} AS arn, 'n' || {S('event_id % 5')} AS name
    FROM {{events}}
    """,
)


def bus(t):
    metric = F.struct(
        F.struct(
            F.struct(F.col("namespace").alias("namespace"), F.col("metric_name").alias("name")).alias("metric")
        ).alias("metricStat")
    )
    detail = F.struct(
        F.col("name").alias("alarmName"),
        F.col("arn").alias("alarmArn"),
        F.struct(
            F.col("state").alias("value"),
            F.concat(F.lit("value "), F.col("event_type")).alias("reason"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        ).alias("state"),
        F.struct(
            F.when(F.col("event_id") % 9 != 0, F.col("value")).alias("threshold"), F.array(metric).alias("metrics")
        ).alias("configuration"),
    )
    event = F.struct(F.lit("aws.cloudwatch").alias("source"), F.col("number").alias("account"), detail.alias("detail"))
    return t["_bus"].select("event_id", F.to_json(event).alias("value"))


query(
    "R3_parse_alarm_event",
    """
    SELECT event_id, number AS account, arn AS alarm_arn, name AS alarm_name, state, 'value ' || event_type
      AS state_reason, ts AS state_updated_at, namespace, metric_name,
      CASE WHEN event_id % 9 <> 0 THEN value END AS threshold, '' AS resource_arn
    FROM {_bus} WHERE state = 'ALARM'
    """,
)(lambda t: alerts.parse_alarm_event(bus(t)))

query(
    "R1_write_back_severity",
    f"""
    SELECT a.id, CASE WHEN a.state = 'ALARM' THEN c.severity ELSE a.severity END AS severity,
      CASE WHEN a.state = 'ALARM' THEN TIMESTAMP '{AS_OF}' ELSE a.updated_at END AS updated_at
    FROM {{alarms}} a JOIN {{_classified}} c ON c.id = a.id
    """,
)(lambda t: alerts.write_back_severity(t["alarms"], t["notification_rules"], AS_OF).select("id", "severity", "updated_at"))

MODEL.raw(
    "_stored_alarms",
    f"""
    SELECT a.* FROM {{alarms}} a WHERE a.id < 0 UNION ALL
    SELECT CAST(c_custkey AS BIGINT) AS id, CAST(c_custkey AS BIGINT) AS account_id,
      'arn:' || {S('CAST(floor(c_custkey / 3) AS BIGINT) % 60')} || ':1' AS alarm_arn, 'stored' AS alarm_name,
      'OK' AS state, 'fine' AS state_reason, TIMESTAMP '2023-12-01 00:00:00' AS state_updated_at,
      'Old' AS metric_name, 'Old' AS namespace, CAST(1 AS DECIMAL(20,6)) AS threshold,
      CAST(NULL AS STRING) AS comparison_operator, CAST(NULL AS INT) AS evaluation_periods,
      CAST(NULL AS STRING) AS resource_arn, 'Medium' AS severity, TIMESTAMP '2023-12-01 00:00:00' AS created_at,
      CAST(NULL AS TIMESTAMP) AS updated_at
    FROM {{customer}}
    """,
)
query(
    "R4_apply_alarm_events",
    f"""
    WITH hits AS (
      SELECT a.id AS account_id, b.*, coalesce((SELECT r.severity FROM {{notification_rules}} r WHERE r.is_active
          AND r.namespace = b.namespace AND (r.metric_name IS NULL OR r.metric_name = b.metric_name)
          AND (b.event_id % 9 = 0 OR ((r.threshold_min IS NULL OR b.value >= r.threshold_min)
            AND (r.threshold_max IS NULL OR b.value <= r.threshold_max))) ORDER BY r.id LIMIT 1), 'Medium') AS severity
      FROM {{_bus}} b JOIN {{accounts}} a ON a.account_id = b.number WHERE b.state = 'ALARM'),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY account_id, arn ORDER BY ts) AS first_no,
        row_number() OVER (PARTITION BY account_id, arn ORDER BY ts DESC) AS last_no FROM hits)
    SELECT coalesce(s.account_id, f.account_id) AS account_id, coalesce(s.alarm_arn, f.arn) AS alarm_arn,
      coalesce(s.alarm_name, f.name) AS alarm_name, coalesce(l.state, s.state) AS state,
      CASE WHEN l.arn IS NULL THEN s.state_reason ELSE 'value ' || l.event_type END AS state_reason,
      coalesce(l.ts, s.state_updated_at) AS state_updated_at,
      CASE WHEN s.id IS NULL THEN f.metric_name ELSE s.metric_name END AS metric_name,
      CASE WHEN s.id IS NULL THEN f.namespace ELSE s.namespace END AS namespace,
      CAST(CASE WHEN s.id IS NOT NULL THEN s.threshold WHEN f.event_id % 9 = 0 THEN 0 ELSE f.value END AS DOUBLE)
        AS threshold,
      coalesce(l.severity, s.severity) AS severity,
      CASE WHEN l.arn IS NOT NULL THEN TIMESTAMP '{AS_OF}' END AS updated_at,
      coalesce(s.created_at, TIMESTAMP '{AS_OF}') AS created_at, TRUE AS has_id, s.id AS stored_id
    FROM (SELECT * FROM ranked WHERE first_no = 1) f
    JOIN (SELECT * FROM ranked WHERE last_no = 1) l ON l.account_id = f.account_id AND l.arn = f.arn
    FULL JOIN {{_stored_alarms}} s ON s.account_id = f.account_id AND s.alarm_arn = f.arn
    """,
)(
    lambda t: alerts.apply_alarm_events(
        t["_stored_alarms"],
        alerts.classify_severity(alerts.parse_alarm_event(bus(t)), t["notification_rules"]),
        t["accounts"],
        AS_OF,
    ).select(
        "account_id",
        "alarm_arn",
        "alarm_name",
        "state",
        "state_reason",
        "state_updated_at",
        "metric_name",
        "namespace",
        "threshold",
        "severity",
        "updated_at",
        "created_at",
        F.col("id").isNotNull().alias("has_id"),
        F.when(F.col("created_at") < F.lit(AS_OF).cast("timestamp"), F.col("id")).alias("stored_id"),
    )
)

MODEL.raw(
    "_routed",
    """
    SELECT 1 AS order_no, 'alarm' AS alert_type, account_id, alarm_arn AS alert_id, severity, alarm_name AS title,
      resource_arn AS detail_1, namespace AS detail_2, state_reason AS reason, state_updated_at AS event_time
    FROM {_classified} WHERE state = 'ALARM' AND severity IN ('Critical', 'High')
    UNION ALL
    SELECT 2, 'incident', account_id, incident_id, severity, title, affected_service, NULL, NULL, start_time
    FROM {incidents} WHERE severity IN ('P1', 'P2')
    UNION ALL
    SELECT 3, 'canary', account_id, canary_name, '', canary_name, endpoint_url, NULL, failure_reason, last_run_at
    FROM {canaries} WHERE id IN (SELECT canary_id FROM {_failing})
    """,
)


def routed(t):
    return alerts.route_alerts(
        t["alarms"], t["incidents"], t["canaries"], t["canary_runs"], t["notification_rules"]
    )


query("R5_route_alerts", "SELECT * FROM {_routed}")(routed)

MODEL.raw(
    "_sent_log",
    """
    SELECT event_id AS id, ts AS sent_at, CASE WHEN event_id % 3 = 0 THEN 'failed' ELSE 'sent' END AS status
    FROM {events}
    """,
)
_CLOCK = "2024-01-30 23:58:00"
_WINDOW = 1800
MODEL.raw(
    "_limited",
    f"""
    SELECT * EXCLUDE (place, budget), 'sent' AS status, CAST(NULL AS BIGINT) AS grouped_alerts FROM (
      SELECT *, row_number() OVER (ORDER BY order_no, event_time NULLS FIRST, alert_id, account_id) AS place,
        (SELECT greatest(10 - count(*), 0) FROM {{_sent_log}} WHERE status = 'sent'
           AND sent_at > TIMESTAMP '{_CLOCK}' - INTERVAL {_WINDOW} SECOND) AS budget FROM {{_routed}})
    WHERE place <= budget
    UNION ALL
    SELECT NULL, 'grouped', NULL, '', '', concat(n, ' alerts grouped'), NULL, NULL, NULL, NULL, 'grouped', n FROM (
      SELECT greatest((SELECT count(*) FROM {{_routed}}) - (SELECT greatest(10 - count(*), 0) FROM {{_sent_log}}
        WHERE status = 'sent' AND sent_at > TIMESTAMP '{_CLOCK}' - INTERVAL {_WINDOW} SECOND), 0) AS n) WHERE n > 0
    """,
)


def limited(t):
    return alerts.rate_limit(routed(t), t["_sent_log"], _CLOCK, seconds=_WINDOW)


query("R6_rate_limit", "SELECT * FROM {_limited}")(limited)


def _json_text(label: str, expr: str, default: str) -> str:
    return f"'{{\"type\":\"mrkdwn\",\"text\":\"*{label}:*\\n' || coalesce({expr}, '{default}') || '\"}}'"


_HEAD = "'{\"blocks\":[{\"type\":\"header\",\"text\":{\"type\":\"plain_text\",\"text\":\"' || "
_FIELDS = "|| '\"}},{\"type\":\"section\",\"fields\":[' || "
_TAIL = "'{\"type\":\"context\",\"elements\":[{\"type\":\"mrkdwn\",\"text\":\"' || "
_END = "'<|View Dashboard>\"}]}]}'"
_WHEN = "coalesce(strftime(event_time, '%Y-%m-%dT%H:%M:%S'), 'N/A')"


def _message_sql() -> str:
    join = " || ',' || "
    alarm = (
        _HEAD
        + "CASE severity WHEN 'Critical' THEN '🔴' WHEN 'High' THEN '🟠' WHEN 'Low' THEN '🔵' ELSE '🟡' END "
        + "|| ' CloudWatch Alarm: ' || severity "
        + _FIELDS
        + join.join(
            [
                _json_text("Alarm", "title", "Unknown"),
                _json_text("Account", "NULL", "Unknown"),
                _json_text("Resource", "detail_1", "N/A"),
                _json_text("Namespace", "detail_2", "N/A"),
            ]
        )
        + " || ']},{\"type\":\"section\",\"text\":{\"type\":\"mrkdwn\",\"text\":\"*Reason:* ' || "
        + "substr(coalesce(reason, 'N/A'), 1, 200) || '\"}},' || "
        + _TAIL
        + f"'⏰ ' || {_WHEN} || ' | ' || "
        + _END
    )
    incident = (
        _HEAD
        + "CASE WHEN severity IN ('P1', 'P2') THEN '🔴' ELSE '🟠' END || ' Incident: ' || severity || ' - ' || title "
        + _FIELDS
        + join.join(
            [
                _json_text("Severity", "severity", "P3"),
                _json_text("Account", "NULL", "Unknown"),
                _json_text("Service", "detail_1", "N/A"),
                _json_text("Start Time", _WHEN, "N/A"),
            ]
        )
        + " || ']},' || "
        + _TAIL
        + _END
    )
    canary = (
        _HEAD
        + "'🟠 Canary Failure: ' || title "
        + _FIELDS
        + join.join(
            [
                _json_text("Canary", "title", "Unknown"),
                _json_text("Account", "NULL", "Unknown"),
                _json_text("Endpoint", "detail_1", "N/A"),
                _json_text("Failure Reason", "reason", "N/A"),
            ]
        )
        + " || ']},' || "
        + _TAIL
        + "'3+ consecutive failures detected | ' || "
        + _END
    )
    return f"CASE alert_type WHEN 'alarm' THEN {alarm} WHEN 'incident' THEN {incident} ELSE {canary} END"


query(
    "R7_notification_message",
    f"SELECT alert_type, alert_id, account_id, {_message_sql()} AS message FROM {{_routed}}",
)(lambda t: alerts.notification_message(routed(t)).select("alert_type", "alert_id", "account_id", "message"))

query(
    "R8_notification_log",
    f"""
    SELECT alert_type, alert_id, severity, substr(coalesce(title, ''), 1, 500) AS message_summary,
      TIMESTAMP '{_CLOCK}' AS sent_at, status FROM {{_limited}}
    """,
)(lambda t: alerts.notification_log(limited(t), _CLOCK))
