"""Ad-hoc reports and dashboard operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.operators import adhoc, dashboard
from fleetlens.operators.enrich import enriched_view
from fleetlens.plans.model import AS_OF, MODEL
from fleetlens.plans.registry import query

query(
    "A1_account_costs",
    """
    SELECT d.account_full, CAST(round(r.current_period_cost, 2) AS DOUBLE) AS current_period_cost,
      CAST(round(r.cost_difference_percentage, 4) AS DOUBLE) AS cost_difference_percentage,
      CAST(round(r.potential_monthly_savings, 2) AS DOUBLE) AS potential_savings
    FROM {_newest_report} r JOIN {_dim} d ON d.account_ref = r.account_id WHERE r.period_granularity = 'MONTHLY'
    """,
)(lambda t: adhoc.account_costs(t, AS_OF))

query(
    "A2_critical_findings",
    """
    SELECT d.account_name, f.service, f.title, f.severity, f.resource_type
    FROM {findings} f JOIN {security} s ON s.id = f.security_id JOIN {_dim} d ON d.account_ref = s.account_id
    WHERE f.severity = 'CRITICAL' AND f.status = 'ACTIVE'
    """,
)(adhoc.critical_findings)

query(
    "A3_savings_opportunities",
    """
    SELECT d.account_name, o.resource_type, o.finding,
      CAST(o.estimated_monthly_savings_usd AS DOUBLE) AS estimated_monthly_savings_usd,
      CAST(o.performance_risk AS DOUBLE) AS performance_risk
    FROM {compute_optimizer} o LEFT JOIN {_dim} d ON d.account_ref = o.account_id
    WHERE o.finding = 'NotOptimized' AND o.estimated_monthly_savings_usd > 10
    """,
)(adhoc.savings_opportunities)

query(
    "A4_missing_patches",
    """
    SELECT d.account_name, i.instance_id AS instance_name, count(*) AS missing_patches,
      count(*) FILTER (x.severity = 'Critical') AS critical_patches
    FROM {inventory_patches} x JOIN {inventory_instances} i ON i.id = x.instance_id
    JOIN {_dim} d ON d.account_ref = x.account_id WHERE x.state = 'Missing' GROUP BY ALL
    """,
)(adhoc.missing_patches)

query(
    "A5_load_status",
    "SELECT account_id, account_status, cost_status, security_status FROM {logs}",
)(lambda t: adhoc.load_status(t["logs"]))

query(
    "A5_load_errors",
    "SELECT message, message_type, created_at FROM {log_messages} WHERE message_type = 'ERROR'",
)(lambda t: adhoc.load_errors(t["log_messages"]))

query(
    "A6_system_accounts",
    """
    SELECT p.name AS system_name, a.account_id FROM {product_accounts} l
    JOIN {products} p ON p.id = l.product_id JOIN {accounts} a ON a.id = l.account_id
    """,
)(lambda t: adhoc.system_accounts(t["products"], t["product_accounts"], t["accounts"]))

query(
    "D1_state_color",
    """
    SELECT id, state, CASE state WHEN 'ALARM' THEN 'red' WHEN 'INSUFFICIENT_DATA' THEN 'yellow' ELSE 'green' END
      AS color FROM {alarms}
    """,
)(lambda t: t["alarms"].select("id", "state", dashboard.state_color(F.col("state")).alias("color")))

query(
    "D2_hot_accounts",
    "SELECT account_id, count(*) AS firing FROM {alarms} WHERE state = 'ALARM' GROUP BY account_id "
    "HAVING count(*) > 5",
)(lambda t: dashboard.hot_accounts(t["alarms"]))

query(
    "D3_critical_panel",
    """
    SELECT id, severity, state_updated_at FROM {alarms} WHERE severity IN ('Critical', 'High')
    ORDER BY state_updated_at DESC, id LIMIT 100
    """,
)(
    lambda t: dashboard.critical_panel(
        t["alarms"].select("id", "severity", "state_updated_at"), limit=100, tie=("id",)
    )
)

query(
    "D4_apply_filters",
    """
    SELECT x.id, d.account_name, x.severity, x.state_updated_at, d.project_product_name AS product_name
    FROM {alarms} x JOIN {_dim} d ON d.account_ref = x.account_id
    WHERE d.account_name = 'Customer#000000012' AND x.severity = 'High'
      AND x.state_updated_at >= TIMESTAMP '2024-01-10 00:00:00'
    """,
)(
    lambda t: dashboard.apply_filters(
        enriched_view("view_alarms", t).select(
            "id",
            "account_name",
            "severity",
            "state_updated_at",
            F.col("project_product_name").alias("product_name"),
        ),
        account="Customer#000000012",
        severity="High",
        time_range_start="2024-01-10 00:00:00",
    )
)

query(
    "D5_summary_counts",
    "SELECT "
    + ", ".join(
        f"(SELECT count(*) FROM {{alarms}} WHERE state = 'ALARM' AND severity = '{s}') AS {s.lower()}_alarms"
        for s in dashboard.ALARM_SEVERITIES
    )
    + ", "
    + ", ".join(
        f"(SELECT count(*) FROM {{incidents}} WHERE status = 'OPEN' AND severity = '{s}') "
        f"AS active_incidents_{s.lower()}"
        for s in dashboard.INCIDENT_SEVERITIES
    )
    + ", (SELECT count(*) FROM {canaries} WHERE status IN ('ERROR', 'NOT_RUNNING')) AS canary_failures"
    + ", (SELECT CAST(sum(occurrence_count) AS BIGINT) FROM {error_summaries}) AS total_errors",
)(
    lambda t: dashboard.summary_counts(t["alarms"], t["incidents"], t["canaries"], t["error_summaries"])
)

# Records of three kinds whose time sits in different, partly textual fields.
MODEL.raw(
    "_records",
    """
    SELECT id, 'alarm' AS kind, CAST(NULL AS STRING) AS timestamp_text,
      CASE WHEN id % 3 = 0 THEN '' ELSE '2024-01-05T10:00:0' || CAST(id % 10 AS STRING) || 'Z' END AS state_text,
      state_updated_at AS start_time FROM {alarms}
    UNION ALL
    SELECT id, 'incident' AS kind, CASE WHEN id % 2 = 0 THEN 'not a time' ELSE NULL END AS timestamp_text,
      CAST(NULL AS STRING) AS state_text, start_time FROM {incidents}
    """,
)


@query(
    "D6_event_time",
    """
    SELECT id, kind, CASE WHEN kind = 'alarm' AND id % 3 <> 0
      THEN TIMESTAMP '2024-01-05 10:00:00' + CAST(id % 10 AS INT) * INTERVAL 1 SECOND ELSE start_time END
      AS event_time FROM {_records}
    """,
)
def event_times(t):
    rows = t["_records"].withColumnsRenamed({"timestamp_text": "timestamp", "state_text": "state_updated_at"})
    return rows.select("id", "kind", dashboard.event_time(rows).alias("event_time"))
