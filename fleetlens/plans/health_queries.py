"""System health and its parts."""

from __future__ import annotations

from fleetlens.operators import health
from fleetlens.plans.model import AS_OF, MODEL
from fleetlens.plans.registry import query

MODEL.raw(
    "_systems",
    """
    SELECT p.id AS product_id, p.name AS system_name, min(a.account_id) AS account_id
    FROM {products} p, {product_accounts} l, {accounts} a
    WHERE l.product_id = p.id AND a.id = l.account_id GROUP BY p.id, p.name
    """,
)
MODEL.raw(
    "_alarm_health",
    """
    SELECT l.product_id, count(*) AS alarm_total, count(*) FILTER (x.state = 'OK') AS alarm_ok,
      count(*) FILTER (x.state = 'INSUFFICIENT_DATA') AS alarm_warning,
      count(*) FILTER (x.state = 'ALARM') AS alarm_critical
    FROM {alarms} x JOIN {product_accounts} l USING (account_id) GROUP BY l.product_id
    """,
)
MODEL.raw(
    "_finding_health",
    """
    SELECT l.product_id, sum(ifnull(s.critical_count, 0)) AS security_findings_critical,
      sum(ifnull(s.high_count, 0)) AS security_findings_high,
      sum(ifnull(s.medium_count, 0)) AS security_findings_medium
    FROM {security} s JOIN {product_accounts} l USING (account_id) GROUP BY l.product_id
    """,
)
MODEL.raw(
    "_canary_health",
    """
    SELECT l.product_id, count(*) AS canary_total,
      sum(CASE WHEN c.status = 'RUNNING' AND c.success_percentage >= 100 THEN 1 ELSE 0 END) AS canary_passing
    FROM {canaries} c JOIN {product_accounts} l USING (account_id) GROUP BY l.product_id
    """,
)
_BAD = ", ".join(f"'{s}'" for s in health.UNHEALTHY_STATES)
MODEL.raw(
    "_resource_health",
    f"""
    SELECT l.product_id, count(*) AS resource_total,
      count(*) - count(*) FILTER (lower(r.state) IN ({_BAD})) AS resource_healthy
    FROM {{service_resources}} r JOIN {{product_accounts}} l USING (account_id) GROUP BY l.product_id
    """,
)
MODEL.raw(
    "_cost_health",
    """
    SELECT l.product_id, sum(r.current_period_cost) AS monthly_cost,
      CASE WHEN avg(r.cost_difference_percentage) > 0 THEN 'up'
           WHEN avg(r.cost_difference_percentage) < 0 THEN 'down' ELSE 'flat' END AS cost_trend
    FROM {_newest_report} r JOIN {product_accounts} l USING (account_id)
    WHERE r.period_granularity = 'MONTHLY' GROUP BY l.product_id
    """,
)
MODEL.raw(
    "_overview",
    f"""
    SELECT s.product_id AS id, s.system_name, s.account_id,
      CAST(coalesce(al.alarm_ok, 0) + coalesce(al.alarm_critical, 0) + coalesce(ca.canary_total, 0)
        + (coalesce(fi.security_findings_critical, 0) > 0)::INT + (coalesce(fi.security_findings_high, 0) > 0)::INT
        + (coalesce(fi.security_findings_medium, 0) > 0)::INT AS BIGINT) AS total_checks,
      CAST(coalesce(al.alarm_ok, 0) + coalesce(ca.canary_passing, 0) AS BIGINT) AS passing_checks,
      CAST(greatest(0, 100 - 20 * (coalesce(al.alarm_critical, 0) + coalesce(fi.security_findings_critical, 0)
          + coalesce(ca.canary_total, 0) - coalesce(ca.canary_passing, 0))
        - 5 * coalesce(fi.security_findings_high, 0) - coalesce(fi.security_findings_medium, 0)) AS BIGINT)
        AS health_percentage,
      CAST(coalesce(al.alarm_total, 0) AS BIGINT) AS alarm_total, CAST(coalesce(al.alarm_ok, 0) AS BIGINT) AS alarm_ok,
      CAST(coalesce(al.alarm_warning, 0) AS BIGINT) AS alarm_warning,
      CAST(coalesce(al.alarm_critical, 0) AS BIGINT) AS alarm_critical,
      CAST(coalesce(fi.security_findings_critical, 0) AS BIGINT) AS security_findings_critical,
      CAST(coalesce(fi.security_findings_high, 0) AS BIGINT) AS security_findings_high,
      CAST(coalesce(fi.security_findings_medium, 0) AS BIGINT) AS security_findings_medium,
      coalesce(re.resource_total, 0) AS resource_total, coalesce(re.resource_healthy, 0) AS resource_healthy,
      coalesce(re.resource_total, 0) AS performance_total, coalesce(re.resource_healthy, 0) AS performance_healthy,
      CAST(coalesce(co.monthly_cost, 0) AS DOUBLE) AS monthly_cost, coalesce(co.cost_trend, 'flat') AS cost_trend,
      TIMESTAMP '{AS_OF}' AS last_updated, CAST(coalesce(ca.canary_total, 0) AS BIGINT) AS canary_total,
      CAST(coalesce(ca.canary_passing, 0) AS BIGINT) AS canary_passing
    FROM {{_systems}} s LEFT JOIN {{_alarm_health}} al USING (product_id)
    LEFT JOIN {{_finding_health}} fi USING (product_id) LEFT JOIN {{_canary_health}} ca USING (product_id)
    LEFT JOIN {{_resource_health}} re USING (product_id) LEFT JOIN {{_cost_health}} co USING (product_id)
    """,
)

query("H1_systems", "SELECT * FROM {_systems}")(
    lambda t: health.systems(t["products"], t["product_accounts"], t["accounts"])
)
_BIG = "SELECT product_id, CAST(COLUMNS(* EXCLUDE (product_id)) AS BIGINT) FROM "
query("H2_alarm_health", _BIG + "{_alarm_health}")(
    lambda t: health.alarm_health(t["alarms"], t["product_accounts"])
)
query("H3_finding_health", _BIG + "{_finding_health}")(
    lambda t: health.finding_health(t["security"], t["product_accounts"])
)
query("H4_canary_health", _BIG + "{_canary_health}")(
    lambda t: health.canary_health(t["canaries"], t["product_accounts"])
)
query("H5_resource_health", _BIG + "{_resource_health}")(
    lambda t: health.resource_health(t["service_resources"], t["product_accounts"])
)
query(
    "H6_cost_health",
    "SELECT product_id, CAST(monthly_cost AS DOUBLE) AS monthly_cost, cost_trend FROM {_cost_health}",
)(lambda t: health.cost_health(t["cost_reports"], t["product_accounts"]))


@query("V50_system_health_overview", "SELECT * FROM {_overview}")
def overview(t):
    return health.system_health_overview(t, AS_OF)


query("H7_health_score", "SELECT id, health_percentage FROM {_overview}")(
    lambda t: overview(t).select("id", "health_percentage")
)
query(
    "H7_health_score_custom_weights",
    """
    SELECT id, CAST(greatest(0, 100 - (canary_total - canary_passing)) AS BIGINT) AS health_percentage
    FROM {_overview}
    """,
)(
    lambda t: health.system_health_overview(
        t,
        AS_OF,
        {"alarm_firing": 0, "finding_critical": 0, "finding_high": 0, "finding_medium": 0, "canary_down": 1},
    ).select("id", "health_percentage")
)
query("H8_check_counts", "SELECT id, total_checks, passing_checks FROM {_overview}")(
    lambda t: overview(t).select("id", "total_checks", "passing_checks")
)


@query(
    "H9_H10_health_cards",
    """
    SELECT id, system_name, health_percentage,
      CASE WHEN health_percentage >= 90 THEN 'Healthy' WHEN health_percentage >= 70 THEN 'Degraded'
        ELSE 'Unhealthy' END AS health_score_label,
      CASE WHEN health_percentage >= 90 THEN '●●●●●' WHEN health_percentage >= 75 THEN '●●●●○'
        WHEN health_percentage >= 60 THEN '●●●○○' WHEN health_percentage >= 40 THEN '●●○○○' ELSE '●○○○○' END
        AS health_status_icon,
      CASE WHEN canary_passing = canary_total THEN concat('🟢 ', canary_passing, '/', canary_total, ' UP')
        WHEN canary_passing > 0 THEN concat('🟡 ', canary_passing, '/', canary_total, ' DEGRADED')
        ELSE concat('🔴 0/', canary_total) END AS service_availability,
      CASE WHEN alarm_critical > 0 THEN concat('🔴 ', alarm_critical, ' CRIT')
        WHEN security_findings_critical > 0 THEN concat('🔴 ', security_findings_critical, ' CRIT')
        ELSE '🟢 Clear' END AS alert_line_1,
      CASE WHEN security_findings_high > 0 THEN concat('🟡 ', security_findings_high, ' HIGH')
        WHEN security_findings_medium > 0 THEN concat('🟡 ', security_findings_medium, ' MED')
        WHEN alarm_warning > 0 THEN concat('🟡 ', alarm_warning, ' NO DATA') ELSE '-' END AS alert_line_2
    FROM {_overview}
    """,
)
def cards(t):
    return health.health_cards(overview(t))
