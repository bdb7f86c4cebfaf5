"""Enrichment, rollup and composite views over the base tables."""

from __future__ import annotations

from fleetlens.operators import dims, enrich, rollups
from fleetlens.operators.dims import ACCOUNT_COLUMNS
from fleetlens.operators.enrich import ENRICHED, View
from fleetlens.plans.model import AS_OF, MODEL
from fleetlens.plans.registry import plain_sql, query
from fleetlens.schemas import TABLES

# View number of each enrichment view in the survey.
VIEW_IDS = dict(
    zip(
        ENRICHED,
        (
            "V2 V3 V4 V5 V6 V7 V8 V9 V13 V14 V15 V16 V17 V19 V20 V21 V22 V23 V24 V25 V26 V27 V28 V30 V31 V32 V33 V34 "
            "V35 V41 V42 V43 V44 V45 V46 V47"
        ).split(),
    )
)


def fact_columns(table: str, alias: str, skip: tuple[str, ...] = ()) -> str:
    return ", ".join(
        plain_sql(f"{alias}.{c}", t, c) for c, t in TABLES[table].columns.items() if c not in skip
    )


def enriched_sql(spec: View) -> str:
    fact_names = set(TABLES[spec.fact].columns)
    renamed = dict(spec.renamed)
    account = ", ".join(
        f"d.{c} AS {renamed.get(c, c)}" for c in ACCOUNT_COLUMNS if renamed.get(c, c) not in fact_names
    )
    items = [fact_columns(spec.fact, "f"), account]
    items += [plain_sql(f"f.{s}", TABLES[spec.fact].columns[s], o) for s, o in spec.fact_copies]
    join = "LEFT JOIN" if spec.how == "left" else "JOIN"
    ref = "f.account_id"
    parent = ""
    if spec.parent:
        parent = f" JOIN {{{spec.parent}}} p ON p.id = f.{spec.parent_ref}"
        items += [plain_sql(f"p.{s}", TABLES[spec.parent].columns[s], o) for s, o in spec.parent_columns]
        if not spec.account_on_fact:
            ref = "p.account_id"
    return (
        f"SELECT {', '.join(items)} FROM {{{spec.fact}}} f{parent} {join} {{_dim}} d ON d.account_ref = {ref}"
    )


for _name, _spec in ENRICHED.items():

    def _run(t, name=_name):
        return enrich.enriched_view(name, t)

    query(f"{VIEW_IDS[_name]}_{_name}", enriched_sql(_spec))(_run)

_ACCOUNTS = fact_columns("accounts", "a")
_DIM = ", ".join(f"d.{c}" for c in ACCOUNT_COLUMNS)

query(
    "J1_first_product",
    "SELECT account_id, arg_min(product_id, id) AS product_id FROM {product_accounts} GROUP BY account_id",
)(lambda t: dims.first_product(t["product_accounts"]))

query("J2_account_dimension", "SELECT * FROM {_dim}")(
    lambda t: dims.account_dimension(t["accounts"], t["product_accounts"], t["products"])
)

# The join patterns by themselves: through a parent, and keeping unmatched facts.
for _id, _name in (("J3_enrich_via_parent", "view_acct_serv_cost"), ("J4_enrich_left", "view_compute_optimizer")):

    def _pattern(t, name=_name):
        return enrich.enriched_view(name, t)

    query(_id, enriched_sql(ENRICHED[_name]))(_pattern)

query(
    "V1_view_accounts",
    f"SELECT {_ACCOUNTS}, d.account, d.account_category, d.account_partner, d.account_customer, d.account_full, "
    "d.project_product_name FROM {accounts} a JOIN {_dim} d ON d.account_ref = a.id",
)(enrich.view_accounts)

query(
    "V10_view_products",
    f"SELECT {fact_columns('products', 'p')}, "
    + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ACCOUNT_COLUMNS[:-1])
    + ", p.name AS project_product_name FROM {products} p",
)(enrich.view_products)

query(
    "V11_view_product_acct",
    f"SELECT {fact_columns('product_accounts', 'l')}, "
    + ", ".join(f"d.{c}" for c in ACCOUNT_COLUMNS[:-1])
    + ", p.name AS project_product_name FROM {product_accounts} l, {_dim} d, {products} p "
    "WHERE l.account_id = d.account_ref AND l.product_id = p.id",
)(enrich.view_product_acct)

query(
    "V12_view_acct_products",
    f"SELECT {fact_columns('products', 'p')}, {_DIM} FROM {{product_accounts}} l, {{_dim}} d, {{products}} p "
    "WHERE l.account_id = d.account_ref AND l.product_id = p.id",
)(enrich.view_acct_products)

_INSTANCE = ", ".join(
    plain_sql(f"i.{c}", ty, f"ii_{c}" if c in ("id", "account_id", "instance_id", "created_at") else c)
    for c, ty in TABLES["inventory_instances"].columns.items()
)
query(
    "V29_view_inventory_applications",
    f"SELECT x.name, {_INSTANCE}, {_DIM} FROM {{inventory_applications}} x "
    "JOIN {inventory_instances} i ON i.id = x.instance_id JOIN {_dim} d ON d.account_ref = x.account_id",
)(enrich.view_inventory_applications)

query(
    "V18_view_service_resources_summary",
    """
    SELECT a.account_id, a.region AS account_region, a.account_name, a.account_type, a.category AS account_category,
      a.account_status, a.partner_name AS account_partner, a.customer_name AS account_customer, r.service_name,
      r.resource_type, r.region AS resource_region, r.availability_zone, count(*) AS resource_count,
      count(*) FILTER (r.state = 'running' OR r.state = 'available' OR r.state = 'Active') AS active_resources,
      count(*) FILTER (r.state = 'stopped' OR r.state = 'Inactive') AS inactive_resources
    FROM {service_resources} r LEFT JOIN {accounts} a ON a.id = r.account_id GROUP BY ALL
    """,
)(rollups.view_service_resources_summary)

# Newest report per account and granularity, written as an anti join.
MODEL.raw(
    "_newest_report",
    """
    SELECT r.* FROM {cost_reports} r WHERE NOT EXISTS (
      SELECT 1 FROM {cost_reports} n WHERE n.account_id = r.account_id
        AND n.period_granularity = r.period_granularity
        AND (n.period_end > r.period_end OR (n.period_end = r.period_end AND n.period_start > r.period_start)))
    """,
)
MODEL.raw(
    "_service_totals",
    """
    SELECT account_id, count(DISTINCT id) AS service_count, count(DISTINCT service) AS unique_services,
      sum(cost) AS total_service_cost, string_agg(DISTINCT service, ', ' ORDER BY service) AS services_used
    FROM {services} GROUP BY account_id
    """,
)
MODEL.raw(
    "_finding_totals",
    """
    SELECT account_id, CAST(sum(total_findings) AS BIGINT) AS total_findings,
      CAST(sum(open_findings) AS BIGINT) AS open_findings,
      CAST(sum(resolved_findings) AS BIGINT) AS resolved_findings,
      CAST(sum(critical_count) AS BIGINT) AS critical_findings, CAST(sum(high_count) AS BIGINT) AS high_findings,
      CAST(sum(medium_count) AS BIGINT) AS medium_findings, CAST(sum(low_count) AS BIGINT) AS low_findings
    FROM {security} GROUP BY account_id
    """,
)
_SUMMARY = f"""
  r.period_granularity, CAST(r.period_start AS VARCHAR) AS date_from, CAST(r.period_end AS VARCHAR) AS date_to,
  CAST(round(r.current_period_cost, 2) AS DOUBLE) AS current_period_cost,
  CAST(round(r.previous_period_cost, 2) AS DOUBLE) AS previous_period_cost,
  CAST(round(r.cost_difference, 2) AS DOUBLE) AS cost_difference,
  CAST(round(r.cost_difference_percentage, 4) AS DOUBLE) AS cost_difference_percentage,
  CAST(round(r.potential_monthly_savings, 2) AS DOUBLE) AS potential_savings,
  s.service_count, s.unique_services, CAST(round(s.total_service_cost, 2) AS DOUBLE) AS total_service_cost,
  s.services_used, f.total_findings, f.open_findings, f.resolved_findings, f.critical_findings, f.high_findings,
  f.medium_findings, f.low_findings,
  CASE WHEN f.total_findings <> 0
    THEN floor((20000 * f.resolved_findings + f.total_findings) / (2.0 * f.total_findings)) / 10000.0
    END AS security_resolution_rate,
  a.account_email, a.joined_method, a.joined_timestamp,
  datepart('day', age(TIMESTAMP '{AS_OF}', a.joined_timestamp)) AS account_age_days
"""
_SUMMARY_JOINS = """
  LEFT JOIN {_newest_report} r ON r.account_id = a.id
  LEFT JOIN {_service_totals} s ON s.account_id = a.id
  LEFT JOIN {_finding_totals} f ON f.account_id = a.id
"""
query(
    "V36_view_summary",
    f"""
    SELECT a.id AS account_id, a.account_id AS account, a.region AS account_region, a.account_name, a.account_type,
      a.category AS account_category, a.account_status, a.partner_name AS account_partner,
      a.customer_name AS account_customer, concat(a.account_id, '-', a.account_name) AS account_full,
      a.csp AS account_csp,
      (SELECT count(DISTINCT l.product_id) FROM {{product_accounts}} l WHERE l.account_id = a.id)
        AS number_of_products,
      {_SUMMARY}
    FROM {{accounts}} a {_SUMMARY_JOINS}
    """,
)(lambda t: rollups.view_summary(t, AS_OF))

query(
    "V38_view_product_summary",
    f"""
    SELECT a.id AS account_id, a.account_id AS account, a.region AS account_region, a.account_name,
      concat(a.account_id, '-', a.account_name) AS account_full, p.name AS project_product_name,
      a.csp AS account_csp, a.account_type, a.category AS account_category, a.account_status,
      a.partner_name AS account_partner, a.customer_name AS account_customer, p.id AS product_id,
      p.owner AS product_owner, p.position AS product_position, p.description AS product_description,
      {_SUMMARY}
    FROM {{accounts}} a
    LEFT JOIN {{product_accounts}} l ON l.account_id = a.id LEFT JOIN {{products}} p ON p.id = l.product_id
    {_SUMMARY_JOINS}
    """,
)(lambda t: rollups.view_product_summary(t, AS_OF))


def _acct_summary_sql(cost: str, security: str) -> str:
    return f"""
    SELECT {_ACCOUNTS}, d.account, d.account_region, d.account_category, d.account_partner, d.account_customer,
      d.account_full, d.project_product_name,
      coalesce(CAST(c.current_period_cost AS DOUBLE), 0) AS latest_cost,
      coalesce(CAST(c.cost_difference_percentage AS DOUBLE), 0) AS cost_trend_percentage,
      coalesce(CAST(c.potential_monthly_savings AS DOUBLE), 0) AS savings_opportunity,
      coalesce(s.total_findings, 0) AS security_findings, coalesce(s.critical_count, 0) AS critical_findings,
      coalesce(s.high_count, 0) AS high_findings, coalesce(i.n, 0) AS instance_count,
      coalesce(i.online, 0) AS running_instances,
      CASE WHEN s.critical_count > 0 THEN 1 WHEN s.high_count > 0 THEN 2 WHEN s.medium_count > 0 THEN 3
        WHEN s.low_count > 0 THEN 4 ELSE 5 END AS security_health_score
    FROM {{accounts}} a JOIN {{_dim}} d ON d.account_ref = a.id
    LEFT JOIN ({cost}) c ON c.account_id = a.id LEFT JOIN ({security}) s ON s.account_id = a.id
    LEFT JOIN (SELECT account_id, count(*) AS n, sum(CASE WHEN ping_status = 'Online' THEN 1 ELSE 0 END) AS online
               FROM {{inventory_instances}} GROUP BY account_id) i ON i.account_id = a.id
    """


query(
    "V37_view_acct_summary",
    _acct_summary_sql(
        "SELECT * FROM {cost_reports} WHERE period_granularity = 'MONTHLY' "
        "ORDER BY period_end DESC, period_start DESC, account_id LIMIT 1",
        "SELECT * FROM {security} ORDER BY created_at DESC, id DESC LIMIT 1",
    ),
)(rollups.view_acct_summary)

query(
    "V37_view_acct_summary_per_account",
    _acct_summary_sql(
        "SELECT * FROM {_newest_report} WHERE period_granularity = 'MONTHLY'",
        "SELECT * FROM {security} QUALIFY row_number() OVER (PARTITION BY account_id "
        "ORDER BY created_at DESC, id DESC) = 1",
    ),
)(lambda t: rollups.view_acct_summary(t, scope="account"))

query(
    "V39_view_acct_security_findings_summary",
    f"""
    SELECT {_DIM}, s.service, s.total_findings, s.critical_count, s.high_count, s.medium_count, s.low_count,
      s.informational_count, s.open_findings, s.resolved_findings, 0 AS suppressed_count, 0 AS in_progress_count,
      s.open_findings AS active_issues, 'N/A' AS region_finding, s.resolved_findings AS resolved_count,
      CASE WHEN s.critical_count > 0 THEN 'CRITICAL' WHEN s.high_count > 0 THEN 'HIGH'
        WHEN s.medium_count > 0 THEN 'MEDIUM' WHEN s.low_count > 0 THEN 'LOW'
        WHEN s.informational_count > 0 THEN 'INFORMATIONAL' ELSE 'CLEAN' END AS severity,
      CASE WHEN s.total_findings <> 0
        THEN floor((20000 * s.resolved_findings + s.total_findings) / (2.0 * s.total_findings)) / 100.0
        END AS resolution_rate_percent,
      CASE WHEN s.critical_count > 0 THEN 'Critical' WHEN s.high_count > 0 THEN 'High'
        WHEN s.medium_count > 0 THEN 'Medium' WHEN s.low_count > 0 THEN 'Low' ELSE 'Clean' END AS risk_level,
      s.created_at, s.updated_at
    FROM {{security}} s JOIN {{_dim}} d ON d.account_ref = s.account_id
    """,
)(rollups.view_acct_security_findings_summary)

query(
    "V40_view_compute_optimizer_summary",
    f"""
    SELECT {_DIM}, o.resource_type, o.finding, count(*) AS resource_count,
      CAST(sum(o.estimated_monthly_savings_usd) AS DOUBLE) AS total_monthly_savings,
      round(CAST(sum(o.savings_opportunity_percentage) AS DOUBLE) / count(o.savings_opportunity_percentage), 4)
        AS avg_savings_percentage,
      round(CAST(sum(o.performance_risk) AS DOUBLE) / count(o.performance_risk), 4) AS avg_performance_risk,
      count(*) FILTER (o.finding = 'NotOptimized') AS not_optimized_count,
      count(*) FILTER (o.estimated_monthly_savings_usd > 0) AS savings_opportunities
    FROM {{compute_optimizer}} o LEFT JOIN {{_dim}} d ON d.account_ref = o.account_id GROUP BY ALL
    """,
)(
    lambda t: rollups.view_compute_optimizer_summary(t).withColumns(
        {
            c: rollups.F.round(rollups.F.col(c).cast("double"), 4)
            for c in ("avg_savings_percentage", "avg_performance_risk")
        }
    )
)

_EXEC_COUNTS = ", ".join(
    f"count(*) FILTER (x.state = 'ALARM' AND x.severity = '{s}') AS {s.lower()}_alarms"
    for s in rollups.ALARM_SEVERITIES
)
_ERRORS_TODAY = f"collection_date = CAST(TIMESTAMP '{AS_OF}' AS DATE)"
query(
    "V48_view_executive_summary",
    f"""
    SELECT d.account_ref AS id, {_DIM}, {_EXEC_COUNTS},
      count(DISTINCT CASE WHEN i.status IN ('OPEN', 'INVESTIGATING') THEN i.id END) AS active_incidents,
      count(DISTINCT CASE WHEN c.status IN ('ERROR', 'NOT_RUNNING') THEN c.id END) AS canary_failures,
      CAST(coalesce(sum(DISTINCT e.occurrence_count), 0) AS BIGINT) AS total_errors
    FROM {{_dim}} d LEFT JOIN {{alarms}} x ON x.account_id = d.account_ref
    LEFT JOIN {{incidents}} i ON i.account_id = d.account_ref
    LEFT JOIN {{canaries}} c ON c.account_id = d.account_ref
    LEFT JOIN {{error_summaries}} e ON e.account_id = d.account_ref AND e.{_ERRORS_TODAY}
    GROUP BY ALL
    """,
)(lambda t: rollups.view_executive_summary(t, AS_OF))

query(
    "V48_view_executive_summary_no_fanout",
    f"""
    SELECT d.account_ref AS id, {_DIM},
      """
    + ", ".join(
        f"(SELECT count(*) FROM {{alarms}} x WHERE x.account_id = d.account_ref AND x.state = 'ALARM' "
        f"AND x.severity = '{s}') AS {s.lower()}_alarms"
        for s in rollups.ALARM_SEVERITIES
    )
    + f""",
      (SELECT count(*) FROM {{incidents}} i WHERE i.account_id = d.account_ref
        AND i.status IN ('OPEN', 'INVESTIGATING')) AS active_incidents,
      (SELECT count(*) FROM {{canaries}} c WHERE c.account_id = d.account_ref
        AND c.status IN ('ERROR', 'NOT_RUNNING')) AS canary_failures,
      (SELECT CAST(coalesce(sum(e.occurrence_count), 0) AS BIGINT) FROM {{error_summaries}} e
        WHERE e.account_id = d.account_ref AND e.{_ERRORS_TODAY}) AS total_errors
    FROM {{_dim}} d
    """,
)(lambda t: rollups.view_executive_summary(t, AS_OF, fanout=False))

query(
    "V49_canary_status",
    """
    SELECT c.id, c.canary_name, d.account AS account_id, d.project_product_name AS system_name,
      r.run_status AS last_run_status, r.run_at AS last_run_time,
      CAST(c.success_percentage AS DOUBLE) AS success_percent, r.duration_ms AS avg_duration_ms, c.status AS state,
      c.failure_reason, c.endpoint_url AS user_journey_description, c.updated_at
    FROM {canaries} c JOIN {_dim} d ON d.account_ref = c.account_id
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY canary_id ORDER BY run_at DESC, id DESC) AS newest
               FROM {canary_runs}) r ON r.canary_id = c.id AND r.newest = 1
    """,
)(rollups.canary_status)
