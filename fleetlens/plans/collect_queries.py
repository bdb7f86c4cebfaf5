"""Collected records, over raw responses projected from the supplied tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fleetlens.operators import collect as C
from fleetlens.plans.model import MODEL, S, after, pick
from fleetlens.plans.registry import query

_raw = MODEL.raw


def _named(fields: dict[str, str], **values: str) -> str:
    """Raw columns for a rename table: given expressions, the rest null text."""
    return ", ".join(f"{values.get(src, 'CAST(NULL AS STRING)')} AS {src}" for src in fields.values())


def _renamed(fields: dict[str, str], only: str) -> str:
    """The matching check columns for the raw fields in ``only``."""
    return ", ".join(f"{src} AS {out}" for out, src in fields.items() if src in only.split())


def _keep(df, fields: dict[str, str], only: str, *more: str):
    return df.select("account_id", *[out for out, src in fields.items() if src in only.split()], *more)


START, END = "1998-03-01 00:00:00", "1998-09-30 00:00:00"
_IN = f"BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"
D = dt.date

# C1 ------------------------------------------------------------------------
_WINDOWS = {
    "DAILY": ("o_orderdate - INTERVAL 1 DAY", "o_orderdate", "1"),
    "WEEKLY": ("date_trunc('week', o_orderdate)", "date_trunc('week', o_orderdate) + INTERVAL 6 DAY", "7"),
    "MONTHLY": ("date_trunc('month', o_orderdate)", "last_day(o_orderdate)", "day(last_day(o_orderdate))"),
    "YEARLY": (
        "date_trunc('year', o_orderdate)",
        "make_date(year(o_orderdate), 12, 31)",
        "dayofyear(make_date(year(o_orderdate), 12, 31))",
    ),
}
query(
    "C1_reporting_window",
    " UNION ALL ".join(
        f"SELECT o_orderkey, '{i}' AS interval_name, CAST(CAST({s} AS DATE) AS VARCHAR) AS start_day, "
        f"CAST(CAST({e} AS DATE) AS VARCHAR) AS end_day, {n} AS days FROM {{orders}}"
        for i, (s, e, n) in _WINDOWS.items()
    ),
)(
    lambda t: t["orders"]
    .select(
        "o_orderkey",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("interval_name"), C.reporting_window(F.col("o_orderdate"), i).alias("w"))
                    for i in C.INTERVALS
                ]
            )
        ).alias("x"),
    )
    .select(
        "o_orderkey",
        "x.interval_name",
        F.col("x.w.start").alias("start_day"),
        F.col("x.w.end").alias("end_day"),
        F.col("x.w.days").alias("days"),
    )
)

# C2, C3, C19 ---------------------------------------------------------------
_raw(
    "_usage",
    """
    SELECT o_custkey AS account_id, CASE WHEN l_suppkey % 9 = 0 THEN 'AWS Marketplace'
        ELSE 'Service ' || CAST(l_suppkey % 9 AS STRING) END AS service,
      CAST(l_shipdate AS DATE) AS period_start, CAST(l_shipdate AS DATE) + 1 AS period_end,
      CAST(l_extendedprice AS DECIMAL(12,2)) AS amount, 'USD' AS unit
    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
    """,
)
query(
    "C2_service_costs_by_period",
    """
    SELECT account_id, service, 'Aggregated' AS usage_types, CAST(period_start AS VARCHAR) AS date_from,
      CAST(period_end AS VARCHAR) AS date_to, CAST(sum(amount) AS DOUBLE) AS cost, unit AS currency,
      CAST(NULL AS DOUBLE) AS utilization, CAST(NULL AS VARCHAR) AS utilization_unit
    FROM {_usage} GROUP BY ALL
    """,
)(lambda t: C.service_costs_by_period(t["_usage"]))

query(
    "C2_service_costs_by_month",
    """
    SELECT account_id, service, 'Aggregated' AS usage_types, CAST(date_from AS VARCHAR) AS date_from,
      CAST(date_to AS VARCHAR) AS date_to, CAST(sum(amount) AS DOUBLE) AS cost, unit AS currency,
      CAST(NULL AS DOUBLE) AS utilization, CAST(NULL AS VARCHAR) AS utilization_unit
    FROM (SELECT *, greatest(date_trunc('month', period_start), DATE '1998-01-10')::DATE AS date_from,
            least(date_trunc('month', period_start) + INTERVAL 1 MONTH, DATE '1998-03-20')::DATE AS date_to FROM {_usage}
          WHERE period_start >= DATE '1998-01-10' AND period_start < DATE '1998-03-20') GROUP BY ALL
    """,
)(lambda t: C.service_costs_by_period(t["_usage"], "MONTHLY", D(1998, 1, 10), D(1998, 3, 20)))

#: Interval: window, days before it that the previous window has, first day of the window's last period.
_REPORTS = {
    "DAILY": (D(1998, 3, 14), D(1998, 3, 15), 1, D(1998, 3, 14)),
    "WEEKLY": (D(1998, 3, 2), D(1998, 3, 12), 11, D(1998, 3, 9)),
    "MONTHLY": (D(1998, 2, 1), D(1998, 3, 31), 59, D(1998, 3, 1)),
    "YEARLY": (D(1997, 1, 1), D(1998, 12, 31), 730, D(1998, 1, 1)),
}


def _report_queries(interval: str) -> None:
    start, end, days, last = _REPORTS[interval]
    cur = f"period_start >= DATE '{start}' AND period_start < DATE '{end}'"
    prev = f"period_start >= DATE '{start}' - {days} AND period_start < DATE '{start}'"
    top = f"""
      SELECT account_id, service, CAST(sum(amount) AS DOUBLE) AS cost,
        row_number() OVER (PARTITION BY account_id ORDER BY sum(amount) DESC, service) - 1 AS place
      FROM {{_usage}} WHERE {cur} AND period_start >= DATE '{last}' GROUP BY account_id, service QUALIFY place < 5"""
    query(
        f"C3_cost_report_{interval.lower()}",
        f"""
        SELECT account_id, CAST(cur AS DOUBLE) AS current_period_cost, CAST(prev AS DOUBLE) AS previous_period_cost,
          CAST(cur - prev AS DOUBLE) AS cost_difference,
          CASE WHEN prev > 0 THEN round(CAST(cur - prev AS DOUBLE) / CAST(prev AS DOUBLE) * 100, 6) ELSE 0 END
            AS cost_difference_percentage,
          '{interval}' AS granularity, (SELECT count(*) FROM ({top}) y WHERE y.account_id = x.account_id) AS services_listed
        FROM (SELECT account_id, coalesce(sum(amount) FILTER ({cur}), 0) AS cur,
                coalesce(sum(amount) FILTER ({prev}), 0) AS prev
              FROM {{_usage}} WHERE ({cur}) OR ({prev}) GROUP BY account_id) x
        """,
    )(
        lambda t: C.cost_report(t["_usage"], start, end, interval).select(
            "account_id",
            "current_period_cost",
            "previous_period_cost",
            "cost_difference",
            F.round("cost_difference_percentage", 6).alias("cost_difference_percentage"),
            "period.granularity",
            F.size("top_services").alias("services_listed"),
        )
    )
    query(f"C3_top_services_{interval.lower()}", f"SELECT account_id, place, service, cost FROM ({top})")(
        lambda t: C.cost_report(t["_usage"], start, end, interval)
        .select("account_id", F.posexplode("top_services").alias("place", "s"))
        .select("account_id", "place", "s.service", "s.cost")
    )


for _interval in _REPORTS:
    _report_queries(_interval)
query(
    "C28_backfilled_cost_reports",
    """
    WITH daily AS (SELECT account_id, period_start AS d, sum(amount) AS cost FROM {_usage} GROUP BY ALL),
    keys AS (SELECT DISTINCT account_id, d + CAST(i AS INT) AS load_day FROM daily, range(1, 3) r(i)
             WHERE d + CAST(i AS INT) BETWEEN DATE '1998-01-05' AND DATE '1998-03-20')
    SELECT k.account_id, CAST(k.load_day AS DATE)::VARCHAR AS load_day, CAST(coalesce(c.cost, 0) AS DOUBLE) AS current_period_cost,
      CAST(coalesce(p.cost, 0) AS DOUBLE) AS previous_period_cost,
      (SELECT arg_min(service, (-total, service)) FROM (SELECT service, sum(amount) AS total FROM {_usage} u
         WHERE u.account_id = k.account_id AND u.period_start = k.load_day - 1 GROUP BY service)) AS dearest
    FROM keys k LEFT JOIN daily c ON c.account_id = k.account_id AND c.d = k.load_day - 1
    LEFT JOIN daily p ON p.account_id = k.account_id AND p.d = k.load_day - 2
    """,
)(
    lambda t: C.backfilled_cost_reports(
        t["_usage"], C.backfill_days(t["_usage"].sparkSession, "5-1-1998", "20-3-1998", D(1998, 6, 1))
    ).select(
        "account_id", "load_day", "current_period_cost", "previous_period_cost", F.get("top_services", F.lit(0))["service"].alias("dearest")
    )
)
query(
    "C3_cost_forecasts",
    "SELECT account_id, CAST(period_start AS VARCHAR) AS period_start, CAST(period_end AS VARCHAR) AS period_end, "
    "CAST(amount AS DOUBLE) AS amount FROM {_usage}",
)(lambda t: C.cost_forecasts(t["_usage"].withColumnRenamed("amount", "mean_value")))

_raw("_entitlements", "SELECT 3 * c_custkey AS account_id, 'prod-' || CAST(c_custkey % 9 AS STRING) AS ProductCode, "
     "'Users' AS Dimension FROM {customer}")  # fmt: skip
_MARKET = "service = 'AWS Marketplace' AND period_start >= DATE '1998-03-01' AND period_start < DATE '1998-09-30'"
query(
    "C19_marketplace_costs",
    f"""
    WITH totals AS (SELECT account_id, CAST(sum(amount) AS DOUBLE) AS c FROM {{_usage}} WHERE {_MARKET} GROUP BY ALL)
    SELECT e.account_id, ProductCode AS product_code, CAST(NULL AS VARCHAR) AS product_name, Dimension AS dimension,
      coalesce(c, 0) AS cost_consumed, 'USD' AS currency, '1998-03-01' AS period_start, '1998-09-30' AS period_end,
      'ACTIVE' AS status FROM {{_entitlements}} e LEFT JOIN totals USING (account_id)
    UNION ALL
    SELECT account_id, 'MARKETPLACE_USAGE', 'AWS Marketplace Products', 'Usage', c, 'USD', '1998-03-01',
      '1998-09-30', 'CONSUMED' FROM totals
    WHERE c > 0 AND account_id NOT IN (SELECT account_id FROM {{_entitlements}})
    """,
)(lambda t: C.marketplace_costs(t["_usage"], t["_entitlements"], D(1998, 3, 1), D(1998, 9, 30)))
query(
    "C19_marketplace_daily_costs",
    f"SELECT account_id, CAST(period_start AS VARCHAR) AS date, CAST(sum(amount) AS DOUBLE) AS cost FROM {{_usage}} "
    f"WHERE {_MARKET} GROUP BY ALL HAVING sum(amount) > 0",
)(lambda t: C.marketplace_daily_costs(t["_usage"], D(1998, 3, 1), D(1998, 9, 30)))

# C4 ------------------------------------------------------------------------
_raw(
    "_rules",
    """
    SELECT o_custkey AS account_id, 'rule-' || CAST(o_orderkey % 50 AS STRING) AS ConfigRuleName,
      CASE o_orderstatus WHEN 'F' THEN 'COMPLIANT' WHEN 'O' THEN 'NON_COMPLIANT' ELSE 'NOT_APPLICABLE' END
        AS ComplianceType FROM {orders}
    """,
)
_raw(
    "_evaluations",
    f"""
    SELECT o_custkey AS account_id, 'rule-' || CAST(o_orderkey % 50 AS STRING) AS ConfigRuleName,
      CASE WHEN (l_linenumber % 2 = 0) THEN 'COMPLIANT' ELSE 'NON_COMPLIANT' END AS ComplianceType,
      'res-' || CAST(l_partkey AS STRING) AS ResourceId, 'Bucket' AS ResourceType,
      {after("(DATE '1998-06-13' + CAST(l_linenumber AS INT))", "l_partkey % 24")} AS ResultRecordedTime,
      CAST(NULL AS STRING) AS Annotation, 'DETECTIVE' AS EvaluationMode
    FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
    """,
)
_raw(
    "_packs",
    """
    SELECT o_custkey + 3 AS account_id, 'rule-' || CAST(o_orderkey % 50 AS STRING) AS ConfigRuleName,
      'pack-' || CAST(o_orderkey % 4 AS STRING) AS ConformancePackName, o_orderkey AS position
    FROM {orders}
    """,
)
_DAY = "ResultRecordedTime BETWEEN TIMESTAMP '1998-06-15 00:00:00' AND TIMESTAMP '1998-06-15 23:59:59'"


def compliance(t):
    return C.config_compliance(t["_rules"], t["_evaluations"], t["_packs"], D(1998, 6, 15), D(1998, 6, 16))


query(
    "C4_config_compliance",
    f"""
    SELECT account_id, '1998-06-15' AS date_from, '1998-06-16' AS date_to,
      round_even(ok / (ok + bad) * 100, 2) AS compliance_score, ok + bad AS total_rules, ok AS compliant_rules,
      bad AS non_compliant_rules, bad_now AS curr_non_compliant, ok_now AS curr_compliant
    FROM (SELECT account_id, count(*) FILTER (ComplianceType = 'COMPLIANT') AS ok,
        count(*) FILTER (ComplianceType = 'NON_COMPLIANT') AS bad,
        count(*) FILTER (ComplianceType = 'COMPLIANT' AND now) AS ok_now,
        count(*) FILTER (ComplianceType = 'NON_COMPLIANT' AND now) AS bad_now
      FROM (SELECT r.*, (account_id, ConfigRuleName, ComplianceType) IN
              (SELECT (account_id, ConfigRuleName, ComplianceType) FROM {{_evaluations}} WHERE {_DAY}) AS now
            FROM {{_rules}} r WHERE ComplianceType <> 'NOT_APPLICABLE') GROUP BY account_id)
    """,
)(lambda t: compliance(t)[0])
query(
    "C4_evaluated_resources",
    f"""
    SELECT e.account_id, e.ConfigRuleName AS rule_name, ResourceId AS resource_id, ResourceType AS resource_type,
      ResultRecordedTime AS config_rule_invoked_time, coalesce(p.pack, 'Standalone') AS conformance_pack,
      ComplianceType AS compliance_type, Annotation AS annotation, EvaluationMode AS evaluation_mode
    FROM {{_evaluations}} e
    LEFT JOIN (SELECT account_id, ConfigRuleName, arg_max(ConformancePackName, position) AS pack FROM {{_packs}}
               GROUP BY ALL) p USING (account_id, ConfigRuleName)
    WHERE {_DAY} AND (account_id, ConfigRuleName, ComplianceType) IN
      (SELECT (account_id, ConfigRuleName, ComplianceType) FROM {{_rules}})
    """,
)(lambda t: compliance(t)[1])

# C5, C6 --------------------------------------------------------------------
_raw(
    "_patches",
    f"""
    SELECT l_partkey AS account_id, 'i-' || {S('l_partkey')} AS InstanceId, 'KB' || {S('l_suppkey')} AS Title,
      {pick('l_linenumber', 'Security', '', None)} AS Classification, {pick('l_suppkey', 'Critical', '', None)}
      AS Severity, 'Installed' AS State, {after('l_shipdate', 'l_suppkey % 24')} AS InstalledTime FROM {{lineitem}}
    """,
)
_PATCHES = f"""
    SELECT account_id, InstanceId AS instance_id, Title AS title,
      CASE WHEN Classification <> '' THEN Classification ELSE 'Normal' END AS classification,
      CASE WHEN Severity <> '' THEN Severity ELSE 'None' END AS severity, State AS state,
      InstalledTime AS installed_time FROM {{_patches}} WHERE InstalledTime {_IN}
"""
query("C5_patch_window", _PATCHES)(lambda t: C.patch_window(t["_patches"], START, END))
_raw(
    "_instances",
    "SELECT p_partkey AS account_id, "
    + _named(C.INSTANCE_FIELDS, InstanceId=f"'i-' || {S('p_partkey')}", PlatformName="p_type", PingStatus="'Online'",
             IsLatestVersion="p_size % 2 = 0", LastPingDateTime="TIMESTAMP '2024-01-01 00:00:00'")
    + ", p_size, p_name FROM {part}",
)


def inventory(t):
    entry = lambda i: F.struct(
        F.concat("p_name", F.lit(f" {i}")).alias("Name"),
        F.col("p_size").cast("string").alias("Version"),
        *[F.lit(None).cast("string").alias(c) for c in ("Publisher", "Architecture", "ApplicationType")],
        F.lit(None).cast("timestamp").alias("InstalledTime"),
    )
    apps = t["_instances"].withColumn("Entries", F.slice(F.array(entry(0), entry(1)), 1, F.col("p_size") % 3))
    return C.inventory_records(t["_instances"], apps, t["_patches"], START, END)


_SOME = "InstanceId PlatformName PingStatus IsLatestVersion LastPingDateTime"
query("C6_inventory_instances", f"SELECT account_id, {_renamed(C.INSTANCE_FIELDS, _SOME)} FROM {{_instances}}")(
    lambda t: _keep(inventory(t)[0], C.INSTANCE_FIELDS, _SOME)
)
query(
    "C6_inventory_applications",
    "SELECT account_id, InstanceId AS instance_id, concat(p_name, ' ', i) AS name, CAST(p_size AS VARCHAR) AS version "
    "FROM {_instances}, range(0, 2) r(i) WHERE i < p_size % 3",
)(lambda t: inventory(t)[1].select("account_id", "instance_id", "name", "version"))
query("C6_inventory_patches", _PATCHES)(lambda t: inventory(t)[2])

# C7 ------------------------------------------------------------------------
_raw(
    "_hub",
    f"""
    SELECT o_custkey AS account_id, 'f-' || {S('CAST(floor(o_orderkey / 2) AS BIGINT)')} AS Id,
      {pick('o_orderkey', 'Security Hub', 'Inspector', None)} AS ProductName,
      {pick('o_orderkey', 'CRITICAL', 'HIGH', 'MEDIUM', 'LOW', 'INFORMATIONAL')} AS label,
      {pick('o_custkey', 'NEW', 'RESOLVED', 'NOTIFIED', 'SUPPRESSED')} AS workflow,
      CASE WHEN o_orderkey % 10 = 9 THEN 'ARCHIVED' ELSE 'ACTIVE' END AS RecordState,
      'Title ' || {S('o_orderkey % 40')} AS Title, 'res-' || {S('o_orderkey % 90')} AS resource,
      CAST(o_orderdate AS TIMESTAMP) AS CreatedAt, {after('o_orderdate', 'o_orderkey % 900')} AS UpdatedAt,
      o_orderkey AS position FROM {{orders}}
    """,
)


def hub(t):
    return t["_hub"].select(
        "account_id",
        "Id",
        "ProductName",
        F.struct(F.col("label").alias("Label")).alias("Severity"),
        F.struct(F.col("workflow").alias("Status")).alias("Workflow"),
        "RecordState",
        "Title",
        F.array(F.struct(F.lit("Bucket").alias("Type"), F.col("resource").alias("Id"))).alias("Resources"),
        "CreatedAt",
        "UpdatedAt",
        "position",
    )


_raw(
    "_relevant",
    f"""
    SELECT * FROM {{_hub}}
    WHERE RecordState = 'ACTIVE' AND label IN ('CRITICAL', 'HIGH', 'MEDIUM', 'LOW')
      AND ((workflow = 'NEW' AND CreatedAt {_IN})
        OR (workflow IN ('RESOLVED', 'NOTIFIED', 'SUPPRESSED') AND UpdatedAt {_IN}))
    QUALIFY row_number() OVER (PARTITION BY Id ORDER BY (workflow <> 'NEW')::INT, position) = 1
    """,
)
query(
    "C7_finding_rollup",
    "SELECT account_id, coalesce(ProductName, '') AS service, count(*) AS total_findings, "
    + ", ".join(f"count(*) FILTER (label = '{s}') AS {s.lower()}_count" for s in C.COUNTED_SEVERITIES)
    + ", count(*) FILTER (workflow <> 'RESOLVED') AS open_findings, "
    "count(*) FILTER (workflow = 'RESOLVED') AS resolved_findings FROM {_relevant} GROUP BY ALL",
)(lambda t: C.finding_rollup(hub(t), START, END)[0])
query(
    "C7_finding_details",
    """
    SELECT account_id, coalesce(ProductName, '') AS product, Id AS finding_id, 'Bucket' AS service, Title AS title,
      label AS severity, workflow AS status, 'Bucket' AS resource_type, resource AS resource_id,
      CreatedAt AS created_at, UpdatedAt AS updated_at, RecordState AS record_state, ProductName AS product_name
    FROM {_relevant}
    """,
)(lambda t: C.finding_rollup(hub(t), START, END)[1])

# C8, C13, C14, C16, C18, C22 -----------------------------------------------
_raw(
    "_threats",
    "SELECT user_id AS account_id, "
    + _named(C.THREAT_FIELDS, Id=S("event_id"), Type="event_type", Severity="value", UpdatedAt="CAST(ts AS TIMESTAMP)")
    + " FROM {events}",
)
_T = "Id Type Severity UpdatedAt"
JAN = ("2024-01-10 00:00:00", "2024-01-20 12:00:00")
_JAN = f"BETWEEN TIMESTAMP '{JAN[0]}' AND TIMESTAMP '{JAN[1]}'"
query(
    "C8_threat_findings",
    f"SELECT account_id, {_renamed(C.THREAT_FIELDS, _T)} FROM {{_threats}} WHERE UpdatedAt {_JAN}",
)(lambda t: _keep(C.threat_findings(t["_threats"], *JAN), C.THREAT_FIELDS, _T))

_raw(
    "_secrets",
    "SELECT p_partkey AS account_id, "
    + _named(C.SECRET_FIELDS, Name="p_name", ARN=f"'s-' || {S('p_partkey')}", RotationEnabled="p_size % 2 = 0")
    + " FROM {part}",
)
query(
    "C13_secret_records",
    f"SELECT account_id, {_renamed(C.SECRET_FIELDS, 'Name ARN RotationEnabled')} FROM {{_secrets}}",
)(lambda t: _keep(C.secret_records(t["_secrets"]), C.SECRET_FIELDS, "Name ARN RotationEnabled"))
_raw(
    "_certificates",
    "SELECT p_partkey AS account_id, "
    + _named(C.CERTIFICATE_FIELDS, CertificateArn=f"'c-' || {S('p_partkey')}", Status="p_type",
             NotAfter="TIMESTAMP '2024-06-01 00:00:00'")
    + " FROM {part}",
)
query(
    "C13_certificate_records",
    f"SELECT account_id, {_renamed(C.CERTIFICATE_FIELDS, 'CertificateArn Status NotAfter')} FROM {{_certificates}}",
)(lambda t: _keep(C.certificate_records(t["_certificates"]), C.CERTIFICATE_FIELDS, "CertificateArn Status NotAfter"))
_raw(
    "_trails",
    f"""
    SELECT s_suppkey AS account_id, s_name AS Name, 't-' || {S('s_suppkey')} AS TrailARN,
      s_suppkey % 2 = 0 AS IsMultiRegionTrail, 'logs' AS S3BucketName, TRUE AS LogFileValidationEnabled FROM {{supplier}}
    """,
)
_raw(
    "_trail_status",
    f"SELECT 't-' || {S('s_suppkey + 4')} AS TrailARN, s_suppkey % 3 = 0 AS IsLogging, "
    "TIMESTAMP '2024-01-02 00:00:00' AS LatestDeliveryTime FROM {supplier}",
)
query(
    "C13_trail_records",
    f"""
    SELECT account_id, Name AS name, TrailARN AS arn, IsLogging AS is_logging, IsMultiRegionTrail AS is_multi_region,
      S3BucketName AS s3_bucket, LogFileValidationEnabled AS log_file_validation,
      least(5, (SELECT count(*) FROM {{events}} e WHERE e.user_id = account_id AND e.ts {_JAN})) AS recent_events_count,
      LatestDeliveryTime AS latest_delivery_time
    FROM {{_trails}} LEFT JOIN {{_trail_status}} USING (TrailARN)
    """,
)(
    lambda t: C.trail_records(
        t["_trails"],
        t["_trail_status"],
        t["events"].select(F.col("user_id").alias("account_id"), F.col("ts").cast("timestamp").alias("EventTime")),
        *JAN,
    )
)
_raw(
    "_vulnerabilities",
    "SELECT o_custkey AS account_id, "
    + _named(
        C.VULNERABILITY_FIELDS,
        findingArn=f"'v-' || {S('o_orderkey')}",
        severity="o_orderpriority",
        firstObservedAt="CAST(o_orderdate AS TIMESTAMP)",
        lastObservedAt=after("o_orderdate", "o_orderkey % 2000"),
        updatedAt=f"CASE WHEN o_orderkey % 3 = 0 THEN {after('o_orderdate', 'o_orderkey % 9000')} ELSE NULL END",
    )
    + " FROM {orders}",
)
_VUL = "findingArn severity firstObservedAt lastObservedAt updatedAt"
query(
    "C14_vulnerability_findings",
    f"SELECT account_id, {_renamed(C.VULNERABILITY_FIELDS, _VUL)} FROM {{_vulnerabilities}} "
    f"WHERE firstObservedAt {_IN} OR lastObservedAt {_IN} OR updatedAt {_IN}",
)(lambda t: _keep(C.vulnerability_findings(t["_vulnerabilities"], START, END), C.VULNERABILITY_FIELDS, _VUL))
_raw(
    "_services_seen",
    "SELECT user_id AS account_id, event_type AS ServiceName, 'ns' AS Namespace, props AS KeyAttributes, "
    "CAST(ts AS TIMESTAMP) AS SeenAt FROM {events}",
)
query(
    "C16_signal_services",
    "SELECT account_id, ServiceName AS service_name, Namespace AS namespace, KeyAttributes AS key_attributes "
    "FROM {_services_seen} WHERE SeenAt BETWEEN TIMESTAMP '2024-01-24 13:00:00' AND TIMESTAMP '2024-01-25 12:00:00'",
)(
    lambda t: C.signal_services(
        t["_services_seen"], dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 25), dt.datetime(2024, 1, 25, 12)
    )
)
_raw(
    "_health",
    "SELECT user_id AS account_id, "
    + _named(C.HEALTH_FIELDS, arn=S("event_id"), service="event_type", startTime="CAST(ts AS TIMESTAMP)")
    + " FROM {events}",
)
query(
    "C18_health_event_records",
    f"SELECT account_id, {_renamed(C.HEALTH_FIELDS, 'arn service startTime')} FROM {{_health}} WHERE startTime {_JAN}",
)(lambda t: _keep(C.health_event_records(t["_health"], *JAN), C.HEALTH_FIELDS, "arn service startTime"))
_raw(
    "_cases",
    "SELECT o_custkey AS account_id, "
    + _named(C.TICKET_FIELDS, caseId=S("o_orderkey"), status="o_orderstatus", timeCreated="CAST(o_orderdate AS TIMESTAMP)",
             language=pick("o_orderkey", "ja", None))
    + " FROM {orders}",
)
query(
    "C22_ticket_records",
    "SELECT account_id, caseId AS case_id, status, timeCreated AS time_created, coalesce(language, 'en') AS language, "
    f"'1998-03-01' AS date_from, '1998-09-30' AS date_to FROM {{_cases}} WHERE timeCreated {_IN}",
)(
    lambda t: _keep(
        C.ticket_records(t["_cases"], START, END),
        C.TICKET_FIELDS,
        "caseId status timeCreated language",
        "date_from",
        "date_to",
    )
)

# C9 - C12 ------------------------------------------------------------------
_raw(
    "_keys",
    f"""
    SELECT c_custkey AS account_id, 'k-' || {S('c_custkey')} AS KeyId, 'a-' || {S('c_custkey')} AS Arn,
      c_name AS Description, 'ENCRYPT_DECRYPT' AS KeyUsage, 'Enabled' AS KeyState,
      TIMESTAMP '2020-01-01 00:00:00' AS CreationDate, TRUE AS Enabled FROM {{customer}}
    """,
)
_raw(
    "_rotation",
    f"""
    SELECT 'k-' || {S('c_custkey + 7')} AS KeyId, c_custkey % 2 = 0 AS KeyRotationEnabled,
      {pick('c_custkey', None, None, 'AccessDeniedException', None, 'Throttled')} AS ErrorCode
    FROM {{customer}}
    """,
)
query(
    "C9_key_records",
    """
    SELECT account_id, KeyId AS key_id, Arn AS arn, Description AS description, KeyUsage AS key_usage,
      KeyState AS key_state, CreationDate AS creation_date, Enabled AS enabled,
      CASE WHEN ErrorCode IS NOT NULL THEN TRUE ELSE coalesce(KeyRotationEnabled, FALSE) END AS key_rotation_enabled
    FROM {_keys} LEFT JOIN {_rotation} USING (KeyId) WHERE coalesce(ErrorCode, '') <> 'Throttled'
    """,
)(lambda t: C.key_records(t["_keys"], t["_rotation"]))

# Each ACL has three rules whose kinds follow from its key: kind number (k + i) % 6.
_KINDS = (
    ("ManagedRuleGroupStatement", '{"ManagedRuleGroupStatement":{"VendorName":"AWS","Name":"SQLiRuleSet"}}'),
    ("ManagedRuleGroupStatement", '{"ManagedRuleGroupStatement":{"VendorName":"Other","Name":"XSSRules"}}'),
    ("RateBasedStatement", '{"RateBasedStatement":{"Limit":100}}'),
    ("GeoMatchStatement", '{"GeoMatchStatement":{"CountryCodes":["KP","RU"]}}'),
    ("IPSetReferenceStatement", '{"IPSetReferenceStatement":{"ARN":"set-1"}}'),
    ("NotStatement", '{"NotStatement":{"Statement":{"XssMatchStatement":{}}}}'),
)
_KIND = lambda i: f"(o_orderkey + {i}) % 6"


def acls(t):
    kinds = F.array(*[F.lit(text) for _, text in _KINDS])
    rule = lambda i: F.struct(
        F.lit(f"rule-{i}").alias("Name"),
        F.lit(i).alias("Priority"),
        F.get(kinds, ((F.col("o_orderkey") + i) % 6).cast("int")).alias("Statement"),
        (F.when((F.col("o_orderkey") + i) % 2 == 0, '{"Block":{}}') if i < 2 else F.lit("{}")).alias("Action"),
        (F.lit('{"Count":{}}') if i == 1 else F.lit(None).cast("string")).alias("OverrideAction"),
        F.struct(
            (F.col("o_orderkey") % 4 == i).alias("SampledRequestsEnabled"),
            (F.col("o_orderkey") % 5 == i).alias("CloudWatchMetricsEnabled"),
        ).alias("VisibilityConfig"),
    )
    return t["orders"].select(
        F.col("o_custkey").alias("account_id"),
        F.concat(F.lit("acl-"), F.col("o_orderkey").cast("string")).alias("Name"),
        F.col("o_orderkey").cast("string").alias("Id"),
        F.lit("arn").alias("ARN"),
        F.when(F.col("o_orderkey") % 2 == 0, "REGIONAL").otherwise("CLOUDFRONT").alias("Scope"),
        F.lit(None).cast("string").alias("Description"),
        F.lit('{"Allow":{}}').alias("DefaultAction"),
        F.lit(7).alias("Capacity"),
        F.array(F.lit("r1")).alias("ResourceArns"),
        (F.col("o_orderkey") % 3 == 0).alias("LoggingEnabled"),
        F.array(*[rule(i) for i in range(3)]).cast(C.RULE_TYPE).alias("Rules"),
    )


def _count_kind(*numbers: int) -> str:
    return " + ".join(f"(CASE WHEN {_KIND(i)} IN ({', '.join(map(str, numbers))}) THEN 1 ELSE 0 END)" for i in range(3))


query(
    "C10_acl_rollup",
    f"""
    SELECT o_custkey AS account_id, 'acl-' || CAST(o_orderkey AS VARCHAR) AS name, 3 AS rules_count,
      {_count_kind(0, 1)} AS managed_rules_count, {_count_kind(2)} AS rate_limit_rules_count,
      {_count_kind(3, 4, 5)} AS custom_rules_count, 1 AS associated_resources_count,
      o_orderkey % 3 = 0 AS logging_enabled, ({_count_kind(3)}) > 0 AS geo_blocking_enabled,
      CASE WHEN ({_count_kind(3)}) > 0 THEN 'KP,RU' ELSE '' END AS blocked_countries,
      CASE WHEN ({_count_kind(4)}) > 0 THEN 'set-1' ELSE '' END AS ip_sets,
      o_orderkey % 4 < 3 AS sampled_requests_enabled, o_orderkey % 5 < 3 AS cloudwatch_metrics_enabled
    FROM {{orders}}
    """,
)(
    lambda t: C.acl_rollup(acls(t)).select(
        "account_id",
        "name",
        "rules_count",
        "managed_rules_count",
        "rate_limit_rules_count",
        "custom_rules_count",
        "associated_resources_count",
        "logging_enabled",
        "geo_blocking_enabled",
        F.array_join("blocked_countries", ",").alias("blocked_countries"),
        F.array_join("ip_sets", ",").alias("ip_sets"),
        "sampled_requests_enabled",
        "cloudwatch_metrics_enabled",
    )
)
_RULE_ROWS = " UNION ALL ".join(
    f"SELECT *, {i} AS i, {_KIND(i)} AS kind, "
    + (f"CASE WHEN (o_orderkey + {i}) % 2 = 0 THEN '{{\"Block\":{{}}}}' END" if i < 2 else "NULL")
    + " AS act FROM {orders}"
    for i in range(3)
)
_TYPE_OF = "CASE kind " + " ".join(f"WHEN {n} THEN '{k}'" for n, (k, _) in enumerate(_KINDS)) + " END"
query(
    "C11_C12_acl_rules",
    f"""
    SELECT o_custkey AS account_id, 'acl-' || CAST(o_orderkey AS VARCHAR) AS web_acl_name,
      'rule-' || CAST(i AS VARCHAR) AS rule_name, i AS priority,
      coalesce(act, CASE WHEN i = 1 THEN '{{"Count":{{}}}}' ELSE '{{"None":{{}}}}' END) AS action,
      {_TYPE_OF} AS statement_type, kind < 2 AS is_managed_rule, kind >= 2 AS is_custom_rule, kind = 2 AS rate_limit,
      o_orderkey % 3 = 0 AS logging_enabled, kind = 3 AS geo_blocking, kind = 0 AS sql_injection,
      o_orderkey % 4 = i AS sample_request_enabled, o_orderkey % 5 = i AS cloudwatch_enabled,
      kind IN (1, 5) AS has_xss_protection, 'v2' AS waf_version, kind IN (0, 2, 3, 4) AS is_compliant,
      CASE WHEN o_orderkey % 2 = 0 THEN 'REGIONAL' ELSE 'CLOUDFRONT' END AS scope
    FROM ({_RULE_ROWS})
    """,
)(lambda t: C.acl_rules(acls(t)))

# C15, C17 ------------------------------------------------------------------
_raw(
    "_checks",
    f"""
    SELECT o_custkey AS account_id, 'check ' || {S('o_orderkey')} AS name, 'security' AS category,
      {pick('o_orderkey', 'warning', 'error', 'ok')} AS status, 'do it' AS description,
      o_totalprice AS estimatedMonthlySavings, o_orderkey % 4 AS flagged,
      CASE o_orderkey % 5 WHEN 0 THEN 'no time' WHEN 1 THEN '1998-05-01T00:00:00Z' WHEN 2 THEN NULL
        ELSE '2005-01-01T00:00:00Z' END AS timestamp FROM {{orders}}
    """,
)
query(
    "C15_advisor_checks",
    """
    SELECT account_id, name AS check_name, category, status AS severity, description AS recommendation,
      flagged AS affected_resources_count, estimatedMonthlySavings AS potential_savings,
      CASE WHEN timestamp LIKE '1998%' THEN TIMESTAMP '1998-05-01 00:00:00' END AS timestamp
    FROM {_checks} WHERE status <> 'ok' AND flagged > 0 AND (timestamp IS NULL OR timestamp NOT LIKE '2005%')
    """,
)(
    lambda t: C.advisor_checks(
        t["_checks"].withColumn(
            "flaggedResources", F.slice(F.array(*[F.lit(f"r{i}") for i in range(3)]), 1, F.col("flagged").cast("int"))
        ),
        START,
        END,
    )
)
_raw(
    "_apps",
    f"""
    SELECT c_custkey AS account_id, 'app-' || {S('c_custkey')} AS appArn, c_name AS name,
      {after("DATE '1998-01-01'", 'c_custkey * 5')} AS creationTime,
      CASE WHEN c_custkey % 4 = 0 THEN TIMESTAMP '1998-06-01 00:00:00' ELSE NULL END AS lastAssessmentTime,
      'PolicyMet' AS complianceStatus, c_custkey % 100 AS resiliencyScore, 'Active' AS status,
      'pol-' || {S('c_custkey % 6')} AS resiliencyPolicyArn FROM {{customer}}
    """,
)
_raw("_policies", f"SELECT 'pol-' || {S('n_nationkey + 2')} AS policyArn, 60 * n_nationkey AS rpoInSecs, "
     "90 * n_nationkey AS rtoInSecs FROM {nation}")  # fmt: skip
_raw(
    "_drills",
    f"SELECT 'app-' || {S('2 * o_custkey')} AS appArn, CAST(o_orderdate AS TIMESTAMP) AS creationTime, "
    "o_orderkey AS position FROM {orders}",
)
_raw("_app_costs", f"SELECT 'app-' || {S('3 * c_custkey')} AS appArn, c_acctbal AS cost FROM {{customer}}")
query(
    "C17_resilience_apps",
    f"""
    SELECT account_id, a.appArn AS app_arn, name, creationTime AS creation_time,
      lastAssessmentTime AS last_assessment_time, complianceStatus AS compliance_status,
      resiliencyScore AS resiliency_score, status, rpoInSecs AS rpo, rtoInSecs AS rto,
      (SELECT arg_min(d.creationTime, d.position) FROM {{_drills}} d WHERE d.appArn = a.appArn) AS last_drill, cost
    FROM {{_apps}} a LEFT JOIN {{_policies}} p ON p.policyArn = a.resiliencyPolicyArn
    LEFT JOIN {{_app_costs}} c ON c.appArn = a.appArn
    WHERE a.creationTime {_IN} OR lastAssessmentTime {_IN}
    """,
)(lambda t: C.resilience_apps(t["_apps"], t["_policies"], t["_drills"], t["_app_costs"], START, END))

# C20, C21 ------------------------------------------------------------------


def _saving(value):
    return F.struct(
        F.lit(12.5).alias("savingsOpportunityPercentage"),
        F.struct(value.alias("value")).alias("estimatedMonthlySavings"),
    ).alias("savingsOpportunity")


def optimizer(t):
    key, price = F.col("p_partkey"), F.col("p_retailprice")
    base = [key.alias("account_id"), F.col("p_type").alias("finding")]
    some = lambda *options: F.when(key % 3 != 0, F.array(*options))
    use = lambda name, top: F.struct(F.lit(name).alias("name"), top.cast("double").alias("maximum"))
    instances = t["part"].select(
        *base,
        F.concat(F.lit("i-"), key.cast("string")).alias("instanceArn"),
        F.col("p_name").alias("instanceName"),
        F.col("p_brand").alias("currentInstanceType"),
        some(
            F.struct(F.lit("m5").alias("instanceType"), F.lit(1.0).alias("performanceRisk"), _saving(price)),
            F.struct(F.lit("m6").alias("instanceType"), F.lit(2.0).alias("performanceRisk"), _saving(price * 2)),
        ).alias("recommendationOptions"),
        F.when(
            key % 2 == 0,
            F.array(use("Cpu", F.col("p_size")), use("Memory", F.col("p_size")), use("Memory", F.col("p_size") + 1)),
        )
        .otherwise(F.array().cast("array<struct<name: string, maximum: double>>"))
        .alias("utilizationMetrics"),
    )
    volumes = t["part"].select(
        *base,
        F.concat(F.lit("v-"), key.cast("string")).alias("volumeArn"),
        F.struct(F.lit("gp2").alias("volumeType"), F.col("p_size").alias("volumeSize")).alias("currentConfiguration"),
        some(
            F.struct(
                F.struct(F.lit("gp3").alias("volumeType"), (F.col("p_size") + 1).alias("volumeSize")).alias(
                    "configuration"
                ),
                F.lit(0.0).alias("performanceRisk"),
                _saving(price),
            )
        ).alias("volumeRecommendationOptions"),
    )
    functions = t["part"].select(
        *base,
        F.concat(F.lit("f-"), key.cast("string")).alias("functionArn"),
        F.col("p_name").alias("functionName"),
        F.lit(128).alias("currentMemorySize"),
        some(F.struct(F.lit(256).alias("memorySize"), _saving(price))).alias("memorySizeRecommendationOptions"),
    )
    return C.optimizer_records(instances, volumes, functions)


_OPTION = "p_partkey % 3 <> 0"
_OPT = lambda e: f"CASE WHEN {_OPTION} THEN {e} END"
query(
    "C20_optimizer_records",
    f"""
    SELECT CAST(p_partkey AS VARCHAR) AS account_id, 'EC2' AS resource_type, 'i-' || CAST(p_partkey AS VARCHAR)
        AS resource_arn, p_name AS resource_name, p_type AS finding, p_brand AS current_instance_type,
      {_OPT("'m5'")} AS recommended_instance_type, CAST(NULL AS BIGINT) AS current_volume_size,
      CAST(NULL AS BIGINT) AS recommended_volume_size, CAST(NULL AS BIGINT) AS recommended_memory_size,
      {_OPT('p_retailprice')} AS estimated_monthly_savings_usd, {_OPT('12.5::DOUBLE')} AS savings_opportunity_percentage,
      {_OPT('1.0::DOUBLE')} AS performance_risk,
      CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE 0 END::DOUBLE AS cpu_utilization_max,
      CASE WHEN p_partkey % 2 = 0 THEN p_size + 0.5 ELSE 0 END::DOUBLE AS memory_utilization_avg
    FROM {{part}} UNION ALL
    SELECT CAST(p_partkey AS VARCHAR), 'EBS', 'v-' || CAST(p_partkey AS VARCHAR), NULL, p_type, NULL, NULL, p_size,
      {_OPT('p_size + 1')}, NULL, {_OPT('p_retailprice')}, {_OPT('12.5')}, {_OPT('0.0')}, NULL, NULL FROM {{part}}
    UNION ALL
    SELECT CAST(p_partkey AS VARCHAR), 'Lambda', 'f-' || CAST(p_partkey AS VARCHAR), p_name, p_type, NULL, NULL, NULL,
      NULL, {_OPT('256')}, {_OPT('p_retailprice')}, {_OPT('12.5')}, NULL, NULL, NULL FROM {{part}}
    """,
)(
    lambda t: optimizer(t).select(
        "account_id",
        "resource_type",
        "resource_arn",
        "resource_name",
        "finding",
        "current_instance_type",
        "recommended_instance_type",
        "current_volume_size",
        "recommended_volume_size",
        "recommended_memory_size",
        "estimated_monthly_savings_usd",
        "savings_opportunity_percentage",
        "performance_risk",
        "cpu_utilization_max",
        "memory_utilization_avg",
    )
)


def resources(t):
    key = F.col("p_partkey")
    number = lambda head: F.concat(F.lit(head), key.cast("string"))
    tag = lambda k, v: F.struct(F.lit(k).alias("Key"), v.alias("Value"))
    tags = F.when(key % 2 == 0, F.array(tag("Env", F.lit("x")), tag("Name", F.col("p_name")))).otherwise(
        F.array(tag("Env", F.lit("x")))
    )
    part = t["part"].withColumns({"account_id": key, "region": F.lit("r1"), "Tags": tags})
    zones = F.array(F.lit("a"), F.lit("b"))
    return C.resource_records(
        {
            "instances": part.select(
                "account_id", "region", "Tags", number("i-").alias("InstanceId"),
                F.struct(F.lit("a").alias("AvailabilityZone")).alias("Placement"),
                F.struct(F.lit("running").alias("Name")).alias("State"), F.col("p_type").alias("InstanceType"),
                F.lit("vpc").alias("VpcId"),
            ),
            "databases": part.select(
                "account_id", "region", number("db-").alias("DBInstanceIdentifier"), F.lit("a").alias("AvailabilityZone"),
                F.lit("available").alias("DBInstanceStatus"), F.lit("pg").alias("Engine"),
                F.lit("db.m5").alias("DBInstanceClass"), (key % 2 == 0).alias("MultiAZ"),
            ),
            "volumes": part.select(
                "account_id", "region", "Tags", number("vol-").alias("VolumeId"), F.lit("b").alias("AvailabilityZone"),
                F.lit("in-use").alias("State"), F.when(key % 3 != 0, F.col("p_size")).alias("Size"),
                F.lit("gp3").alias("VolumeType"),
            ),
            "buckets": part.select(
                "account_id", "region", number("b-").alias("Name"),
                F.lit("2020-01-01 00:00:00").cast("timestamp").alias("CreationDate"),
            ),
            "load_balancers": part.select(
                "account_id", "region", number("lb-").alias("LoadBalancerName"),
                F.transform(zones, lambda z: F.struct(z.alias("ZoneName"))).alias("AvailabilityZones"),
                F.struct(F.lit("active").alias("Code")).alias("State"), F.lit("application").alias("Type"),
                F.lit("internal").alias("Scheme"),
            ),
            "scaling_groups": part.select(
                "account_id", "region", number("asg-").alias("AutoScalingGroupName"), zones.alias("AvailabilityZones"),
                F.slice(F.array(F.lit("x"), F.lit("y")), 1, (key % 3).cast("int")).alias("Instances"),
                F.lit(0).alias("MinSize"), F.lit(4).alias("MaxSize"),
            ),
            "subnets": part.select(
                "account_id", "region", "Tags", number("sn-").alias("SubnetId"), F.lit("a").alias("AvailabilityZone"),
                F.lit("available").alias("State"), F.col("p_size").alias("AvailableIpAddressCount"),
                F.lit("vpc").alias("VpcId"),
            ),
            "functions": part.select(
                "account_id", "region", number("fn-").alias("FunctionArn"), F.col("p_name").alias("FunctionName"),
                F.lit("Active").alias("State"), F.lit("python").alias("Runtime"), F.lit(None).cast("string").alias("VpcId"),
                F.when(key % 2 == 0, 3008).alias("MemorySize"),
                F.lit("2020-01-01 00:00:00").cast("timestamp").alias("LastModified"), F.lit("Zip").alias("PackageType"),
                F.array(F.lit("arm64")).alias("Architectures"), F.lit(None).cast("int").alias("EphemeralStorageSize"),
            ),
        }
    )


_NAME = "CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE '' END"
_RESOURCES = (
    ("EC2", "Instance", "i-", _NAME, "'a'", "'running'", "NULL", "NULL", "NULL"),
    ("RDS", "DBInstance", "db-", "'db-' || p", "'a'", "'available'", "NULL", "NULL", "p_partkey % 2 = 0"),
    ("EBS", "Volume", "vol-", _NAME, "'b'", "'in-use'", "CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_size END", "NULL", "NULL"),
    ("S3", "Bucket", "b-", "'b-' || p", "NULL", "'Active'", "NULL", "NULL", "NULL"),
    ("ELB", "LoadBalancer", "lb-", "'lb-' || p", "'a,b'", "'active'", "NULL", "NULL", "NULL"),
    ("AutoScaling", "AutoScalingGroup", "asg-", "'asg-' || p", "'a,b'",
     "CASE WHEN p_partkey % 3 > 0 THEN 'Active' ELSE 'Inactive' END", "NULL", "p_partkey % 3", "NULL"),
    ("VPC", "Subnet", "sn-", _NAME, "'a'", "'available'", "NULL", "NULL", "NULL"),
    ("Lambda", "Function", "fn-", "p_name", "'Generic'", "'Active'", "CASE WHEN p_partkey % 2 = 0 THEN 3 ELSE 0 END",
     "1", "TRUE"),
)
query(
    "C21_resource_records",
    " UNION ALL ".join(
        f"SELECT p AS account_id, '{svc}' AS service_name, '{kind}' AS resource_type, '{head}' || p AS resource_id, "
        f"{name} AS resource_name, {zone} AS availability_zone, {state} AS state, CAST({size} AS BIGINT) AS size_gb, "
        f"CAST({n} AS BIGINT) AS instance_count, CAST({multi} AS BOOLEAN) AS multi_az "
        "FROM (SELECT *, CAST(p_partkey AS VARCHAR) AS p FROM {part})"
        for svc, kind, head, name, zone, state, size, n, multi in _RESOURCES
    ),
)(
    lambda t: resources(t).select(
        "account_id",
        "service_name",
        "resource_type",
        "resource_id",
        "resource_name",
        "availability_zone",
        "state",
        "size_gb",
        "instance_count",
        "multi_az",
    )
)

# C23 -----------------------------------------------------------------------
_raw(
    "_utilisation",
    f"""
    SELECT {pick('o_custkey', 'Reserved Instance', 'Savings Plan')} AS reservation_type,
      's-' || {S('o_custkey')} AS commitment_key, CAST(o_orderdate AS DATE) AS period_start,
      o_orderkey % 3 AS UtilizationPercentage, o_totalprice AS OnDemandCost, CAST(1 AS DOUBLE) AS CommitmentCost,
      CAST(2 AS DOUBLE) AS NetSavings FROM {{orders}}
    """,
)


def commitments(t):
    number = F.concat(F.lit("s-"), F.col("c_custkey").cast("string"))
    charge = F.array(F.struct((F.col("c_custkey") % 10).cast("double").alias("Amount")))
    reservations = t["customer"].filter("c_custkey % 2 = 0").select(
        F.col("c_custkey").alias("account_id"), number.alias("ReservedInstancesId"), F.lit("m5").alias("InstanceType"),
        F.lit(2).alias("InstanceCount"), F.lit("Linux").alias("ProductDescription"),
        charge.alias("RecurringCharges"), F.lit(5.0).alias("FixedPrice"),
    )
    plans = t["customer"].filter("c_custkey % 2 = 1").select(
        F.col("c_custkey").alias("account_id"), F.concat(F.lit("plan-"), number).alias("savingsPlanId"),
        number.alias("savingsPlanArn"), F.lit("Compute").alias("savingsPlanType"), F.lit("7.5").alias("commitment"),
        F.lit(None).cast("string").alias("upfrontPaymentAmount"), F.lit("1").alias("recurringPaymentAmount"),
        F.lit("plan").alias("description"),
    )
    details = C.reservation_details(reservations).unionByName(C.plan_details(plans))
    return C.commitment_savings(details, t["_utilisation"], D(1998, 3, 1), D(1998, 9, 30))


query(
    "C23_commitment_savings",
    """
    SELECT c_custkey AS account_id,
      CASE WHEN c_custkey % 2 = 0 THEN 's-' ELSE 'plan-s-' END || CAST(c_custkey AS VARCHAR) AS subscription_id,
      CASE WHEN c_custkey % 2 = 0 THEN 'Reserved Instance' ELSE 'Savings Plan' END AS reservation_type,
      CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 10 * 730 ELSE 7.5 END::DOUBLE AS commitment,
      CASE WHEN c_custkey % 2 = 0 THEN 5 ELSE 0 END::DOUBLE AS upfront_cost,
      CASE WHEN c_custkey % 2 = 0 THEN '2x m5 Linux' ELSE 'plan' END AS description,
      CAST(u.period_start AS VARCHAR) AS date, coalesce(u.UtilizationPercentage, 0)::DOUBLE AS utilization_percentage,
      coalesce(u.OnDemandCost, 0)::DOUBLE AS on_demand_cost, coalesce(u.NetSavings, 0)::DOUBLE AS net_savings
    FROM {customer} LEFT JOIN (SELECT * FROM {_utilisation} WHERE period_start >= DATE '1998-03-01'
        AND period_start < DATE '1998-09-30'
        AND (reservation_type = 'Savings Plan' OR UtilizationPercentage > 0)) u
      ON u.commitment_key = 's-' || CAST(c_custkey AS VARCHAR)
    """,
)(
    lambda t: commitments(t).select(
        "account_id",
        "subscription_id",
        "reservation_type",
        "commitment",
        "upfront_cost",
        "description",
        "date",
        "utilization_percentage",
        "on_demand_cost",
        "net_savings",
    )
)

# Every line of every document is a log line; common words stand in for the severities.
_MATCH = "The|Der|La"


def log_lines(t):
    lines = t["documents"].select("doc_id", "source", F.explode(F.split("text", "\n", -1)).alias("message"))
    midnight = F.unix_micros(F.lit("2024-01-30 00:00:00").cast("timestamp"))
    return lines.select(
        (F.col("doc_id") % 50).alias("account_id"),
        F.col("source").alias("log_group_name"),
        "message",
        F.timestamp_micros(midnight + F.col("doc_id") % 1440 * F.lit(60_000_000)).alias("timestamp"),
    )


query(
    "C24_error_patterns",
    f"""
    WITH lines AS (SELECT doc_id % 50 AS account_id, source AS log_group_name,
        unnest(string_split(text, chr(10))) AS message,
        TIMESTAMP '2024-01-30 00:00:00' + CAST(doc_id % 1440 AS INT) * INTERVAL 1 MINUTE AS timestamp
      FROM {{documents}}),
    hits AS (SELECT *, regexp_extract(message, '((?:{_MATCH}).*)', 1) AS pattern FROM lines
      WHERE regexp_matches(message, '(?i)(?:{_MATCH})')
        AND timestamp BETWEEN TIMESTAMP '2024-01-30 00:00:00' AND TIMESTAMP '2024-01-30 20:00:00'),
    counted AS (SELECT account_id, log_group_name, CASE WHEN pattern = '' THEN 'Unknown error pattern' ELSE pattern END
        AS error_pattern, count(*) AS occurrence_count, min(timestamp) AS first_occurrence,
        max(timestamp) AS last_occurrence FROM hits GROUP BY ALL),
    grouped AS (SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY account_id, log_group_name
      ORDER BY occurrence_count DESC, error_pattern) <= 50)
    SELECT *, '2024-01-30' AS collection_date FROM grouped QUALIFY row_number() OVER (PARTITION BY account_id
      ORDER BY occurrence_count DESC, log_group_name, error_pattern) <= 50
    """,
)(
    lambda t: C.error_patterns(
        log_lines(t), "2024-01-30 00:00:00", "2024-01-30 20:00:00", D(2024, 1, 30), match=_MATCH
    )
)

# C25 -----------------------------------------------------------------------
NOON = "2024-01-25 12:00:00"
_DAY_BACK = f"BETWEEN TIMESTAMP '{NOON}' - INTERVAL 24 HOUR AND TIMESTAMP '{NOON}'"


def raw_alarms(t):
    dim = lambda n, v: F.struct(F.lit(n).alias("Name"), F.concat(F.lit(v), F.col("user_id").cast("string")).alias("Value"))
    shape = F.col("event_id") % 5
    dims = (
        F.when(shape == 0, F.array(dim("InstanceId", "i"), dim("Zone", "z")))
        .when(shape == 1, F.array(dim("Zone", "z"), dim("Rack", "k")))
        .when(shape == 2, F.array(dim("Zone", "z"), dim("BucketName", "b")))
        .when(shape == 3, F.array(dim("LoadBalancer", "l")))
        .otherwise(F.array().cast("array<struct<Name: string, Value: string>>"))
    )
    return t["events"].select(
        F.col("user_id").alias("account_id"),
        F.lit("r1").alias("region"),
        F.concat(F.lit("arn"), F.col("event_id").cast("string")).alias("AlarmArn"),
        F.col("event_type").alias("AlarmName"),
        F.lit("ALARM").alias("StateValue"),
        F.lit(None).cast("string").alias("StateReason"),
        F.col("ts").cast("timestamp").alias("StateUpdatedTimestamp"),
        F.lit("m").alias("MetricName"),
        F.lit(None).cast("string").alias("Namespace"),
        F.col("value").alias("Threshold"),
        F.lit("GreaterThanThreshold").alias("ComparisonOperator"),
        F.lit(2).alias("EvaluationPeriods"),
        dims.alias("Dimensions"),
    )


query(
    "C25_alarm_records",
    """
    SELECT user_id AS account_id, 'arn' || CAST(event_id AS VARCHAR) AS alarm_arn, event_type AS alarm_name,
      'ALARM' AS state, '' AS state_reason, ts AS state_updated_at, CASE WHEN kind = 0 THEN 'm' END AS metric_name,
      CASE WHEN kind = 0 THEN '' END AS namespace, CASE WHEN kind = 0 THEN value END AS threshold,
      CASE WHEN kind = 0 THEN 'GreaterThanThreshold' END AS comparison_operator,
      CASE WHEN kind = 0 THEN 2 END AS evaluation_periods,
      CASE WHEN kind = 0 THEN CASE event_id % 5 WHEN 0 THEN 'arn:aws:ec2:r1::instance/i' || CAST(user_id AS VARCHAR)
        WHEN 1 THEN 'z' || CAST(user_id AS VARCHAR) WHEN 2 THEN 'arn:aws:s3:::b' || CAST(user_id AS VARCHAR)
        WHEN 3 THEN 'arn:aws:elasticloadbalancing:r1::loadbalancer/l' || CAST(user_id AS VARCHAR) END END
        AS resource_arn
    FROM {events}, range(0, 2) r(kind) WHERE kind = 0 OR event_type = 'error'
    """,
)(
    lambda t: C.alarm_records(
        raw_alarms(t),
        raw_alarms(t)
        .filter(F.col("AlarmName") == "error")
        .select("account_id", "AlarmArn", "AlarmName", "StateValue", "StateReason", "StateUpdatedTimestamp"),
    )
)


def raw_history(t):
    kind = F.col("event_id") % 3
    data = (
        F.when(kind == 0, '{"oldState":{"stateValue":"OK"},"newState":{"stateValue":"ALARM","stateReason":"why"}}')
        .when(kind == 1, '{"newState":{"stateValue":"OK"}}')
        .otherwise("not json")
    )
    return t["events"].select(
        F.col("user_id").alias("account_id"),
        F.col("event_type").alias("AlarmName"),
        data.alias("HistoryData"),
        F.concat(F.lit("summary "), F.col("event_id").cast("string")).alias("HistorySummary"),
        F.col("ts").cast("timestamp").alias("Timestamp"),
    )


query(
    "C25_alarm_history_records",
    f"""
    SELECT user_id AS account_id, event_type AS alarm_name, CASE WHEN event_id % 3 = 0 THEN 'OK' ELSE '' END
      AS previous_state, CASE event_id % 3 WHEN 0 THEN 'ALARM' WHEN 1 THEN 'OK' ELSE '' END AS new_state,
      CASE WHEN event_id % 3 = 0 THEN 'why' ELSE 'summary ' || CAST(event_id AS VARCHAR) END AS reason,
      ts AS transition_time FROM {{events}} WHERE ts {_DAY_BACK}
    """,
)(lambda t: C.alarm_history_records(raw_history(t), NOON))

# C26 -----------------------------------------------------------------------
_raw(
    "_runs",
    f"""
    SELECT user_id % 20 AS account_id, 'probe-' || {S('user_id')} AS Name,
      CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'PASSED' ELSE event_type END AS State,
      CASE WHEN event_type = 'error' THEN 'timeout' ELSE '' END AS StateReason, CAST(ts AS TIMESTAMP) AS Started,
      {after('ts', 'floor(value)', 'SECOND')} AS Completed FROM {{events}}
    """,
)
_raw(
    "_probes",
    f"""
    SELECT c_custkey % 20 AS account_id, 'probe-' || {S('c_custkey')} AS Name,
      {pick('c_custkey', 'RUNNING', 'STOPPED', None)} AS State, '' AS StateReason,
      TIMESTAMP '2023-12-31 00:00:00' AS LastStarted FROM {{customer}}
    """,
)
query(
    "C26_canary_records",
    f"""
    SELECT p.account_id, p.Name AS canary_name,
      CASE WHEN n IS NULL THEN 'NOT_RUNNING' ELSE coalesce(State, 'UNKNOWN') END AS status,
      CAST(NULL AS VARCHAR) AS endpoint_url, round_even(passed / n * 100, 1) AS success_percentage,
      CAST(NULL AS VARCHAR) AS failure_reason, coalesce(latest, LastStarted) AS last_run_at
    FROM {{_probes}} p LEFT JOIN (SELECT account_id, Name, count(*) AS n, count(*) FILTER (State = 'PASSED') AS passed,
        max(Started) AS latest FROM {{_runs}} WHERE Started {_DAY_BACK} GROUP BY ALL) r USING (account_id, Name)
    """,
)(lambda t: C.canary_records(t["_probes"], t["_runs"], NOON))
query(
    "C26_canary_run_records",
    f"""
    SELECT account_id, Name AS canary_name, CASE WHEN State = 'PASSED' THEN 'PASSED' ELSE 'FAILED' END AS run_status,
      1000 * date_diff('second', Started, Completed) AS duration_ms, CAST(NULL AS BIGINT) AS response_time_ms,
      nullif(StateReason, '') AS failure_reason, Started AS run_at FROM {{_runs}} WHERE Started {_DAY_BACK}
    """,
)(lambda t: C.canary_run_records(t["_runs"], NOON))

# C27 -----------------------------------------------------------------------
_raw(
    "_databases",
    f"SELECT c_custkey % 30 AS account_id, 'db-' || {S('c_custkey')} AS DBInstanceIdentifier, "
    f"'arn-' || {S('c_custkey')} AS DBInstanceArn, c_custkey % 2 = 0 AS PerformanceInsightsEnabled FROM {{customer}}",
)
_raw(
    "_points",
    f"""
    SELECT user_id % 30 AS account_id, 'db-' || {S('user_id')} AS instance_identifier,
      CASE WHEN event_type IN ('click', 'view') THEN 'insights' ELSE 'metrics' END AS source,
      CASE event_type WHEN 'click' THEN 'os.cpuUtilization.total.avg' WHEN 'view' THEN 'db.load.avg'
        WHEN 'error' THEN 'CPUUtilization' WHEN 'signup' THEN 'FreeableMemory' ELSE 'DatabaseConnections' END AS metric,
      CAST(ts AS TIMESTAMP) AS timestamp,
      CASE WHEN event_type = 'signup' THEN value * 1048576 ELSE value END AS value FROM {{events}}
    """,
)
_raw(
    "_top_items",
    f"""
    SELECT user_id % 30 AS account_id, 'db-' || {S('user_id')} AS instance_identifier,
      {pick('event_id', 'wait_event', 'sql')} AS kind, event_id AS position, 'item ' || {S('event_id')} AS name
    FROM {{events}}
    """,
)
_LATEST = lambda m: (
    f"(SELECT arg_max(x.value, x.timestamp) FROM {{_points}} x WHERE x.account_id = d.account_id "
    f"AND x.instance_identifier = d.DBInstanceIdentifier AND x.metric = '{m}' AND x.timestamp {_DAY_BACK})"
)
_TOP = lambda k: (
    f"CASE WHEN PerformanceInsightsEnabled THEN (SELECT arg_min(x.name, x.position) FROM {{_top_items}} x "
    f"WHERE x.account_id = d.account_id AND x.instance_identifier = d.DBInstanceIdentifier AND x.kind = '{k}') END"
)
query(
    "C27_db_insight_records",
    f"""
    SELECT account_id, DBInstanceIdentifier AS instance_identifier, DBInstanceArn AS instance_arn,
      PerformanceInsightsEnabled AS insights_enabled,
      CASE WHEN PerformanceInsightsEnabled THEN 'INSIGHTS_ENABLED' ELSE 'INSIGHTS_DISABLED' END AS status,
      CASE WHEN PerformanceInsightsEnabled THEN {_LATEST('os.cpuUtilization.total.avg')}
        ELSE {_LATEST('CPUUtilization')} END AS cpu_utilization,
      CASE WHEN PerformanceInsightsEnabled THEN {_LATEST('db.load.avg')} END AS active_sessions,
      {_TOP('wait_event')} AS top_wait_event, {_TOP('sql')} AS top_sql_query,
      round_even({_LATEST('FreeableMemory')} / 1048576, 2) AS freeable_memory_mb,
      CAST(floor({_LATEST('DatabaseConnections')}) AS BIGINT) AS database_connections,
      TIMESTAMP '{NOON}' AS collection_timestamp
    FROM {{_databases}} d
    """,
)(lambda t: C.db_insight_records(t["_databases"], t["_points"], t["_top_items"], NOON))
query(
    "C27_db_event_records",
    f"""
    SELECT user_id % 30 AS account_id, 'db-instance' AS source_type, 'db-' || CAST(user_id AS VARCHAR)
      AS source_identifier, 'a,' || event_type AS event_category, props AS message, ts AS event_time
    FROM {{events}} WHERE ts {_DAY_BACK} AND user_id IN (SELECT c_custkey FROM {{customer}})
    """,
)(
    lambda t: C.db_event_records(
        t["events"].select(
            (F.col("user_id") % 30).alias("account_id"),
            F.concat(F.lit("db-"), F.col("user_id").cast("string")).alias("SourceIdentifier"),
            F.lit(None).cast("string").alias("SourceType"),
            F.array(F.lit("a"), F.col("event_type")).alias("EventCategories"),
            F.col("props").alias("Message"),
            F.col("ts").cast("timestamp").alias("Date"),
        ),
        t["_databases"],
        NOON,
    )
)

# C28 -----------------------------------------------------------------------
query(
    "C28_backfill_days",
    """
    SELECT CAST(CAST(ts AS DATE) + 1 AS VARCHAR) AS load_day, event_type, count(*) AS n FROM {events}
    WHERE CAST(ts AS DATE) + 1 BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY ALL
    """,
)(
    lambda t: C.backfill(t["events"], "ts", D(2024, 1, 5), D(2024, 1, 20))
    .groupBy("load_day", "event_type")
    .agg(F.count(F.lit(1)).alias("n"))
)
