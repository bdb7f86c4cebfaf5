"""Projection of the supplied tables into the base tables.

Each base table is one SELECT in the SQL subset that Spark and other ANSI
engines share.  Spark evaluates it to feed the operators; the check queries use
the very same text as a common table expression.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from fleetlens.schemas import TABLES, sql_type
from fleetlens.session import configure

AS_OF = "2024-01-31 00:00:00"

SOURCES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_REF = re.compile(r"\{(\w+)\}")


@dataclass
class Model:
    """Named SELECT texts; ``{name}`` refers to a source table or another text."""

    texts: dict[str, str] = field(default_factory=dict)

    def raw(self, name: str, text: str) -> None:
        self.texts[name] = " ".join(text.split())

    def table(self, name: str, source: str, /, **columns: str) -> None:
        """A base table: given expressions cast to the catalog type, the rest null."""
        spec = TABLES[name].columns
        unknown = set(columns) - set(spec)
        if unknown:
            raise ValueError(f"{name}: {sorted(unknown)}")
        items = [f"CAST({columns.get(c, 'NULL')} AS {sql_type(t)}) AS {c}" for c, t in spec.items()]
        self.raw(name, f"SELECT {', '.join(items)} FROM {source}")

    def references(self, text: str) -> list[str]:
        return [r for r in dict.fromkeys(_REF.findall(text)) if r in self.texts or r in SOURCES]

    def closure(self, text: str) -> list[str]:
        """Model names the text needs, dependencies first."""
        ordered: list[str] = []

        def visit(name: str) -> None:
            if name in SOURCES or name in ordered:
                return
            for dep in self.references(self.texts[name]):
                visit(dep)
            ordered.append(name)

        for ref in self.references(text):
            visit(ref)
        return ordered

    def oracle(self, text: str) -> str:
        """Standalone SQL: the needed projections as CTEs, then the text."""
        plain = lambda t: _REF.sub(
            lambda m: m.group(1) if m.group(1) in self.texts or m.group(1) in SOURCES else m.group(0), t
        )
        ctes = [f"{name} AS ({plain(self.texts[name])})" for name in self.closure(text)]
        body = plain(text).strip()
        if not ctes:
            return body
        if body.upper().startswith("WITH "):
            return f"WITH {', '.join(ctes)}, {body[5:]}"
        return f"WITH {', '.join(ctes)} {body}"


MODEL = Model()


class Lake:
    """Lazy base tables over one folder of supplied Parquet files."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._prefix = "fl_" + hashlib.sha1(self.sf_dir.encode()).hexdigest()[:8] + "_"
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in SOURCES:
                df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                df = self.sql(MODEL.texts[name])
            df.createOrReplaceTempView(self._prefix + name)
            self._known[name] = df
        return self._known[name]

    def sql(self, text: str) -> DataFrame:
        def view(match: re.Match) -> str:
            name = match.group(1)
            if name not in MODEL.texts and name not in SOURCES:
                return match.group(0)
            self[name]
            return self._prefix + name

        return self.spark.sql(_REF.sub(view, text))


class _Tables(dict):
    """Mapping that reads base tables on first use."""

    def __init__(self, lake: Lake):
        super().__init__()
        self.sf_dir = lake.sf_dir
        self._lake = lake

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._lake[name]
        return self[name]


_LAKES: dict[tuple[str, str], dict[str, DataFrame]] = {}


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Base tables over ``sf_dir``; their plans are analysed once per session."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _LAKES:
        _LAKES[key] = _Tables(Lake(spark, sf_dir))
    return _LAKES[key]


# ---------------------------------------------------------------------------
# Base tables
# ---------------------------------------------------------------------------
_t = MODEL.table
S = lambda expr: f"CAST({expr} AS STRING)"


def padded(expr: str) -> str:
    return f"lpad(CAST({expr} AS STRING), 12, '0')"


def after(start: str, amount: str, unit: str = "HOUR") -> str:
    return f"CAST({start} AS TIMESTAMP) + CAST({amount} AS INT) * INTERVAL '1' {unit}"


def pick(expr: str, *labels: str | None) -> str:
    """Label by ``expr`` modulo the number of labels."""
    lit = lambda v: "NULL" if v is None else f"'{v}'"
    n = len(labels)
    whens = " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(labels))
    return f"CASE ({expr}) % {n} {whens} END"


NATION_OF = "{customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"
# every tenth customer shares the account number of its neighbour, in another region
ACCOUNT_OF = "CASE WHEN c_custkey % 10 = 1 THEN c_custkey - 1 ELSE c_custkey END"

_t(
    "accounts",
    NATION_OF,
    id="c_custkey",
    account_id=padded(ACCOUNT_OF),
    account_name="CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE c_name END",
    account_email=f"'ops' || {S('c_custkey')} || '@example.com'",
    account_status="CASE WHEN c_acctbal < 0 THEN 'SUSPENDED' ELSE 'ACTIVE' END",
    account_arn=f"'arn:aws:organizations::' || {padded(ACCOUNT_OF)} || ':account'",
    partner_name="r_name",
    customer_name="n_name",
    joined_method=pick("c_custkey", "CREATED", "INVITED"),
    joined_timestamp=after("(DATE '2015-01-01' + CAST(c_custkey % 2000 AS INT))", "c_custkey % 24"),
    account_type=pick("c_custkey", "PRODUCTION", "STAGING", "DEVELOPMENT"),
    csp="'AWS'",
    region="CASE WHEN c_custkey % 10 = 1 THEN 'us-east-1' ELSE 'ap-southeast-1' END",
    category="c_mktsegment",
    created_at="TIMESTAMP '2023-06-01 00:00:00'",
)
_t(
    "products",
    "(SELECT n_nationkey AS k, n_name AS name FROM {nation} UNION ALL "
    "SELECT 100 + r_regionkey AS k, 'Platform ' || r_name AS name FROM {region})",
    id="k",
    name="name",
    owner=pick("k", "System", "Team A", "Team B"),
    position=pick("k", "Lead", None),
    description="'Runs ' || name",
)
_t(
    "product_accounts",
    "(SELECT 2 * c_custkey AS k, c_nationkey AS p, c_custkey + 7 AS a FROM {customer} "
    "UNION ALL SELECT 2 * c_custkey + 1 AS k, (c_nationkey + 1) % 25 AS p, 5 * c_custkey AS a FROM {customer})",
    id="k",
    product_id="p",
    account_id="a",
)
_t(
    "contact_info",
    "{customer}",
    id="c_custkey",
    account_id="c_custkey + 5",
    address_line1=f"{S('c_custkey')} || ' Main Street'",
    city=pick("c_custkey", "Springfield", "Rivertown", None),
    country_code=pick("c_custkey", "SG", "US"),
    postal_code=f"lpad({S('c_custkey % 10000')}, 5, '0')",
    company_name="c_name",
    phone_number=f"'+1-555-' || lpad({S('c_custkey % 10000')}, 4, '0')",
    full_name="'Owner of ' || c_name",
)
_t(
    "alternate_contacts",
    "(SELECT 3 * c_custkey AS k, c_custkey, 'billing' AS kind FROM {customer} UNION ALL "
    "SELECT 3 * c_custkey + 1 AS k, 2 * c_custkey, 'operations' AS kind FROM {customer} UNION ALL "
    "SELECT 3 * c_custkey + 2 AS k, 3 * c_custkey, 'security' AS kind FROM {customer})",
    id="k",
    account_id="c_custkey",
    contact_type="kind",
    full_name="kind || ' contact'",
    title="'Manager'",
    email=f"kind || {S('c_custkey')} || '@example.com'",
)
LINE_ID = "((l_orderkey * 8 + l_linenumber) * 100003 + l_partkey) * 1009 + l_suppkey"
_t(
    "services",
    "{lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey",
    id=LINE_ID,
    account_id="o_custkey",
    service="p_brand",
    date_from="l_shipdate",
    date_to="CAST(l_shipdate AS DATE) + 1",
    cost="CAST(l_extendedprice AS DECIMAL(12,2))",
    currency="'USD'",
    usage_types="'Aggregated'",
)
# Amounts in whole cents keep every engine exact.
CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
MODEL.raw(
    "_spend",
    f"""
    SELECT o_custkey, 'MONTHLY' AS granularity, CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start,
      CAST(last_day(CAST(o_orderdate AS DATE)) AS DATE) AS period_end, CAST(sum({CENTS}) AS BIGINT) AS cents,
      2 * (o_custkey * 1000 + (max(year(o_orderdate)) - 1995) * 12 + max(month(o_orderdate))) AS k
    FROM {{orders}}
    GROUP BY o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE),
      CAST(last_day(CAST(o_orderdate AS DATE)) AS DATE)
    UNION ALL
    SELECT o_custkey, 'DAILY' AS granularity, CAST(o_orderdate AS DATE) AS period_start,
      CAST(o_orderdate AS DATE) + 1 AS period_end, CAST(sum({CENTS}) AS BIGINT) AS cents,
      2 * (o_custkey * 10000 + (max(year(o_orderdate)) - 1995) * 372 + max(month(o_orderdate)) * 31
        + max(day(o_orderdate))) + 1 AS k
    FROM {{orders}} GROUP BY o_custkey, CAST(o_orderdate AS DATE)
    """,
)
MODEL.raw(
    "_spend_change",
    """
    SELECT *, coalesce(lag(cents) OVER (PARTITION BY o_custkey, granularity ORDER BY period_start), 0) AS previous
    FROM {_spend}
    """,
)
MONEY = lambda cents: f"CAST({cents} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2))"
_t(
    "cost_reports",
    "{_spend_change}",
    id="k",
    account_id="o_custkey",
    current_period_cost=MONEY("cents"),
    previous_period_cost=MONEY("previous"),
    cost_difference=MONEY("(cents - previous)"),
    cost_difference_percentage="CASE WHEN previous > 0 THEN "
    + MONEY("floor(CAST((cents - previous) * 10000 AS DOUBLE) / CAST(previous AS DOUBLE))")
    + " ELSE 0 END",
    potential_monthly_savings=MONEY("(cents % 1000)"),
    anomalies_detected="0",
    saving_opportunities_count="0",
    period_start="period_start",
    period_end="period_end",
    period_granularity="granularity",
    region="'Global'",
)
MONTH_REPORT = "2 * (o_custkey * 1000 + (year(o_orderdate) - 1995) * 12 + month(o_orderdate))"
_t(
    "service_costs",
    "{orders}",
    id="o_orderkey",
    cost_report_id=MONTH_REPORT,
    service_name=f"'Service ' || {S('o_orderkey % 7')}",
    cost="CAST(o_totalprice AS DECIMAL(12,2))",
    region="'Global'",
)
_t(
    "cost_forecasts",
    "{orders}",
    id="o_orderkey",
    cost_report_id=f"{MONTH_REPORT} + 2 * (o_orderkey % 2)",
    period_start="CAST(o_orderdate AS DATE) + 1",
    period_end="CAST(o_orderdate AS DATE) + 31",
    amount="CAST(o_totalprice AS DECIMAL(12,2))",
    region="'Global'",
)
SECURITY_ID = "o_custkey * 3 + CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END"
_t(
    "security",
    f"(SELECT {SECURITY_ID} AS k, o_custkey, o_orderstatus, count(*) AS n, "
    + ", ".join(
        f"sum(CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END) AS {c}"
        for p, c in (("1-URGENT", "crit"), ("2-HIGH", "high"), ("3-MEDIUM", "med"), ("5-LOW", "low"))
    )
    + " FROM {orders} GROUP BY o_custkey, o_orderstatus)",
    id="k",
    account_id="o_custkey + 5",
    service="CASE o_orderstatus WHEN 'F' THEN 'Security Hub' WHEN 'O' THEN 'GuardDuty' ELSE 'Inspector' END",
    total_findings="CASE WHEN o_custkey % 17 = 0 THEN 0 ELSE n END",
    critical_count="crit",
    high_count="high",
    medium_count="med",
    low_count="low",
    informational_count="n - crit - high - med - low",
    open_findings="n - CASE WHEN o_orderstatus = 'F' THEN n ELSE n % 3 END",
    resolved_findings="CASE WHEN o_orderstatus = 'F' THEN n ELSE n % 3 END",
    created_at=after("DATE '2023-01-01'", "k", "MINUTE"),
    updated_at=after("DATE '2023-02-01'", "k", "MINUTE"),
)
SEVERITY_OF = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL' WHEN '2-HIGH' THEN 'HIGH' WHEN '3-MEDIUM' THEN 'MEDIUM' "
    "WHEN '5-LOW' THEN 'LOW' ELSE 'INFORMATIONAL' END"
)
_t(
    "findings",
    "{orders}",
    id="o_orderkey",
    security_id=SECURITY_ID,
    finding_id=f"'finding-' || {S('o_orderkey')}",
    service=pick("o_orderkey", "Instance", "Bucket", "Role"),
    title=f"'Check ' || {S('o_orderkey % 40')}",
    severity=SEVERITY_OF,
    status="CASE o_orderstatus WHEN 'F' THEN 'RESOLVED' WHEN 'O' THEN 'ACTIVE' ELSE 'NOTIFIED' END",
    resource_type=pick("o_orderkey", "Instance", "Bucket", "Role"),
    resource_id=f"'res-' || {S('o_orderkey % 500')}",
    created_at="o_orderdate",
    updated_at=after("o_orderdate", "o_orderkey % 72"),
    region="'ap-southeast-1'",
    record_state="'ACTIVE'",
    product_name=pick("o_orderkey", "Security Hub", "Inspector", "Config"),
)
_t(
    "logs",
    "{orders}",
    id="o_orderkey",
    account_id="o_custkey",
    date_created=after("o_orderdate", "o_orderkey % 86400", "SECOND"),
    account_status=pick("o_orderkey", "Pass", "Pass", "Fail"),
    cost_status="'Pass'",
    service_status="'Pass'",
    security_status=pick("o_orderkey", "Pass", "Fail"),
)
_t(
    "log_messages",
    "{orders}",
    id="o_orderkey",
    log_id="o_orderkey - o_orderkey % 3",
    message=f"'step ' || {S('o_orderkey % 9')}",
    message_type=pick("o_orderkey", "INFO", "ERROR", "WARN"),
    created_at="o_orderdate",
)
_t(
    "config_reports",
    "{orders}",
    id="o_orderkey",
    account_id="o_custkey",
    date_from="o_orderdate",
    date_to="CAST(o_orderdate AS DATE) + 1",
    compliance_score="CAST(o_orderkey % 101 AS DECIMAL(5,2))",
    total_rules="100",
    compliant_rules="o_orderkey % 101",
    non_compliant_rules="100 - o_orderkey % 101",
)
_t(
    "non_compliant_resources",
    "{lineitem}",
    id=LINE_ID,
    config_report_id="l_orderkey",
    resource_type=pick("l_partkey", "Instance", "Volume", "Bucket"),
    resource_id=f"'res-' || {S('l_partkey')}",
    compliance_type="CASE WHEN l_returnflag = 'N' THEN 'COMPLIANT' ELSE 'NON_COMPLIANT' END",
    rule_name=f"'rule-' || {S('l_suppkey % 20')}",
    created_at="l_shipdate",
    status="'OPEN'",
)
_t(
    "service_resources",
    "{lineitem}",
    id=LINE_ID,
    account_id="l_partkey",
    service_name=pick("l_linenumber", "EC2", "RDS", "S3", "Lambda"),
    resource_type=pick("l_linenumber", "Instance", "DBInstance", "Bucket", "Function"),
    resource_id=f"'r-' || {S('l_orderkey')} || '-' || {S('l_linenumber')}",
    region=pick("l_suppkey", "ap-southeast-1", "us-east-1"),
    availability_zone=pick("l_suppkey", "a", "b", None),
    state="CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'running' WHEN 'AO' THEN 'available' "
    "WHEN 'NF' THEN 'STOPPED' WHEN 'NO' THEN 'Active' WHEN 'RF' THEN 'Inactive' ELSE NULL END",
    instance_count="CAST(l_quantity AS INT)",
    creation_date="l_shipdate",
)
_t(
    "compute_optimizer",
    "{lineitem}",
    id=LINE_ID,
    account_id="l_partkey",
    resource_type=pick("l_linenumber", "EC2", "EBS", "Lambda"),
    resource_arn=f"'arn:' || {S('l_orderkey')} || ':' || {S('l_linenumber')}",
    finding=pick("l_suppkey", "NotOptimized", "Optimized", "Underprovisioned"),
    savings_opportunity_percentage="CASE WHEN l_discount > 0.09 THEN NULL ELSE CAST(l_quantity AS INT) END",
    estimated_monthly_savings_usd="CASE WHEN l_tax > 0.07 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END",
    performance_risk="l_linenumber",
)
_t(
    "config_inventory",
    "{lineitem}",
    id=LINE_ID,
    account_id="l_suppkey",
    resource_type="'Instance'",
    resource_id=f"'ci-' || {S('l_orderkey')}",
    size_gb="CAST(l_quantity AS INT)",
)
_t(
    "guard_duty_findings",
    "{events}",
    id="event_id",
    account_id="user_id",
    detector_id=f"'det-' || {S('event_id')}",
    finding_type=pick("event_id", "Recon", "UnauthorizedAccess", "Backdoor"),
    severity="CAST(event_id % 90 AS DECIMAL(4,0)) * CAST(0.1 AS DECIMAL(2,1))",
    title="'Detector ' || event_type",
    region="'ap-southeast-1'",
    created_at="ts",
    updated_at=after("ts", "event_id % 48"),
)
_t(
    "kms_keys",
    "{customer}",
    id="c_custkey",
    account_id="c_custkey",
    key_id=f"'key-' || {S('c_custkey')}",
    key_state=pick("c_custkey", "Enabled", "Disabled", "PendingDeletion"),
    enabled="c_custkey % 3 = 0",
    key_rotation_enabled="c_custkey % 2 = 0",
)
_t(
    "waf_rules",
    "{customer}",
    id="c_custkey",
    account_id="c_custkey + 3",
    name=f"'acl-' || {S('c_custkey')}",
    waf_id=f"'waf-' || {S('c_custkey')}",
    scope=pick("c_custkey", "REGIONAL", "CLOUDFRONT"),
    rules_count="c_custkey % 9",
    geo_blocking_enabled="c_custkey % 4 = 0",
)
_t(
    "waf_rules_detailed",
    "{orders}",
    id="o_orderkey",
    account_id="o_custkey",
    web_acl_name=f"'acl-' || {S('o_custkey')}",
    rule_name=f"'rule-' || {S('o_orderkey')}",
    priority="o_orderkey % 10",
    statement_type=pick("o_orderkey", "RateBasedStatement", "GeoMatchStatement"),
    is_compliant="o_orderkey % 2 = 0",
)
_t(
    "cloudtrail_logs",
    "{supplier}",
    id="s_suppkey",
    account_id="s_suppkey",
    name="s_name",
    arn=f"'trail-' || {S('s_suppkey')}",
    is_logging="s_suppkey % 4 <> 0",
    is_multi_region="s_suppkey % 2 = 0",
)
_t(
    "secrets_manager_secrets",
    "{part}",
    id="p_partkey",
    account_id="p_partkey",
    name="p_name",
    arn=f"'secret-' || {S('p_partkey')}",
    rotation_enabled="p_size % 2 = 0",
)
_t(
    "certificates",
    "{part}",
    id="p_partkey",
    account_id="p_partkey",
    arn=f"'cert-' || {S('p_partkey')}",
    domain_name=f"'host' || {S('p_partkey')} || '.example.com'",
    status=pick("p_size", "ISSUED", "EXPIRED"),
    not_after=after("DATE '2024-02-01'", "p_size * 24"),
)
_t(
    "inspector_findings",
    "{orders}",
    id="o_orderkey",
    account_id="o_custkey",
    finding_arn=f"'vuln-' || {S('o_orderkey')}",
    severity=SEVERITY_OF,
    status="'ACTIVE'",
    title=f"'CVE-' || {S('o_orderkey % 300')}",
    first_observed_at="o_orderdate",
)
_t(
    "inventory_instances",
    "{part}",
    id="p_partkey",
    account_id="p_partkey - p_partkey % 4",
    instance_id=f"'i-' || {S('p_partkey')}",
    instance_type="p_type",
    platform=pick("p_partkey", "Linux", "Windows"),
    ping_status=pick("p_size", "Online", "ConnectionLost", "Online"),
    is_latest_version="p_size % 2 = 0",
    last_ping_date_time=after("DATE '2024-01-01'", "p_partkey % 500"),
)
_t(
    "inventory_applications",
    "{lineitem}",
    id=LINE_ID,
    account_id="l_partkey",
    instance_id="l_partkey - l_partkey % 2",
    name=f"'app-' || {S('l_suppkey')}",
    version=S("l_linenumber"),
)
_t(
    "inventory_patches",
    "{lineitem}",
    id=LINE_ID,
    account_id="l_partkey",
    instance_id="l_partkey",
    title=f"'KB' || {S('l_suppkey')}",
    classification="'Security'",
    severity=pick("l_suppkey", "Critical", "Important", "Moderate"),
    state=pick("l_linenumber", "Installed", "Missing", "Failed"),
    installed_time="l_shipdate",
)
_t(
    "marketplace_usage",
    "{orders}",
    id="o_orderkey",
    account_id="o_custkey",
    product_code=f"'prod-' || {S('o_orderkey % 30')}",
    cost_consumed="CAST(o_totalprice AS DECIMAL(12,2))",
    currency="'USD'",
    period_start="o_orderdate",
    period_end="CAST(o_orderdate AS DATE) + 1",
    status=pick("o_orderkey", "ACTIVE", "CONSUMED"),
)
_t(
    "trusted_advisor_checks",
    "{orders}",
    id="o_orderkey",
    account_id="o_custkey",
    check_name=f"'check-' || {S('o_orderkey % 60')}",
    category=pick("o_orderkey", "cost_optimizing", "security", "fault_tolerance"),
    severity=pick("o_orderkey", "warning", "error"),
    affected_resources_count="o_orderkey % 12",
    potential_savings="CAST(o_totalprice AS DECIMAL(12,2))",
    timestamp="o_orderdate",
)
_t(
    "health_events",
    "{events}",
    id="event_id",
    account_id="user_id",
    arn=f"'health-' || {S('event_id')}",
    service=pick("event_id", "EC2", "RDS", "S3"),
    event_type_code="event_type",
    start_time="ts",
    end_time=after("ts", "event_id % 10"),
    status_code=pick("event_id", "open", "closed", "upcoming"),
)
_t(
    "application_signals",
    "{customer}",
    id="c_custkey",
    account_id="c_custkey",
    service_name=f"'svc-' || {S('c_custkey')}",
    namespace="'default'",
    key_attributes="'[]'",
)
_t(
    "resilience_hub_apps",
    "{customer}",
    id="c_custkey",
    account_id="c_custkey",
    app_arn=f"'app-' || {S('c_custkey')}",
    name="c_name",
    compliance_status=pick("c_custkey", "PolicyMet", "PolicyBreached"),
    resiliency_score="c_custkey % 100",
    rpo="c_custkey % 3600",
    rto="c_custkey % 7200",
)
_t(
    "support_tickets",
    "{orders}",
    id="o_orderkey",
    account_id="o_custkey",
    case_id=f"'case-' || {S('o_orderkey')}",
    subject=f"'Request ' || {S('o_orderkey')}",
    status=pick("o_orderkey", "opened", "resolved", "pending"),
    severity_code=pick("o_orderkey", "low", "normal", "urgent"),
    time_created="o_orderdate",
    language="'en'",
    date_from="o_orderdate",
    date_to="CAST(o_orderdate AS DATE) + 1",
)
_t(
    "ri_sp_daily_savings",
    "{orders}",
    id="o_orderkey",
    account_id="o_custkey",
    date_from="o_orderdate",
    date_to="CAST(o_orderdate AS DATE) + 1",
    reservation_type=pick("o_orderkey", "Reserved Instance", "Savings Plan"),
    subscription_id=f"'sub-' || {S('o_orderkey % 200')}",
    utilization_percentage="o_orderkey % 101",
    net_savings="CAST(o_totalprice AS DECIMAL(12,2))",
)
NAMESPACE_OF = (
    "CASE event_type WHEN 'click' THEN 'AWS/EC2' WHEN 'error' THEN 'AWS/RDS' WHEN 'purchase' THEN 'AWS/Lambda' "
    "WHEN 'signup' THEN 'CWAgent' ELSE 'Custom/App' END"
)
METRIC_OF = (
    "CASE event_type WHEN 'click' THEN 'CPUUtilization' WHEN 'error' THEN 'FreeableMemory' WHEN 'purchase' "
    "THEN 'Duration' WHEN 'signup' THEN 'mem_used_percent' ELSE 'Latency' END"
)
STATE_OF = "CASE event_type WHEN 'error' THEN 'ALARM' WHEN 'signup' THEN 'INSUFFICIENT_DATA' ELSE 'OK' END"
_t(
    "alarms",
    "{events}",
    id="event_id",
    account_id="user_id * 3",
    alarm_arn=f"'arn:aws:cloudwatch:ap-southeast-1:' || {padded('user_id * 3')} || ':alarm:a' || {S('event_id')}",
    alarm_name=f"'a' || {S('event_id')}",
    state=STATE_OF,
    state_reason="'value ' || event_type",
    state_updated_at="ts",
    metric_name=METRIC_OF,
    namespace=NAMESPACE_OF,
    threshold="CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(value AS DECIMAL(12,2)) END",
    comparison_operator="'GreaterThanThreshold'",
    evaluation_periods="event_id % 5",
    severity=pick("event_id", "Critical", "High", "Medium", "Low"),
)
_t(
    "canaries",
    "{customer}",
    id="c_custkey",
    account_id="c_custkey - c_custkey % 3",
    canary_name=f"'probe-' || {S('c_custkey')}",
    status=pick("c_custkey", "RUNNING", "RUNNING", "RUNNING", "ERROR", "RUNNING", "NOT_RUNNING", "STOPPED"),
    endpoint_url=f"'https://host' || {S('c_custkey')} || '.example.com'",
    success_percentage="CASE WHEN c_custkey % 8 = 3 THEN NULL WHEN c_custkey % 4 = 1 THEN 97 ELSE 100 END",
    failure_reason=pick("c_custkey", None, "timeout", None),
    updated_at="TIMESTAMP '2024-01-30 00:00:00'",
)
_t(
    "canary_runs",
    "{events}",
    id="event_id",
    canary_id="user_id",
    run_status="CASE WHEN event_type IN ('error', 'view') THEN 'FAILED' ELSE 'PASSED' END",
    duration_ms="floor(value * 10)",
    failure_reason="CASE WHEN event_type = 'error' THEN 'timeout' ELSE NULL END",
    run_at="ts",
)
_t(
    "incidents",
    "{orders}",
    id="o_orderkey",
    account_id="o_custkey",
    incident_id=f"'inc-' || {S('o_orderkey')}",
    severity="CASE o_orderpriority WHEN '1-URGENT' THEN 'P1' WHEN '2-HIGH' THEN 'P2' WHEN '3-MEDIUM' THEN 'P3' "
    "ELSE 'P4' END",
    title=f"'Incident ' || {S('o_orderkey')}",
    affected_service=pick("o_orderkey", "checkout", "search", None),
    start_time="o_orderdate",
    status="CASE o_orderstatus WHEN 'F' THEN 'RESOLVED' WHEN 'O' THEN 'OPEN' ELSE 'INVESTIGATING' END",
)
_t(
    "error_summaries",
    "{lineitem} JOIN {orders} ON l_orderkey = o_orderkey",
    id=LINE_ID,
    account_id="o_custkey",
    log_group_name=f"'group-' || {S('l_suppkey % 20')}",
    error_pattern=f"'ERROR ' || {S('l_partkey % 50')}",
    occurrence_count="CAST(l_quantity AS INT)",
    first_occurrence="l_shipdate",
    last_occurrence="l_shipdate",
    collection_date="CASE WHEN l_linenumber <= 2 THEN DATE '2024-01-31' ELSE CAST(l_shipdate AS DATE) END",
)
_t(
    "db_insights",
    "{events}",
    id="event_id",
    account_id="user_id",
    instance_identifier=f"'db-' || {S('user_id')}",
    cpu_utilization="CAST(event_id % 100 AS DECIMAL(5,2))",
    insights_enabled="event_id % 2 = 0",
    collection_timestamp="ts",
)
_t(
    "db_events",
    "{events}",
    id="event_id",
    account_id="user_id",
    source_identifier=f"'db-' || {S('user_id')}",
    source_type="'db-instance'",
    event_category="event_type",
    event_time="ts",
)
_t(
    "alarm_history",
    "{events}",
    id="event_id",
    alarm_id="event_id",
    new_state=STATE_OF,
    transition_time="ts",
)
FIVE_MINUTES = "date_trunc('hour', ts) + CAST(floor(minute(ts) / 5) * 5 AS INT) * INTERVAL '1' MINUTE"
DIMENSIONS_OF = (
    "CASE WHEN event_id % 10 = 0 THEN '[]' ELSE '[{\"Name\":\"' || "
    "CASE event_type WHEN 'click' THEN 'InstanceId' WHEN 'error' THEN 'DBInstanceIdentifier' WHEN 'purchase' "
    "THEN 'FunctionName' WHEN 'signup' THEN 'path' ELSE 'Host' END || '\",\"Value\":\"r' || "
    f"{S('user_id % 40')} || '\"}}]' END"
)
_t(
    "cloudwatch_metrics",
    "{events}",
    id="event_id",
    collected_at=FIVE_MINUTES,
    account_id=padded("user_id"),
    region="'ap-southeast-1'",
    namespace=NAMESPACE_OF,
    metric_name=METRIC_OF,
    dimensions=DIMENSIONS_OF,
    resource_id=f"CASE WHEN event_id % 10 = 0 THEN '' ELSE 'r' || {S('user_id % 40')} END",
    statistic="'Average'",
    value="value",
    unit="event_type",
    dashboard_category="CASE event_type WHEN 'click' THEN 'capacity' WHEN 'error' THEN 'availability' "
    "WHEN 'purchase' THEN 'performance' ELSE NULL END",
)
_t(
    "alarm_states",
    "{events}",
    id="event_id",
    collected_at=FIVE_MINUTES,
    account_id=padded("user_id"),
    alarm_name=f"'a' || {S('user_id % 40')}",
    namespace=NAMESPACE_OF,
    metric_name=METRIC_OF,
    dimensions=DIMENSIONS_OF,
    resource_id=f"'r' || {S('user_id % 40')}",
    state=STATE_OF,
    state_reason="'value ' || event_type",
    state_updated_at="ts",
)
