"""Raw service responses, landed as tables, to the records a payload section holds.

Every job handles all accounts at once.  Inputs keep the vendor's field names.
Lists that may grow without bound (findings, histories, events) come out as
rows of their own and are never gathered into one value.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions.text import blank_to_null
from fleetlens.functions.timecalc import as_timestamp
from fleetlens.schemas import TABLES

INTERVALS = ("DAILY", "WEEKLY", "MONTHLY", "YEARLY")

# Fixed values.
ACTIVE_SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
COUNTED_SEVERITIES = (*ACTIVE_SEVERITIES, "INFORMATIONAL")
UPDATED_STATUSES = ("RESOLVED", "NOTIFIED", "SUPPRESSED")
MANAGED, RATE = "ManagedRuleGroupStatement", "RateBasedStatement"
COMPLIANT_STATEMENTS = (
    "RateBasedStatement",
    "ManagedRuleGroupStatement",
    "SqliMatchStatement",
    "XssMatchStatement",
    "GeoMatchStatement",
    "IPSetReferenceStatement",
    "RuleGroupReferenceStatement",
)
COMPLIANT_VENDORS = ("AWS", "Amazon")
HOURS_PER_MONTH = 730
TOP_SERVICES = 5
TOP_PATTERNS = 50
UNKNOWN_PATTERN = "Unknown error pattern"


def _text(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def inside(col: Column | str, start, end) -> Column:
    """Closed time range; null is outside."""
    value = F.col(col) if isinstance(col, str) else col
    return F.coalesce(value.between(as_timestamp(start), as_timestamp(end)), F.lit(False))


def any_inside(cols, start, end) -> Column:
    return reduce(lambda a, b: a | b, [inside(c, start, end) for c in cols])


# C1 ------------------------------------------------------------------------


def reporting_window(end: Column, interval: str) -> Column:
    """Struct (start, end, days) of the reporting interval that ``end`` lies in."""
    day = end.cast("date")
    if interval == "YEARLY":
        start, last = F.make_date(F.year(day), F.lit(1), F.lit(1)), F.make_date(F.year(day), F.lit(12), F.lit(31))
    elif interval == "MONTHLY":
        start, last = F.trunc(day, "month"), F.last_day(day)
    elif interval == "WEEKLY":
        start = F.date_trunc("week", day).cast("date")
        last = F.date_add(start, 6)
    elif interval == "DAILY":
        return F.struct(F.date_sub(day, 1).alias("start"), day.alias("end"), F.lit(1).alias("days"))
    else:
        raise ValueError(f"interval must be one of {INTERVALS}, not {interval!r}")
    return F.struct(start.alias("start"), last.alias("end"), (F.datediff(last, start) + 1).alias("days"))


def backfill_days(spark: SparkSession, start: str | None, end: str | None, today: dt.date) -> DataFrame:
    """One row per day to load; ``d-m-yyyy`` bounds, default 1 January to today."""

    def parse(text: str | None) -> dt.date | None:
        try:
            day, month, year = (int(x) for x in (text or "").split("-"))
            return dt.date(year, month, day)
        except ValueError:
            return None

    till = parse(end) or today
    since = parse(start) or dt.date(till.year, 1, 1)
    days = F.sequence(F.lit(since), F.lit(till)) if since <= till else F.array().cast("array<date>")
    return spark.range(1).select(F.explode(days).alias("day"))


def backfill(df: DataFrame, day_column: str, start: dt.date, end: dt.date) -> DataFrame:
    """Daily windows of a raw table in one pass, each row tagged with its load day.

    The day's window reaches from the day before to the day, so a row belongs to
    the following load day; a range filter replaces a loop over days.
    """
    load_day = F.date_add(F.col(day_column).cast("date"), 1)
    return df.withColumn("load_day", load_day).filter(F.col("load_day").between(F.lit(start), F.lit(end)))


# C2, C3 --------------------------------------------------------------------


#: Spark's names of the units that periods of an interval start with.
PERIOD_UNIT = {"DAILY": "day", "WEEKLY": "week", "MONTHLY": "month", "YEARLY": "year"}


def period_of(day: Column, interval: str) -> Column:
    """First day of the period that ``day`` lies in."""
    return F.date_trunc(PERIOD_UNIT[interval], day).cast("date")


def service_costs_by_period(usage: DataFrame, interval: str = "DAILY", start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Cost per account, period of the interval and service, dearest first.

    With a window, only its usage counts and its first and last period are cut
    to it.
    """
    if start is not None:
        usage = usage.filter((F.col("period_start") >= F.lit(start)) & (F.col("period_start") < F.lit(end)))
    if interval != "DAILY":
        first = period_of(F.col("period_start"), interval)
        last = (first + F.expr(f"INTERVAL 1 {PERIOD_UNIT[interval]}")).cast("date")
        if start is not None:
            first, last = F.greatest(first, F.lit(start)), F.least(last, F.lit(end))
        usage = usage.withColumns({"period_start": first, "period_end": last})
    return (
        usage.groupBy("account_id", "service", "period_start", "period_end", "unit")
        .agg(F.sum("amount").alias("cost"))
        .select(
            "account_id",
            "service",
            F.lit("Aggregated").alias("usage_types"),
            F.col("period_start").alias("date_from"),
            F.col("period_end").alias("date_to"),
            "cost",
            F.col("unit").alias("currency"),
            F.lit(None).cast("double").alias("utilization"),
            F.lit(None).cast("string").alias("utilization_unit"),
        )
        .orderBy(F.desc("cost"))
    )


def cost_report(usage: DataFrame, start: dt.date, end: dt.date, interval: str = "DAILY") -> DataFrame:
    """Per account current and previous total, change and top services of the last period.

    The last period is the window's, in the interval's granularity: an account
    without use in it lists no service.  One scan covers both windows; the
    previous one has the same number of days and ends where the current one
    starts.
    """
    days = 1 if interval == "DAILY" else (end - start).days + 1
    before = start - dt.timedelta(days=days)
    day = F.col("period_start")
    rows = usage.filter((day >= F.lit(before)) & (day < F.lit(end)))
    current = day >= F.lit(start)
    latest = current & (period_of(day, interval) == period_of(F.lit(end - dt.timedelta(days=1)), interval))
    report = reported(rows.select("account_id", "service", "amount", current.alias("current"), latest.alias("latest")), ("account_id",))
    period = F.struct(F.lit(start).alias("start"), F.lit(end).alias("end"), F.lit(interval).alias("granularity"))
    return report.withColumn("period", period)


def backfilled_cost_reports(usage: DataFrame, days: DataFrame) -> DataFrame:
    """C28 over C3: the daily report of every day of ``days`` (``backfill_days``) in one pass, with its ``load_day``.

    A load day's window is the day before it; usage of a day is current for the
    next load day and previous for the one after.
    """
    both = F.array(
        F.struct(F.date_add("period_start", 1).alias("load_day"), F.lit(True).alias("current")),
        F.struct(F.date_add("period_start", 2).alias("load_day"), F.lit(False).alias("current")),
    )
    rows = usage.select("account_id", "service", "amount", F.inline(both)).withColumn("latest", F.col("current"))
    rows = rows.join(days.select(F.col("day").alias("load_day")), "load_day", "left_semi")
    report = reported(rows, ("account_id", "load_day"))
    period = F.struct(F.date_sub("load_day", 1).alias("start"), F.col("load_day").alias("end"), F.lit("DAILY").alias("granularity"))
    return report.withColumn("period", period)


def reported(rows: DataFrame, keys: tuple[str, ...], n: int = TOP_SERVICES) -> DataFrame:
    """Totals, change and the ``n`` dearest services (ties by name) per ``keys``.

    ``rows`` carries service, amount and whether it counts for the current
    window and for its last period.
    """
    cost = lambda cond: F.sum(F.when(cond, F.col("amount")))
    per_service = rows.groupBy(*keys, "service").agg(
        cost(F.col("current")).alias("cur"), cost(~F.col("current")).alias("prev"), cost(F.col("latest")).alias("last")
    )
    dearest = W.partitionBy(*keys).orderBy(F.desc_nulls_last("last"), "service")
    ranked = per_service.withColumn("_rank", F.row_number().over(dearest))
    entry = F.when((F.col("_rank") <= n) & F.col("last").isNotNull(), F.struct("_rank", "service", F.col("last").alias("cost")))
    totals = ranked.groupBy(*keys).agg(
        F.coalesce(F.sum("cur"), F.lit(0)).alias("current_period_cost"),
        F.coalesce(F.sum("prev"), F.lit(0)).alias("previous_period_cost"),
        F.array_sort(F.collect_list(entry)).alias("_top"),
    )
    difference, previous = F.col("current_period_cost") - F.col("previous_period_cost"), F.col("previous_period_cost")
    change = F.when(previous > 0, difference.cast("double") / previous.cast("double") * 100).otherwise(0.0)
    return totals.select(
        *keys,
        "current_period_cost",
        "previous_period_cost",
        difference.alias("cost_difference"),
        change.alias("cost_difference_percentage"),
        F.transform("_top", lambda s: F.struct(s["service"].alias("service"), s["cost"].alias("cost"))).alias("top_services"),
    )


def cost_forecasts(forecast: DataFrame) -> DataFrame:
    """Forecast rows of an account."""
    return forecast.select("account_id", "period_start", "period_end", F.col("mean_value").alias("amount"))


# C4, C5 --------------------------------------------------------------------


def config_compliance(
    rules: DataFrame, evaluations: DataFrame, packs: DataFrame, start: dt.date, end: dt.date
) -> tuple[DataFrame, DataFrame]:
    """C4: (report per account, resources evaluated on the start day).

    A rule named by several packs goes to the last one; without one it is
    standalone.  A rule counts as evaluated when a result of its own compliance
    type was recorded that day.
    """
    day_start = dt.datetime.combine(start, dt.time.min)
    day_end = day_start.replace(hour=23, minute=59, second=59)
    judged = rules.filter(F.col("ComplianceType").isin("COMPLIANT", "NON_COMPLIANT"))
    key = ["account_id", "ConfigRuleName", "ComplianceType"]
    today = evaluations.filter(inside("ResultRecordedTime", day_start, day_end))
    touched = today.select(*key).distinct().withColumn("_today", F.lit(True))
    flags = judged.join(touched, key, "left")
    ok = F.col("ComplianceType") == "COMPLIANT"
    now = F.coalesce("_today", F.lit(False))
    report = flags.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("total_rules"),
        F.count_if(ok).alias("compliant_rules"),
        F.count_if(~ok).alias("non_compliant_rules"),
        F.count_if(~ok & now).alias("curr_non_compliant"),
        F.count_if(ok & now).alias("curr_compliant"),
    )
    score = F.bround(F.col("compliant_rules") / F.col("total_rules") * 100, 2)
    report = report.select(
        "account_id",
        F.lit(start).alias("date_from"),
        F.lit(end).alias("date_to"),
        score.alias("compliance_score"),
        "total_rules",
        "compliant_rules",
        "non_compliant_rules",
        "curr_non_compliant",
        "curr_compliant",
    )
    pack = packs.groupBy("account_id", "ConfigRuleName").agg(
        F.max_by("ConformancePackName", "position").alias("_pack")
    )
    resources = (
        today.join(judged.select(*key).distinct(), key, "left_semi")
        .join(pack, ["account_id", "ConfigRuleName"], "left")
        .select(
            "account_id",
            F.col("ConfigRuleName").alias("rule_name"),
            F.col("ResourceId").alias("resource_id"),
            F.col("ResourceType").alias("resource_type"),
            F.col("ResultRecordedTime").alias("config_rule_invoked_time"),
            F.coalesce("_pack", F.lit("Standalone")).alias("conformance_pack"),
            F.col("ComplianceType").alias("compliance_type"),
            F.col("Annotation").alias("annotation"),
            F.col("EvaluationMode").alias("evaluation_mode"),
        )
    )
    return report, resources


def patch_window(patches: DataFrame, start, end) -> DataFrame:
    """Patches installed inside the window."""
    return patches.filter(inside("InstalledTime", start, end)).select(
        "account_id",
        F.col("InstanceId").alias("instance_id"),
        F.col("Title").alias("title"),
        F.coalesce(F.nullif("Classification", F.lit("")), F.lit("Normal")).alias("classification"),
        F.coalesce(F.nullif("Severity", F.lit("")), F.lit("None")).alias("severity"),
        F.col("State").alias("state"),
        F.col("InstalledTime").alias("installed_time"),
    )


# Rename and filter ------------------------


def normalise(
    df: DataFrame, spec: dict[str, str], time_cols: tuple[str, ...] = (), start=None, end=None
) -> DataFrame:
    """Rename raw fields; with ``time_cols`` keep rows where any of them lies in the window."""
    if time_cols:
        df = df.filter(any_inside(time_cols, start, end))
    return df.select("account_id", *[F.col(src).alias(out) for out, src in spec.items()])


# Output column <- raw field.
INSTANCE_FIELDS = {
    "instance_id": "InstanceId",
    "platform": "PlatformName",
    "platform_type": "PlatformType",
    "platform_version": "PlatformVersion",
    "agent_version": "AgentVersion",
    "is_latest_version": "IsLatestVersion",
    "computer_name": "ComputerName",
    "instance_type": "ResourceType",
    "ip_address": "IPAddress",
    "ping_status": "PingStatus",
    "last_ping_date_time": "LastPingDateTime",
    "association_status": "AssociationStatus",
    "association_execution_date": "LastAssociationExecutionDate",
    "association_success_date": "LastSuccessfulAssociationExecutionDate",
}
APPLICATION_FIELDS = {
    "name": "Name",
    "version": "Version",
    "publisher": "Publisher",
    "architecture": "Architecture",
    "application_type": "ApplicationType",
    "install_time": "InstalledTime",
}
THREAT_FIELDS = {
    "id": "Id",
    "type": "Type",
    "severity": "Severity",
    "title": "Title",
    "description": "Description",
    "created_at": "CreatedAt",
    "updated_at": "UpdatedAt",
    "confidence": "Confidence",
    "region": "Region",
}
SECRET_FIELDS = {
    "name": "Name",
    "arn": "ARN",
    "description": "Description",
    "created_date": "CreatedDate",
    "last_changed_date": "LastChangedDate",
    "last_accessed_date": "LastAccessedDate",
    "rotation_enabled": "RotationEnabled",
}
CERTIFICATE_FIELDS = {
    "arn": "CertificateArn",
    "domain_name": "DomainName",
    "status": "Status",
    "type": "Type",
    "key_algorithm": "KeyAlgorithm",
    "created_at": "CreatedAt",
    "issued_at": "IssuedAt",
    "not_before": "NotBefore",
    "not_after": "NotAfter",
}
VULNERABILITY_FIELDS = {
    "finding_arn": "findingArn",
    "severity": "severity",
    "status": "status",
    "type": "type",
    "title": "title",
    "description": "description",
    "first_observed_at": "firstObservedAt",
    "last_observed_at": "lastObservedAt",
    "updated_at": "updatedAt",
}
SIGNAL_FIELDS = {"service_name": "ServiceName", "namespace": "Namespace", "key_attributes": "KeyAttributes"}
HEALTH_FIELDS = {
    "arn": "arn",
    "service": "service",
    "event_type_code": "eventTypeCode",
    "event_type_category": "eventTypeCategory",
    "region": "region",
    "availability_zone": "availabilityZone",
    "start_time": "startTime",
    "end_time": "endTime",
    "last_updated_time": "lastUpdatedTime",
    "status_code": "statusCode",
    "event_scope_code": "eventScopeCode",
}
TICKET_FIELDS = {
    "case_id": "caseId",
    "display_id": "displayId",
    "subject": "subject",
    "status": "status",
    "severity_code": "severityCode",
    "service_code": "serviceCode",
    "category_code": "categoryCode",
    "time_created": "timeCreated",
    "submitted_by": "submittedBy",
    "language": "language",
}


def inventory_records(instances: DataFrame, applications: DataFrame, patches: DataFrame, start, end):
    """(instances, applications, patches); ``applications`` holds an ``Entries`` array per instance."""
    entries = applications.select(
        "account_id", F.col("InstanceId").alias("instance_id"), F.explode("Entries").alias("_e")
    ).select("account_id", "instance_id", "_e.*")
    apps = entries.select(
        "account_id", "instance_id", *[F.col(src).alias(out) for out, src in APPLICATION_FIELDS.items()]
    )
    return normalise(instances, INSTANCE_FIELDS), apps, patch_window(patches, start, end)


def threat_findings(findings: DataFrame, start, end) -> DataFrame:
    """Detector findings updated inside the window."""
    return normalise(findings, THREAT_FIELDS, ("UpdatedAt",), start, end)


def vulnerability_findings(findings: DataFrame, start, end) -> DataFrame:
    """C14: findings first seen, last seen or updated inside the window."""
    times = ("firstObservedAt", "lastObservedAt", "updatedAt")
    return normalise(findings, VULNERABILITY_FIELDS, times, start, end)


def signal_window(start: dt.datetime, end: dt.datetime, now: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """A window of more than a day becomes the last 23 hours."""
    if end - start > dt.timedelta(hours=24):
        return now - dt.timedelta(hours=23), now
    return start, end


def signal_services(services: DataFrame, start: dt.datetime, end: dt.datetime, now: dt.datetime) -> DataFrame:
    """Services seen inside the adjusted window."""
    return normalise(services, SIGNAL_FIELDS, ("SeenAt",), *signal_window(start, end, now))


def health_event_records(events: DataFrame, start, end) -> DataFrame:
    """Health events started inside the window."""
    return normalise(events, HEALTH_FIELDS, ("startTime",), start, end)


def ticket_records(cases: DataFrame, start, end) -> DataFrame:
    """Support cases created inside the window; the language defaults to English."""
    rows = cases.withColumn("language", F.coalesce("language", F.lit("en")))
    out = normalise(rows, TICKET_FIELDS, ("timeCreated",), start, end)
    return out.withColumns({"date_from": as_timestamp(start).cast("date"), "date_to": as_timestamp(end).cast("date")})


# C7 ------------------------------------------------------------------------


def relevant_findings(findings: DataFrame, start, end) -> DataFrame:
    """Findings created new or updated to a closed status inside the window, each once.

    The created set comes first, so a finding in both keeps its created row.
    ``position`` gives the response order inside a set.
    """
    active = findings.filter(
        (F.col("RecordState") == "ACTIVE") & F.col("Severity.Label").isin(*ACTIVE_SEVERITIES)
    )
    status = F.col("Workflow.Status")
    created = active.filter(inside("CreatedAt", start, end) & (status == "NEW"))
    updated = active.filter(inside("UpdatedAt", start, end) & status.isin(*UPDATED_STATUSES))
    both = created.withColumn("_set", F.lit(0)).unionByName(updated.withColumn("_set", F.lit(1)))
    fields = [c for c in findings.columns if c != "Id"]
    first = F.min_by(F.struct(*fields), F.struct("_set", "position"))
    return both.groupBy("Id").agg(first.alias("_f")).select("Id", "_f.*")


def finding_rollup(findings: DataFrame, start, end) -> tuple[DataFrame, DataFrame]:
    """(totals per account and product, largest first; the findings behind them)."""
    rows = relevant_findings(findings, start, end)
    label, status = F.col("Severity.Label"), F.col("Workflow.Status")
    product = _text("ProductName")
    resource = F.get(F.col("Resources"), F.lit(0))
    detail = rows.select(
        "account_id",
        product.alias("product"),
        F.col("Id").alias("finding_id"),
        resource["Type"].alias("service"),
        F.col("Title").alias("title"),
        F.coalesce(label, F.lit("UNKNOWN")).alias("severity"),
        F.coalesce(F.nullif(status, F.lit("")), F.lit("OPEN")).alias("status"),
        resource["Type"].alias("resource_type"),
        resource["Id"].alias("resource_id"),
        F.col("CreatedAt").alias("created_at"),
        F.col("UpdatedAt").alias("updated_at"),
        F.col("RecordState").alias("record_state"),
        F.col("ProductName").alias("product_name"),
    )
    counts = [F.count_if(F.col("severity") == s).alias(f"{s.lower()}_count") for s in COUNTED_SEVERITIES]
    rollup = (
        detail.groupBy("account_id", F.col("product").alias("service"))
        .agg(
            F.count(F.lit(1)).alias("total_findings"),
            *counts,
            F.count_if(F.col("status") != "RESOLVED").alias("open_findings"),
            F.count_if(F.col("status") == "RESOLVED").alias("resolved_findings"),
        )
        .orderBy(F.desc("total_findings"))
    )
    return rollup, detail


# C9 - C12 ------------------------------------------------------------------


def key_records(keys: DataFrame, rotation: DataFrame) -> DataFrame:
    """Keys with their rotation flag.

    A refused rotation lookup counts as rotated; a key whose lookup failed in
    another way is left out.
    """
    status = rotation.select(
        F.col("KeyId").alias("_key"), "KeyRotationEnabled", F.col("ErrorCode").alias("_error")
    )
    denied = F.col("_error") == "AccessDeniedException"
    return (
        keys.join(status, F.col("KeyId") == F.col("_key"), "left")
        .filter(F.col("_error").isNull() | denied)
        .select(
            "account_id",
            F.col("KeyId").alias("key_id"),
            F.col("Arn").alias("arn"),
            F.col("Description").alias("description"),
            F.col("KeyUsage").alias("key_usage"),
            F.col("KeyState").alias("key_state"),
            F.col("CreationDate").alias("creation_date"),
            F.col("Enabled").alias("enabled"),
            F.when(denied, True).otherwise(F.coalesce("KeyRotationEnabled", F.lit(False))).alias("key_rotation_enabled"),
        )
    )


RULE_TYPE = (
    "array<struct<Name: string, Priority: int, Statement: string, Action: string, OverrideAction: string, "
    "VisibilityConfig: struct<SampledRequestsEnabled: boolean, CloudWatchMetricsEnabled: boolean>>>"
)


def _has(rule: Column, statement: str) -> Column:
    keys = F.coalesce(F.json_object_keys(rule["Statement"]), F.array().cast("array<string>"))
    return F.array_contains(keys, statement)


def _n_rules(condition) -> Column:
    return F.size(F.filter("Rules", condition))


def _any_visible(flag: str) -> Column:
    return F.exists("Rules", lambda r: F.coalesce(r["VisibilityConfig"][flag], F.lit(False)))


def acl_rollup(acls: DataFrame) -> DataFrame:
    """One row per ACL; its rules are folded in place, nothing is shuffled."""
    countries = F.flatten(
        F.transform(
            F.filter("Rules", lambda r: _has(r, "GeoMatchStatement")),
            lambda r: F.coalesce(
                F.from_json(F.get_json_object(r["Statement"], "$.GeoMatchStatement.CountryCodes"), "array<string>"),
                F.array().cast("array<string>"),
            ),
        )
    )
    ip_sets = F.transform(
        F.filter("Rules", lambda r: _has(r, "IPSetReferenceStatement")),
        lambda r: F.get_json_object(r["Statement"], "$.IPSetReferenceStatement.ARN"),
    )
    managed = _n_rules(lambda r: _has(r, MANAGED))
    rate = _n_rules(lambda r: ~_has(r, MANAGED) & _has(r, RATE))
    return acls.select(
        "account_id",
        F.col("Name").alias("name"),
        F.col("Id").alias("id"),
        F.col("ARN").alias("arn"),
        F.col("Scope").alias("scope"),
        _text("Description").alias("description"),
        F.col("DefaultAction").alias("default_action"),
        F.size("Rules").alias("rules_count"),
        F.coalesce("Capacity", F.lit(0)).alias("capacity"),
        managed.alias("managed_rules_count"),
        (F.size("Rules") - managed - rate).alias("custom_rules_count"),
        rate.alias("rate_limit_rules_count"),
        F.coalesce(F.size("ResourceArns"), F.lit(0)).alias("associated_resources_count"),
        F.coalesce("LoggingEnabled", F.lit(False)).alias("logging_enabled"),
        (F.size(countries) > 0).alias("geo_blocking_enabled"),
        countries.alias("blocked_countries"),
        ip_sets.alias("ip_sets"),
        _any_visible("SampledRequestsEnabled").alias("sampled_requests_enabled"),
        _any_visible("CloudWatchMetricsEnabled").alias("cloudwatch_metrics_enabled"),
    )


def rule_compliance(statement_type: Column, vendor: Column) -> Column:
    """Listed statement types comply; a managed group only from a trusted vendor."""
    return F.when(statement_type == MANAGED, F.coalesce(vendor.isin(*COMPLIANT_VENDORS), F.lit(False))).otherwise(
        statement_type.isin(*COMPLIANT_STATEMENTS)
    )


def acl_rules(acls: DataFrame) -> DataFrame:
    """C11: one row per rule of an ACL with its type and protections."""
    rows = acls.select(
        "account_id",
        F.col("Name").alias("web_acl_name"),
        F.col("Scope").alias("scope"),
        F.coalesce("LoggingEnabled", F.lit(False)).alias("logging_enabled"),
        F.explode("Rules").alias("_r"),
    )
    statement = _text("_r.Statement")
    kind = F.coalesce(F.get(F.json_object_keys(statement), F.lit(0)), F.lit("Unknown"))
    managed = kind == MANAGED
    group = F.coalesce(F.get_json_object(statement, f"$.{MANAGED}.Name"), F.lit(""))
    vendor = F.get_json_object(statement, f"$.{MANAGED}.VendorName")
    stated = lambda c: F.when(~F.coalesce(c, F.lit("")).isin("", "{}"), c)
    action = F.coalesce(stated(F.col("_r.Action")), F.col("_r.OverrideAction"), F.lit('{"None":{}}'))
    mentions = lambda match, word: F.contains(statement, F.lit(match)) | (managed & F.contains(group, F.lit(word)))
    visible = lambda f: F.coalesce(F.col(f"_r.VisibilityConfig.{f}"), F.lit(False))
    return rows.select(
        "account_id",
        "web_acl_name",
        F.col("_r.Name").alias("rule_name"),
        F.col("_r.Priority").alias("priority"),
        action.alias("action"),
        kind.alias("statement_type"),
        managed.alias("is_managed_rule"),
        (~managed).alias("is_custom_rule"),
        (kind == RATE).alias("rate_limit"),
        "logging_enabled",
        F.contains(statement, F.lit("GeoMatchStatement")).alias("geo_blocking"),
        mentions("SqliMatchStatement", "SQLi").alias("sql_injection"),
        visible("SampledRequestsEnabled").alias("sample_request_enabled"),
        visible("CloudWatchMetricsEnabled").alias("cloudwatch_enabled"),
        mentions("XssMatchStatement", "XSS").alias("has_xss_protection"),
        F.lit("v2").alias("waf_version"),
        rule_compliance(kind, vendor).alias("is_compliant"),
        "scope",
    )


# C13, C15, C17 -------------------------------------------------------------


def trail_records(trails: DataFrame, status: DataFrame, events: DataFrame, start, end, most: int = 5) -> DataFrame:
    """Trails with state and number of recent events of their account, at most ``most``."""
    counts = (
        events.filter(inside("EventTime", start, end))
        .groupBy("account_id")
        .agg(F.least(F.count(F.lit(1)), F.lit(most)).alias("_n"))
    )
    state = status.select(F.col("TrailARN").alias("_arn"), "IsLogging", "LatestDeliveryTime")
    return (
        trails.join(state, F.col("TrailARN") == F.col("_arn"), "left")
        .join(counts, "account_id", "left")
        .select(
            "account_id",
            F.col("Name").alias("name"),
            F.col("TrailARN").alias("arn"),
            F.col("IsLogging").alias("is_logging"),
            F.col("IsMultiRegionTrail").alias("is_multi_region"),
            F.col("S3BucketName").alias("s3_bucket"),
            F.col("LogFileValidationEnabled").alias("log_file_validation"),
            F.coalesce("_n", F.lit(0)).alias("recent_events_count"),
            F.col("LatestDeliveryTime").alias("latest_delivery_time"),
        )
    )


def secret_records(secrets: DataFrame) -> DataFrame:
    """All secrets."""
    return normalise(secrets, SECRET_FIELDS)


def certificate_records(certificates: DataFrame) -> DataFrame:
    """All certificates."""
    return normalise(certificates, CERTIFICATE_FIELDS)


def advisor_checks(checks: DataFrame, start, end) -> DataFrame:
    """Checks in trouble with flagged resources, undated or dated inside the window."""
    when = F.try_to_timestamp(blank_to_null(F.col("timestamp")))
    flagged = F.coalesce(F.size("flaggedResources"), F.lit(0))
    return (
        checks.withColumn("_when", when)
        .filter(F.col("status").isin("warning", "error") & (flagged > 0))
        .filter(F.col("_when").isNull() | inside("_when", start, end))
        .select(
            "account_id",
            F.col("name").alias("check_name"),
            "category",
            F.col("status").alias("severity"),
            F.col("description").alias("recommendation"),
            flagged.alias("affected_resources_count"),
            F.col("estimatedMonthlySavings").alias("potential_savings"),
            F.col("_when").alias("timestamp"),
        )
    )


def resilience_apps(
    apps: DataFrame, policies: DataFrame, drills: DataFrame, costs: DataFrame, start, end
) -> DataFrame:
    """C17: apps created or assessed inside the window with targets, first listed drill and cost."""
    policy = policies.select(F.col("policyArn").alias("resiliencyPolicyArn"), "rpoInSecs", "rtoInSecs")
    drill = drills.groupBy("appArn").agg(F.min_by("creationTime", "position").alias("last_drill"))
    cost = costs.select("appArn", "cost")
    return (
        apps.filter(any_inside(("creationTime", "lastAssessmentTime"), start, end))
        .join(policy, "resiliencyPolicyArn", "left")
        .join(drill, "appArn", "left")
        .join(cost, "appArn", "left")
        .select(
            "account_id",
            F.col("appArn").alias("app_arn"),
            "name",
            F.col("creationTime").alias("creation_time"),
            F.col("lastAssessmentTime").alias("last_assessment_time"),
            F.col("complianceStatus").alias("compliance_status"),
            F.col("resiliencyScore").alias("resiliency_score"),
            "status",
            F.col("rpoInSecs").alias("rpo"),
            F.col("rtoInSecs").alias("rto"),
            "last_drill",
            "cost",
        )
    )


# C19 -----------------------------------------------------------------------


def marketplace_costs(usage: DataFrame, entitlements: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Entitlements carrying their account's whole marketplace cost.

    An account with cost but no entitlement gets one generic row.
    """
    day = F.col("period_start")
    rows = usage.filter((F.col("service") == "AWS Marketplace") & (day >= F.lit(start)) & (day < F.lit(end)))
    totals = rows.groupBy("account_id").agg(F.sum("amount").alias("cost_consumed"))
    common = [
        F.coalesce("cost_consumed", F.lit(0)).alias("cost_consumed"),
        F.lit("USD").alias("currency"),
        F.lit(start).alias("period_start"),
        F.lit(end).alias("period_end"),
    ]
    owned = entitlements.join(totals, "account_id", "left").select(
        "account_id",
        F.col("ProductCode").alias("product_code"),
        F.lit(None).cast("string").alias("product_name"),
        F.col("Dimension").alias("dimension"),
        *common,
        F.lit("ACTIVE").alias("status"),
    )
    generic = (
        totals.filter(F.col("cost_consumed") > 0)
        .join(entitlements.select("account_id").distinct(), "account_id", "left_anti")
        .select(
            "account_id",
            F.lit("MARKETPLACE_USAGE").alias("product_code"),
            F.lit("AWS Marketplace Products").alias("product_name"),
            F.lit("Usage").alias("dimension"),
            *common,
            F.lit("CONSUMED").alias("status"),
        )
    )
    return owned.unionByName(generic)


def marketplace_daily_costs(usage: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Days with a marketplace cost."""
    day = F.col("period_start")
    return (
        usage.filter((F.col("service") == "AWS Marketplace") & (day >= F.lit(start)) & (day < F.lit(end)))
        .groupBy("account_id", F.col("period_start").alias("date"))
        .agg(F.sum("amount").alias("cost"))
        .filter(F.col("cost") > 0)
    )


# C20, C21 ------------------------------------------------------------------


def _shape(df: DataFrame, table: str, fixed: dict[str, Column], skip: tuple[str, ...]) -> DataFrame:
    """Rows of a common shape; columns a source does not know are null."""
    columns = [c for c in TABLES[table].columns if c not in skip]
    kinds = TABLES[table].columns
    return df.select(
        *[
            (fixed[c] if c in fixed else F.lit(None)).cast(T.StringType() if c == "account_id" else kinds[c]).alias(c)
            for c in columns
        ]
    )


def optimizer_records(instances: DataFrame, volumes: DataFrame, functions: DataFrame) -> DataFrame:
    """C20: three recommendation sources in one shape; only the first option counts."""

    def option(column: str) -> Column:
        return F.get(F.col(column), F.lit(0))

    def saving(o: Column) -> dict[str, Column]:
        return {
            "savings_opportunity_percentage": o["savingsOpportunity"]["savingsOpportunityPercentage"],
            "estimated_monthly_savings_usd": o["savingsOpportunity"]["estimatedMonthlySavings"]["value"],
        }

    def maxima(metric: str) -> Column:
        named = F.filter(F.col("utilizationMetrics"), lambda u: u["name"] == metric)
        return F.transform(named, lambda u: F.coalesce(u["maximum"], F.lit(0.0)))

    mean = F.when(
        F.size(maxima("Memory")) > 0,
        F.aggregate(maxima("Memory"), F.lit(0.0), lambda a, x: a + x) / F.size(maxima("Memory")),
    ).otherwise(F.lit(0.0))
    skip = ("id", "created_at")
    machine, volume, function = (
        option("recommendationOptions"),
        option("volumeRecommendationOptions"),
        option("memorySizeRecommendationOptions"),
    )
    common = lambda kind, arn, name: {
        "account_id": F.col("account_id"),
        "resource_type": F.lit(kind),
        "resource_arn": F.col(arn),
        "resource_name": name,
        "finding": F.col("finding"),
    }
    parts = [
        _shape(
            instances,
            "compute_optimizer",
            {
                **common("EC2", "instanceArn", F.col("instanceName")),
                "current_instance_type": F.col("currentInstanceType"),
                "recommended_instance_type": machine["instanceType"],
                "performance_risk": machine["performanceRisk"],
                "cpu_utilization_max": F.coalesce(F.array_max(maxima("Cpu")), F.lit(0.0)),
                "memory_utilization_avg": mean,
                **saving(machine),
            },
            skip,
        ),
        _shape(
            volumes,
            "compute_optimizer",
            {
                **common("EBS", "volumeArn", F.lit(None)),
                "current_volume_type": F.col("currentConfiguration.volumeType"),
                "current_volume_size": F.col("currentConfiguration.volumeSize"),
                "recommended_volume_type": volume["configuration"]["volumeType"],
                "recommended_volume_size": volume["configuration"]["volumeSize"],
                "performance_risk": volume["performanceRisk"],
                **saving(volume),
            },
            skip,
        ),
        _shape(
            functions,
            "compute_optimizer",
            {
                **common("Lambda", "functionArn", F.col("functionName")),
                "current_memory_size": F.col("currentMemorySize"),
                "recommended_memory_size": function["memorySize"],
                **saving(function),
            },
            skip,
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def name_tag(tags: Column) -> Column:
    """Value of the first tag called Name, else empty."""
    return F.coalesce(F.get(F.filter(tags, lambda t: t["Key"] == "Name"), F.lit(0))["Value"], F.lit(""))


#: Per source: (service, type, id, name, zone, state, further columns).  A source
#: is used when it is given; all land in one shape.
RESOURCE_SOURCES = {
    "instances": lambda: (
        "EC2", "Instance", F.col("InstanceId"), name_tag(F.col("Tags")), F.col("Placement.AvailabilityZone"),
        F.col("State.Name"), {"instance_type": F.col("InstanceType"), "vpc_id": F.col("VpcId")},
    ),
    "databases": lambda: (
        "RDS", "DBInstance", F.col("DBInstanceIdentifier"), F.col("DBInstanceIdentifier"), F.col("AvailabilityZone"),
        F.col("DBInstanceStatus"),
        {"engine": F.col("Engine"), "instance_class": F.col("DBInstanceClass"), "multi_az": F.col("MultiAZ")},
    ),
    "volumes": lambda: (
        "EBS", "Volume", F.col("VolumeId"), name_tag(F.col("Tags")), F.col("AvailabilityZone"), F.col("State"),
        {"size_gb": F.coalesce("Size", F.lit(0)), "volume_type": F.col("VolumeType")},
    ),
    "buckets": lambda: (
        "S3", "Bucket", F.col("Name"), F.col("Name"), F.lit(None), F.lit("Active"),
        {"creation_date": F.col("CreationDate")},
    ),
    "load_balancers": lambda: (
        "ELB", "LoadBalancer", F.col("LoadBalancerName"), F.col("LoadBalancerName"),
        F.array_join(F.col("AvailabilityZones.ZoneName"), ","), F.col("State.Code"),
        {"type": F.col("Type"), "scheme": F.col("Scheme")},
    ),
    "scaling_groups": lambda: (
        "AutoScaling", "AutoScalingGroup", F.col("AutoScalingGroupName"), F.col("AutoScalingGroupName"),
        F.array_join(F.col("AvailabilityZones"), ","),
        F.when(F.coalesce(F.size("Instances"), F.lit(0)) > 0, "Active").otherwise("Inactive"),
        {"instance_count": F.coalesce(F.size("Instances"), F.lit(0)), "min_size": F.col("MinSize"),
         "max_size": F.col("MaxSize")},
    ),
    "subnets": lambda: (
        "VPC", "Subnet", F.col("SubnetId"), name_tag(F.col("Tags")), F.col("AvailabilityZone"), F.col("State"),
        {"available_ip_count": F.coalesce("AvailableIpAddressCount", F.lit(0)), "vpc_id": F.col("VpcId")},
    ),
    "functions": lambda: (
        "Lambda", "Function", F.col("FunctionArn"), F.col("FunctionName"), F.lit("Generic"), F.col("State"),
        {"instance_type": F.col("Runtime"), "vpc_id": _text("VpcId"), "engine": F.col("Runtime"),
         "instance_class": F.lit(""), "multi_az": F.lit(True),
         "size_gb": F.round(F.coalesce("MemorySize", F.lit(128)) / 1024, 0),
         "volume_type": F.lit("EphemeralStorage"), "creation_date": F.col("LastModified"),
         "type": F.col("PackageType"),
         "scheme": F.coalesce(F.get("Architectures", F.lit(0)), F.lit("x86_64")), "instance_count": F.lit(1),
         "max_size": F.coalesce("EphemeralStorageSize", F.lit(512))},
    ),
}


def resource_records(sources: dict[str, DataFrame]) -> DataFrame:
    """Resources of up to eight sources in one shape."""
    unknown = set(sources) - set(RESOURCE_SOURCES)
    if unknown:
        raise ValueError(f"unknown sources: {sorted(unknown)}")
    parts = []
    for source, df in sources.items():
        service, kind, number, name, zone, state, more = RESOURCE_SOURCES[source]()
        fixed = {
            "account_id": F.col("account_id"),
            "service_name": F.lit(service),
            "resource_type": F.lit(kind),
            "resource_id": number,
            "resource_name": name,
            "region": F.col("region"),
            "availability_zone": zone,
            "state": state,
            **more,
        }
        parts.append(_shape(df, "service_resources", fixed, ("id", "created_at")))
    return reduce(DataFrame.unionByName, parts)


# C23 -----------------------------------------------------------------------


def reservation_details(reservations: DataFrame) -> DataFrame:
    """Reserved capacity: monthly commitment is the hourly charge times 730."""
    charge = F.coalesce(F.get("RecurringCharges", F.lit(0))["Amount"], F.lit(0.0))
    return reservations.select(
        "account_id",
        F.col("ReservedInstancesId").alias("subscription_id"),
        F.lit("Reserved Instance").alias("reservation_type"),
        F.lit(None).cast("string").alias("savings_plan_arn"),
        F.lit("Amazon EC2").alias("service"),
        F.col("InstanceType").alias("instance_type"),
        F.col("InstanceCount").alias("instance_count"),
        (charge * HOURS_PER_MONTH).alias("commitment"),
        F.coalesce(F.col("FixedPrice").cast("double"), F.lit(0.0)).alias("upfront_cost"),
        charge.alias("recurring_cost"),
        F.concat_ws(" ", F.concat(F.col("InstanceCount").cast("string"), F.lit("x")), "InstanceType", "ProductDescription").alias(
            "description"
        ),
    )


def plan_details(plans: DataFrame) -> DataFrame:
    """Savings plans."""
    return plans.select(
        "account_id",
        F.col("savingsPlanId").alias("subscription_id"),
        F.lit("Savings Plan").alias("reservation_type"),
        F.col("savingsPlanArn").alias("savings_plan_arn"),
        F.lit("AWS Savings Plans").alias("service"),
        F.col("savingsPlanType").alias("instance_type"),
        F.lit(None).cast("int").alias("instance_count"),
        F.coalesce(F.col("commitment").cast("double"), F.lit(0.0)).alias("commitment"),
        F.coalesce(F.col("upfrontPaymentAmount").cast("double"), F.lit(0.0)).alias("upfront_cost"),
        F.coalesce(F.col("recurringPaymentAmount").cast("double"), F.lit(0.0)).alias("recurring_cost"),
        "description",
    )


def commitment_savings(details: DataFrame, utilisation: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Commitments with their daily utilisation; one zero row where no day qualifies.

    A reservation's day counts only with use; a savings plan's day always does.
    ``utilisation`` is keyed by subscription for reservations and by ARN for plans.
    """
    day = F.col("period_start")
    used = utilisation.filter((day >= F.lit(start)) & (day < F.lit(end))).filter(
        (F.col("reservation_type") == "Savings Plan") | (F.col("UtilizationPercentage") > 0)
    )
    cents = lambda c: F.bround(F.col(c).cast("double"), 2)
    days = used.select(
        F.col("reservation_type"),
        F.col("commitment_key").alias("_key"),
        F.col("period_start").alias("date"),
        cents("UtilizationPercentage").alias("utilization_percentage"),
        cents("OnDemandCost").alias("on_demand_cost"),
        cents("CommitmentCost").alias("reservation_cost"),
        cents("NetSavings").alias("net_savings"),
    )
    key = F.when(F.col("reservation_type") == "Savings Plan", F.col("savings_plan_arn")).otherwise(
        F.col("subscription_id")
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    return (
        details.withColumn("_key", key)
        .join(days, ["reservation_type", "_key"], "left")
        .select(
            *details.columns,
            F.lit(start).alias("date_from"),
            F.lit(end).alias("date_to"),
            "date",
            zero("utilization_percentage"),
            zero("on_demand_cost"),
            zero("reservation_cost"),
            zero("net_savings"),
        )
    )


# C24 -----------------------------------------------------------------------


def error_patterns(logs: DataFrame, start, end, day: dt.date, n: int = TOP_PATTERNS, match: str = "ERROR|FATAL") -> DataFrame:
    """Most frequent error patterns: the ``n`` largest of a log group, then of an account.

    The filter ignores case, the pattern does not, so a line in lower case has
    no pattern of its own.  Whole lines are read.
    """
    pattern = F.regexp_extract("message", f"((?:{match}).*)", 1)
    lines = logs.filter(inside("timestamp", start, end) & F.col("message").rlike(f"(?i)(?:{match})"))
    counted = lines.groupBy(
        "account_id",
        "log_group_name",
        F.coalesce(F.nullif(pattern, F.lit("")), F.lit(UNKNOWN_PATTERN)).alias("error_pattern"),
    ).agg(
        F.count(F.lit(1)).alias("occurrence_count"),
        F.min("timestamp").alias("first_occurrence"),
        F.max("timestamp").alias("last_occurrence"),
    )
    group = W.partitionBy("account_id", "log_group_name").orderBy(F.desc("occurrence_count"), "error_pattern")
    account = W.partitionBy("account_id").orderBy(F.desc("occurrence_count"), "log_group_name", "error_pattern")
    return (
        counted.withColumn("_group", F.row_number().over(group))
        .filter(F.col("_group") <= n)
        .withColumn("_account", F.row_number().over(account))
        .filter(F.col("_account") <= n)
        .drop("_group", "_account")
        .withColumn("collection_date", F.lit(day))
    )


# C25 -----------------------------------------------------------------------


def alarm_resource(dimensions: Column, region: Column) -> Column:
    """Resource of an alarm: the last known dimension, else the first value of an unknown one."""
    known = {
        "InstanceId": ("arn:aws:ec2:", "::instance/"),
        "FunctionName": ("arn:aws:lambda:", "::function:"),
        "DBInstanceIdentifier": ("arn:aws:rds:", "::db:"),
        "LoadBalancer": ("arn:aws:elasticloadbalancing:", "::loadbalancer/"),
    }

    def step(acc: Column, d: Column) -> Column:
        expr = F
        for name, (head, tail) in known.items():
            expr = expr.when(d["Name"] == name, F.concat(F.lit(head), region, F.lit(tail), _text(d["Value"])))
        expr = expr.when(d["Name"] == "BucketName", F.concat(F.lit("arn:aws:s3:::"), _text(d["Value"])))
        missing = F.coalesce(acc, F.lit("")) == ""
        return expr.when(missing & (_text(d["Value"]) != ""), d["Value"]).otherwise(acc)

    return F.aggregate(dimensions, F.lit(None).cast("string"), step)


def alarm_records(metric_alarms: DataFrame, composite_alarms: DataFrame) -> DataFrame:
    """Metric and composite alarms in one shape."""
    text = [("AlarmArn", "alarm_arn"), ("AlarmName", "alarm_name"), ("StateValue", "state"), ("StateReason", "state_reason")]
    head = ["account_id", *[_text(src).alias(out) for src, out in text]]
    updated = F.col("StateUpdatedTimestamp").alias("state_updated_at")
    metric = metric_alarms.select(
        *head,
        updated,
        _text("MetricName").alias("metric_name"),
        _text("Namespace").alias("namespace"),
        F.col("Threshold").cast("double").alias("threshold"),
        _text("ComparisonOperator").alias("comparison_operator"),
        F.col("EvaluationPeriods").cast("int").alias("evaluation_periods"),
        alarm_resource(F.col("Dimensions"), F.col("region")).alias("resource_arn"),
    )
    return metric.unionByName(composite_alarms.select(*head, updated), allowMissingColumns=True)


def alarm_history_records(history: DataFrame, as_of) -> DataFrame:
    """State changes of the last day; the reason falls back to the summary."""
    state = "struct<stateValue: string, stateReason: string>"
    data = F.from_json("HistoryData", f"oldState {state}, newState {state}")
    since = as_timestamp(as_of) - F.expr("INTERVAL '24' HOUR")
    return (
        history.filter(F.col("Timestamp").between(since, as_timestamp(as_of)))
        .withColumn("_d", data)
        .select(
            "account_id",
            F.col("AlarmName").alias("alarm_name"),
            _text("_d.oldState.stateValue").alias("previous_state"),
            _text("_d.newState.stateValue").alias("new_state"),
            F.coalesce("_d.newState.stateReason", "HistorySummary", F.lit("")).alias("reason"),
            F.col("Timestamp").alias("transition_time"),
        )
    )


# C26 -----------------------------------------------------------------------


def canary_run_records(runs: DataFrame, as_of) -> DataFrame:
    """Runs of the last day; every state but PASSED is a failure."""
    since = as_timestamp(as_of) - F.expr("INTERVAL '24' HOUR")
    millis = (F.unix_micros("Completed") - F.unix_micros("Started")) / F.lit(1000)
    return runs.filter(F.col("Started").between(since, as_timestamp(as_of))).select(
        "account_id",
        F.col("Name").alias("canary_name"),
        F.when(F.col("State") == "PASSED", "PASSED").otherwise("FAILED").alias("run_status"),
        millis.cast("int").alias("duration_ms"),
        F.lit(None).cast("int").alias("response_time_ms"),
        F.nullif("StateReason", F.lit("")).alias("failure_reason"),
        F.col("Started").alias("run_at"),
    )


def canary_records(canaries: DataFrame, runs: DataFrame, as_of) -> DataFrame:
    """Canaries with success rate and latest run; without runs NOT_RUNNING and the last known one."""
    rolled = (
        canary_run_records(runs, as_of)
        .groupBy("account_id", "canary_name")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count_if(F.col("run_status") == "PASSED").alias("_passed"),
            F.max("run_at").alias("_latest"),
        )
    )
    ran = F.col("_n").isNotNull()
    return (
        canaries.withColumnRenamed("Name", "canary_name")
        .join(rolled, ["account_id", "canary_name"], "left")
        .select(
            "account_id",
            "canary_name",
            F.when(ran, F.coalesce("State", F.lit("UNKNOWN"))).otherwise("NOT_RUNNING").alias("status"),
            F.lit(None).cast("string").alias("endpoint_url"),
            F.bround(F.col("_passed") / F.col("_n") * 100, 1).alias("success_percentage"),
            F.nullif("StateReason", F.lit("")).alias("failure_reason"),
            F.when(ran, F.col("_latest")).otherwise(F.col("LastStarted")).alias("last_run_at"),
        )
    )


# C27 -----------------------------------------------------------------------


def db_insight_records(instances: DataFrame, points: DataFrame, top_items: DataFrame, as_of) -> DataFrame:
    """Latest figures per database instance.

    ``points`` holds (account_id, instance_identifier, source, metric, timestamp,
    value) with source ``insights`` or ``metrics``; ``top_items`` the ranked wait
    events and statements (kind, position, name).  Processor use of an instance
    with insights comes from them, else from plain metrics, and only with
    insights are load, wait event and statement known.
    """
    since = as_timestamp(as_of) - F.expr("INTERVAL '24' HOUR")
    key = ["account_id", "instance_identifier"]
    latest = lambda source, metric: F.max_by(
        "value", F.when((F.col("source") == source) & (F.col("metric") == metric), F.col("timestamp"))
    )
    figures = (
        points.filter(F.col("timestamp").between(since, as_timestamp(as_of)) & F.col("value").isNotNull())
        .groupBy(*key)
        .agg(
            latest("insights", "os.cpuUtilization.total.avg").alias("_cpu_pi"),
            latest("insights", "db.load.avg").alias("_load"),
            latest("metrics", "CPUUtilization").alias("_cpu_cw"),
            latest("metrics", "FreeableMemory").alias("_memory"),
            latest("metrics", "DatabaseConnections").alias("_connections"),
        )
    )
    first = lambda kind: F.min_by("name", F.when(F.col("kind") == kind, F.col("position")))
    top = top_items.groupBy(*key).agg(first("wait_event").alias("_wait"), first("sql").alias("_sql"))
    on = F.coalesce("PerformanceInsightsEnabled", F.lit(False))
    only_on = lambda c: F.when(on, F.col(c))
    return (
        instances.withColumnRenamed("DBInstanceIdentifier", "instance_identifier")
        .join(figures, key, "left")
        .join(top, key, "left")
        .select(
            *key,
            F.col("DBInstanceArn").alias("instance_arn"),
            on.alias("insights_enabled"),
            F.when(on, "INSIGHTS_ENABLED").otherwise("INSIGHTS_DISABLED").alias("status"),
            F.bround(F.when(on, F.col("_cpu_pi")).otherwise(F.col("_cpu_cw")), 2).alias("cpu_utilization"),
            F.bround(only_on("_load"), 2).alias("active_sessions"),
            only_on("_wait").alias("top_wait_event"),
            only_on("_sql").alias("top_sql_query"),
            F.bround(F.col("_memory") / (1024 * 1024), 2).alias("freeable_memory_mb"),
            F.col("_connections").cast("int").alias("database_connections"),
            as_timestamp(as_of).alias("collection_timestamp"),
        )
    )


def db_event_records(events: DataFrame, instances: DataFrame, as_of) -> DataFrame:
    """Events of the last day that belong to a known instance."""
    since = as_timestamp(as_of) - F.expr("INTERVAL '24' HOUR")
    known = instances.select("account_id", F.col("DBInstanceIdentifier").alias("SourceIdentifier"))
    return (
        events.filter(F.col("Date").between(since, as_timestamp(as_of)))
        .join(known, ["account_id", "SourceIdentifier"], "left_semi")
        .select(
            "account_id",
            F.coalesce("SourceType", F.lit("db-instance")).alias("source_type"),
            F.col("SourceIdentifier").alias("source_identifier"),
            F.array_join("EventCategories", ",").alias("event_category"),
            _text("Message").alias("message"),
            F.col("Date").alias("event_time"),
        )
    )
