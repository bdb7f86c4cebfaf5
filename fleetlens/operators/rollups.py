"""Aggregate and composite views.

Each fact is reduced to one row per account (or account and period) before any
join, so a hot account is combined on the map side and joins stay small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.text import account_full
from fleetlens.functions.timecalc import age_day_part, as_timestamp
from fleetlens.operators.dims import ACCOUNT_COLUMNS, account_dimension, owning_product
from fleetlens.operators.enrich import Tables, enrich

GRANULARITIES = ("MONTHLY", "WEEKLY", "DAILY")

_REPORT_FIELDS = (
    "period_start",
    "period_end",
    "current_period_cost",
    "previous_period_cost",
    "cost_difference",
    "cost_difference_percentage",
    "potential_monthly_savings",
)


def ratio(numerator: Column, denominator: Column, scale: int, factor: int = 1) -> Column:
    """Rounded (half away from zero) quotient, null when the denominator is 0.

    Integer operands are scaled to one exact decimal division before rounding.
    """
    quotient = F.try_divide(numerator.cast("decimal(20,0)") * F.lit(factor), denominator.cast("decimal(20,0)"))
    return F.round(quotient.cast("decimal(38,18)"), scale)


def latest_report(cost_reports: DataFrame, *keys: str) -> DataFrame:
    """Newest report per key by period end; equal ends go to the later start, then region."""
    newest = F.max_by(F.struct(*_REPORT_FIELDS), F.struct("period_end", "period_start", "region"))
    return cost_reports.groupBy(*keys).agg(newest.alias("_r")).select(*keys, "_r.*")


def service_metrics(services: DataFrame) -> DataFrame:
    """Per account: distinct rows and services, total cost and the sorted service list.

    Cost and names collapse to (account, service) on the map side.  Distinct ids
    are counted apart, spread by (account, id), so neither side gathers the rows
    of a hot account in one task and no row is expanded.
    """
    per_service = services.groupBy("account_id", "service").agg(F.sum("cost").alias("cost"))
    totals = per_service.groupBy("account_id").agg(
        F.count("service").alias("unique_services"),
        F.sum("cost").alias("total_service_cost"),
        F.nullif(F.array_join(F.array_sort(F.collect_list("service")), ", "), F.lit("")).alias("services_used"),
    )
    ids = services.groupBy("account_id").agg(F.count_distinct("id").alias("service_count"))
    return totals.join(ids, "account_id")


def finding_totals(security: DataFrame) -> DataFrame:
    total = lambda c, out=None: F.sum(c).alias(out or c)
    return security.groupBy("account_id").agg(
        total("total_findings"),
        total("open_findings"),
        total("resolved_findings"),
        total("critical_count", "critical_findings"),
        total("high_count", "high_findings"),
        total("medium_count", "medium_findings"),
        total("low_count", "low_findings"),
    )


def _summary_columns(as_of) -> list[Column]:
    """Cost, service, finding and age columns both summaries share."""
    return [
        "period_granularity",
        F.col("period_start").alias("date_from"),
        F.col("period_end").alias("date_to"),
        F.round("current_period_cost", 2).alias("current_period_cost"),
        F.round("previous_period_cost", 2).alias("previous_period_cost"),
        F.round("cost_difference", 2).alias("cost_difference"),
        F.round("cost_difference_percentage", 4).alias("cost_difference_percentage"),
        F.round("potential_monthly_savings", 2).alias("potential_savings"),
        "service_count",
        "unique_services",
        F.round("total_service_cost", 2).alias("total_service_cost"),
        "services_used",
        "total_findings",
        "open_findings",
        "resolved_findings",
        "critical_findings",
        "high_findings",
        "medium_findings",
        "low_findings",
        ratio(F.col("resolved_findings"), F.col("total_findings"), 4).alias("security_resolution_rate"),
        "account_email",
        "joined_method",
        "joined_timestamp",
        age_day_part(as_timestamp(as_of), F.col("joined_timestamp")).alias("account_age_days"),
    ]


def _account_rollups(tables: Tables) -> DataFrame:
    """Accounts joined to their per-account rollups and latest report per granularity."""
    accounts = tables["accounts"].withColumnRenamed("account_id", "account")
    reports = latest_report(
        tables["cost_reports"].filter(F.col("period_granularity").isin(*GRANULARITIES)),
        "account_id",
        "period_granularity",
    )
    ref = lambda df: df.withColumnRenamed("account_id", "id")
    return (
        accounts.join(ref(reports), "id", "left")
        .join(ref(service_metrics(tables["services"])), "id", "left")
        .join(ref(finding_totals(tables["security"])), "id", "left")
    )


def _full() -> Column:
    return account_full().alias("account_full")


def view_summary(tables: Tables, as_of, ordered: bool = True) -> DataFrame:
    """One row per account and granularity with cost, service and finding rollups."""
    products = tables["product_accounts"].groupBy(F.col("account_id").alias("id")).agg(
        F.countDistinct("product_id").alias("number_of_products")
    )
    rows = _account_rollups(tables).join(products, "id", "left")
    out = rows.select(
        F.col("id").alias("account_id"),
        "account",
        F.col("region").alias("account_region"),
        "account_name",
        "account_type",
        F.col("category").alias("account_category"),
        "account_status",
        F.col("partner_name").alias("account_partner"),
        F.col("customer_name").alias("account_customer"),
        F.concat(F.coalesce("account", F.lit("")), F.lit("-"), F.coalesce("account_name", F.lit(""))).alias(
            "account_full"
        ),
        F.col("csp").alias("account_csp"),
        F.coalesce("number_of_products", F.lit(0)).alias("number_of_products"),
        *_summary_columns(as_of),
    )
    return out.orderBy("account_name", F.desc_nulls_first("date_from")) if ordered else out


def view_product_summary(tables: Tables, as_of, ordered: bool = True) -> DataFrame:
    """As V36, one row per account, linked product and granularity."""
    links = tables["product_accounts"].select(F.col("account_id").alias("id"), F.col("product_id").alias("_pid"))
    details = tables["products"].select(
        F.col("id").alias("product_id"),
        F.col("name").alias("project_product_name"),
        F.col("owner").alias("product_owner"),
        F.col("position").alias("product_position"),
        F.col("description").alias("product_description"),
    )
    linked = links.join(details, F.col("_pid") == F.col("product_id"), "left").drop("_pid")
    out = (
        _account_rollups(tables)
        .join(linked, "id", "left")
        .select(
            F.col("id").alias("account_id"),
            "account",
            F.col("region").alias("account_region"),
            "account_name",
            F.concat(F.coalesce("account", F.lit("")), F.lit("-"), F.coalesce("account_name", F.lit(""))).alias(
                "account_full"
            ),
            "project_product_name",
            F.col("csp").alias("account_csp"),
            "account_type",
            F.col("category").alias("account_category"),
            "account_status",
            F.col("partner_name").alias("account_partner"),
            F.col("customer_name").alias("account_customer"),
            "product_id",
            "product_owner",
            "product_position",
            "product_description",
            *_summary_columns(as_of),
        )
    )
    order = ("account_name", "project_product_name", F.desc_nulls_first("date_from"))
    return out.orderBy(*order) if ordered else out


def view_service_resources_summary(tables: Tables) -> DataFrame:
    """Resource counts per account, service, type, region and zone; unmatched resources stay.

    Resources collapse to their group before the account join, so the join
    carries groups and not resources.
    """
    state = F.col("state")
    groups = (
        tables["service_resources"]
        .groupBy("account_id", "service_name", "resource_type", "region", "availability_zone")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(state.isin("running", "available", "Active")).alias("active"),
            F.count_if(state.isin("stopped", "Inactive")).alias("inactive"),
        )
        .withColumnRenamed("account_id", "_ref")
        .withColumnRenamed("region", "resource_region")
    )
    accounts = tables["accounts"].select(
        F.col("id").alias("_id"),
        "account_id",
        F.col("region").alias("account_region"),
        "account_name",
        "account_type",
        F.col("category").alias("account_category"),
        "account_status",
        F.col("partner_name").alias("account_partner"),
        F.col("customer_name").alias("account_customer"),
    )
    keys = [c for c in accounts.columns if c != "_id"] + [
        "service_name",
        "resource_type",
        "resource_region",
        "availability_zone",
    ]
    return (
        groups.join(accounts, F.col("_ref") == F.col("_id"), "left")
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("resource_count"),
            F.sum("active").alias("active_resources"),
            F.sum("inactive").alias("inactive_resources"),
        )
    )


def _security_score() -> Column:
    return (
        F.when(F.col("critical_count") > 0, 1)
        .when(F.col("high_count") > 0, 2)
        .when(F.col("medium_count") > 0, 3)
        .when(F.col("low_count") > 0, 4)
        .otherwise(5)
    )


def view_acct_summary(tables: Tables, scope: str = "global") -> DataFrame:
    """Account row with its latest cost, security and instance figures.

    ``scope='global'`` takes the single newest monthly report and the single
    newest security row of the whole table, so at most one account gets values.
    ``scope='account'`` takes the newest of each account.
    """
    monthly = tables["cost_reports"].filter(F.col("period_granularity") == "MONTHLY")
    cost_fields = ("current_period_cost", "cost_difference_percentage", "potential_monthly_savings")
    sec_fields = ("total_findings", "critical_count", "high_count", "medium_count", "low_count")
    if scope == "global":
        cost = monthly.orderBy(F.desc("period_end"), F.desc("period_start"), "account_id").limit(1)
        sec = tables["security"].orderBy(F.desc("created_at"), F.desc("id")).limit(1)
    elif scope == "account":
        cost = latest_report(monthly, "account_id")
        newest = F.max_by(F.struct(*sec_fields), F.struct("created_at", "id"))
        sec = tables["security"].groupBy("account_id").agg(newest.alias("_s")).select("account_id", "_s.*")
    else:
        raise ValueError(f"scope must be 'global' or 'account', not {scope!r}")
    ref = F.col("account_id").alias("_ref")
    instances = tables["inventory_instances"].groupBy(ref).agg(
        F.count(F.lit(1)).alias("instances"), F.count_if(F.col("ping_status") == "Online").alias("online")
    )
    accounts = tables["accounts"]
    owned = owning_product(tables["product_accounts"], tables["products"]).withColumnRenamed("account_id", "_ref")
    rows = accounts.withColumn("_ref", F.col("id"))
    for side in (owned, cost.select(ref, *cost_fields), sec.select(ref, *sec_fields), instances):
        rows = rows.join(side, "_ref", "left")
    zero = lambda c, out: F.coalesce(c, F.lit(0)).alias(out)
    return rows.select(
        *accounts.columns,
        F.col("account_id").alias("account"),
        F.col("region").alias("account_region"),
        F.col("category").alias("account_category"),
        F.col("partner_name").alias("account_partner"),
        F.col("customer_name").alias("account_customer"),
        _full(),
        "project_product_name",
        zero("current_period_cost", "latest_cost"),
        zero("cost_difference_percentage", "cost_trend_percentage"),
        zero("potential_monthly_savings", "savings_opportunity"),
        zero("total_findings", "security_findings"),
        zero("critical_count", "critical_findings"),
        zero("high_count", "high_findings"),
        zero("instances", "instance_count"),
        zero("online", "running_instances"),
        _security_score().alias("security_health_score"),
    )


def _first_present(labels: dict[str, str], otherwise: str) -> Column:
    """Label of the first count column above zero."""
    expr = F
    for column, label in labels.items():
        expr = expr.when(F.col(column) > 0, label)
    return expr.otherwise(otherwise)


def view_acct_security_findings_summary(tables: Tables) -> DataFrame:
    """Resolution rate, severity and risk label per security row."""
    dimension = account_dimension(tables["accounts"], tables["product_accounts"], tables["products"])
    counts = ("critical_count", "high_count", "medium_count", "low_count")
    severity = dict(zip((*counts, "informational_count"), ("CRITICAL", "HIGH", "MEDIUM", "LOW", "INFORMATIONAL")))
    risk = dict(zip(counts, ("Critical", "High", "Medium", "Low")))
    return enrich(tables["security"], dimension).select(
        *ACCOUNT_COLUMNS,
        "service",
        "total_findings",
        *counts,
        "informational_count",
        "open_findings",
        "resolved_findings",
        F.lit(0).alias("suppressed_count"),
        F.lit(0).alias("in_progress_count"),
        F.col("open_findings").alias("active_issues"),
        F.lit("N/A").alias("region_finding"),
        F.col("resolved_findings").alias("resolved_count"),
        _first_present(severity, "CLEAN").alias("severity"),
        ratio(F.col("resolved_findings"), F.col("total_findings"), 2, 100).alias("resolution_rate_percent"),
        _first_present(risk, "Clean").alias("risk_level"),
        "created_at",
        "updated_at",
    )


def view_compute_optimizer_summary(tables: Tables) -> DataFrame:
    """Savings per account, product, type and finding; unmatched recommendations stay.

    Means travel through the account-level pre-aggregate as sum and count.
    """
    saving = F.col("estimated_monthly_savings_usd")
    groups = (
        tables["compute_optimizer"]
        .groupBy(F.col("account_id").alias("_ref"), "resource_type", "finding")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(saving).alias("saving"),
            F.sum("savings_opportunity_percentage").alias("pct"),
            F.count("savings_opportunity_percentage").alias("pct_n"),
            F.sum("performance_risk").alias("risk"),
            F.count("performance_risk").alias("risk_n"),
            F.count_if(saving > 0).alias("with_saving"),
        )
    )
    dimension = account_dimension(tables["accounts"], tables["product_accounts"], tables["products"])
    joined = groups.join(dimension, F.col("_ref") == F.col("account_ref"), "left")
    mean = lambda total, n: F.try_divide(F.sum(total).cast("decimal(38,6)"), F.sum(n).cast("decimal(20,0)"))
    return joined.groupBy(*ACCOUNT_COLUMNS, "resource_type", "finding").agg(
        F.sum("n").alias("resource_count"),
        F.sum("saving").alias("total_monthly_savings"),
        mean("pct", "pct_n").alias("avg_savings_percentage"),
        mean("risk", "risk_n").alias("avg_performance_risk"),
        F.sum(F.when(F.col("finding") == "NotOptimized", F.col("n")).otherwise(0)).alias("not_optimized_count"),
        F.sum("with_saving").alias("savings_opportunities"),
    )


ALARM_SEVERITIES = ("Critical", "High", "Medium", "Low")


def view_executive_summary(tables: Tables, as_of, fanout: bool = True) -> DataFrame:
    """Firing alarms, active incidents, canary failures and today's errors per account.

    The reference joins four children before it counts, so alarm counts multiply
    by the number of matching incidents, canaries and errors.  With ``fanout``
    that product is computed from four per-account counts instead of the joined
    rows; without it the plain counts come out.
    """
    ref = F.col("account_id").alias("_ref")
    firing = F.col("state") == "ALARM"
    alarms = tables["alarms"].groupBy(ref).agg(
        *[
            F.count_if(firing & (F.col("severity") == s)).alias(f"_{s.lower()}")
            for s in ALARM_SEVERITIES
        ]
    )
    incidents = tables["incidents"].groupBy(ref).agg(
        F.count(F.lit(1)).alias("_inc"), F.count_if(F.col("status").isin("OPEN", "INVESTIGATING")).alias("_active")
    )
    canaries = tables["canaries"].groupBy(ref).agg(
        F.count(F.lit(1)).alias("_can"), F.count_if(F.col("status").isin("ERROR", "NOT_RUNNING")).alias("_failing")
    )
    today = tables["error_summaries"].filter(F.col("collection_date") == as_timestamp(as_of).cast("date"))
    # equal counts of one account merge, so they are deduplicated before the sum
    errors = (
        today.groupBy(ref, "occurrence_count")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("_ref")
        .agg(
            F.sum("n").alias("_err"),
            F.sum("occurrence_count").alias("_err_distinct"),
            F.sum(F.col("occurrence_count") * F.col("n")).alias("_err_all"),
        )
    )
    rows = account_dimension(tables["accounts"], tables["product_accounts"], tables["products"])
    rows = rows.withColumnRenamed("account_ref", "_ref")
    for side in (alarms, incidents, canaries, errors):
        rows = rows.join(side, "_ref", "left")
    times = F.lit(1)
    if fanout:
        for n in ("_inc", "_can", "_err"):
            times = times * F.greatest(F.coalesce(n, F.lit(0)), F.lit(1))
    return rows.select(
        F.col("_ref").alias("id"),
        *ACCOUNT_COLUMNS,
        *[
            (F.coalesce(f"_{s.lower()}", F.lit(0)) * times).alias(f"{s.lower()}_alarms")
            for s in ALARM_SEVERITIES
        ],
        F.coalesce("_active", F.lit(0)).alias("active_incidents"),
        F.coalesce("_failing", F.lit(0)).alias("canary_failures"),
        F.coalesce("_err_distinct" if fanout else "_err_all", F.lit(0)).alias("total_errors"),
    )


def latest_run(canary_runs: DataFrame) -> DataFrame:
    """Newest run per canary; equal times go to the higher id."""
    newest = F.max_by(F.struct("run_status", "run_at", "duration_ms"), F.struct("run_at", "id"))
    return canary_runs.groupBy("canary_id").agg(newest.alias("_run")).select("canary_id", "_run.*")


def canary_status(tables: Tables) -> DataFrame:
    """Each canary with its latest run and owning system."""
    accounts = tables["accounts"].select(F.col("id").alias("_ref"), F.col("account_id").alias("_account"))
    owned = owning_product(tables["product_accounts"], tables["products"]).withColumnRenamed("account_id", "_ref")
    runs = latest_run(tables["canary_runs"])
    canaries = tables["canaries"].withColumnRenamed("account_id", "_ref")
    return (
        canaries.join(accounts, "_ref")
        .join(owned, "_ref", "left")
        .join(runs, F.col("id") == F.col("canary_id"), "left")
        .select(
            "id",
            "canary_name",
            F.col("_account").alias("account_id"),
            F.col("project_product_name").alias("system_name"),
            F.col("run_status").alias("last_run_status"),
            F.col("run_at").alias("last_run_time"),
            F.col("success_percentage").alias("success_percent"),
            F.col("duration_ms").alias("avg_duration_ms"),
            F.col("status").alias("state"),
            "failure_reason",
            F.col("endpoint_url").alias("user_journey_description"),
            "updated_at",
        )
    )
