"""System health: per-product rollups, penalty score, bands and card labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.timecalc import as_timestamp
from fleetlens.operators.enrich import Tables

# Points lost per active problem.
DEFAULT_WEIGHTS = {
    "alarm_firing": 20,
    "finding_critical": 20,
    "finding_high": 5,
    "finding_medium": 1,
    "canary_down": 20,
}

# Resource states that count as unhealthy, compared in lower case.
UNHEALTHY_STATES = (
    "stopped",
    "stopping",
    "terminated",
    "terminating",
    "shutting-down",
    "failed",
    "error",
    "impaired",
    "unhealthy",
    "deleting",
    "deleted",
    "inactive",
    "disabled",
    "unavailable",
    "degraded",
    "insufficient-data",
)


def systems(products: DataFrame, links: DataFrame, accounts: DataFrame) -> DataFrame:
    """H1: products with at least one account and their representative account."""
    named = accounts.select(F.col("id").alias("account_id"), F.col("account_id").alias("_account"))
    reps = links.join(named, "account_id").groupBy("product_id").agg(F.min("_account").alias("account_id"))
    names = products.select(F.col("id").alias("product_id"), F.col("name").alias("system_name"))
    return names.join(reps, "product_id").select("product_id", "system_name", "account_id")


# Per-account partials.  Every figure is additive, so an account that belongs to
# several products counts fully in each after the join to the links.


def _alarm_partial(alarms: DataFrame) -> DataFrame:
    state = F.col("state")
    return alarms.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("alarm_total"),
        F.count_if(state == "OK").alias("alarm_ok"),
        F.count_if(state == "INSUFFICIENT_DATA").alias("alarm_warning"),
        F.count_if(state == "ALARM").alias("alarm_critical"),
    )


def _finding_partial(security: DataFrame) -> DataFrame:
    return security.groupBy("account_id").agg(
        *[F.sum(f"{s}_count").alias(f"security_findings_{s}") for s in ("critical", "high", "medium")]
    )


def _canary_partial(canaries: DataFrame) -> DataFrame:
    passing = (F.col("status") == "RUNNING") & (F.coalesce("success_percentage", F.lit(0)) >= 100)
    return canaries.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("canary_total"), F.count_if(passing).alias("canary_passing")
    )


def _resource_partial(resources: DataFrame) -> DataFrame:
    healthy = F.col("state").isNull() | ~F.lower("state").isin(*UNHEALTHY_STATES)
    return resources.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("resource_total"), F.count_if(healthy).alias("resource_healthy")
    )


def _cost_partial(cost_reports: DataFrame) -> DataFrame:
    newest = F.max_by(
        F.struct("current_period_cost", "cost_difference_percentage"),
        F.struct("period_end", "period_start", "region"),
    )
    latest = (
        cost_reports.filter(F.col("period_granularity") == "MONTHLY")
        .groupBy("account_id")
        .agg(newest.alias("_r"))
    )
    return latest.select(
        "account_id",
        F.col("_r.current_period_cost").alias("monthly_cost"),
        F.col("_r.cost_difference_percentage").alias("trend_sum"),
    )


_PARTIALS = {
    "alarms": (_alarm_partial, ("alarm_total", "alarm_ok", "alarm_warning", "alarm_critical")),
    "security": (
        _finding_partial,
        ("security_findings_critical", "security_findings_high", "security_findings_medium"),
    ),
    "canaries": (_canary_partial, ("canary_total", "canary_passing")),
    "service_resources": (_resource_partial, ("resource_total", "resource_healthy")),
    "cost_reports": (_cost_partial, ("monthly_cost", "trend_sum")),
}


def _by_product(partial: DataFrame, links: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    pairs = links.select("product_id", "account_id")
    return (
        pairs.join(partial, "account_id")
        .groupBy("product_id")
        .agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
    )


def _rollup(source: str, df: DataFrame, links: DataFrame) -> DataFrame:
    partial, measures = _PARTIALS[source]
    return _by_product(partial(df), links, measures)


def alarm_health(alarms: DataFrame, links: DataFrame) -> DataFrame:
    """H2: alarm counts by state per product."""
    return _rollup("alarms", alarms, links)


def finding_health(security: DataFrame, links: DataFrame) -> DataFrame:
    """H3: critical, high and medium findings per product."""
    return _rollup("security", security, links)


def canary_health(canaries: DataFrame, links: DataFrame) -> DataFrame:
    """H4: canaries and passing canaries per product."""
    return _rollup("canaries", canaries, links)


def resource_health(resources: DataFrame, links: DataFrame) -> DataFrame:
    """H5: resources and healthy resources per product; no state counts as healthy."""
    return _rollup("service_resources", resources, links)


def _trend(total: Column) -> Column:
    # the sign of a mean is the sign of its sum
    return F.when(total > 0, "up").when(total < 0, "down").otherwise("flat")


def cost_health(cost_reports: DataFrame, links: DataFrame) -> DataFrame:
    """H6: latest monthly cost summed per product and the direction of its mean change."""
    rolled = _rollup("cost_reports", cost_reports, links)
    return rolled.select("product_id", "monthly_cost", _trend(F.col("trend_sum")).alias("cost_trend"))


def _n(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def health_score(weights: dict[str, int] | None = None) -> Column:
    """H7: 100 minus the penalties, not below 0; any weight may be overridden."""
    unknown = set(weights or {}) - set(DEFAULT_WEIGHTS)
    if unknown:
        raise ValueError(f"unknown weights: {sorted(unknown)}")
    w = {**DEFAULT_WEIGHTS, **(weights or {})}
    lost = (
        F.lit(w["alarm_firing"]) * _n("alarm_critical")
        + F.lit(w["finding_critical"]) * _n("security_findings_critical")
        + F.lit(w["finding_high"]) * _n("security_findings_high")
        + F.lit(w["finding_medium"]) * _n("security_findings_medium")
        + F.lit(w["canary_down"]) * (_n("canary_total") - _n("canary_passing"))
    )
    return F.greatest(F.lit(0), F.lit(100) - lost)


def check_counts() -> tuple[Column, Column]:
    """H8: (total, passing) checks: judged alarms, canaries and one per finding class present."""
    total = _n("alarm_ok") + _n("alarm_critical") + _n("canary_total")
    for severity in ("critical", "high", "medium"):
        total = total + (_n(f"security_findings_{severity}") > 0).cast("int")
    return total, _n("alarm_ok") + _n("canary_passing")


def health_band(score: Column) -> Column:
    """H9: band word."""
    return F.when(score >= 90, "Healthy").when(score >= 70, "Degraded").otherwise("Unhealthy")


def health_icon(score: Column) -> Column:
    """H9: five-dot icon; marks at 90, 75, 60 and 40."""
    filled = 1 + sum((score >= mark).cast("int") for mark in (90, 75, 60, 40))
    return F.concat(F.repeat(F.lit("●"), filled), F.repeat(F.lit("○"), F.lit(5) - filled))


def availability_label() -> Column:
    """Canary availability; no canaries reads ``0/0 UP``."""
    total, passing = _n("canary_total"), _n("canary_passing")
    return (
        F.when(passing == total, F.format_string("🟢 %d/%d UP", passing, total))
        .when(passing > 0, F.format_string("🟡 %d/%d DEGRADED", passing, total))
        .otherwise(F.format_string("🔴 0/%d", total))
    )


def alert_line_1() -> Column:
    """Firing alarms, else critical findings, else clear."""
    firing, critical = _n("alarm_critical"), _n("security_findings_critical")
    return (
        F.when(firing > 0, F.format_string("🔴 %d CRIT", firing))
        .when(critical > 0, F.format_string("🔴 %d CRIT", critical))
        .otherwise("🟢 Clear")
    )


def alert_line_2() -> Column:
    """High findings, else medium, else alarms without data, else a dash."""
    high, medium = _n("security_findings_high"), _n("security_findings_medium")
    no_data = _n("alarm_warning")
    return (
        F.when(high > 0, F.format_string("🟡 %d HIGH", high))
        .when(medium > 0, F.format_string("🟡 %d MED", medium))
        .when(no_data > 0, F.format_string("🟡 %d NO DATA", no_data))
        .otherwise("-")
    )


def system_health_overview(tables: Tables, as_of, weights: dict[str, int] | None = None) -> DataFrame:
    """One row per system with its rollups, score and check counts.

    The five facts shrink to per-account partials, meet in one union, and reach
    products through a single join and a single aggregate.
    """
    parts = [partial(tables[name]) for name, (partial, _) in _PARTIALS.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    measures = tuple(m for _, names in _PARTIALS.values() for m in names)
    rolled = _by_product(union, tables["product_accounts"], measures)
    base = systems(tables["products"], tables["product_accounts"], tables["accounts"])
    total, passing = check_counts()
    return base.join(rolled, "product_id", "left").select(
        F.col("product_id").alias("id"),
        "system_name",
        "account_id",
        total.alias("total_checks"),
        passing.alias("passing_checks"),
        health_score(weights).alias("health_percentage"),
        *[_n(c).alias(c) for c in _PARTIALS["alarms"][1]],
        *[_n(c).alias(c) for c in _PARTIALS["security"][1]],
        _n("resource_total").alias("resource_total"),
        _n("resource_healthy").alias("resource_healthy"),
        _n("resource_total").alias("performance_total"),
        _n("resource_healthy").alias("performance_healthy"),
        _n("monthly_cost").alias("monthly_cost"),
        F.coalesce(_trend(F.col("trend_sum")), F.lit("flat")).alias("cost_trend"),
        as_timestamp(as_of).alias("last_updated"),
        _n("canary_total").alias("canary_total"),
        _n("canary_passing").alias("canary_passing"),
    )


def health_cards(overview: DataFrame) -> DataFrame:
    """H9 + H10 for each system of the overview."""
    score = F.col("health_percentage")
    return overview.select(
        "id",
        "system_name",
        "health_percentage",
        health_band(score).alias("health_score_label"),
        health_icon(score).alias("health_status_icon"),
        availability_label().alias("service_availability"),
        alert_line_1().alias("alert_line_1"),
        alert_line_2().alias("alert_line_2"),
    )
