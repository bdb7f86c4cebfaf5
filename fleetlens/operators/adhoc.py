"""Documented ad-hoc reports over the views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.operators.enrich import Tables, enriched_view
from fleetlens.operators.rollups import view_summary


def account_costs(tables: Tables, as_of) -> DataFrame:
    """A1: monthly cost per account, dearest first."""
    return (
        view_summary(tables, as_of, ordered=False)
        .filter(F.col("period_granularity") == "MONTHLY")
        .select("account_full", "current_period_cost", "cost_difference_percentage", "potential_savings")
        .orderBy(F.desc("current_period_cost"))
    )


def critical_findings(tables: Tables) -> DataFrame:
    """A2: active critical findings, newest first."""
    return (
        enriched_view("view_acct_security_findings_details", tables)
        .filter((F.col("severity") == "CRITICAL") & (F.col("status") == "ACTIVE"))
        .orderBy(F.desc("created_at"))
        .select("account_name", "service", "title", "severity", "resource_type")
    )


def savings_opportunities(tables: Tables, above: int = 10) -> DataFrame:
    """A3: recommendations not yet taken that save more than ``above``, largest first."""
    return (
        enriched_view("view_compute_optimizer", tables)
        .filter((F.col("finding") == "NotOptimized") & (F.col("estimated_monthly_savings_usd") > above))
        .select("account_name", "resource_type", "finding", "estimated_monthly_savings_usd", "performance_risk")
        .orderBy(F.desc("estimated_monthly_savings_usd"))
    )


def missing_patches(tables: Tables) -> DataFrame:
    """A4: missing patches per account and instance, most critical first."""
    return (
        enriched_view("view_inventory_patches", tables)
        .filter(F.col("state") == "Missing")
        .groupBy("account_name", "instance_name")
        .agg(
            F.count(F.lit(1)).alias("missing_patches"),
            F.count_if(F.col("severity") == "Critical").alias("critical_patches"),
        )
        .orderBy(F.desc("critical_patches"))
    )


def load_status(logs: DataFrame) -> DataFrame:
    """A5: section status of every load, newest first."""
    return logs.orderBy(F.desc("date_created")).select(
        "account_id", "account_status", "cost_status", "security_status"
    )


def load_errors(log_messages: DataFrame) -> DataFrame:
    """A5: error messages of the loads."""
    return log_messages.filter(F.col("message_type") == "ERROR").select("message", "message_type", "created_at")


def system_accounts(products: DataFrame, links: DataFrame, accounts: DataFrame) -> DataFrame:
    """Systems and their accounts by system name."""
    named = products.select(F.col("id").alias("product_id"), F.col("name").alias("system_name"))
    numbers = accounts.select(F.col("id").alias("_ref"), F.col("account_id").alias("number"))
    return (
        links.join(named, "product_id")
        .join(numbers, F.col("account_id") == F.col("_ref"))
        .select("system_name", F.col("number").alias("account_id"))
        .orderBy("system_name")
    )
