"""Enrichment views: a fact joined to its account and owning product.

One engine function and a registry describe all of them.  No join carries a
broadcast hint: Spark broadcasts the account dimension while its measured size
is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond that,
where adaptive execution splits a hot account.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.text import account_full
from fleetlens.operators.dims import ACCOUNT_COLUMNS, account_dimension, owning_product

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class View:
    """``fact`` reaches its account directly or through ``parent`` (joined on ``parent_ref``)."""

    fact: str
    parent: str | None = None
    parent_ref: str | None = None
    how: str = "inner"
    # parent column -> output name, appended after the account columns
    parent_columns: tuple[tuple[str, str], ...] = ()
    # fact column -> output name, appended after the account columns
    fact_copies: tuple[tuple[str, str], ...] = ()
    # the fact has its own account reference although a parent is joined
    account_on_fact: bool = False
    # output names that differ from the usual ones
    renamed: tuple[tuple[str, str], ...] = ()


_REPORT_DATES = (("period_start", "date_from"), ("period_end", "date_to"))

ENRICHED: dict[str, View] = {
    "view_contact_info": View("contact_info"),
    "view_alternate_contacts": View("alternate_contacts"),
    "view_acct_serv": View("services"),
    "view_acct_cost_rep": View("cost_reports", fact_copies=_REPORT_DATES),
    "view_acct_serv_cost": View("service_costs", "cost_reports", "cost_report_id", parent_columns=_REPORT_DATES),
    "view_acct_cost_rep_forecast": View(
        "cost_forecasts", "cost_reports", "cost_report_id", parent_columns=_REPORT_DATES
    ),
    "view_acct_security": View("security"),
    "view_acct_security_findings_details": View("findings", "security", "security_id"),
    "view_acct_logs": View("logs", renamed=(("account_status", "acct_status"),)),
    "view_acct_log_messages": View("log_messages", "logs", "log_id"),
    "view_config_reports": View("config_reports"),
    "view_non_compliant_resources": View("non_compliant_resources", "config_reports", "config_report_id"),
    "view_service_resources": View("service_resources"),
    "view_compute_optimizer": View("compute_optimizer", how="left"),
    "view_guard_duty_findings": View("guard_duty_findings"),
    "view_kms_keys": View("kms_keys"),
    "view_waf_rules": View("waf_rules"),
    "view_waf_rules_detailed": View("waf_rules_detailed"),
    "view_cloudtrail_logs": View("cloudtrail_logs"),
    "view_secrets_manager_secrets": View("secrets_manager_secrets"),
    "view_certificates": View("certificates"),
    "view_inspector_findings": View("inspector_findings"),
    "view_inventory_instances": View("inventory_instances"),
    "view_inventory_patches": View(
        "inventory_patches",
        "inventory_instances",
        "instance_id",
        parent_columns=(("instance_id", "instance_name"), ("instance_type", "instance_type")),
        account_on_fact=True,
    ),
    "view_marketplace_usage": View("marketplace_usage"),
    "view_trusted_advisor_checks": View("trusted_advisor_checks"),
    "view_health_events": View("health_events"),
    "view_application_signals": View("application_signals"),
    "view_resilience_hub_apps": View("resilience_hub_apps"),
    "view_acct_support_tickets": View("support_tickets"),
    "view_ri_sp_daily_savings": View("ri_sp_daily_savings"),
    "view_alarms": View("alarms"),
    "view_canaries": View("canaries"),
    "view_incidents": View("incidents"),
    "view_error_summaries": View("error_summaries"),
    "view_db_insights": View("db_insights"),
}


def enrich(fact: DataFrame, dimension: DataFrame, account_ref: str = "account_id", how: str = "inner") -> DataFrame:
    """Attach the account columns; ``how='left'`` keeps unmatched facts."""
    clash = [c for c in fact.columns if c in ACCOUNT_COLUMNS]
    kept = dimension.drop(*clash) if clash else dimension
    joined = fact.join(kept, F.col(account_ref) == F.col("account_ref"), how)
    return joined.select(*fact.columns, *[c for c in ACCOUNT_COLUMNS if c not in clash])


def enrich_via_parent(
    child: DataFrame,
    parent: DataFrame,
    parent_ref: str,
    dimension: DataFrame,
    parent_columns: tuple[tuple[str, str], ...] = (),
    account_on_child: bool = False,
) -> DataFrame:
    """Reach the account through the child's parent row."""
    wanted = [F.col("id").alias("_parent_id")]
    if not account_on_child:
        wanted.append(F.col("account_id").alias("_account_ref"))
    wanted += [F.col(src).alias(f"_p_{out}") for src, out in parent_columns]
    joined = child.join(parent.select(*wanted), F.col(parent_ref) == F.col("_parent_id"))
    ref = "account_id" if account_on_child else "_account_ref"
    return enrich(joined, dimension, ref).select(
        *child.columns,
        *[c for c in ACCOUNT_COLUMNS if c not in child.columns],
        *[F.col(f"_p_{out}").alias(out) for _, out in parent_columns],
    )


def _dimension(tables: Tables) -> DataFrame:
    return account_dimension(tables["accounts"], tables["product_accounts"], tables["products"])


def enriched_view(name: str, tables: Tables) -> DataFrame:
    """Any view of the registry."""
    spec = ENRICHED[name]
    dimension = _dimension(tables)
    fact = tables[spec.fact]
    if spec.parent:
        return enrich_via_parent(
            fact, tables[spec.parent], spec.parent_ref, dimension, spec.parent_columns, spec.account_on_fact
        )
    if not spec.renamed:
        out = enrich(fact, dimension, how=spec.how)
        return out.select("*", *[F.col(src).alias(alias) for src, alias in spec.fact_copies])
    # The fact owns a column of the same name; the account's goes out under another one.
    for old, new in spec.renamed:
        dimension = dimension.withColumnRenamed(old, new)
    names = [dict(spec.renamed).get(c, c) for c in ACCOUNT_COLUMNS]
    joined = fact.join(dimension, F.col("account_id") == F.col("account_ref"))
    return joined.select(*fact.columns, *names)


def view_accounts(tables: Tables) -> DataFrame:
    """V1: accounts with their aliases and first product."""
    owned = owning_product(tables["product_accounts"], tables["products"])
    owned = owned.withColumnRenamed("account_id", "_ref")
    accounts = tables["accounts"]
    return accounts.join(owned, accounts["id"] == owned["_ref"], "left").select(
        *accounts.columns,
        F.col("account_id").alias("account"),
        F.col("category").alias("account_category"),
        F.col("partner_name").alias("account_partner"),
        F.col("customer_name").alias("account_customer"),
        account_full().alias("account_full"),
        "project_product_name",
    )


def view_products(tables: Tables) -> DataFrame:
    """Products alone, account columns null."""
    empty: list[Column] = [F.lit(None).cast("string").alias(c) for c in ACCOUNT_COLUMNS[:-1]]
    return tables["products"].select("*", *empty, F.col("name").alias("project_product_name"))


def view_product_acct(tables: Tables) -> DataFrame:
    """Every link with its account and its own product."""
    links = tables["product_accounts"]
    own = tables["products"].select(F.col("id").alias("_pid"), F.col("name").alias("project_product_name"))
    dimension = _dimension(tables).drop("project_product_name")
    return (
        links.join(dimension, F.col("account_id") == F.col("account_ref"))
        .join(own, F.col("product_id") == F.col("_pid"))
        .select(*links.columns, *ACCOUNT_COLUMNS)
    )


def view_acct_products(tables: Tables) -> DataFrame:
    """Product rows per linked account; the project name is that account's first product."""
    products = tables["products"]
    links = tables["product_accounts"].select("product_id", F.col("account_id").alias("_ref"))
    return (
        links.join(_dimension(tables), F.col("_ref") == F.col("account_ref"))
        .join(products, F.col("product_id") == F.col("id"))
        .select(*products.columns, *ACCOUNT_COLUMNS)
    )


def view_inventory_applications(tables: Tables) -> DataFrame:
    """Application name with the prefixed columns of its instance."""
    instances = tables["inventory_instances"]
    prefixed = [
        F.col(c).alias(f"ii_{c}" if c in ("id", "account_id", "instance_id", "created_at") else c)
        for c in instances.columns
    ]
    apps = tables["inventory_applications"].select(
        "name", F.col("instance_id").alias("_instance"), F.col("account_id").alias("_ref")
    )
    joined = apps.join(instances.select(*prefixed), F.col("_instance") == F.col("ii_id"))
    out = enrich(joined, _dimension(tables), "_ref")
    return out.drop("_instance", "_ref")
