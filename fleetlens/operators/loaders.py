"""Section loaders: payload documents to base tables.

``updates_for`` turns the valid documents into keyed update rows of one table;
``load_tables`` resolves references and upserts.  Children find their parent
through its natural key, so no per-row lookups happen.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.casting import cast_text
from fleetlens.functions.stitched import running_max
from fleetlens.functions.timecalc import as_timestamp, minutes_between
from fleetlens.operators.upsert import row_id, replace_links, upsert, upsert_stats
from fleetlens.schemas import TABLES
from fleetlens.session import shared_dir
from fleetlens.sources.payloads import (
    ORDER,
    explode_children,
    explode_section,
    loaded_columns,
    project_cast,
    text_fields,
)
from fleetlens.sources.store import TableStore
from fleetlens.sources.versions import remove

# Stand-ins for account fields that are null in a document.
ACCOUNT_DEFAULTS = {
    "account_name": "Unknown",
    "account_email": "unknown@example.com",
    "account_status": "ACTIVE",
    "joined_method": "CREATED",
    "csp": "AWS",
    "account_type": "PRODUCTION",
    "joined_timestamp": "1970-01-01T00:00:00Z",
}


def _plain(path: str, table: str, renames=None, **nested: str) -> Callable[[DataFrame], DataFrame]:
    """Loader of a section whose records are the table's rows."""
    renames = renames or {}
    names = [renames.get(c, c) for c in loaded_columns(table)]

    def load(payloads: DataFrame) -> DataFrame:
        return project_cast(explode_section(payloads, path, text_fields(*names, **nested)), table, renames)

    return load


# L1 ------------------------------------------------------------------------


def account_updates(payloads: DataFrame) -> DataFrame:
    """Accounts; null fields take their stand-in, four optional ones keep what they say."""
    names = [c for c in TABLES["accounts"].columns if c not in ("id", "csp", "created_at", "updated_at")]
    rows = explode_section(payloads, "account", text_fields(*names))
    arn = F.concat(F.lit("arn:aws:organizations::"), F.col("account_id"), F.lit(":account"))
    filled = rows.withColumns(
        {
            "account_arn": F.coalesce("account_arn", arn),
            "csp": F.lit("AWS"),
            **{c: F.coalesce(c, F.lit(ACCOUNT_DEFAULTS[c])) for c in names if c in ACCOUNT_DEFAULTS},
            **{c: F.coalesce(c, F.lit("")) for c in ("category", "customer_name", "partner_name", "region")},
        }
    )
    return project_cast(filled, "accounts", columns=[*names, "csp"])


_CONTACT_FIELDS = [c for c in loaded_columns("contact_info")]


def contact_updates(payloads: DataFrame) -> DataFrame:
    """Contact of an account; skipped when every field is null."""
    rows = explode_section(payloads, "account.contact_info", text_fields(*_CONTACT_FIELDS))
    any_value = F.coalesce(*[F.col(c) for c in _CONTACT_FIELDS]).isNotNull()
    return project_cast(rows.filter(any_value), "contact_info")


def alternate_contact_updates(payloads: DataFrame) -> DataFrame:
    """One row per contact type; the phone number is not stored."""
    person = "struct<name: string, title: string, email: string>"
    rows = payloads.select(
        "_path",
        "_date",
        "_account",
        "_region",
        F.explode(
            F.map_entries(F.from_json(F.get_json_object("account", "$.alternate_contacts"), f"map<string, {person}>"))
        ).alias("_entry"),
    ).filter(F.col("_entry.value").isNotNull())
    named = rows.select(
        "_path",
        "_date",
        "_account",
        "_region",
        F.lit(0).alias("_pos"),
        F.col("_entry.key").alias("contact_type"),
        F.col("_entry.value.name").alias("full_name"),
        F.col("_entry.value.title").alias("title"),
        F.col("_entry.value.email").alias("email"),
    )
    return project_cast(named, "alternate_contacts", columns=["contact_type", "full_name", "title", "email"])


# L2 ------------------------------------------------------------------------


def product_mentions(payloads: DataFrame) -> DataFrame:
    """One row per product named by a document, in list order."""
    listed = F.split(F.get_json_object("account", "$.product"), ",")
    names = F.filter(F.transform(listed, lambda n: F.trim(n)), lambda n: n != "")
    return payloads.select("_path", "_date", "_account", "_region", F.posexplode(names).alias("_pos", "name"))


def product_updates(payloads: DataFrame) -> DataFrame:
    """Products by lower-case name; the newest spelling is stored."""
    return product_mentions(payloads).select(
        *ORDER, F.lower("name").alias("_lname"), "name", F.lit("System").alias("owner")
    )


def current_links(payloads: DataFrame) -> DataFrame:
    """(account, region, lower-case product) of each account's newest non-empty list."""
    listed = payloads.withColumn("_list", F.get_json_object("account", "$.product"))
    names = F.array_distinct(
        F.filter(F.transform(F.split("_list", ","), lambda n: F.lower(F.trim(n))), lambda n: n != "")
    )
    newest = (
        listed.withColumn("_names", names)
        .filter(F.size("_names") > 0)
        .groupBy("_account", "_region")
        .agg(F.max_by("_names", F.struct("_date", "_path")).alias("_names"))
    )
    return newest.select("_account", "_region", F.explode("_names").alias("_lname"))


# L3 ------------------------------------------------------------------------

_EVALUATION = (
    "array<struct<rule_name: string, resource_id: string, resource_type: string, config_rule_invoked_time: string, "
    "conformance_pack: string, compliance_type: string, annotation: string, evaluation_mode: string>>"
)


def config_report_updates(payloads: DataFrame) -> DataFrame:
    return project_cast(
        explode_section(payloads, "config", text_fields(*loaded_columns("config_reports"))), "config_reports"
    ).filter(F.col("date_from").isNotNull())


def non_compliant_updates(payloads: DataFrame) -> DataFrame:
    """Evaluated resources of a report; the rule's invocation time becomes the creation time."""
    reports = explode_section(payloads, "config", text_fields("date_from", non_compliant_resources=_EVALUATION))
    rows = explode_children(reports, "non_compliant_resources", {"date_from": "_p_date_from"})
    columns = [c for c in loaded_columns("non_compliant_resources") if c != "status"] + ["created_at"]
    return project_cast(
        rows,
        "non_compliant_resources",
        {"created_at": "config_rule_invoked_time"},
        columns=columns,
        extra={"_p_date_from": F.try_to_timestamp("_p_date_from").cast("date")},
    )


# L5 ------------------------------------------------------------------------

_PERIOD = "struct<start: string, end: string, granularity: string>"


def _cost_records(payloads: DataFrame) -> DataFrame:
    numbers = [c for c in loaded_columns("cost_reports") if not c.startswith("period") and c != "region"]
    rows = explode_section(
        payloads,
        "cost",
        text_fields(
            *numbers,
            period=_PERIOD,
            top_services="array<struct<service: string, cost: string>>",
            forecast=f"array<struct<period: {_PERIOD}, amount: string>>",
        ),
    )
    return rows.withColumns(
        {
            "period_start": F.col("period.start"),
            "period_end": F.col("period.end"),
            "period_granularity": F.col("period.granularity"),
        }
    )


def cost_report_updates(payloads: DataFrame) -> DataFrame:
    """Cost reports; the billing source is global, so the region is fixed."""
    out = project_cast(_cost_records(payloads), "cost_reports", constants={"region": "Global"})
    return out.filter(F.col("period_start").isNotNull())


def _report_key() -> dict:
    return {"_p_period_start": F.try_to_timestamp("_p_period_start").cast("date"), "_p_region": F.lit("Global")}


def service_cost_updates(payloads: DataFrame) -> DataFrame:
    rows = explode_children(_cost_records(payloads), "top_services", {"period_start": "_p_period_start"})
    return project_cast(
        rows, "service_costs", {"service_name": "service"}, {"region": "Global"}, extra=_report_key()
    )


def cost_forecast_updates(payloads: DataFrame) -> DataFrame:
    rows = explode_children(_cost_records(payloads), "forecast", {"period_start": "_p_period_start"})
    flat = rows.withColumns({"period_start": F.col("period.start"), "period_end": F.col("period.end")})
    return project_cast(
        flat,
        "cost_forecasts",
        constants={"region": "Global"},
        columns=["period_start", "period_end", "amount", "region"],
        extra=_report_key(),
    )


# L6 ------------------------------------------------------------------------

_SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW", "INFORMATIONAL")


def security_updates(payloads: DataFrame) -> DataFrame:
    """Finding summary per service; missing counts are zero."""
    counts = "struct<" + ", ".join(f"{s}: string" for s in _SEVERITIES) + ">"
    totals = ("total_findings", "open_findings", "resolved_findings")
    rows = explode_section(
        payloads, "security.security_hub", text_fields("service", *totals, severity_counts=counts)
    )
    filled = rows.withColumns(
        {
            **{c: F.coalesce(c, F.lit("0")) for c in totals},
            **{f"{s.lower()}_count": F.coalesce(f"severity_counts.{s}", F.lit("0")) for s in _SEVERITIES},
        }
    )
    return project_cast(filled, "security")


def finding_updates(payloads: DataFrame) -> DataFrame:
    columns = [c for c in TABLES["findings"].columns if c not in ("id", "security_id")]
    finding = "array<struct<" + ", ".join(f"`{c}`: string" for c in columns) + ">>"
    hubs = explode_section(payloads, "security.security_hub", text_fields("service", findings=finding))
    rows = explode_children(hubs, "findings", {"service": "_p_service"})
    return project_cast(rows, "findings", columns=columns, extra={"_p_service": F.col("_p_service")})


# L7 ------------------------------------------------------------------------


def _installed(part: str, table: str) -> Callable[[DataFrame], DataFrame]:
    """Applications or patches, each tied to the instance its own record names."""
    columns = [c for c in loaded_columns(table) if c != "instance_id"]

    def load(payloads: DataFrame) -> DataFrame:
        rows = explode_section(payloads, f"inventory.{part}", text_fields("instance_id", *columns))
        return project_cast(rows, table, columns=columns, extra={"_p_instance_id": F.col("instance_id")})

    return load


# L18 -----------------------------------------------------------------------

_LOG_FIELDS = [c for c in loaded_columns("logs")]


def log_updates(payloads: DataFrame, as_of) -> DataFrame:
    """Load logs; a log without a creation time gets the load time."""
    out = project_cast(explode_section(payloads, "logs", text_fields(*_LOG_FIELDS)), "logs")
    return out.withColumn("date_created", F.coalesce("date_created", as_timestamp(as_of)))


def log_message_updates(payloads: DataFrame, as_of, stored_logs: DataFrame | None = None) -> DataFrame:
    """Messages keyed by their log: plain text has type INFO, an object gives one row per key.

    Messages hang on the account's newest log at the time the document applies:
    its own unless a newer one came earlier.  The running maximum works on one
    row per document and is split by month.
    """
    rows = explode_section(payloads, "logs", text_fields("date_created", message="string"))
    text = F.col("message")
    first = F.substring(F.trim(text), 1, 1)
    items = (
        F.when(first == "[", F.from_json(text, "array<string>"))
        .when(F.coalesce(text, F.lit("")) != "", F.array(text))
        .otherwise(F.array().cast("array<string>"))
    )
    own = F.coalesce(cast_text(F.col("date_created"), TABLES["logs"].columns["date_created"]), as_timestamp(as_of))
    logs = rows.withColumns({"_own": own, "_items": items}).drop("message", "date_created")
    placed = running_max(
        logs, ["_account", "_region"], ["_date", "_path", "_pos"], F.date_trunc("month", F.col("_date")), "_own", "_log"
    )
    if stored_logs is not None:
        top = stored_logs.groupBy("_account", "_region").agg(F.max("date_created").alias("_stored"))
        placed = placed.join(top, ["_account", "_region"], "left").withColumn("_log", F.greatest("_log", "_stored"))
    item = placed.select(
        "_path", "_date", "_account", "_region", F.col("_log").alias("_p_date_created"), F.posexplode("_items")
    )
    as_map = F.when(F.substring(F.trim("col"), 1, 1) == "{", F.from_json("col", "map<string,string>"))
    pairs = F.coalesce(as_map, F.create_map(F.lit("INFO"), F.col("col")))
    return item.select(
        "_path",
        "_date",
        "_account",
        "_region",
        "_p_date_created",
        F.col("pos").alias("_item"),
        F.posexplode(pairs).alias("_key_no", "message_type", "message"),
    ).select(
        "_path",
        "_date",
        "_account",
        "_region",
        F.struct("_item", "_key_no").alias("_pos"),
        "message",
        "message_type",
        "_p_date_created",
    )


# L19 - L23 -----------------------------------------------------------------


def alarm_updates(payloads: DataFrame) -> DataFrame:
    """Alarms; without a severity a load puts it back to Medium."""
    names = loaded_columns("alarms")
    rows = explode_section(payloads, "alarms", text_fields(*names))
    return project_cast(rows.withColumn("severity", F.coalesce("severity", F.lit("Medium"))), "alarms")


def _nested(section: str, child: str, table: str, parent_key: str) -> Callable[[DataFrame], DataFrame]:
    names = loaded_columns(table)
    kind = "array<struct<" + ", ".join(f"`{c}`: string" for c in names) + ">>"

    def load(payloads: DataFrame) -> DataFrame:
        parents = explode_section(payloads, section, text_fields(parent_key, **{child: kind}))
        rows = explode_children(parents, child, {parent_key: f"_p_{parent_key}"})
        extra = {f"_p_{parent_key}": F.col(f"_p_{parent_key}")}
        return project_cast(rows, table, columns=names, extra=extra)

    return load


def error_updates(payloads: DataFrame) -> DataFrame:
    out = _plain("error_logs", "error_summaries")(payloads)
    return out.withColumn("occurrence_count", F.coalesce("occurrence_count", F.lit(0)))


def db_insight_updates(payloads: DataFrame) -> DataFrame:
    out = _plain("db_insights", "db_insights")(payloads)
    return out.withColumn("insights_enabled", F.coalesce("insights_enabled", F.lit(True)))


def db_event_updates(payloads: DataFrame) -> DataFrame:
    names = loaded_columns("db_events")
    kind = "array<struct<" + ", ".join(f"`{c}`: string" for c in names) + ">>"
    parents = explode_section(payloads, "db_insights", text_fields("instance_identifier", events=kind))
    return project_cast(explode_children(parents, "events", {}), "db_events", columns=names)


def _incident_records(payloads: DataFrame) -> DataFrame:
    fields = [c for c in loaded_columns("incidents") if c != "resolution_duration_minutes"]
    return explode_section(payloads, "incidents", text_fields(*fields))


def _complete() -> F.Column:
    present = [F.coalesce(c, F.lit("")) != "" for c in ("severity", "title", "start_time")]
    return present[0] & present[1] & present[2]


def incident_updates(payloads: DataFrame) -> DataFrame:
    """Incidents with severity, title and start; resolved ones get their duration."""
    rows = _incident_records(payloads).filter(_complete())
    rows = rows.withColumn("status", F.coalesce("status", F.lit("OPEN")))
    out = project_cast(rows, "incidents")
    resolved = (F.col("status") == "RESOLVED") & F.col("resolution_time").isNotNull()
    return out.withColumn(
        "resolution_duration_minutes", F.when(resolved, minutes_between(F.col("start_time"), F.col("resolution_time")))
    )


def skipped_incidents(payloads: DataFrame) -> DataFrame:
    return _incident_records(payloads).filter(~_complete())


# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Load:
    """How one table is loaded.  ``parent`` is (table, reference column, parent key columns)."""

    table: str
    updates: Callable[..., DataFrame]
    parent: tuple[str, str, tuple[str, ...]] | None = None


def _loads() -> dict[str, Load]:
    report = ("cost_reports", "cost_report_id", ("period_start", "region"))
    loads = [
        Load("contact_info", contact_updates),
        Load("alternate_contacts", alternate_contact_updates),
        Load("config_reports", config_report_updates),
        Load(
            "non_compliant_resources",
            non_compliant_updates,
            ("config_reports", "config_report_id", ("date_from",)),
        ),
        Load("services", _plain("service", "services")),
        Load("cost_reports", cost_report_updates),
        Load("service_costs", service_cost_updates, report),
        Load("cost_forecasts", cost_forecast_updates, report),
        Load("security", security_updates),
        Load("findings", finding_updates, ("security", "security_id", ("service",))),
        Load(
            "guard_duty_findings",
            _plain("security.guard_duty", "guard_duty_findings", {"detector_id": "id", "finding_type": "type"}),
        ),
        Load("kms_keys", _plain("security.kms", "kms_keys")),
        Load("waf_rules", _plain("security.waf", "waf_rules", {"waf_id": "id"})),
        Load("waf_rules_detailed", _plain("security.waf_rules", "waf_rules_detailed")),
        Load("cloudtrail_logs", _plain("security.cloudtrail", "cloudtrail_logs")),
        Load("secrets_manager_secrets", _plain("security.secrets_manager", "secrets_manager_secrets")),
        Load("certificates", _plain("security.certificate_manager", "certificates")),
        Load("inspector_findings", _plain("security.inspector", "inspector_findings")),
        Load("inventory_instances", _plain("inventory.instances", "inventory_instances")),
        Load(
            "inventory_applications",
            _installed("applications", "inventory_applications"),
            ("inventory_instances", "instance_id", ("instance_id",)),
        ),
        Load(
            "inventory_patches",
            _installed("patches", "inventory_patches"),
            ("inventory_instances", "instance_id", ("instance_id",)),
        ),
        Load("marketplace_usage", _plain("marketplace", "marketplace_usage")),
        Load("trusted_advisor_checks", _plain("trusted_advisor", "trusted_advisor_checks")),
        Load("health_events", _plain("health", "health_events")),
        Load("application_signals", _plain("application", "application_signals")),
        Load("resilience_hub_apps", _plain("resilience_hub", "resilience_hub_apps")),
        Load("service_resources", _plain("service_resources", "service_resources")),
        Load("compute_optimizer", _plain("compute_optimizer", "compute_optimizer")),
        Load("config_inventory", _plain("config_inventory", "config_inventory")),
        Load("support_tickets", _plain("support_tickets", "support_tickets")),
        Load("ri_sp_daily_savings", _plain("ri_sp_savings", "ri_sp_daily_savings")),
        Load("alarms", alarm_updates),
        Load(
            "alarm_history",
            _nested("alarms", "history", "alarm_history", "alarm_arn"),
            ("alarms", "alarm_id", ("alarm_arn",)),
        ),
        Load("canaries", _plain("canaries", "canaries")),
        Load(
            "canary_runs",
            _nested("canaries", "runs", "canary_runs", "canary_name"),
            ("canaries", "canary_id", ("canary_name",)),
        ),
        Load("error_summaries", error_updates),
        Load("db_insights", db_insight_updates),
        Load("db_events", db_event_updates),
        Load("incidents", incident_updates),
    ]
    return {load.table: load for load in loads}


LOADS = _loads()

#: The section of a document that a table's rows come from, where it has another name.
_SECTION_OF = {
    **dict.fromkeys(("accounts", "contact_info", "alternate_contacts", "products", "product_accounts"), "account"),
    **dict.fromkeys(("config_reports", "non_compliant_resources"), "config"),
    **dict.fromkeys(("cost_reports", "service_costs", "cost_forecasts"), "cost"),
    **dict.fromkeys(
        "security findings guard_duty_findings kms_keys waf_rules waf_rules_detailed cloudtrail_logs "
        "secrets_manager_secrets certificates inspector_findings".split(),
        "security",
    ),
    **dict.fromkeys(("inventory_instances", "inventory_applications", "inventory_patches"), "inventory"),
    "services": "service",
    "marketplace_usage": "marketplace",
    "trusted_advisor_checks": "trusted_advisor",
    "health_events": "health",
    "application_signals": "application",
    "resilience_hub_apps": "resilience_hub",
    "ri_sp_daily_savings": "ri_sp_savings",
    "log_messages": "logs",
    "alarm_history": "alarms",
    "canary_runs": "canaries",
    "error_summaries": "error_logs",
    "db_events": "db_insights",
}


def section_of(table: str) -> str:
    return _SECTION_OF.get(table, table)


#: Parents by natural key alone, not by account.
_GLOBAL_PARENTS = frozenset({"inventory_instances"})


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[table].schema)


class Loader:
    """New table states after a batch of documents.

    ``base`` holds the stored tables; a missing one counts as empty.  States are
    lazy and built on demand, parents before children.  ``settle`` may write a
    state out and read it back so that children do not recompute it.  With a
    ``store`` the tables live there and only touched parts are rewritten.
    """

    def __init__(
        self,
        payloads: DataFrame,
        base: dict[str, DataFrame] | None = None,
        as_of="1970-01-01 00:00:00",
        settle: Callable[[str, DataFrame], DataFrame] | None = None,
        store: TableStore | None = None,
        batch: tuple[str, int] | None = None,
    ):
        self.payloads = payloads
        self.spark = payloads.sparkSession
        self.base = {} if base is None else base
        self.as_of = as_of
        self.store = store
        self.batch = batch
        self._settle = settle or (lambda table, df: df)
        self._states: dict[str, DataFrame] = {}

    def stored(self, table: str) -> DataFrame:
        if self.store is not None:
            return self.store.read(table)
        return self.base[table] if table in self.base else empty_table(self.spark, table)

    def documents(self, table: str) -> DataFrame:
        """The documents that rows of ``table`` come from; its section is all they have to hold."""
        return self.payloads

    def state(self, table: str) -> DataFrame:
        if table not in self._states:
            self._states[table] = self._settle(table, self._build(table))
        return self._states[table]

    def _merge(self, table: str, updates: DataFrame, keys=None) -> DataFrame:
        spec = TABLES[table]
        mode = "partial" if spec.partial else "full"
        defaults = {**spec.defaults, "created_at": str(self.as_of), "updated_at": str(self.as_of)}
        if self.store is not None:
            return self.store.upsert(table, updates, mode, ORDER, defaults, keys, self.batch)
        return upsert(self.stored(table), updates, keys or spec.key, mode, ORDER, defaults)

    def _account_ids(self) -> DataFrame:
        return self.state("accounts").select(
            F.col("account_id").alias("_account"), F.col("region").alias("_region"), F.col("id").alias("account_id")
        )

    def _with_account(self, updates: DataFrame) -> DataFrame:
        return updates.join(self._account_ids(), ["_account", "_region"])

    def updates(self, table: str) -> DataFrame:
        """Update rows of ``table`` with references and ids filled in."""
        if table == "accounts":
            rows = account_updates(self.documents(table))
            return rows.drop("_account", "_region").withColumn("id", row_id(table))
        if table == "log_messages":
            logs = self.stored("logs").join(self._account_ids(), "account_id")
            known = self.store is not None or "logs" in self.base
            rows = log_message_updates(self.documents(table), self.as_of, logs if known else None)
            parent = ("logs", "log_id", ("date_created",))
        elif table == "logs":
            rows, parent = log_updates(self.documents(table), self.as_of), None
        else:
            load = LOADS[table]
            rows, parent = load.updates(self.documents(table)), load.parent
        rows = self._with_account(rows)
        if parent:
            parent_table, reference, keys = parent
            state = self.state(parent_table)
            scope = () if parent_table in _GLOBAL_PARENTS else ("account_id",)
            found = state.select(
                F.col("id").alias(reference), *[F.col(k).alias(f"_p_{k}") for k in keys], *scope
            )
            rows = rows.join(found, [f"_p_{k}" for k in keys] + list(scope)).drop(*[f"_p_{k}" for k in keys])
        columns = [c for c in rows.columns if c in TABLES[table].columns]
        return rows.select(*ORDER, *columns).withColumn("id", row_id(table))

    def _build(self, table: str) -> DataFrame:
        if table in ("products", "product_accounts"):
            state = self._products() if table == "products" else self._product_accounts()
            # small tables that are replaced whole
            return state if self.store is None else self.store.overwrite(table, state)
        return self._merge(table, self.updates(table))

    def _products(self) -> DataFrame:
        stored = self.stored("products").withColumn("_lname", F.lower("name"))
        updates = product_updates(self.documents("products")).withColumn("id", F.xxhash64(F.lit("products"), F.col("_lname")))
        merged = upsert(
            stored, updates, ("_lname",), "full", ORDER, {"created_at": str(self.as_of), "updated_at": str(self.as_of)}
        )
        return merged.drop("_lname")

    def _product_accounts(self) -> DataFrame:
        ids = self.state("products").groupBy(F.lower("name").alias("_lname")).agg(F.min("id").alias("product_id"))
        links = (
            self._with_account(current_links(self.documents("product_accounts")))
            .join(ids, "_lname")
            .select("product_id", "account_id")
            .distinct()
        )
        stored = self.stored("product_accounts")
        kept = replace_links(stored, links)
        fresh = links.join(stored, ["product_id", "account_id"], "left_anti").select(
            row_id("product_accounts").alias("id"),
            "product_id",
            "account_id",
            as_timestamp(self.as_of).alias("created_at"),
            as_timestamp(self.as_of).alias("updated_at"),
        )
        return kept.select(*TABLES["product_accounts"].columns).unionByName(fresh)

    def stats(self, table: str) -> DataFrame:
        """S7 for one table of the batch."""
        skipped = skipped_incidents(self.documents(table)) if table == "incidents" else None
        return upsert_stats(self.stored(table), self.updates(table), TABLES[table].key, skipped)


#: Parents come before their children.
LOAD_ORDER = ("accounts", "products", "product_accounts", "logs", "log_messages", *LOADS)


def load_tables(
    payloads: DataFrame, store: TableStore, as_of, tables: tuple[str, ...] = LOAD_ORDER, batch: tuple[str, int] | None = None
) -> None:
    """Load a batch of valid documents into ``store``.

    The parsed documents are staged once as one Parquet column per section, so
    a table's load reads only its section; the staging folder goes afterwards.
    ``batch`` (source, number) makes a repeated load change nothing.
    """
    spark = payloads.sparkSession
    staging = shared_dir(spark, "payload-sections")
    try:
        payloads.write.parquet(staging)
        loader = Loader(spark.read.schema(payloads.schema).parquet(staging), as_of=as_of, store=store, batch=batch)
        for table in tables:
            loader.state(table)
    finally:
        remove(spark, staging)
