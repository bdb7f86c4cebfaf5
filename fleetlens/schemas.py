"""Table catalog: columns, types, natural keys and defaults of every base table.

Columns are listed once per table; the type follows from the column name, the
same rule that loading uses to cast, with a short list of per-table exceptions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Table and column names users query.
# ---------------------------------------------------------------------------
_COLUMNS = {
    "accounts": "id account_id account_name account_email account_status account_arn partner_name "
    "customer_name joined_method joined_timestamp account_type csp region category created_at updated_at",
    "contact_info": "id account_id address_line1 address_line2 address_line3 city country_code postal_code "
    "state_or_region company_name phone_number website_url full_name created_at updated_at",
    "alternate_contacts": "id account_id contact_type full_name title email phone_number created_at updated_at",
    "services": "id account_id service date_from date_to cost currency utilization utilization_unit "
    "usage_types created_at updated_at",
    "cost_reports": "id account_id current_period_cost previous_period_cost cost_difference "
    "cost_difference_percentage potential_monthly_savings anomalies_detected saving_opportunities_count "
    "period_start period_end period_granularity created_at region",
    "service_costs": "id cost_report_id service_name cost created_at region",
    "cost_forecasts": "id cost_report_id period_start period_end amount prediction_interval_lower_bound "
    "prediction_interval_upper_bound created_at region",
    "security": "id account_id service total_findings critical_count high_count medium_count low_count "
    "informational_count open_findings resolved_findings created_at updated_at",
    "findings": "id security_id finding_id service title description severity status resource_type resource_id "
    "created_at updated_at recommendation compliance_status region workflow_state record_state product_name "
    "company_name product_arn generator_id generator",
    "products": "id name owner position description created_at updated_at",
    "product_accounts": "id product_id account_id created_at updated_at",
    "logs": "id account_id date_created account_status cost_status service_status security_status config_status "
    "inventory_status marketplace_status trusted_advisor_status health_status application_status "
    "resilience_hub_status created_at updated_at",
    "log_messages": "id log_id message message_type created_at",
    "config_reports": "id account_id date_from date_to compliance_score total_rules compliant_rules "
    "non_compliant_rules curr_non_compliant curr_compliant created_at",
    "non_compliant_resources": "id config_report_id resource_type resource_id compliance_type rule_name "
    "created_at annotation evaluation_mode conformance_pack status",
    "service_resources": "id account_id service_name resource_type resource_id resource_name region "
    "availability_zone state instance_type vpc_id engine instance_class multi_az size_gb volume_type "
    "creation_date type scheme instance_count min_size max_size available_ip_count created_at",
    "compute_optimizer": "id account_id resource_type resource_arn resource_name finding current_instance_type "
    "current_memory_size current_volume_type current_volume_size recommended_instance_type "
    "recommended_memory_size recommended_volume_type recommended_volume_size savings_opportunity_percentage "
    "estimated_monthly_savings_usd performance_risk cpu_utilization_max memory_utilization_avg "
    "migration_effort created_at",
    "config_inventory": "id account_id resource_type resource_subtype resource_id resource_name region "
    "availability_zone state instance_type instance_class engine vpc_id size_gb volume_type creation_date "
    "multi_az scheme type instance_count min_size max_size available_ip_count created_at updated_at",
    "guard_duty_findings": "id account_id detector_id finding_type severity title description confidence region "
    "created_at updated_at",
    "kms_keys": "id account_id key_id arn description key_usage key_state creation_date enabled "
    "key_rotation_enabled created_at",
    "waf_rules": "id account_id name waf_id arn scope description default_action rules_count logging_enabled "
    "geo_blocking_enabled blocked_countries created_at",
    "waf_rules_detailed": "id account_id web_acl_name rule_name priority action statement_type is_managed_rule "
    "is_custom_rule rate_limit logging_enabled geo_blocking sql_injection sample_request_enabled "
    "cloudwatch_enabled has_xss_protection waf_version is_compliant scope created_at updated_at",
    "cloudtrail_logs": "id account_id name arn is_logging is_multi_region s3_bucket kms_key_id "
    "log_file_validation latest_delivery_time created_at",
    "secrets_manager_secrets": "id account_id name arn description created_date last_changed_date "
    "rotation_enabled created_at",
    "certificates": "id account_id arn domain_name status type not_after created_at",
    "inspector_findings": "id account_id finding_arn severity status type title description first_observed_at "
    "created_at",
    "inventory_instances": "id account_id instance_id instance_type platform ip_address computer_name "
    "ping_status last_ping_date_time agent_version created_at platform_type platform_version "
    "is_latest_version association_status association_execution_date association_success_date",
    "inventory_applications": "id account_id instance_id name version publisher architecture application_type "
    "install_time created_at",
    "inventory_patches": "id account_id instance_id title classification severity state installed_time created_at",
    "marketplace_usage": "id account_id product_code product_name cost_consumed currency period_start period_end "
    "status created_at",
    "trusted_advisor_checks": "id account_id check_name category severity recommendation "
    "affected_resources_count potential_savings timestamp created_at",
    "health_events": "id account_id arn service event_type_code region start_time end_time status_code created_at",
    "application_signals": "id account_id service_name namespace key_attributes created_at",
    "resilience_hub_apps": "id account_id app_arn name compliance_status resiliency_score status cost created_at "
    "description creation_time last_assessment_time rpo rto last_drill",
    "support_tickets": "id account_id case_id display_id subject status severity_code service_code "
    "category_code time_created submitted_by language date_from date_to created_at updated_at",
    "ri_sp_daily_savings": "id account_id date_from date_to reservation_type subscription_id offering_id "
    "savings_plan_arn service instance_type instance_count instance_family instance_tenancy offering_class "
    "product_types region utilization_percentage on_demand_cost reservation_cost net_savings commitment "
    "upfront_cost recurring_cost recurring_frequency usage_price currency start_date end_date "
    "returnable_until duration_seconds offering_type state description created_at updated_at",
    "alarms": "id account_id alarm_arn alarm_name state state_reason state_updated_at metric_name namespace "
    "threshold comparison_operator evaluation_periods resource_arn severity created_at updated_at",
    "alarm_history": "id alarm_id previous_state new_state reason transition_time created_at",
    "canaries": "id account_id canary_name status endpoint_url success_percentage failure_reason last_run_at "
    "created_at updated_at",
    "canary_runs": "id canary_id run_status duration_ms response_time_ms failure_reason run_at created_at",
    "incidents": "id account_id incident_id severity title description affected_service start_time "
    "resolution_time resolution_duration_minutes status assigned_owner created_at updated_at",
    "error_summaries": "id account_id log_group_name error_pattern occurrence_count first_occurrence "
    "last_occurrence collection_date created_at updated_at",
    "db_insights": "id account_id instance_identifier instance_arn cpu_utilization active_sessions "
    "top_wait_event top_sql_query insights_enabled freeable_memory_mb database_connections "
    "collection_timestamp created_at",
    "db_events": "id account_id source_identifier source_type event_category message event_time created_at",
    "notification_rules": "id namespace metric_name threshold_min threshold_max severity description is_active "
    "created_at updated_at",
    "slack_notifications": "id alert_type alert_id severity message_summary sent_at status retry_count "
    "error_message",
    "cloudwatch_metrics": "id collected_at account_id region namespace metric_name dimensions resource_id "
    "statistic value unit dashboard_category",
    "alarm_states": "id collected_at account_id alarm_name namespace metric_name dimensions resource_id state "
    "state_reason state_updated_at",
}

# Natural keys, on the parent's natural key where the table hangs off another.
_KEYS = {
    "accounts": "account_id region",
    "contact_info": "account_id",
    "alternate_contacts": "account_id contact_type",
    "services": "account_id service usage_types date_from",
    "cost_reports": "account_id period_start region",
    "service_costs": "cost_report_id service_name region",
    "cost_forecasts": "cost_report_id period_start region",
    "security": "account_id service",
    "findings": "finding_id",
    "products": "name",
    "product_accounts": "product_id account_id",
    "logs": "account_id date_created",
    "log_messages": "log_id message_type",
    "config_reports": "account_id date_from",
    "non_compliant_resources": "config_report_id resource_id rule_name",
    "service_resources": "account_id resource_id",
    "compute_optimizer": "resource_arn",
    "config_inventory": "account_id resource_id",
    "guard_duty_findings": "account_id detector_id",
    "kms_keys": "key_id",
    "waf_rules": "waf_id",
    "waf_rules_detailed": "account_id web_acl_name rule_name",
    "cloudtrail_logs": "arn",
    "secrets_manager_secrets": "arn",
    "certificates": "arn",
    "inspector_findings": "finding_arn",
    "inventory_instances": "instance_id",
    "inventory_applications": "instance_id name",
    "inventory_patches": "instance_id title",
    "marketplace_usage": "account_id product_code period_start",
    "trusted_advisor_checks": "account_id check_name",
    "health_events": "arn",
    "application_signals": "account_id service_name",
    "resilience_hub_apps": "app_arn",
    "support_tickets": "case_id",
    "ri_sp_daily_savings": "account_id subscription_id date_from date_to reservation_type",
    "alarms": "account_id alarm_arn",
    "alarm_history": "alarm_id transition_time",
    "canaries": "account_id canary_name",
    "canary_runs": "canary_id run_at",
    "incidents": "incident_id",
    "error_summaries": "account_id log_group_name error_pattern collection_date",
    "db_insights": "account_id instance_identifier collection_timestamp",
    "db_events": "account_id source_identifier event_time",
    "notification_rules": "namespace metric_name severity",
    "slack_notifications": "id",
    "cloudwatch_metrics": "collected_at account_id namespace metric_name resource_id statistic",
    "alarm_states": "collected_at account_id alarm_name",
}

# Types by column name (fixed values).
_DATES = "date_from date_to period_start period_end collection_date"
_TIMESTAMPS = (
    "created_at updated_at joined_timestamp date_created creation_date created_date last_changed_date not_after "
    "first_observed_at last_ping_date_time association_execution_date association_success_date install_time "
    "installed_time timestamp start_time end_time creation_time last_assessment_time last_drill time_created "
    "start_date end_date returnable_until state_updated_at transition_time last_run_at run_at resolution_time "
    "first_occurrence last_occurrence collection_timestamp event_time sent_at collected_at latest_delivery_time"
)
_MONEY = (
    "cost utilization current_period_cost previous_period_cost cost_difference cost_difference_percentage "
    "potential_monthly_savings amount prediction_interval_lower_bound prediction_interval_upper_bound "
    "cost_consumed potential_savings"
)
_INTEGERS = (
    "anomalies_detected saving_opportunities_count total_findings critical_count high_count medium_count low_count "
    "informational_count open_findings resolved_findings total_rules compliant_rules non_compliant_rules "
    "curr_non_compliant curr_compliant size_gb instance_count min_size max_size available_ip_count "
    "current_memory_size current_volume_size recommended_memory_size recommended_volume_size priority rules_count "
    "affected_resources_count rpo rto duration_seconds evaluation_periods duration_ms response_time_ms "
    "resolution_duration_minutes occurrence_count active_sessions database_connections retry_count"
)
_BOOLEANS = (
    "multi_az enabled key_rotation_enabled logging_enabled geo_blocking_enabled is_managed_rule is_custom_rule "
    "rate_limit geo_blocking sql_injection sample_request_enabled cloudwatch_enabled has_xss_protection "
    "is_compliant is_logging is_multi_region log_file_validation rotation_enabled is_latest_version "
    "insights_enabled is_active"
)
_DECIMALS = {
    "compliance_score": (5, 2),
    "savings_opportunity_percentage": (5, 2),
    "estimated_monthly_savings_usd": (10, 2),
    "performance_risk": (3, 2),
    "cpu_utilization_max": (5, 2),
    "memory_utilization_avg": (5, 2),
    "confidence": (3, 1),
    "resiliency_score": (5, 2),
    "utilization_percentage": (5, 2),
    "on_demand_cost": (12, 2),
    "reservation_cost": (12, 2),
    "net_savings": (12, 2),
    "commitment": (12, 2),
    "upfront_cost": (12, 2),
    "recurring_cost": (12, 2),
    "usage_price": (12, 2),
    "threshold": (20, 6),
    "threshold_min": (20, 6),
    "threshold_max": (20, 6),
    "success_percentage": (5, 2),
    "cpu_utilization": (5, 2),
    "freeable_memory_mb": (10, 2),
}
#: JSON documents are kept as text.
JSON_COLUMNS = frozenset("default_action key_attributes dimensions".split())

_TYPE_BY_NAME: dict[str, T.DataType] = {}
for _names, _type in (
    (_DATES, T.DateType()),
    (_TIMESTAMPS, T.TimestampType()),
    (_MONEY, T.DecimalType(20, 10)),
    (_INTEGERS, T.IntegerType()),
    (_BOOLEANS, T.BooleanType()),
):
    _TYPE_BY_NAME.update(dict.fromkeys(_names.split(), _type))
_TYPE_BY_NAME.update({name: T.DecimalType(*ps) for name, ps in _DECIMALS.items()})
_TYPE_BY_NAME["value"] = T.DoubleType()

_REFERENCES = frozenset(
    "id product_id cost_report_id security_id log_id config_report_id alarm_id canary_id".split()
)
_EXCEPTIONS = {
    ("accounts", "account_id"): T.StringType(),
    ("cloudwatch_metrics", "account_id"): T.StringType(),
    ("alarm_states", "account_id"): T.StringType(),
    ("guard_duty_findings", "severity"): T.DecimalType(3, 1),
    ("inventory_applications", "instance_id"): T.LongType(),
    ("inventory_patches", "instance_id"): T.LongType(),
}

_DEFAULTS = {
    "accounts": {"partner_name": "None", "customer_name": "None", "region": "Global"},
    "services": {"currency": "USD"},
    "cost_reports": {
        "potential_monthly_savings": 0,
        "anomalies_detected": 0,
        "saving_opportunities_count": 0,
        "region": "Global",
    },
    "service_costs": {"region": "Global"},
    "cost_forecasts": {"region": "Global"},
    "security": dict.fromkeys(
        "total_findings critical_count high_count medium_count low_count informational_count open_findings "
        "resolved_findings".split(),
        0,
    ),
    "logs": dict.fromkeys([c for c in _COLUMNS["logs"].split() if c.endswith("_status")], "Pass"),
    "config_reports": {"curr_non_compliant": 0, "curr_compliant": 0},
    "non_compliant_resources": {"status": "OPEN"},
    "kms_keys": {"enabled": True, "key_rotation_enabled": False},
    "waf_rules": {"rules_count": 0, "logging_enabled": False, "geo_blocking_enabled": False},
    "waf_rules_detailed": {
        "is_managed_rule": False,
        "is_custom_rule": True,
        "rate_limit": False,
        "logging_enabled": False,
        "geo_blocking": False,
        "sql_injection": False,
        "sample_request_enabled": False,
        "cloudwatch_enabled": False,
        "has_xss_protection": False,
        "waf_version": "v2",
        "is_compliant": False,
        "scope": "REGIONAL",
    },
    "cloudtrail_logs": {"is_logging": False, "is_multi_region": False, "log_file_validation": False},
    "secrets_manager_secrets": {"rotation_enabled": False},
    "marketplace_usage": {"currency": "USD"},
    "trusted_advisor_checks": {"affected_resources_count": 0},
    "support_tickets": {"language": "en"},
    "alarms": {"severity": "Medium"},
    "incidents": {"status": "OPEN"},
    "error_summaries": {"occurrence_count": 0},
    "db_insights": {"insights_enabled": True},
    "notification_rules": {"is_active": True},
    "slack_notifications": {"status": "sent", "retry_count": 0},
    "cloudwatch_metrics": {"region": "ap-southeast-1", "dimensions": "{}"},
    "alarm_states": {"dimensions": "{}"},
}

#: Tables where a null in an update keeps the stored value.
PARTIAL_TABLES = frozenset(
    "alarms alarm_history canaries canary_runs error_summaries db_insights db_events incidents".split()
)


@dataclass(frozen=True)
class Table:
    """One base table: column types in order, natural key and defaults."""

    name: str
    columns: dict[str, T.DataType]
    key: tuple[str, ...]
    defaults: dict[str, object] = field(default_factory=dict)
    partial: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t) for n, t in self.columns.items()])


def column_type(table: str, column: str) -> T.DataType:
    if (table, column) in _EXCEPTIONS:
        return _EXCEPTIONS[table, column]
    if column in _REFERENCES or column == "account_id":
        return T.LongType()
    return _TYPE_BY_NAME.get(column, T.StringType())


TABLES: dict[str, Table] = {
    name: Table(
        name,
        {c: column_type(name, c) for c in cols.split()},
        tuple(_KEYS[name].split()),
        _DEFAULTS.get(name, {}),
        name in PARTIAL_TABLES,
    )
    for name, cols in _COLUMNS.items()
}


def sql_type(dtype: T.DataType) -> str:
    """Type name that both Spark SQL and ANSI engines read."""
    return {"string": "STRING", "double": "DOUBLE"}.get(dtype.simpleString(), dtype.simpleString().upper())
