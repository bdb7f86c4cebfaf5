"""Metric pipeline: discovery filters, resource keys, points, snapshots and freshness."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.timecalc import as_timestamp, floor_minutes

# Dimension that identifies the resource of a namespace.
PRIMARY_DIMENSION = {
    "AWS/EC2": "InstanceId",
    "AWS/RDS": "DBInstanceIdentifier",
    "AWS/Lambda": "FunctionName",
    "AWS/ApplicationELB": "LoadBalancer",
    "AWS/ApiGateway": "ApiName",
    "AWS/ECS": "ClusterName",
    "ECS/ContainerInsights": "ClusterName",
    "EKS/ContainerInsights": "ClusterName",
    "AWS/CloudFront": "DistributionId",
    "AWS/S3": "BucketName",
    "AWS/DynamoDB": "TableName",
    "AWS/SQS": "QueueName",
    "CWAgent": "InstanceId",
    "AWS/Logs": "LogGroupName",
    "AWS/Backup": "ResourceType",
    "AWS/CertificateManager": "CertificateArn",
    "AWS/Route53": "HealthCheckId",
}

DIMENSIONS_DDL = "array<struct<Name:string,Value:string>>"
TIMESERIES_KEY = ("collected_at", "account_id", "namespace", "metric_name", "resource_id", "statistic")
SNAPSHOT_KEY = ("collected_at", "account_id", "alarm_name")
SNAPSHOT_REPLACED = ("state", "state_reason", "state_updated_at")


@dataclass(frozen=True)
class ExclusionRule:
    """Regular expressions anchored at the start, as the config document states them."""

    namespace: str
    metrics: str
    empty_dimensions: bool = False
    dimensions: dict[str, tuple[str, ...]] = field(default_factory=dict)


@dataclass(frozen=True)
class MetricConfig:
    accounts: list[str]
    default_region: str
    region_overrides: dict[str, str]
    metrics: list[dict[str, str]]

    def definitions(self, spark: SparkSession) -> DataFrame:
        rows = [(m["namespace"], m["metric_name"], m["statistic"], m.get("category", "")) for m in self.metrics]
        return spark.createDataFrame(rows, "namespace string, metric_name string, statistic string, category string")


def read_document(spark: SparkSession, path: str) -> str:
    """Text of one small config file."""
    return spark.read.text(path, wholetext=True).first()[0]


def parse_exclusion_rules(text: str) -> list[ExclusionRule]:
    rules = []
    for entry in json.loads(text):
        rest = {k: v for k, v in entry.items() if k not in ("namespace", "metrics", "EmptyDimensions")}
        dims = {k: (v,) if isinstance(v, str) else tuple(v) for k, v in rest.items()}
        rules.append(ExclusionRule(entry["namespace"], entry["metrics"], bool(entry.get("EmptyDimensions")), dims))
    return rules


def parse_metric_config(text: str) -> MetricConfig:
    doc = json.loads(text)
    return MetricConfig(
        [str(a) for a in doc.get("accounts", [])],
        doc.get("default_region", "ap-southeast-1"),
        doc.get("region_overrides", {}),
        doc.get("metrics", []),
    )


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    if not mapping:
        return F.lit(None).cast("string")
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])[key]


def with_region(df: DataFrame, overrides: dict[str, str], default: str) -> DataFrame:
    """M1: region by namespace, else the default."""
    return df.withColumn("region", F.coalesce(_lookup(overrides, F.col("namespace")), F.lit(default)))


def _starts(col: Column, pattern: str) -> Column:
    return F.coalesce(col.rlike(f"^(?:{pattern})"), F.lit(False))


def excluded(rules: list[ExclusionRule]) -> Column:
    """True where any rule drops the metric.

    The rules are a config document, so they become one generated predicate:
    no join, no shuffle, whatever the number of metrics.
    """
    dims = F.coalesce(F.col("dimensions"), F.array().cast(DIMENSIONS_DDL))

    def value_matches(name: str, patterns: tuple[str, ...]) -> Column:
        def matches(d: Column) -> Column:
            return (d["Name"] == name) & reduce(lambda a, b: a | b, [_starts(d["Value"], p) for p in patterns])

        return F.exists(dims, matches)

    def one(rule: ExclusionRule) -> Column:
        hits = [value_matches(name, patterns) for name, patterns in rule.dimensions.items()]
        if rule.empty_dimensions:
            hits.append(F.size(dims) == 0)
        if not hits:
            return F.lit(False)
        any_hit = reduce(lambda a, b: a | b, hits)
        return _starts(F.col("namespace"), rule.namespace) & _starts(F.col("metric_name"), rule.metrics) & any_hit

    return reduce(lambda a, b: a | b, [one(r) for r in rules], F.lit(False))


def exclude_metrics(df: DataFrame, rules: list[ExclusionRule]) -> DataFrame:
    """M2: metrics no rule drops."""
    return df.filter(~F.coalesce(excluded(rules), F.lit(False)))


def resource_id(dimensions: Column, namespace: Column) -> Column:
    """M3: value of the namespace's primary dimension, else of the first, else empty."""
    primary = _lookup(PRIMARY_DIMENSION, namespace)
    match = F.get(F.filter(dimensions, lambda d: d["Name"] == primary), F.lit(0))["Value"]
    return F.coalesce(match, F.get(dimensions, F.lit(0))["Value"], F.lit(""))


def enrich_metrics(df: DataFrame, definitions: DataFrame) -> DataFrame:
    """M4: one row per configured statistic of the metric; unconfigured metrics go."""
    defs = definitions.select(
        "namespace", "metric_name", "statistic", F.coalesce("category", F.lit("")).alias("category")
    )
    return df.join(defs, ["namespace", "metric_name"])


def align_window(now: Column, minutes: int = 5) -> tuple[Column, Column]:
    """M5: the last full window before ``now`` as (start, end)."""
    end = floor_minutes(now, minutes)
    return F.timestamp_micros(F.unix_micros(end) - F.lit(minutes * 60_000_000)), end


def flatten_points(df: DataFrame, timestamps: str = "timestamps", values: str = "values") -> DataFrame:
    """M6: one row per (timestamp, value); the longer array is cut to the shorter."""
    n = F.least(F.size(timestamps), F.size(values))
    pairs = F.arrays_zip(
        F.slice(timestamps, F.lit(1), n).alias("collected_at"), F.slice(values, F.lit(1), n).alias("value")
    )
    rest = [c for c in df.columns if c not in (timestamps, values)]
    return df.select(*rest, F.inline(pairs))


def alarm_snapshots(alarms: DataFrame, definitions: DataFrame, accounts: DataFrame | None, as_of) -> DataFrame:
    """M7: state of every alarm on a configured metric at ``as_of``.

    The account is the owner, else the fifth part of the ARN.  ``accounts`` is a
    table of the known numbers (``account_id``): alarms of other accounts go,
    those without any account stay.  None knows every account.
    """
    owner = F.coalesce(
        F.nullif(F.col("owning_account"), F.lit("")), F.get(F.split("alarm_arn", ":"), F.lit(4)), F.lit("")
    )
    kept = alarms.join(definitions.select("namespace", "metric_name").distinct(), ["namespace", "metric_name"], "left_semi")
    rows = kept.withColumn("account_id", owner)
    if accounts is not None:
        known = accounts.select(F.col("account_id").cast("string").alias("account_id")).distinct()
        named = rows.filter("account_id <> ''").join(known, "account_id", "left_semi").select(rows.columns)
        rows = rows.filter("account_id = ''").unionByName(named)
    return rows.select(
        as_timestamp(as_of).alias("collected_at"),
        "account_id",
        "alarm_name",
        "namespace",
        "metric_name",
        F.to_json(F.coalesce("dimensions", F.array().cast(DIMENSIONS_DDL))).alias("dimensions"),
        resource_id(F.col("dimensions"), F.col("namespace")).alias("resource_id"),
        F.coalesce("state", F.lit("")).alias("state"),
        F.coalesce("state_reason", F.lit("")).alias("state_reason"),
        "state_updated_at",
    )


def collect_points(
    discovered: DataFrame, results: DataFrame, config: MetricConfig, rules: list[ExclusionRule]
) -> DataFrame:
    """M1-M6 as one plan: filter and key the discovered metrics, then flatten their fetched points.

    ``discovered`` carries a ``query_id`` per metric: several dimension sets of
    one resource are several queries.  ``results`` carries query_id, statistic,
    label and the two point arrays.
    """
    spark = discovered.sparkSession
    kept = exclude_metrics(discovered, rules)
    keyed = with_region(kept, config.region_overrides, config.default_region).withColumn(
        "resource_id", resource_id(F.col("dimensions"), F.col("namespace"))
    )
    enriched = enrich_metrics(keyed, config.definitions(spark))
    points = flatten_points(results.select("query_id", "statistic", "label", "timestamps", "values"))
    joined = enriched.join(points, ["query_id", "statistic"])
    return joined.select(
        "collected_at",
        "account_id",
        "region",
        "namespace",
        "metric_name",
        F.to_json("dimensions").alias("dimensions"),
        "resource_id",
        "statistic",
        "value",
        F.coalesce("label", F.lit("")).alias("unit"),
        F.col("category").alias("dashboard_category"),
    )


def retain(df: DataFrame, as_of, days: int = 90) -> DataFrame:
    """M8: rows young enough to keep; a row of exactly ``days`` stays."""
    return df.filter(F.col("collected_at") >= as_timestamp(as_of) - F.expr(f"INTERVAL '{int(days)}' DAY"))


def expired_count(df: DataFrame, as_of, days: int = 90) -> DataFrame:
    """M8: how many rows ``retain`` drops."""
    limit = as_timestamp(as_of) - F.expr(f"INTERVAL '{int(days)}' DAY")
    return df.agg(F.count_if(F.col("collected_at") < limit).alias("deleted"))


def recent(df: DataFrame, as_of, minutes: int = 10) -> DataFrame:
    """Rows collected after ``as_of`` minus ``minutes``."""
    return df.filter(F.col("collected_at") > as_timestamp(as_of) - F.expr(f"INTERVAL '{int(minutes)}' MINUTE"))


def _graded(value: Column, good: int, short: str = "WARN") -> Column:
    return F.when(value >= good, "PASS").when(value >= 1, short).otherwise("FAIL")


def freshness_checks(metrics: DataFrame, alarms: DataFrame, as_of, minutes: int = 10) -> DataFrame:
    """M9: (check_name, observed, status) rows over the last ``minutes``.

    Both sources shrink to their distinct (account, namespace, category) or
    (account, state) groups first; the distinct counts then run on the groups.
    """
    # a missing category is one category of its own, hence the marker
    groups = (
        recent(metrics, as_of, minutes)
        .groupBy("account_id", "namespace", F.coalesce("dashboard_category", F.lit("null")).alias("category"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    m = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("points"),
        F.countDistinct("account_id").alias("accounts"),
        F.countDistinct("namespace").alias("namespaces"),
        F.countDistinct("category").alias("categories"),
    )
    states = recent(alarms, as_of, minutes).groupBy("account_id", "state").agg(F.count(F.lit(1)).alias("n"))
    a = states.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("alarms"),
        F.countDistinct("state").alias("states"),
        F.countDistinct("account_id").alias("alarm_accounts"),
    )
    any_or = lambda c, otherwise: F.when(F.col(c) > 0, "PASS").otherwise(otherwise)
    check = lambda label, c, status: F.struct(
        F.lit(label).alias("check_name"), F.col(c).cast("bigint").alias("observed"), status.alias("status")
    )
    metric_rows = m.select(
        F.inline(
            F.array(
                check("metric_points", "points", any_or("points", "FAIL")),
                check("metric_accounts", "accounts", any_or("accounts", "FAIL")),
                check("metric_namespaces", "namespaces", _graded(F.col("namespaces"), 5)),
                check("metric_categories", "categories", _graded(F.col("categories"), 3)),
            )
        )
    )
    alarm_rows = a.select(
        F.inline(
            F.array(
                check("alarm_records", "alarms", any_or("alarms", "FAIL")),
                check("alarm_states", "states", any_or("states", "WARN")),
                check("alarm_accounts", "alarm_accounts", any_or("alarm_accounts", "WARN")),
            )
        )
    )
    return metric_rows.unionByName(alarm_rows)


def recent_breakdown(df: DataFrame, column: str, as_of, minutes: int = 10) -> DataFrame:
    """M9: recent rows per category, state or account; null reads as the word."""
    label = F.coalesce(F.col(column).cast("string"), F.lit("null")).alias(column)
    return recent(df, as_of, minutes).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def cadence_check(runs: DataFrame, as_of, minutes: int = 30, limit_seconds: int = 300) -> DataFrame:
    """(check_name, observed, status) for run time and spacing of recent runs.

    ``runs`` has ``started_at`` and ``duration_ms``.
    """
    start = as_timestamp(as_of) - F.expr(f"INTERVAL '{int(minutes)}' MINUTE")
    seconds = F.bround(F.col("duration_ms") / 1000, 0)
    stats = (
        runs.filter(F.col("started_at") >= start)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.max(seconds), F.lit(0)).cast("bigint").alias("longest"),
            F.floor((F.unix_millis(F.max("started_at")) - F.unix_millis(F.min("started_at"))) / 60000).alias("span"),
        )
        .withColumn("spacing", F.when(F.col("n") >= 2, F.floor(F.col("span") / (F.col("n") - 1))))
    )
    duration = F.when(F.col("longest") >= limit_seconds, "FAIL").when(F.col("longest") > 0, "PASS").otherwise("WARN")
    spacing = F.when(F.col("spacing").between(4, 6), "PASS").otherwise("WARN")
    return stats.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("longest_run_seconds").alias("check_name"),
                    F.col("longest").alias("observed"),
                    duration.alias("status"),
                ),
                F.struct(
                    F.lit("mean_spacing_minutes").alias("check_name"),
                    F.col("spacing").cast("bigint").alias("observed"),
                    spacing.alias("status"),
                ),
            )
        )
    )
