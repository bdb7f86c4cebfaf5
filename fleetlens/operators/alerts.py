"""Alerting: severity rules, failure runs, routing, rate limit and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens.functions.timecalc import as_timestamp
from fleetlens.operators.upsert import merge_keyed, row_id

# Fixed values.
SEVERITY_ICONS = {"Critical": "🔴", "High": "🟠", "Medium": "🟡", "Low": "🔵"}
MAX_MESSAGES = 10
WINDOW_SECONDS = 300
REASON_LENGTH = 200
SUMMARY_LENGTH = 500

EVENT_SCHEMA = """
    source string, account string,
    detail struct<
      alarmName: string, alarmArn: string,
      state: struct<value: string, reason: string, timestamp: string>,
      configuration: struct<
        threshold: double,
        metrics: array<struct<metricStat: struct<metric: struct<namespace: string, name: string>>>>>>
"""

ALERT_ORDER = {"alarm": 1, "incident": 2, "canary": 3}


def classify_severity(alarms: DataFrame, rules: DataFrame) -> DataFrame:
    """``severity`` of the first active rule that fits, by rule id; Medium without one.

    The rules of a namespace travel as one sorted array, so each alarm meets one
    row, an alarm never multiplies, and the range test needs no join of its own.
    """
    active = rules.filter(F.col("is_active"))
    rule = F.struct("id", "metric_name", "threshold_min", "threshold_max", "severity")
    by_namespace = active.groupBy("namespace").agg(F.array_sort(F.collect_list(rule)).alias("_rules"))
    metric, threshold = F.col("metric_name"), F.col("threshold")

    def fits(r: Column) -> Column:
        low = r["threshold_min"].isNull() | (threshold >= r["threshold_min"])
        high = r["threshold_max"].isNull() | (threshold <= r["threshold_max"])
        return (r["metric_name"].isNull() | (r["metric_name"] == metric)) & (threshold.isNull() | (low & high))

    rest = [c for c in alarms.columns if c != "severity"]
    found = F.get(F.filter("_rules", fits), F.lit(0))["severity"]
    return (
        alarms.select(*rest)
        .join(by_namespace, "namespace", "left")
        .select(*rest, F.coalesce(found, F.lit("Medium")).alias("severity"))
    )


def write_back_severity(alarms: DataFrame, rules: DataFrame, as_of) -> DataFrame:
    """R1 on loaded alarms: those in state ALARM take the severity of their rule, all others stay."""
    found = classify_severity(alarms.withColumnRenamed("severity", "_stored"), rules)
    firing = F.coalesce(F.col("state") == "ALARM", F.lit(False))
    found = found.withColumns(
        {
            "severity": F.when(firing, F.col("severity")).otherwise(F.col("_stored")),
            "updated_at": F.when(firing, as_timestamp(as_of)).otherwise(F.col("updated_at")),
        }
    )
    return found.select(*alarms.columns)


def consecutive_failures(runs: DataFrame, n: int = 3, keys: tuple[str, ...] = ("canary_id",)) -> DataFrame:
    """R2: keys whose newest ``n`` runs exist and all failed.

    The rank filter runs before the shuffle too, so a hot canary sends at most
    ``n`` rows per input partition.
    """
    newest = W.partitionBy(*keys).orderBy(F.desc("run_at"), F.desc("id"))
    return (
        runs.select(*keys, "id", "run_at", "run_status")
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= n)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.bool_and(F.col("run_status") == "FAILED").alias("_all"))
        .filter((F.col("_n") == n) & F.col("_all"))
        .select(*keys)
    )


def parse_alarm_event(events: DataFrame, column: str = "value") -> DataFrame:
    """Flat alarm rows from the event JSON; only events in state ALARM."""
    event = F.from_json(column, EVENT_SCHEMA)
    metric = F.get(F.col("_e.detail.configuration.metrics"), F.lit(0))["metricStat"]["metric"]
    blank = lambda c: F.coalesce(c, F.lit(""))
    keep = [c for c in events.columns if c != column]
    return (
        events.withColumn("_e", event)
        .filter(F.col("_e.detail.state.value") == "ALARM")
        .select(
            *keep,
            blank(F.col("_e.account")).alias("account"),
            blank(F.col("_e.detail.alarmArn")).alias("alarm_arn"),
            blank(F.col("_e.detail.alarmName")).alias("alarm_name"),
            F.col("_e.detail.state.value").alias("state"),
            blank(F.col("_e.detail.state.reason")).alias("state_reason"),
            F.try_to_timestamp(F.col("_e.detail.state.timestamp")).alias("state_updated_at"),
            blank(metric["namespace"]).alias("namespace"),
            blank(metric["name"]).alias("metric_name"),
            F.col("_e.detail.configuration.threshold").alias("threshold"),
            F.lit("").alias("resource_arn"),
        )
    )


EVENT_REPLACED = ("state", "state_reason", "state_updated_at", "severity", "updated_at")


def apply_alarm_events(alarms: DataFrame, events: DataFrame, accounts: DataFrame, as_of) -> DataFrame:
    """Alarms after the classified events; unknown accounts are ignored.

    An account number with several region rows gets the event on each of them.
    An alarm first seen here gets the id a load of it would give, so that later
    loads and their children find it.
    """
    ids = accounts.select(F.col("id").alias("account_id"), F.col("account_id").alias("account"))
    rows = events.join(ids, "account").select(
        "account_id",
        "alarm_arn",
        "alarm_name",
        "state",
        "state_reason",
        "state_updated_at",
        "metric_name",
        "namespace",
        F.coalesce("threshold", F.lit(0.0)).cast("decimal(20,6)").alias("threshold"),
        "severity",
        as_timestamp(as_of).alias("updated_at"),
        as_timestamp(as_of).alias("created_at"),
    ).withColumn("id", row_id("alarms"))
    missing = [c for c in alarms.columns if c not in rows.columns]
    rows = rows.withColumns({c: F.lit(None).cast(alarms.schema[c].dataType) for c in missing})
    return merge_keyed(alarms, rows, ("account_id", "alarm_arn"), EVENT_REPLACED, ("state_updated_at",))


def route_alerts(
    alarms: DataFrame, incidents: DataFrame, canaries: DataFrame, runs: DataFrame, rules: DataFrame
) -> DataFrame:
    """Alerts to send: severe firing alarms, P1/P2 incidents, canaries that keep failing.

    ``order_no`` puts alarms before incidents before canaries.
    """
    firing = classify_severity(alarms.filter(F.col("state") == "ALARM"), rules)
    severe = firing.filter(F.col("severity").isin("Critical", "High"))
    failing = consecutive_failures(runs).withColumnRenamed("canary_id", "id")
    columns = {
        "alarm": {
            "id": "alarm_arn", "title": "alarm_name", "severity": "severity", "detail_1": "resource_arn",
            "detail_2": "namespace", "reason": "state_reason", "event_time": "state_updated_at",
        },
        "incident": {
            "id": "incident_id", "title": "title", "severity": "severity", "detail_1": "affected_service",
            "event_time": "start_time",
        },
        "canary": {
            "id": "canary_name", "title": "canary_name", "detail_1": "endpoint_url", "reason": "failure_reason",
            "event_time": "last_run_at",
        },
    }

    def shape(df: DataFrame, kind: str) -> DataFrame:
        given = columns[kind]
        text = lambda out: (
            F.col(given[out]).cast("string") if out in given else F.lit(None).cast("string")
        )
        return df.select(
            F.lit(ALERT_ORDER[kind]).alias("order_no"),
            F.lit(kind).alias("alert_type"),
            F.col("account_id"),
            text("id").alias("alert_id"),
            F.coalesce(text("severity"), F.lit("")).alias("severity"),
            text("title").alias("title"),
            text("detail_1").alias("detail_1"),
            text("detail_2").alias("detail_2"),
            text("reason").alias("reason"),
            F.col(given["event_time"]).cast("timestamp").alias("event_time"),
        )

    urgent = incidents.filter(F.col("severity").isin("P1", "P2"))
    stuck = canaries.join(failing, "id", "left_semi")
    return shape(severe, "alarm").unionByName(shape(urgent, "incident")).unionByName(shape(stuck, "canary"))


PENDING_ORDER = ("order_no", "event_time", "alert_id", "account_id")


def rate_limit(
    pending: DataFrame,
    log: DataFrame,
    as_of,
    n: int = MAX_MESSAGES,
    seconds: int = WINDOW_SECONDS,
    order_by: tuple[str, ...] = PENDING_ORDER,
) -> DataFrame:
    """The alerts that fit the budget as ``sent`` and one ``grouped`` row for the rest.

    Only alerts logged as sent inside the window use the budget.  Both sides are
    cut to ``n`` rows by a distributed top-k before they meet; the overflow is
    counted, never gathered.
    """
    since = as_timestamp(as_of) - F.expr(f"INTERVAL '{int(seconds)}' SECOND")
    used = log.filter((F.col("status") == "sent") & (F.col("sent_at") > since)).select("sent_at")
    used = used.orderBy(F.desc("sent_at")).limit(n)
    first = pending.orderBy(*order_by).limit(n)
    # at most 2n rows from here on
    rows = used.select(F.lit(0).alias("_side")).unionByName(
        first.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    place = W.orderBy("_side", *order_by)
    sent = (
        rows.withColumn("_place", F.row_number().over(place))
        .filter((F.col("_side") == 1) & (F.col("_place") <= n))
        .select(*pending.columns)
    )
    total = pending.agg(F.count(F.lit(1)).alias("n"))
    taken = sent.agg((-F.count(F.lit(1))).alias("n"))
    over = total.unionByName(taken).agg(F.sum("n").alias("n")).filter(F.col("n") > 0)
    grouped = over.select(
        F.lit("grouped").alias("alert_type"),
        F.lit("").alias("alert_id"),
        F.lit("").alias("severity"),
        F.concat(F.col("n").cast("string"), F.lit(" alerts grouped")).alias("title"),
        F.lit("grouped").alias("status"),
        F.col("n").alias("grouped_alerts"),
    )
    return sent.withColumn("status", F.lit("sent")).unionByName(grouped, allowMissingColumns=True)


def _icon(severity: Column) -> Column:
    pairs = [F.lit(x) for p in SEVERITY_ICONS.items() for x in p]
    return F.coalesce(F.create_map(*pairs)[severity], F.lit(SEVERITY_ICONS["Medium"]))


def _text(value: Column, kind: str = "mrkdwn") -> Column:
    return F.struct(F.lit(kind).alias("type"), value.alias("text"))


def _block(kind: str, text: Column | None = None, fields: list[Column] | None = None, elements=None) -> Column:
    none_text = F.lit(None).cast("struct<type:string,text:string>")
    none_list = F.lit(None).cast("array<struct<type:string,text:string>>")
    return F.struct(
        F.lit(kind).alias("type"),
        (none_text if text is None else text).alias("text"),
        (F.array(*fields) if fields else none_list).alias("fields"),
        (F.array(*elements) if elements else none_list).alias("elements"),
    )


def notification_message(alerts: DataFrame, dashboard_url: str = "") -> DataFrame:
    """``message`` JSON per alert; unset parts are left out of the JSON."""
    link = F.lit(f"<{dashboard_url}|View Dashboard>")
    severity, title = F.col("severity"), F.coalesce("title", F.lit("Unknown"))
    labelled = lambda name, c, default: _text(
        F.concat(F.lit(f"*{name}:*\n"), F.coalesce(c, F.lit(default)))
    )
    account = F.coalesce("account_name", F.lit("Unknown")) if "account_name" in alerts.columns else F.lit("Unknown")
    when = F.coalesce(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("N/A"))
    context = lambda text: _block("context", elements=[_text(text)])
    header = lambda text: _block("header", text=_text(text, "plain_text"))
    alarm = F.array(
        header(F.concat(_icon(severity), F.lit(" CloudWatch Alarm: "), severity)),
        _block(
            "section",
            fields=[
                labelled("Alarm", F.col("title"), "Unknown"),
                labelled("Account", account, "Unknown"),
                labelled("Resource", F.col("detail_1"), "N/A"),
                labelled("Namespace", F.col("detail_2"), "N/A"),
            ],
        ),
        _block(
            "section",
            text=_text(
                F.concat(
                    F.lit("*Reason:* "), F.substring(F.coalesce("reason", F.lit("N/A")), 1, REASON_LENGTH)
                )
            ),
        ),
        context(F.concat(F.lit("⏰ "), when, F.lit(" | "), link)),
    )
    incident = F.array(
        header(
            F.concat(
                F.when(severity.isin("P1", "P2"), "🔴").otherwise("🟠"),
                F.lit(" Incident: "), severity, F.lit(" - "), title,
            )
        ),
        _block(
            "section",
            fields=[
                labelled("Severity", severity, "P3"),
                labelled("Account", account, "Unknown"),
                labelled("Service", F.col("detail_1"), "N/A"),
                labelled("Start Time", when, "N/A"),
            ],
        ),
        context(link),
    )
    canary = F.array(
        header(F.concat(F.lit("🟠 Canary Failure: "), title)),
        _block(
            "section",
            fields=[
                labelled("Canary", F.col("title"), "Unknown"),
                labelled("Account", account, "Unknown"),
                labelled("Endpoint", F.col("detail_1"), "N/A"),
                labelled("Failure Reason", F.col("reason"), "N/A"),
            ],
        ),
        context(F.concat(F.lit("3+ consecutive failures detected | "), link)),
    )
    count = (
        F.coalesce(F.col("grouped_alerts").cast("string"), F.lit("0"))
        if "grouped_alerts" in alerts.columns
        else F.lit("0")
    )
    grouped = F.array(
        header(F.concat(F.lit("⚠️ "), count, F.lit(" Additional Alerts (Rate Limited)"))),
        _block(
            "section",
            text=_text(
                F.concat(
                    F.lit("*"),
                    count,
                    F.lit(
                        " additional alerts were grouped to prevent notification fatigue.* "
                        "Check the dashboard for details."
                    ),
                )
            ),
        ),
        context(link),
    )
    kind = F.col("alert_type")
    blocks = (
        F.when(kind == "alarm", alarm).when(kind == "incident", incident).when(kind == "canary", canary).otherwise(grouped)
    )
    return alerts.withColumn("message", F.to_json(F.struct(blocks.alias("blocks"))))


def notification_log(limited: DataFrame, as_of, more: tuple[str, ...] = ()) -> DataFrame:
    """Audit rows of a dispatch, shaped for the notification table, and the columns ``more``."""
    return limited.select(
        "alert_type",
        F.coalesce("alert_id", F.lit("")).alias("alert_id"),
        F.coalesce("severity", F.lit("")).alias("severity"),
        F.substring(F.coalesce("title", F.lit("")), 1, SUMMARY_LENGTH).alias("message_summary"),
        as_timestamp(as_of).alias("sent_at"),
        "status",
        *more,
    )
