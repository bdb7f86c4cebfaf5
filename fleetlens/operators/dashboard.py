"""Dashboard display logic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions.text import blank_to_null
from fleetlens.functions.timecalc import as_timestamp

# Fixed values.
TIME_FIELDS = ("timestamp", "state_updated_at", "start_time", "last_occurrence", "collection_timestamp")
PANEL_TIME_FIELDS = ("timestamp", "state_updated_at", "start_time")
PANEL_SEVERITIES = ("Critical", "High", "P1", "P2")
ALARM_SEVERITIES = ("Critical", "High", "Medium", "Low")
INCIDENT_SEVERITIES = ("P1", "P2", "P3", "P4")


def state_color(state: Column) -> Column:
    """Red for firing, yellow for no data, green for everything else."""
    return F.when(state == "ALARM", "red").when(state == "INSUFFICIENT_DATA", "yellow").otherwise("green")


def hot_accounts(alarms: DataFrame, more_than: int = 5) -> DataFrame:
    """Accounts with more than ``more_than`` firing alarms."""
    return (
        alarms.groupBy("account_id")
        .agg(F.count_if(F.col("state") == "ALARM").alias("firing"))
        .filter(F.col("firing") > more_than)
    )


def _time_of(df: DataFrame, fields: tuple[str, ...]) -> Column:
    """First field that is present and reads as a time."""
    found = []
    for name in fields:
        if name in df.columns:
            col = F.col(name)
            if isinstance(df.schema[name].dataType, T.StringType):
                col = F.try_to_timestamp(blank_to_null(col))
            found.append(col.cast("timestamp"))
    return F.coalesce(*found) if found else F.lit(None).cast("timestamp")


def event_time(df: DataFrame) -> Column:
    """Time of a record whichever of the five fields carries it."""
    return _time_of(df, TIME_FIELDS)


def critical_panel(df: DataFrame, limit: int = 100, tie: tuple[str, ...] = ()) -> DataFrame:
    """D3: the newest ``limit`` severe records; a distributed top-k, ``tie`` makes it repeatable."""
    newest = F.desc_nulls_last("_time")
    return (
        df.filter(F.col("severity").isin(*PANEL_SEVERITIES))
        .withColumn("_time", _time_of(df, PANEL_TIME_FIELDS))
        .orderBy(newest, *tie)
        .limit(limit)
        .drop("_time")
    )


def apply_filters(
    df: DataFrame,
    account: str | None = None,
    severity: str | None = None,
    time_range_start=None,
    source_type: str | None = None,
    product: str | None = None,
) -> DataFrame:
    """Every given filter at once; empty ones are ignored."""
    conditions: list[Column] = []
    if account:
        named = [F.col(c) == account for c in ("account_name", "aws_account_id") if c in df.columns]
        conditions.append(reduce(lambda a, b: F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)), named))
    if severity:
        conditions.append(F.col("severity") == severity)
    if time_range_start:
        conditions.append(event_time(df) >= as_timestamp(time_range_start))
    if source_type:
        conditions.append(F.col("source_type") == source_type)
    if product:
        conditions.append(F.col("product_name") == product)
    return reduce(lambda rows, c: rows.filter(c), conditions, df)


def summary_counts(alarms: DataFrame, incidents: DataFrame, canaries: DataFrame, errors: DataFrame) -> DataFrame:
    """Ten global counts in one row.

    Each source gives one partial row; the four meet in a union and a sum, so
    no join is involved and an empty source counts as zero.
    """
    firing, is_open = F.col("state") == "ALARM", F.col("status") == "OPEN"
    parts = [
        alarms.agg(
            *[F.count_if(firing & (F.col("severity") == s)).alias(f"{s.lower()}_alarms") for s in ALARM_SEVERITIES]
        ),
        incidents.agg(
            *[
                F.count_if(is_open & (F.col("severity") == s)).alias(f"active_incidents_{s.lower()}")
                for s in INCIDENT_SEVERITIES
            ]
        ),
        canaries.agg(F.count_if(F.col("status").isin("ERROR", "NOT_RUNNING")).alias("canary_failures")),
        errors.agg(F.sum("occurrence_count").alias("total_errors")),
    ]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return union.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in union.columns])
