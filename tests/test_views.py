"""Hand-built tables for the semantics the supplied data does not reach."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.functions import timecalc
from fleetlens.operators import dims, enrich, health, rollups
from fleetlens.schemas import TABLES

T0 = dt.datetime(2024, 1, 1)


def table(spark, name, rows):
    """A base table from partial rows."""
    schema = TABLES[name].schema
    return spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in rows], schema)


@pytest.fixture()
def small(spark):
    accounts = [
        {"id": 1, "account_id": "000000000001", "account_name": "one", "region": "r1"},
        {"id": 2, "account_id": "000000000001", "account_name": "one again", "region": "r2"},
        {"id": 3, "account_id": "000000000003", "account_name": None, "region": "r1"},
    ]
    tables = {
        "accounts": table(spark, "accounts", accounts),
        "products": table(spark, "products", [{"id": 10, "name": "P"}, {"id": 11, "name": "Q"}, {"id": 12, "name": "R"}]),
        "product_accounts": table(
            spark,
            "product_accounts",
            [
                {"id": 5, "product_id": 10, "account_id": 1},
                {"id": 4, "product_id": 11, "account_id": 1},
                {"id": 6, "product_id": 11, "account_id": 3},
            ],
        ),
    }
    for name in ("alarms", "incidents", "canaries", "error_summaries", "security", "service_resources", "cost_reports",
                 "canary_runs", "inventory_instances", "services", "compute_optimizer"):
        tables[name] = table(spark, name, [])
    return tables


def test_first_product_is_lowest_link(spark, small):
    rows = dims.first_product(small["product_accounts"]).collect()
    assert {r.account_id: r.product_id for r in rows} == {1: 11, 3: 11}


def test_account_full_reads_null_as_empty(small):
    rows = enrich.view_accounts(small).collect()
    assert {r.id: r.account_full for r in rows}[3] == "000000000003-"


def test_enrich_keeps_row_count(spark, small):
    facts = table(spark, "alarms", [{"id": i, "account_id": 1 + i % 4} for i in range(20)])
    dimension = dims.account_dimension(small["accounts"], small["product_accounts"], small["products"])
    assert enrich.enrich(facts, dimension).count() == 15  # account 4 does not exist
    assert enrich.enrich(facts, dimension, how="left").count() == 20


@pytest.mark.parametrize(
    "counts, score, band",
    [((0, 0, 3, 9, 0, 0), 76, "Degraded"), ((0, 0, 0, 0, 0, 0), 100, "Healthy"), ((9, 9, 9, 9, 9, 0), 0, "Unhealthy")],
)
def test_health_score(spark, counts, score, band):
    names = (
        "alarm_critical security_findings_critical security_findings_high security_findings_medium canary_total "
        "canary_passing"
    ).split()
    row = spark.createDataFrame([counts], ", ".join(f"{n} long" for n in names))
    out = row.select(health.health_score().alias("s")).select("s", health.health_band(F.col("s")).alias("b")).first()
    assert (out.s, out.b) == (score, band)


def test_health_of_missing_categories(spark):
    row = spark.createDataFrame([(None,) * 6], "alarm_critical long, security_findings_critical long, "
        "security_findings_high long, security_findings_medium long, canary_total long, canary_passing long")  # fmt: skip
    assert row.select(health.health_score().alias("s")).first().s == 100


def test_health_score_rejects_unknown_weight():
    with pytest.raises(ValueError):
        health.health_score({"alarms": 3})


@pytest.mark.parametrize("score, icon", [(95, "●●●●●"), (90, "●●●●●"), (75, "●●●●○"), (60, "●●●○○"), (40, "●●○○○"), (0, "●○○○○")])
def test_health_icon(spark, score, icon):
    assert spark.range(1).select(health.health_icon(F.lit(score)).alias("i")).first().i == icon


def test_resource_without_state_is_healthy(spark, small):
    resources = table(
        spark,
        "service_resources",
        [{"id": i, "account_id": 1, "state": s} for i, s in enumerate([None, "STOPPED", "running", "Insufficient-Data"])],
    )
    rows = health.resource_health(resources, small["product_accounts"]).collect()
    assert {(r.product_id, r.resource_total, r.resource_healthy) for r in rows} == {(10, 4, 2), (11, 4, 2)}


def naive_executive(tables, as_of):
    """The four children joined before counting, as the view states it."""
    acc = tables["accounts"].select(F.col("id").alias("aid"))
    al = tables["alarms"].select(F.col("account_id").alias("aid"), "state", F.col("severity").alias("sev"))
    inc = tables["incidents"].select(F.col("account_id").alias("aid"), F.col("id").alias("inc"), F.col("status").alias("ist"))
    can = tables["canaries"].select(F.col("account_id").alias("aid"), F.col("id").alias("can"), F.col("status").alias("cst"))
    err = tables["error_summaries"].filter(F.col("collection_date") == F.lit(as_of).cast("date"))
    err = err.select(F.col("account_id").alias("aid"), "occurrence_count")
    joined = acc.join(al, "aid", "left").join(inc, "aid", "left").join(can, "aid", "left").join(err, "aid", "left")
    return joined.groupBy("aid").agg(
        F.count_if((F.col("state") == "ALARM") & (F.col("sev") == "High")).alias("high"),
        F.countDistinct(F.when(F.col("ist").isin("OPEN", "INVESTIGATING"), F.col("inc"))).alias("inc"),
        F.countDistinct(F.when(F.col("cst").isin("ERROR", "NOT_RUNNING"), F.col("can"))).alias("can"),
        F.coalesce(F.sum_distinct("occurrence_count"), F.lit(0)).alias("err"),
    )


def test_executive_summary_equals_naive_join(spark, small):
    rng = random.Random(7)
    account = lambda: rng.randint(1, 3)
    small["alarms"] = table(spark, "alarms", [
        {"id": i, "account_id": account(), "state": rng.choice(["ALARM", "OK"]), "severity": rng.choice(["High", "Low"])}
        for i in range(12)
    ])
    small["incidents"] = table(spark, "incidents", [
        {"id": i, "account_id": account(), "status": rng.choice(["OPEN", "RESOLVED", "INVESTIGATING"])} for i in range(6)
    ])
    small["canaries"] = table(spark, "canaries", [
        {"id": i, "account_id": rng.randint(1, 2), "status": rng.choice(["ERROR", "RUNNING"])} for i in range(5)
    ])
    small["error_summaries"] = table(spark, "error_summaries", [
        {"id": i, "account_id": account(), "occurrence_count": rng.choice([2, 2, 5]), "collection_date": d}
        for i, d in enumerate([dt.date(2024, 1, 31)] * 6 + [dt.date(2024, 1, 30)] * 3)
    ])
    as_of = "2024-01-31 12:00:00"
    want = {r.aid: (r.high, r.inc, r.can, r.err) for r in naive_executive(small, as_of).collect()}
    got = rollups.view_executive_summary(small, as_of).collect()
    assert {r.id: (r.high_alarms, r.active_incidents, r.canary_failures, r.total_errors) for r in got} == want


def test_account_summary_scopes(spark, small):
    small["security"] = table(spark, "security", [
        {"id": 1, "account_id": 1, "critical_count": 2, "high_count": 0, "medium_count": 0, "low_count": 0,
         "total_findings": 2, "created_at": T0},
        {"id": 2, "account_id": 3, "critical_count": 0, "high_count": 1, "medium_count": 0, "low_count": 0,
         "total_findings": 1, "created_at": T0 + dt.timedelta(days=1)},
    ])
    score = lambda scope: {
        r.id: r.security_health_score for r in rollups.view_acct_summary(small, scope).collect()
    }
    assert score("global") == {1: 5, 2: 5, 3: 2}  # only the newest row of the whole table counts
    assert score("account") == {1: 1, 2: 5, 3: 2}
    with pytest.raises(ValueError):
        rollups.view_acct_summary(small, "other")


def test_rounding_is_half_away_from_zero(spark):
    row = spark.range(1).select(rollups.ratio(F.lit(1), F.lit(8), 2, 100).alias("a"), rollups.ratio(F.lit(1), F.lit(0), 2).alias("b")).first()
    assert float(row.a) == 12.5 and row.b is None
    half = spark.range(1).select(rollups.ratio(F.lit(1), F.lit(32), 4).alias("a")).first()
    assert float(half.a) == 0.0313


def test_age_day_part(spark):
    def expected(now, then):
        days = now.day - then.day - (now.time() < then.time())
        if days < 0:
            after = (then.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
            days += (after - dt.timedelta(days=1)).day
        return days

    rng = random.Random(3)
    pairs = [(T0 + dt.timedelta(seconds=rng.randint(0, 10**8)), T0 - dt.timedelta(seconds=rng.randint(0, 10**8))) for _ in range(300)]
    df = spark.createDataFrame(pairs, "n timestamp, t timestamp")
    rows = df.select("n", "t", timecalc.age_day_part(F.col("n"), F.col("t")).alias("d")).collect()
    assert all(r.d == expected(r.n, r.t) for r in rows)


def test_iso_week_of_matches_column(spark):
    days = [dt.date(y, m, d) for y, (m, d) in itertools.product((2019, 2020, 2021, 2024), ((1, 1), (12, 31), (12, 28), (6, 30)))]
    rows = spark.createDataFrame([(d,) for d in days], "d date").select("d", timecalc.iso_week(F.col("d")).alias("w")).collect()
    assert all(r.w == timecalc.iso_week_of(r.d) for r in rows)
