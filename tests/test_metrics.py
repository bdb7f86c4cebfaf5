"""Metric pipeline cases: resource keys, exclusion rules, snapshots, points, weekly tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import metrics as M
from fleetlens.sources import timeseries as ts

T0 = dt.datetime(2025, 1, 15, 10)
DIMS = M.DIMENSIONS_DDL


def key_of(spark, namespace, dims):
    df = spark.createDataFrame([(namespace, dims)], f"n string, d {DIMS}")
    return df.select(M.resource_id(F.col("d"), F.col("n")).alias("k")).first().k


@pytest.mark.parametrize("namespace, name", sorted(M.PRIMARY_DIMENSION.items()))
def test_primary_dimension(spark, namespace, name):
    assert key_of(spark, namespace, [("Other", "x"), (name, "wanted")]) == "wanted"


@pytest.mark.parametrize(
    "namespace, dims, want",
    [
        ("Unknown", [("A", "first"), ("B", "second")], "first"),
        ("AWS/EC2", [], ""),
        ("AWS/EC2", None, ""),
        ("AWS/EC2", [("ImageId", "ami")], "ami"),
    ],
)
def test_resource_fallback(spark, namespace, dims, want):
    assert key_of(spark, namespace, dims) == want


RULES = """
[{"namespace": "AWS/Lambda", "metrics": ".*", "FunctionName": ["internal.*", "ops-.*"]},
 {"namespace": "AWS/.*", "metrics": ".*", "EmptyDimensions": true},
 {"namespace": "AWS/RDS", "metrics": "Read", "EngineName": ".*"}]
"""


@pytest.mark.parametrize(
    "namespace, metric, dims, kept",
    [
        ("AWS/Lambda", "Errors", [("FunctionName", "internal-a")], False),
        ("AWS/Lambda", "Errors", [("FunctionName", "my-internal")], True),  # anchored at the start
        ("AWS/Lambda", "Errors", [("FunctionName", "x"), ("FunctionName", "ops-b")], False),
        ("AWS/EC2", "CPU", [], False),
        ("AWS/EC2", "CPU", None, False),
        ("CWAgent", "mem", [], True),
        ("AWS/RDS", "ReadLatency", [("EngineName", "pg")], False),
        ("AWS/RDS", "WriteLatency", [("EngineName", "pg")], True),
        ("AWS/RDS", "ReadLatency", [("Role", "w")], True),
    ],
)
def test_exclusion(spark, namespace, metric, dims, kept):
    df = spark.createDataFrame([(namespace, metric, dims)], f"namespace string, metric_name string, dimensions {DIMS}")
    assert (M.exclude_metrics(df, M.parse_exclusion_rules(RULES)).count() == 1) is kept


def test_no_rules_keep_everything(spark):
    df = spark.createDataFrame([("a", "b", [])], f"namespace string, metric_name string, dimensions {DIMS}")
    assert M.exclude_metrics(df, []).count() == 1


def test_points_follow_the_shorter_array(spark):
    df = spark.createDataFrame(
        [("a", [T0, T0], [1.0]), ("b", [], [1.0]), ("c", [T0], [1.0, 2.0]), ("d", None, None)],
        "k string, timestamps array<timestamp>, values array<double>",
    )
    assert sorted(r.k for r in M.flatten_points(df).collect()) == ["a", "c"]


def test_alarm_snapshots(spark):
    config = M.parse_metric_config('{"metrics": [{"namespace": "N", "metric_name": "M", "statistic": "Sum"}]}')
    arn = "arn:aws:cloudwatch:r:{}:alarm:a"
    rows = [
        ("own", "N", "M", "111", arn.format("222"), [("D", "v")]),
        ("arn", "N", "M", "", arn.format("222"), []),
        ("foreign", "N", "M", "", arn.format("999"), None),
        ("blank", "N", "M", None, "short", None),
        ("other", "N", "X", "111", "", None),
    ]
    df = spark.createDataFrame(
        rows,
        f"alarm_name string, namespace string, metric_name string, owning_account string, alarm_arn string, dimensions {DIMS}",
    ).withColumns({"state": F.lit("OK"), "state_reason": F.lit(None).cast("string"), "state_updated_at": F.lit(T0)})
    out = {r.alarm_name: r for r in M.alarm_snapshots(df, config.definitions(spark), spark.createDataFrame([("111",), ("222",)], "account_id string"), T0).collect()}
    assert {k: v.account_id for k, v in out.items()} == {"own": "111", "arn": "222", "blank": ""}
    assert out["own"].resource_id == "v" and out["own"].state_reason == ""
    everyone = M.alarm_snapshots(df, config.definitions(spark), None, T0)
    assert everyone.count() == 4


def points(spark, rows):
    """rows: (collected_at, resource, value, unit)."""
    df = spark.createDataFrame(rows, "collected_at timestamp, resource_id string, value double, unit string")
    return df.select(
        "collected_at",
        F.lit("1").alias("account_id"),
        F.lit("r").alias("region"),
        F.lit("N").alias("namespace"),
        F.lit("M").alias("metric_name"),
        F.lit("[]").alias("dimensions"),
        "resource_id",
        F.lit("Sum").alias("statistic"),
        "value",
        "unit",
    )


def read(spark, path):
    return {(r.collected_at, r.resource_id): (r.value, r.unit) for r in ts.read_timeseries(spark, path).collect()}


def test_conflict_changes_only_the_value(spark, tmp_path):
    path = str(tmp_path / "points")
    later = T0 + dt.timedelta(days=8)
    assert len(ts.write_timeseries(points(spark, [(T0, "a", 1.0, "u1"), (later, "a", 2.0, "u1")]), path)) == 2
    assert ts.write_timeseries(points(spark, [(T0, "a", 9.0, "u2"), (T0, "b", 3.0, "u2")]), path) == ["w202503"]
    want = {(T0, "a"): (9.0, "u1"), (T0, "b"): (3.0, "u2"), (later, "a"): (2.0, "u1")}
    assert read(spark, path) == want
    ts.write_timeseries(points(spark, [(T0, "a", 9.0, "u2"), (T0, "b", 3.0, "u2")]), path)  # a retry
    assert read(spark, path) == want
    assert ts.write_timeseries(points(spark, []), path) == []


def test_purge_drops_weeks_and_trims_the_boundary(spark, tmp_path):
    path = str(tmp_path / "points")
    days = [dt.datetime(2025, 1, 1) + dt.timedelta(days=i) for i in range(30)]
    ts.write_timeseries(points(spark, [(d, "a", 1.0, "u") for d in days]), path)
    as_of = dt.datetime(2025, 1, 31)
    assert ts.purge(spark, path, as_of, 15) == 15
    left = read(spark, path)
    assert min(k[0] for k in left) == dt.datetime(2025, 1, 16) and len(left) == 15
    assert ts.stored_weeks(spark, path) == ["w202503", "w202504", "w202505"]
    assert ts.purge(spark, path, as_of, 15) == 0
    assert ts.read_since(spark, path, dt.datetime(2025, 1, 28)).count() == 3


def test_retention_keeps_the_exact_limit(spark):
    df = points(spark, [(T0 - dt.timedelta(days=90), "a", 1.0, "u"), (T0 - dt.timedelta(days=90, seconds=1), "b", 1.0, "u")])
    assert [r.resource_id for r in M.retain(df, T0, 90).collect()] == ["a"]
    assert M.expired_count(df, T0, 90).first().deleted == 1


def test_cadence(spark):
    runs = lambda gap, ms: spark.createDataFrame(
        [(T0 - dt.timedelta(minutes=gap * i), float(ms)) for i in range(5)], "started_at timestamp, duration_ms double"
    )
    status = lambda df: [r.status for r in M.cadence_check(df, T0).collect()]
    assert status(runs(5, 20_000)) == ["PASS", "PASS"]
    assert status(runs(2, 300_000)) == ["FAIL", "WARN"]
    assert status(runs(5, 20_000).limit(0)) == ["WARN", "WARN"]


def test_freshness_of_nothing(spark):
    empty = points(spark, []).withColumns({"dashboard_category": F.lit("x"), "state": F.lit("OK")})
    rows = {r.check_name: r.status for r in M.freshness_checks(empty, empty, T0).collect()}
    assert rows["metric_points"] == "FAIL" and rows["alarm_states"] == "WARN" and len(rows) == 7


def test_sketches_stay_small_and_near(spark):
    """A hundred times the rows: the same state, and results within the stated errors."""
    from fleetlens.streaming import metrics as S

    sizes = []
    for n in (3_000, 300_000):
        rows = spark.range(n).select(F.lit(T0).alias("ts"), F.lit("a").alias("account_id"), F.pmod(F.xxhash64("id"), F.lit(1_000_000)).cast("double").alias("value"))
        one = S.sketched_percentile(rows, ("account_id",)).first()
        exact = S.tumbling_metrics(rows, ("account_id",)).filter("statistic = 'p95'").first().value
        rank = rows.filter(F.col("value") <= one.value).count() / n
        assert one.samples == n and abs(rank - 0.95) < 3 * S.SKETCH_ERROR and abs(one.value - exact) < 30_000
        sizes.append(rows.agg(F.length(F.kll_sketch_agg_double("value", F.lit(S.SKETCH_SIZE))).alias("n")).first().n)
        points = rows.select(F.col("ts").alias("collected_at"), F.col("value").alias("account_id"), F.lit("N").alias("namespace"))
        got, want = ({r.window_start: r for r in f(points).collect()} for f in (S.recent_window_sketched, S.recent_window))
        assert got.keys() == want.keys()
        for start, r in got.items():
            assert r.points == n and r.namespaces == 1 and abs(r.accounts / want[start].accounts - 1) < 0.05
    assert sizes[1] < 2 * sizes[0]
    short = rows.limit(50)
    assert S.sketched_percentile(short, ("account_id",)).first().value == S.tumbling_metrics(short, ("account_id",)).filter("statistic = 'p95'").first().value
    assert S.sketched_percentile(rows.limit(0), ("account_id",)).count() == 0
