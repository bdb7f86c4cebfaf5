"""Versioned parts, the table store and the time series on them."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import alerts
from fleetlens.operators.upsert import row_id
from fleetlens.schemas import TABLES
from fleetlens.sources import store as store_module
from fleetlens.sources import timeseries as ts
from fleetlens.sources.store import TableStore
from fleetlens.sources.versions import VersionedParts

T0 = dt.datetime(2025, 1, 15, 7, 30)
KEY = ("account_id", "canary_name")


def files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def canaries(spark, rows):
    schema = TABLES["canaries"].schema
    frame = spark.createDataFrame(rows, "id long, account_id long, canary_name string, status string, arrival int")
    fill = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in frame.columns}
    return frame.withColumns(fill).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], "arrival")


def points(spark, rows):
    return spark.createDataFrame(rows, "collected_at timestamp, account_id string, value double").select(
        "collected_at", "account_id", F.lit("r").alias("region"), F.lit("N").alias("namespace"), F.lit("M").alias("metric_name"),
        F.lit("[]").alias("dimensions"), F.lit("x").alias("resource_id"), F.lit("Sum").alias("statistic"), "value", F.lit("u").alias("unit"),
    )


def test_a_batch_rewrites_only_its_hours(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ts, "PART_BYTES", 1)
    path = str(tmp_path / "points")
    ts.write_timeseries(points(spark, [(T0 + dt.timedelta(hours=h), "a", 1.0) for h in range(4)]), path)
    before = files(f"{path}/data")
    ts.write_timeseries(points(spark, [(T0, "a", 2.0), (T0, "b", 3.0)]), path)
    new = files(f"{path}/data") - before
    assert new and all("span=2025-01-15-07" in f for f in new)
    rows = {(r.collected_at, r.account_id): r.value for r in ts.read_timeseries(spark, path).collect()}
    assert len(rows) == 5 and rows[T0, "a"] == 2.0


def test_parts_follow_the_bytes(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "points")
    month = [T0 + dt.timedelta(hours=7 * h) for h in range(100)]
    want = {}

    def write(rows):
        ts.write_timeseries(points(spark, rows), path)
        want.update({(when, account): value for when, account, value in rows})
        got = {(r.collected_at, r.account_id): r.value for r in ts.read_timeseries(spark, path).collect()}
        assert got == want
        return ts._parts(spark, path).manifest()

    # small weeks are one part of one file each
    manifest = write([(when, "a", 1.0) for when in month])
    assert all(x.endswith("/all") for x in manifest["parts"]) and len(manifest["parts"]) == 5
    assert len(files(f"{path}/data")) == 5
    # a week that outgrows its part is split where it is touched, the others stay
    first = manifest["bytes"]["w202503/all"]
    monkeypatch.setattr(ts, "PART_BYTES", first)
    manifest = write([(when, "b", 2.0) for when in month[:3]])
    assert {len(x.split("/")[1]) for x in manifest["parts"] if x.startswith("w202503")} == {10}
    assert "w202504/all" in manifest["parts"]
    # days keep being the parts of that week, and only touched ones are written
    before = files(f"{path}/data")
    write([(T0, "a", 5.0)])
    assert {f.split("span=")[1][:10] for f in files(f"{path}/data") - before} == {"2025-01-15"}
    # parts that are too small go together again
    monkeypatch.setattr(ts, "PART_BYTES", 1 << 30)
    assert ts.compact(spark, path) == ["w202503"] and ts.compact(spark, path) == []
    assert all(x.endswith("/all") for x in write([])["parts"])
    # a large part gets several files
    monkeypatch.setattr(ts, "FILE_BYTES", 2000)
    before = files(f"{path}/data")
    # at real sizes pieces are too large to be put into one task
    small = {f"spark.sql.adaptive.{k}": "64" for k in ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize")}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        write([(T0, "c", 1.0)])
    finally:
        for k in small:
            spark.conf.unset(k)
    assert len(files(f"{path}/data") - before) > 1


def test_a_named_batch_counts_once(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), 3)
    rows = canaries(spark, [(1, 1, "a", "OK", 0), (2, None, "keyless", "OK", 1)])
    for _ in range(2):
        store.upsert("canaries", rows, "full", ("arrival",), {}, KEY, ("s", 7))
    assert sorted(r.canary_name for r in store.read("canaries").collect()) == ["a", "keyless"]
    store.upsert("canaries", canaries(spark, [(3, 1, "a", "BAD", 0)]), "full", ("arrival",), {}, KEY, ("s", 8))
    got = {r.canary_name: (r.id, r.status) for r in store.read("canaries").collect()}
    assert got == {"a": (1, "BAD"), "keyless": (2, "OK")}


def test_failure_before_the_switch_loses_nothing(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path), 3)
    store.overwrite("canaries", canaries(spark, [(i, i, f"c{i}", "OK", 0) for i in range(9)]).drop("arrival"))
    before = sorted(map(tuple, store.read("canaries").collect()))

    def broken(self, manifest):
        raise OSError("lost")

    updates = canaries(spark, [(1, 1, "c1", "BAD", 0)])
    with monkeypatch.context() as m:
        m.setattr(VersionedParts, "_switch", broken)
        with pytest.raises(OSError):
            store.upsert("canaries", updates, "full", ("arrival",), {}, KEY, ("s", 1))
    assert sorted(map(tuple, store.read("canaries").collect())) == before
    store.upsert("canaries", updates, "full", ("arrival",), {}, KEY, ("s", 1))
    got = {r.canary_name: r.status for r in store.read("canaries").collect()}
    assert len(got) == 9 and got["c1"] == "BAD"


def test_buckets_follow_the_size(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path), 2)
    store.overwrite("canaries", canaries(spark, [(i, i, f"c{i}", "OK", 0) for i in range(40)]).drop("arrival"))
    monkeypatch.setattr(store_module, "BUCKET_BYTES", 10)
    store.upsert("canaries", canaries(spark, [(50, 50, "new", "OK", 0)]), "full", ("arrival",), {}, KEY)
    assert store.bucket_count("canaries") == 4 and store.read("canaries").count() == 41
    assert len(store.parts("canaries").labels()) > 2


def test_old_versions_go(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), 1)
    for i in range(5):
        store.overwrite("canaries", canaries(spark, [(1, 1, "a", f"S{i}", 0)]).drop("arrival"))
    assert store.read("canaries").first().status == "S4"
    assert len({f.split("commit=")[1].split("/")[0] for f in files(str(tmp_path))}) == 2


def test_alarm_seen_as_event_first_keeps_its_id(spark):
    schema = TABLES["alarms"].schema
    stored = spark.createDataFrame([], schema)
    accounts = spark.createDataFrame([(5, "000000000005")], "id long, account_id string")
    event = spark.createDataFrame(
        [("000000000005", "arn:1", "name", "ALARM", "why", T0, "M", "N", 1.0, "High")],
        "account string, alarm_arn string, alarm_name string, state string, state_reason string, state_updated_at timestamp, metric_name string, namespace string, threshold double, severity string",
    )
    row = alerts.apply_alarm_events(stored, event, accounts, T0).first()
    want = spark.createDataFrame([(5, "arn:1")], "account_id long, alarm_arn string").select(
        row_id("alarms").alias("id") if TABLES["alarms"].key == ("account_id", "alarm_arn") else F.lit(row.id).alias("id")
    )
    assert row.id is not None and row.id == want.first().id and row.created_at == T0
    # a second event changes neither
    again = alerts.apply_alarm_events(spark.createDataFrame([row], schema), event.withColumn("state", F.lit("OK")), accounts, T0 + dt.timedelta(hours=1)).first()
    assert (again.id, again.created_at, again.state) == (row.id, T0, "OK")


def test_shared_folder_has_to_be_named_off_a_local_master(spark, monkeypatch):
    from fleetlens.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        shared_dir(Session(), "x")
