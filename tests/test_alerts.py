"""Alert rules, rate limit and the streams, against plain Python where SQL has no form."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import alerts as R
from fleetlens.operators import upsert as U
from fleetlens.operators.severity_index import classify_by_index
from fleetlens.streaming import alerts as A

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


RULE_DDL = (
    "id long, namespace string, metric_name string, threshold_min double, threshold_max double, severity string, "
    "is_active boolean"
)


@pytest.mark.parametrize(
    "metric, threshold, want",
    [("m", 5.0, "High"), ("m", 10.0, "Critical"), ("m", 20.0, "Critical"), ("m", 20.1, "High"), ("m", None, "Critical"),
     ("z", 1.0, "High"), (None, 1.0, "High")],
)
def test_rule_bounds(spark, metric, threshold, want):
    rules = spark.createDataFrame(
        [(1, "N", "m", 10.0, 20.0, "Critical", True), (2, "N", None, None, None, "High", True), (0, "N", None, None, None, "Low", False)],
        RULE_DDL,
    )
    alarm = spark.createDataFrame([("N", metric, threshold, "x")], "namespace string, metric_name string, threshold double, severity string")
    assert R.classify_severity(alarm, rules).first().severity == want
    other = alarm.withColumn("namespace", F.lit("other"))
    assert R.classify_severity(other, rules).first().severity == "Medium"


def test_interval_index_equals_rules(spark):
    """3 000 rules with open, closed, single-point and empty ranges; thresholds on, between and beyond their bounds."""
    rng = random.Random(11)
    bound = lambda: rng.choice([None, float(rng.randrange(60)), rng.randrange(600) / 10])
    rules = [(i, rng.choice("AB"), rng.choice([None, "m", "n"]), bound(), bound(), f"S{i}", rng.random() < 0.7) for i in range(3000)]
    # with that many rules the first ones win nearly everywhere, so half of the tables is small
    small = [(i, "C", rng.choice([None, "m"]), lo, lo + rng.choice([0.0, 0.5, 3.0, -1.0]), f"S{i}", True) for i, lo in enumerate(rng.randrange(60) * 1.0 for _ in range(12))]
    rules += [(10_000 + r[0], *r[1:]) for r in small]
    values = [None, -1.0, 1e9] + [v for k in range(60) for v in (float(k), k + 0.25)]
    alarms = [(i, n, m, v, "x") for i, (n, m, v) in enumerate((n, m, v) for n in "ABCD" for m in (None, "m", "n", "z") for v in values)]
    alarms = spark.createDataFrame(alarms, "id long, namespace string, metric_name string, threshold double, severity string")
    for subset in (rules, [r for r in rules if r[0] >= 10_000], []):
        frame = spark.createDataFrame(subset, RULE_DDL)
        got = {r.id: r.severity for r in classify_by_index(alarms, frame).collect()}
        for a in alarms.collect():
            fits = [
                r for r in subset
                if r[6] and r[1] == a.namespace and (r[2] is None or r[2] == a.metric_name)
                and (a.threshold is None or ((r[3] is None or a.threshold >= r[3]) and (r[4] is None or a.threshold <= r[4])))
            ]
            assert got[a.id] == (min(fits)[5] if fits else "Medium")


@pytest.mark.parametrize("statuses, want", [("FFF", 1), ("PFFF", 1), ("FFP", 0), ("FF", 0), ("FPFF", 0)])
def test_consecutive_failures(spark, statuses, want):
    rows = [(1, i, at(i), {"F": "FAILED", "P": "PASSED"}[s]) for i, s in enumerate(statuses)]
    runs = spark.createDataFrame(rows, "canary_id long, id long, run_at timestamp, run_status string")
    assert R.consecutive_failures(runs).count() == want


def pending(spark, n):
    rows = [(1, "alarm", 1, f"a{i:03d}", "High", "t", None, None, None, at(i)) for i in range(n)]
    ddl = (
        "order_no int, alert_type string, account_id long, alert_id string, severity string, title string, "
        "detail_1 string, detail_2 string, reason string, event_time timestamp"
    )
    return spark.createDataFrame(rows, ddl)


@pytest.mark.parametrize("n, used, sent, grouped", [(0, 0, 0, 0), (4, 0, 4, 0), (25, 0, 10, 15), (25, 7, 3, 22), (5, 40, 0, 5)])
def test_rate_limit_budget(spark, n, used, sent, grouped):
    log = [(at(-i * 5), "sent") for i in range(1, used + 1)] + [(at(-1), "failed"), (at(-300), "sent")]
    log = spark.createDataFrame(log, "sent_at timestamp, status string")
    rows = R.rate_limit(pending(spark, n), log, at(0)).collect()
    assert sum(r.status == "sent" for r in rows) == sent
    assert [r.grouped_alerts for r in rows if r.status == "grouped"] == ([grouped] if grouped else [])
    assert {r.alert_id for r in rows if r.status == "sent"} == {f"a{i:03d}" for i in range(sent)}


def test_long_texts_are_cut(spark):
    alert = pending(spark, 1).withColumns({"reason": F.repeat(F.lit("r"), 300), "title": F.repeat(F.lit("t"), 900)})
    message = R.notification_message(alert).first().message
    assert "r" * 200 in message and "r" * 201 not in message
    log = R.notification_log(alert.withColumn("status", F.lit("sent")), T0).first()
    assert len(log.message_summary) == 500


def test_grouped_message(spark):
    log = spark.createDataFrame([], "sent_at timestamp, status string")
    limited = R.rate_limit(pending(spark, 12), log, at(0))
    grouped = R.notification_message(limited, "https://d").filter("status = 'grouped'").first()
    assert "⚠️ 2 Additional Alerts (Rate Limited)" in grouped.message and "<https://d|View Dashboard>" in grouped.message
    assert "*2 additional alerts were grouped" in grouped.message
    entry = R.notification_log(limited, T0).filter("status = 'grouped'").first()
    assert (entry.alert_type, entry.alert_id, entry.message_summary) == ("grouped", "", "2 alerts grouped")


def brute_limit(rows, n, seconds):
    """rows: (channel, time, id) -> {id: status}"""
    recent, out = {}, {}
    for channel, when, alert in sorted(rows):
        live = [t for t in recent.get(channel, []) if t > when - dt.timedelta(seconds=seconds)]
        out[alert] = "sent" if len(live) < n else "grouped"
        recent[channel] = [*live, when] if out[alert] == "sent" else live
    return out


def random_alerts(seed, size=600):
    rng = random.Random(seed)
    # a third of the alerts share one channel, many share one time
    return [(rng.choice("aaabcdefg"), at(rng.randint(0, 150) * 10), f"x{i:04d}") for i in range(size)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_equals_brute_force(spark, seed):
    rows = random_alerts(seed)
    df = spark.createDataFrame(rows, "channel string, event_time timestamp, alert_id string")
    got = {r.alert_id: r.status for r in A.rate_limit_replay(df, n=3, seconds=60).collect()}
    assert got == brute_limit(rows, 3, 60)


def test_replay_never_exceeds_the_cap(spark):
    rows = random_alerts(9)
    df = spark.createDataFrame(rows, "channel string, event_time timestamp, alert_id string")
    sent = [r for r in A.rate_limit_replay(df).collect() if r.status == "sent"]
    for r in sent:
        inside = [s for s in sent if s.channel == r.channel and r.event_time - dt.timedelta(seconds=300) < s.event_time <= r.event_time]
        assert len(inside) <= 10


def in_batches(spark, df, tmp_path, time, parts, late=0):
    """A file stream of ``df`` in ``parts`` micro-batches, rows up to ``late`` seconds after their time, and a last row without a key."""
    folder = str(tmp_path / "in")
    rng = random.Random(7)
    rows = sorted(df.collect(), key=lambda r: r[time] + dt.timedelta(seconds=rng.uniform(0, late)))
    step = -(-len(rows) // parts)
    chunks = [rows[i * step : (i + 1) * step] for i in range(parts)]
    chunks.append([tuple(at(10**8) if c == time else None for c in df.columns)])
    for chunk in chunks:
        spark.createDataFrame(chunk, df.schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_stream_limit_equals_replay(spark, tmp_path, parts):
    df = spark.createDataFrame(random_alerts(5, 200), "channel string, event_time timestamp, alert_id string")
    log = str(tmp_path / "log")
    A.stream_rate_limit(in_batches(spark, df, tmp_path, "event_time", parts, 40), log, str(tmp_path / "cp"), 3, 60, "1 minute").awaitTermination()
    got = {r.alert_id: r.status for r in spark.read.parquet(log).collect()}
    assert got == brute_limit([(r.channel, r.event_time, r.alert_id) for r in df.collect()], 3, 60)


def test_stream_limit_goes_on_from_its_checkpoint(spark, tmp_path):
    df = spark.createDataFrame(random_alerts(6, 120), "channel string, event_time timestamp, alert_id string").orderBy("event_time")
    rows, folder, log = df.collect(), str(tmp_path / "in"), str(tmp_path / "log")
    for chunk in (rows[:50], rows[50:], [(None, at(10**8), None)]):
        spark.createDataFrame(chunk, df.schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(df.schema).parquet(folder)
        A.stream_rate_limit(stream, log, str(tmp_path / "cp"), 3, 60, "1 minute").awaitTermination()
    got = {r.alert_id: r.status for r in spark.read.parquet(log).collect()}
    assert got == brute_limit([(r.channel, r.event_time, r.alert_id) for r in rows], 3, 60)


def snapshots(spark, n=400, seed=4):
    rng = random.Random(seed)
    rows = [(rng.choice([1, 1, 2]), rng.choice("xxy"), at(i * 1800), rng.choice(["OK", "ALARM"]), "r") for i in range(n)]
    return spark.createDataFrame(rows, "account_id long, alarm_name string, collected_at timestamp, state string, state_reason string")


def brute_transitions(rows):
    last, out = {}, set()
    for r in sorted(rows, key=lambda r: r.collected_at):
        key = (r.account_id, r.alarm_name)
        if key in last and last[key] != r.state:
            out.add((*key, last[key], r.state, r.collected_at))
        last[key] = r.state
    return out


def as_set(df):
    return {(r.account_id, r.alarm_name, r.previous_state, r.new_state, r.transition_time) for r in df.collect()}


def test_transitions_across_days(spark):
    df = snapshots(spark)
    assert as_set(A.alarm_transitions(df)) == brute_transitions(df.collect())


@pytest.mark.parametrize("parts", [2, 6])
def test_stream_transitions(spark, tmp_path, parts):
    df = snapshots(spark, 120)
    path = str(tmp_path / "out")
    A.stream_alarm_transitions(in_batches(spark, df, tmp_path, "collected_at", parts, 9000), path, str(tmp_path / "cp"), "3 hours").awaitTermination()
    assert as_set(spark.read.parquet(path)) == brute_transitions(df.collect())


def test_stream_failures_in_any_order_of_arrival(spark, tmp_path):
    rng = random.Random(3)
    rows = [(c, i, at(i * 60), rng.choice(["FAILED", "FAILED", "PASSED", None])) for i in range(80) for c in range(rng.randrange(4))] + [(9, 1, at(0), "FAILED"), (9, 2, at(60), "FAILED")]
    df = spark.createDataFrame(rows, "canary_id long, id long, run_at timestamp, run_status string")

    def brute(seconds=None):
        ring, out = {}, set()
        for canary, _, when, status in sorted(rows, key=lambda r: (r[2], r[1])):
            own = ring.setdefault(canary, [])
            own[:] = [k for k in own if seconds is None or k[0] > when - dt.timedelta(seconds=seconds)]
            own[:] = [*own, (when, status)][-3:]
            if len(own) == 3 and all(k[1] == "FAILED" for k in own):
                out.add((canary, when))
        return out

    for number, seconds in enumerate((None, 400)):
        path = str(tmp_path / f"out{number}")
        stream = in_batches(spark, df, tmp_path / str(number), "run_at", 5, 600)
        A.stream_consecutive_failures(stream, path, f"{path}-cp", 3, seconds, "11 minutes").awaitTermination()
        got = {(r.canary_id, r.last_run_at) for r in spark.read.parquet(path).collect()}
        assert got == brute(seconds) and got


# upsert --------------------------------------------------------------------
BASE_DDL = "id long, k string, a int, b int, c int"


def base(spark):
    return spark.createDataFrame([(1, "x", 1, 1, 1), (2, "y", 2, 2, 2)], BASE_DDL)


def state(df):
    return sorted((r.k or "", r.a, r.b, r.c) for r in df.collect())


def test_full_upsert_writes_nulls_and_keeps_uncarried(spark):
    updates = spark.createDataFrame([("x", 5, None, 1), ("x", None, 6, 2), ("z", 7, 7, 3)], "k string, a int, b int, o int")
    out = U.upsert(base(spark), updates, ("k",), "full", ("o",), {"c": 9})
    assert state(out) == [("x", None, 6, 1), ("y", 2, 2, 2), ("z", 7, 7, 9)]


def test_partial_upsert_keeps_stored_values(spark):
    updates = spark.createDataFrame([("x", 5, None, 1), ("x", None, 6, 2), ("z", None, 7, 3)], "k string, a int, b int, o int")
    out = U.upsert(base(spark), updates, ("k",), "partial", ("o",), {"a": 8, "c": 9})
    assert state(out) == [("x", 5, 6, 1), ("y", 2, 2, 2), ("z", 8, 7, 9)]


@pytest.mark.parametrize("mode", ["full", "partial"])
def test_upsert_twice_is_upsert_once(spark, mode):
    updates = spark.createDataFrame([("x", 5, None, 1), ("q", None, 6, 2)], "k string, a int, b int, o int")
    once = U.upsert(base(spark), updates, ("k",), mode, ("o",))
    assert state(U.upsert(once, updates, ("k",), mode, ("o",))) == state(once)


def test_null_key_inserts(spark):
    updates = spark.createDataFrame([(None, 5, 5, 1), (None, 6, 6, 2)], "k string, a int, b int, o int")
    assert U.upsert(base(spark), updates, ("k",), "full", ("o",)).count() == 4


def test_upsert_stats(spark):
    updates = spark.createDataFrame([("x",), ("x",), ("n",), ("n",), (None,)], "k string")
    row = U.upsert_stats(base(spark), updates, ("k",)).first()
    assert (row.created, row.updated, row.skipped) == (2, 3, 0)
