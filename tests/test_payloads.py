"""Documents as files: scan, validation, streaming load into stored tables."""

import json
import os

from pyspark.sql import functions as F

from fleetlens.operators.loaders import Loader
from fleetlens.sources import payloads as P
from fleetlens.sources.store import TableStore
from fleetlens.streaming.payloads import stream_payloads, table_sink

AS_OF = "2024-02-01 00:00:00"


def document(number="111111111111", product="Shop, web ,,Shop", **sections):
    doc = {name: [] for name in P.SECTIONS}
    doc["account"] = {
        "account_id": number, "region": "r1", "account_name": None, "product": product,
        "contact_info": {"city": None}, "alternate_contacts": {"billing": {"name": "B", "phone": "1"}, "security": None},
    }
    doc["logs"] = {"date_created": "2024-01-31T00:00:00+00:00", "message": ["note", {"WARN": "w", "COST": "c"}]}
    return {**doc, **sections}


def put(root, doc, day="2024-01-31", account="111111111111"):
    folder = os.path.join(root, "data", account, "r1")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{day}_DAILY.json")
    with open(path, "w") as out:
        out.write(doc if isinstance(doc, str) else json.dumps(doc, indent=4))
    return path


def loaded(spark, root):
    return P.validate_payloads(P.read_payloads(spark, os.path.join(root, "data")))


def test_scan_and_validation(spark, tmp_path):
    put(tmp_path, document())
    put(tmp_path, "{broken", "2024-01-30")
    missing = document()
    del missing["cost"], missing["logs"]
    put(tmp_path, missing, "2024-01-29")
    put(tmp_path, document() | {"account": {}}, "2024-01-28")
    valid, rejected = loaded(spark, tmp_path)
    row = valid.first()
    assert (row.path_account, row.path_region, str(row._date), row.path_interval) == ("111111111111", "r1", "2024-01-31", "DAILY")
    reasons = {str(r._date): r._reason for r in rejected.collect()}
    assert reasons == {
        "2024-01-30": "not a JSON object", "2024-01-29": "missing sections: cost, logs", "2024-01-28": "no account",
    }


def test_products_links_and_contacts(spark, tmp_path):
    put(tmp_path, document(), "2024-01-30")
    put(tmp_path, document(product="SHOP"), "2024-01-31")
    loader = Loader(loaded(spark, tmp_path)[0], as_of=AS_OF)
    assert sorted(r.name for r in loader.state("products").collect()) == ["SHOP", "web"]
    assert loader.state("product_accounts").count() == 1  # the newest list holds one product
    assert loader.state("contact_info").count() == 0
    contacts = loader.state("alternate_contacts").collect()
    assert [(c.contact_type, c.full_name, c.phone_number) for c in contacts] == [("billing", "B", None)]
    account = loader.state("accounts").first()
    assert (account.account_name, account.account_email, account.csp) == ("Unknown", "unknown@example.com", "AWS")


def test_messages(spark, tmp_path):
    put(tmp_path, document())
    loader = Loader(loaded(spark, tmp_path)[0], as_of=AS_OF)
    assert {r.message_type: r.message for r in loader.state("log_messages").collect()} == {"INFO": "note", "WARN": "w", "COST": "c"}


def test_section_of_another_shape_yields_nothing(spark, tmp_path):
    put(tmp_path, document(config=[], cost=[], security=[], inventory={}))
    loader = Loader(loaded(spark, tmp_path)[0], as_of=AS_OF)
    for table in ("config_reports", "cost_reports", "security", "inventory_instances", "services"):
        assert loader.state(table).count() == 0, table


def test_incidents(spark, tmp_path):
    start = {"severity": "P1", "title": "t", "start_time": "2024-01-01T00:00:00Z"}
    put(tmp_path, document(incidents=[
        {"incident_id": "a", **start, "status": "RESOLVED", "resolution_time": "2024-01-01T01:30:59Z"},
        {"incident_id": "b", **start, "status": "RESOLVED"},
        {"incident_id": "c", "severity": "P1", "start_time": "2024-01-01T00:00:00Z"},
        {"incident_id": "d", **start},
    ]))
    loader = Loader(loaded(spark, tmp_path)[0], as_of=AS_OF)
    rows = {r.incident_id: (r.status, r.resolution_duration_minutes) for r in loader.state("incidents").collect()}
    assert rows == {"a": ("RESOLVED", 90), "b": ("RESOLVED", None), "d": ("OPEN", None)}
    stats = loader.stats("incidents").first()
    assert (stats.created, stats.updated, stats.skipped) == (3, 0, 1)


def alarm(reason, **more):
    return document(alarms=[{"alarm_arn": "arn", "alarm_name": "n", "state": "ALARM", "state_reason": reason, **more}],
                    service=[{"service": "S", "date_from": "2024-01-01", "date_to": "2024-01-02", "cost": 1.5, "usage_types": ["a", "b"]}])


def test_stream_into_store(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"), 4)
    rejected = str(tmp_path / "rejected")

    def run():
        query = stream_payloads(
            spark, str(tmp_path / "data"), str(tmp_path / "cp"),
            table_sink(store, AS_OF, rejected, ("accounts", "services", "alarms")), str(tmp_path / "archive"),
        )
        query.awaitTermination()

    put(tmp_path, alarm("first"), "2024-01-30")
    put(tmp_path, "{}", "2024-01-29")
    run()
    put(tmp_path, alarm(None, threshold=2), "2024-01-31")
    run()
    run()  # nothing new
    row = store.read("alarms").first()
    assert store.read("alarms").count() == 1
    assert (row.state_reason, float(row.threshold), row.severity) == ("first", 2.0, "Medium")
    service = store.read("services").first()
    assert (service.usage_types, float(service.cost)) == ("a,b", 1.5)
    assert store.read("accounts").count() == 1
    assert [r._reason[:7] for r in spark.read.parquet(rejected).collect()] == ["missing"]
    joined = store.read("alarms").join(store.read("accounts").select(F.col("id").alias("account_id")), "account_id")
    assert joined.count() == 1
