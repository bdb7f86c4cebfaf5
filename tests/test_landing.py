"""What loads leave on disk: the sections they read, not whole documents."""

import pytest

from fleetlens.plans import payload_queries
from fleetlens.plans.catalog import queries
from fleetlens.plans.model import tables
from fleetlens.sources import payloads as P
from fleetlens.sources.versions import exists

SF = "/root/testdata/sf0.001"
LOADS = {
    "L5_load_cost_forecasts": "cost",
    "L7_load_patches": "inventory",
    "L3_load_non_compliant": "config",
    "L19_load_alarms": "alarms",
    "L7_load_instances": "inventory",
    "L13_load_resources": "service_resources",
    "L3_load_config": "config",
    "L17_load_savings": "ri_sp_savings",
    "L8_load_marketplace": "marketplace",
    "L18_load_logs": "logs",
    "L22_load_db_events": "db_insights",
    "L21_load_errors": "error_logs",
}


def landed(monkeypatch, spark, name):
    """Columns of each table that a query would write on its way, in a session that has none yet."""
    wrote = {}

    def noted(df, label, *args, **options):
        wrote[label] = df.columns
        return df

    monkeypatch.setattr(payload_queries, "materialize", noted)
    monkeypatch.setattr(payload_queries, "land", lambda df, path, **options: df)
    monkeypatch.setattr(payload_queries, "_STAGED", {})
    queries()[name](spark, SF)
    return wrote


@pytest.mark.parametrize(("name", "section"), sorted(LOADS.items()))
def test_only_the_sections_read_are_landed(spark, monkeypatch, name, section):
    wrote = landed(monkeypatch, spark, name)
    inputs = [columns for label, columns in wrote.items() if not label.startswith(("stored-", "state-"))]
    texts = {c for columns in inputs for c in columns if c in P.SECTIONS or c == "value"}
    assert texts == {"account", section}


def test_documents_are_whole_and_parsed_once(spark):
    documents = payload_queries.documents(tables(spark, SF))
    every = P.validate_payloads(P.parse_payloads(documents))[0]
    few = P.validate_payloads(P.parse_payloads(documents, ("cost",)))[0]
    assert few.select("_path", "account", "cost").exceptAll(every.select("_path", "account", "cost")).count() == 0
    assert few.count() == every.count() > 0
    assert all(every.filter(every[s].isNull()).count() == 0 for s in ("inventory", "incidents"))
    plan = few.select("_path", "account", "cost")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("jsonObjectKeys") == 1


def test_updates_go_when_they_are_merged(spark, monkeypatch):
    paths = []
    write = payload_queries.land

    def noted(df, path, **options):
        paths.append(path)
        return write(df, path, **options)

    monkeypatch.setattr(payload_queries, "land", noted)
    monkeypatch.setattr(payload_queries, "_STAGED", {})
    assert queries()["L3_load_non_compliant"](spark, SF).count() > 0
    assert len(paths) == 6 and not any(exists(spark, path) for path in paths)
