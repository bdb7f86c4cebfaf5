"""All registered queries."""

from __future__ import annotations

from importlib import import_module

from fleetlens.plans.registry import QUERIES

# view_queries comes first: it defines check texts the others refer to
for _module in ("view_queries", "health_queries", "report_queries", "metric_queries", "alert_queries", "payload_queries", "collect_queries", "stream_queries"):
    import_module(f"fleetlens.plans.{_module}")


def queries():
    return {name: q.run for name, q in QUERIES.items()}


def oracle_sql():
    return {name: q.oracle for name, q in QUERIES.items() if q.oracle}
