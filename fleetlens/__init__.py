"""Observability analytics for many accounts, as Spark jobs."""
