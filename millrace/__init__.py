"""Event-table analytics on Spark: ingest, clean, aggregate, profile, model, score."""

from millrace.spec import EventSpec, INCIDENTS

__all__ = ["EventSpec", "INCIDENTS"]
