"""The operators bound to the given tables, each with the SQL another engine checks it by."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def load() -> dict[str, Query]:
    from workload import aggregate, evaluate, ingest, learn, model_runs, profile, relate, stateful, store, stream

    found: dict[str, Query] = {}
    for module in (aggregate, profile, ingest, store, stream, stateful, relate, learn, evaluate, model_runs):
        found.update(module.QUERIES)
    return found
