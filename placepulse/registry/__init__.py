"""Every operator as a query over the given tables, with the SQL another engine checks it by."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """A runnable query; ``sql`` is absent where plain SQL cannot say the same."""

    run: Run
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register the decorated function under ``name``."""

    def register(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return register


def load() -> dict[str, Query]:
    """All queries."""
    from placepulse.registry import jobs, learning, profiles, tables, texts  # noqa: F401

    return REGISTRY
