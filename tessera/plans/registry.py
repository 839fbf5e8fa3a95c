"""Query registry: name -> (spark callable, optional DuckDB oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


PLAN_MODULES = [
    "dataset",
    "evaluation",
    "catalog",
    "render",
    "responses",
    "routing",
    "quota",
    "vectors",
    "models",
    "streaming_plans",
    "jobs",
    "listing",
    "io_plans",
    "artefacts",
    "requests",
]


def load_all() -> None:
    """Import every plan module so its queries register."""
    import importlib

    for m in PLAN_MODULES:
        importlib.import_module(f"tessera.plans.{m}")
