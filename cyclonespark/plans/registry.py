"""Registry of named queries (Spark callables) and their DuckDB SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
OPERATORS: dict[str, list[str]] = {}


def register(name: str, sql: str | None = None, covers: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        OPERATORS[name] = list(covers)
        return fn

    return deco


def load_all() -> None:
    # importing the modules fills the registry
    from cyclonespark.plans import (  # noqa: F401
        q_catalog,
        q_files,
        q_flood,
        q_geometry,
        q_repair,
        q_stations,
        q_tracks,
    )
