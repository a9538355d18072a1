"""Named queries over the given tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Build], Build]:
    """Registers a query under ``name`` together with its SQL."""

    def register(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name], ORACLES[name] = build, sql
        return build

    return register


def load() -> None:
    """Imports the modules that register queries."""
    from shiftledger.registry import changes, checks, curation, intake, kpis, lookups, tables  # noqa: F401
