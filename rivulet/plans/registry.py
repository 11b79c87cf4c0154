"""Registry of queries: a name, the Spark job, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    """Register a job under ``name``; ``sql`` is the DuckDB statement for the same result."""

    def register(job: Job) -> Job:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = job
        if sql is not None:
            ORACLES[name] = sql
        return job

    return register


def with_ctes(*ctes: str) -> str:
    """``WITH a AS (...), b AS (...)`` from named pieces."""
    return "WITH " + ",\n".join(ctes) + "\n"
