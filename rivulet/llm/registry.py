"""Queries of this subpackage and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Job = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    """Register a job under ``name``."""

    def register(job: Job) -> Job:
        QUERIES[name] = job
        if sql is not None:
            ORACLES[name] = sql
        return job

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fold(key: str, folds: int = 5) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key is the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds
