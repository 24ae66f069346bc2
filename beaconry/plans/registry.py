"""The table of registered jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def job(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    """Register a job (spark, sf_dir) -> DataFrame and, where there is one, the SQL that must give the same rows."""
    def add(fn: Job) -> Job:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
