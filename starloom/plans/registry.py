"""The registered queries, each with the SQL that states its expected result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Runner
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None) -> Callable[[Runner], Runner]:
    """Register a function of (spark, folder) under its own name; ``sql`` is None where no SQL can say it."""

    def register(run: Runner) -> Runner:
        name = run.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, run, sql)
        return run

    return register
