"""File sinks: CSV, raw landing, JSON reports."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame

from starloom.sources.tables import schema_summary

STAMP = "%Y%m%d_%H%M%S"


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header that :func:`starloom.sources.tables.read_csv` reads back as it was: spaces, line breaks, and the
    empty text (in quotes) apart from NULL (nothing) included."""
    (
        df.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def land_raw(df: DataFrame, base: str, prefix: str, ts: datetime, *partition_by: str) -> str:
    """Keep one ingest as JSON in a folder named after its time; a landed ingest is never written again."""
    path = f"{base.rstrip('/')}/{prefix}/ingest_ts={ts.strftime(STAMP)}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)
    return path


def append_report(checks: DataFrame, path: str) -> None:
    """Add check rows to a JSON Lines history."""
    checks.write.mode("append").json(path)


def write_schema_summary(tables: Mapping[str, DataFrame], path: str) -> None:
    schema_summary(tables).write.mode("overwrite").json(path)
