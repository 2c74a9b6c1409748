"""Expectation suites as data, each answered by rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.checks import null_counts, sql_text, surplus_groups, union_checks

# The public names of the expectation types in suite files.
EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"

# The suites of the landed files.
INDICATORS_SUITE = [
    (EXISTS, "IndicatorCode"),
    (NOT_NULL, "IndicatorCode"),
    (UNIQUE, "IndicatorCode"),
    (EXISTS, "IndicatorName"),
]
CATEGORIZED_INDICATORS_SUITE = [
    (EXISTS, "IndicatorCode"),
    (EXISTS, "IndicatorName"),
    (EXISTS, "Category"),
    (NOT_NULL, "IndicatorCode"),
    (NOT_NULL, "Category"),
]
DIMENSIONS_SUITE = [(EXISTS, "Code"), (EXISTS, "Title"), (NOT_NULL, "Code")]
REGIONS_SUITE = [(EXISTS, "Code"), (EXISTS, "Title"), (NOT_NULL, "Code")]

Suite = list[tuple[str, str]]


def parse_suite(text: str) -> Suite:
    """A suite from the text of its JSON file."""
    return [(e["expectation_type"], e["kwargs"]["column"]) for e in json.loads(text)["expectations"]]


def run_suite(df: DataFrame, suite: Suite) -> DataFrame:
    """One row per expectation, numbered in suite order: success, rows looked at, rows that break it.

    Existence and NULLs are answered by a single pass. Uniqueness counts every row of a repeated value as
    unexpected, ignores NULLs, and takes a pass of its own per column.
    """
    present = set(df.columns)
    nulls = sorted({c for kind, c in suite if kind != EXISTS and c in present})
    simple, parts = [], []
    for position, (kind, column) in enumerate(suite):
        if kind == EXISTS:
            simple.append(_result(position, kind, column, str(column in present).lower(), "n", "0"))
        elif column not in present:
            simple.append(_result(position, kind, column, "false", "0", "0", "column not found"))
        elif kind == NOT_NULL:
            bad = f"c{nulls.index(column)}"
            simple.append(_result(position, kind, column, f"{bad} = 0", "n", bad))
        elif kind == UNIQUE:
            parts.append(_unique(df, position, column))
        else:
            raise ValueError(f"unknown expectation {kind}")
    if simple:
        parts.insert(0, _rows(null_counts(df, nulls, F.count(F.lit(1)).alias("n")), *simple))
    return union_checks(df.sparkSession, parts)


def _unique(df: DataFrame, position: int, column: str) -> DataFrame:
    looked_at = df.agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("bad"))
    repeated = surplus_groups(df, column).agg(F.lit(0).cast("long").alias("n"), F.sum("n").alias("bad"))
    counts = looked_at.unionByName(repeated).agg(F.expr("coalesce(sum(n), 0)").alias("n"), F.expr("coalesce(sum(bad), 0)").alias("bad"))
    return _rows(counts, _result(position, UNIQUE, column, "bad = 0", "n", "bad"))


def _result(position: int, kind: str, column: str, success: str, looked_at: str, unexpected: str, detail=None) -> str:
    counts = f"cast({looked_at} as bigint), cast({unexpected} as bigint)"
    return f"{position}, {sql_text(kind)}, {sql_text(column)}, {success}, {counts}, {sql_text(detail)}"


def _rows(df: DataFrame, *results: str) -> DataFrame:
    names = "position, expectation, column, success, element_count, unexpected_count, detail"
    return df.selectExpr(f"stack({len(results)}, {', '.join(results)}) as ({names})")
