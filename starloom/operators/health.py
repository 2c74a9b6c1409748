"""Health of the stored tables: present, readable, referentially whole."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import size_mb
from starloom.operators.checks import ERROR, FAIL, PASS, Check, known_rows, rows_of, sql_text, union_checks
from starloom.operators.star import orphans
from starloom.sources.tables import file_stats

# Fact column, dimension table, natural key.
FOREIGN_KEYS = [
    ("indicator_id", "dim_indicator", "indicator_nk"),
    ("location_id", "dim_location", "location_nk"),
    ("period_id", "dim_period", "period_nk"),
    ("sex_id", "dim_sex", "sex_nk"),
]


def orphan_counts(fact: DataFrame, keys: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Facts without a dimension row, per foreign key; a NULL key is an orphan."""
    parts = []
    for fk, dim, nk in keys:
        found = orphans(fact, fk, dim, nk).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))
        parts.append(found.select(F.lit(fk).alias("fk"), "orphans"))
    return reduce(DataFrame.unionByName, parts)


def volume_checks(spark: SparkSession, layer: str, expected: list[str], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per expected table; one that is missing fails."""
    parts = []
    for name in expected:
        if name not in tables:
            absent = Check(layer, name, "exists", status=f"'{FAIL}'", detail="'table not found'")
            parts.append(known_rows(spark, absent))
        else:
            counted = tables[name].agg(F.count(F.lit(1)).alias("n"))
            parts.append(rows_of(counted, Check(layer, name, "exists", observed="n")))
    return union_checks(spark, parts)


def freshness_checks(spark: SparkSession, layer: str, paths: Mapping[str, str]) -> DataFrame:
    """Files, size and last change of each stored table; one that is not there fails."""
    parts = []
    for name, path in paths.items():
        try:
            files = file_stats(spark, path)
        except AnalysisException:
            absent = Check(layer, name, "exists", status=f"'{FAIL}'", detail="'path not found'")
            parts.append(known_rows(spark, absent))
            continue
        total = files.agg(
            size_mb(F.sum("size_bytes")).alias("mb"), F.max("modified_at").alias("changed"), F.count(F.lit(1)).alias("n")
        )
        stored = Check(layer, name, "exists", None, "n", lo=1)
        parts.append(rows_of(total, stored, Check(layer, name, "size_mb", None, "mb", detail="changed")))
    return union_checks(spark, parts)


def reference_checks(spark: SparkSession, marts: Mapping[str, DataFrame], fact: str = "fct_observations") -> DataFrame:
    """Orphans per foreign key; a key that cannot be checked is an error."""
    parts = []
    for fk, table, nk in FOREIGN_KEYS:
        readable = fact in marts and table in marts and fk in marts[fact].columns and nk in marts[table].columns
        if not readable:
            needs = sql_text(f"needs {table}.{nk}")
            parts.append(known_rows(spark, Check("mart", fact, "orphans", fk, status=f"'{ERROR}'", detail=needs)))
            continue
        found = orphan_counts(marts[fact], [(fk, marts[table], nk)])
        parts.append(rows_of(found, Check("mart", fact, "orphans", fk, "orphans", hi=0)))
    return union_checks(spark, parts)


def health_overall(checks: DataFrame) -> DataFrame:
    """``violations`` if any facts are orphaned, else ``degraded`` if anything else did not pass, else ``ok``."""
    orphaned = F.count_if((F.col("check") == "orphans") & (F.col("status") == FAIL)) > 0
    unsound = F.count_if(F.col("status") != PASS) > 0
    return checks.agg(F.when(orphaned, "violations").when(unsound, "degraded").otherwise("ok").alias("overall"))
