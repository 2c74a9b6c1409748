"""Reconciliation of one table across its raw, staging and mart layers."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import or_zero, pct_diff
from starloom.operators.checks import ERROR, FAIL, PASS, Check, known_rows, rows_of, union_checks, verdict

TOLERANCE_PCT = 0.1
LAYERS = ("raw", "staging", "mart")


@dataclass(frozen=True)
class Layers:
    """Tables and id columns of one subject in the three layers.

    ``mart_extra_rows`` are rows the mart adds on purpose. ``raw_filter`` leaves out of the raw count what
    staging drops on purpose; without it such rows count as a difference.
    """

    name: str
    raw: tuple[str, str]
    staging: tuple[str, str]
    mart: tuple[str, str]
    mart_extra_rows: int = 0
    value: str | None = None
    raw_filter: str | None = None


# Fixed values: (table, id column) per layer.
LAYER_MAP = [
    Layers(
        "indicators",
        ("dim_indicators", "indicator_id"),
        ("stg_indicators", "indicator_id"),
        ("dim_indicator", "indicator_nk"),
    ),
    Layers(
        "locations",
        ("dim_locations", "location_id"),
        ("stg_locations", "location_id"),
        ("dim_location", "location_nk"),
    ),
    Layers("periods", ("dim_periods", "period_id"), ("stg_periods", "period_id"), ("dim_period", "period_nk")),
    Layers("sex", ("dim_sex", "sex_id"), ("stg_sex", "sex_id"), ("dim_sex", "sex_nk"), mart_extra_rows=1),
    Layers(
        "observations",
        ("fact_observations", "observation_id"),
        ("stg_observations", "observation_id"),
        ("fct_observations", "observation_id"),
        value="value",
    ),
]


def reconcile(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    staging: Mapping[str, DataFrame],
    marts: Mapping[str, DataFrame],
    layers: list[Layers] | None = None,
    tolerance: float = TOLERANCE_PCT,
) -> DataFrame:
    """Check rows for counts, uniqueness, values and coverage; a table or column that is missing is an error."""
    parts = []
    for subject in layers or LAYER_MAP:
        frames, absent = {}, []
        for layer, tables in zip(LAYERS, (raw, staging, marts)):
            table, column = getattr(subject, layer)
            needed = {column, subject.value} if subject.value else {column}
            df = tables.get(table)
            if df is None or not needed <= set(df.columns):
                missing = "'table or column not found'"
                absent.append(Check(layer, table, "readable", column, status=f"'{ERROR}'", detail=missing))
            else:
                frames[layer] = df
        if absent:
            parts.append(known_rows(spark, *absent))
            continue
        parts += subject_checks(subject, frames, tolerance)
    return union_checks(spark, parts)


def subject_checks(subject: Layers, frames: dict[str, DataFrame], tolerance: float) -> list[DataFrame]:
    """All checks of a subject, from one pass over each layer and one join for the coverage."""
    facts = layer_facts(subject, frames)
    table, column = subject.mart
    counted = facts.withColumn(
        "difference", count_difference(F.col("n_raw"), F.col("n_mart"), subject.mart_extra_rows)
    )
    rows = [Check(layer, *_at(subject, layer, "count"), observed=f"n_{layer}") for layer in LAYERS]
    # A difference of exactly the tolerance passes here, and fails for values below.
    within = f"if(difference <= {tolerance}, '{PASS}', '{FAIL}')"
    rows.append(Check("mart", table, "count_raw_vs_mart", column, "round(difference, 2)", hi=tolerance, status=within))
    rows += _uniqueness(subject)
    if subject.value:
        difference = pct_diff(F.abs("sum_raw"), F.abs("sum_raw") + F.abs(F.col("sum_raw") - F.col("sum_mart")))
        counted = counted.withColumn("sum_difference", difference)
        below = f"if(sum_difference < {tolerance}, '{PASS}', '{FAIL}')"
        rows.append(
            Check("mart", table, "value_sum_raw_vs_mart", subject.value, "round(sum_difference, 2)", hi=tolerance, status=below)
        )
    missing = uncovered(subject, frames).agg(F.count(F.lit(1)).alias("n"))
    return [rows_of(counted, *rows), rows_of(missing, Check("mart", table, "coverage", column, "n", hi=0))]


def uniqueness_checks(subject: Layers, frames: dict[str, DataFrame]) -> list[DataFrame]:
    """Surplus rows per id in raw and mart alone, without the other facts of the layers."""
    parts = []
    for row in _uniqueness(subject):
        column = F.col(f"`{row.column}`")
        surplus = (F.count(F.lit(1)) - F.count_distinct(column)).alias(f"surplus_{row.layer}")
        parts.append(rows_of(frames[row.layer].agg(surplus), row))
    return parts


def _uniqueness(subject: Layers) -> list[Check]:
    return [Check(layer, *_at(subject, layer, "uniqueness"), f"surplus_{layer}", hi=0) for layer in ("raw", "mart")]


def layer_facts(subject: Layers, frames: dict[str, DataFrame]) -> DataFrame:
    """One row: ids (``n``), rows beyond one per id (``surplus``) and the sum of the values, per layer, each layer read once."""
    none = F.lit(None)
    sides = []
    for layer in LAYERS:
        id_ = F.col(f"`{getattr(subject, layer)[1]}`")
        counted = F.when(F.expr(subject.raw_filter), id_) if layer == "raw" and subject.raw_filter else id_
        facts = [F.count(counted).alias("n")]
        if layer != "staging":
            facts.append((F.count(F.lit(1)) - F.count_distinct(id_)).alias("surplus"))
            if subject.value:
                facts.append(F.round(or_zero(F.sum(subject.value)), 2).alias("sum"))
        side = frames[layer].agg(*facts)
        surplus = F.col("surplus") if "surplus" in side.columns else none.cast("long").alias("surplus")
        total = F.col("sum") if "sum" in side.columns else none.cast("double").alias("sum")
        sides.append(side.select(F.lit(layer).alias("layer"), "n", surplus, total.cast("double").alias("sum")))
    return _side_by_side(sides, LAYERS, "n", "surplus", "sum")


def layer_counts(subject: Layers, frames: dict[str, DataFrame]) -> DataFrame:
    """Number of ids in each layer, as one row (raw, staging, mart)."""
    sides = []
    for layer in LAYERS:
        df = frames[layer]
        if layer == "raw" and subject.raw_filter:
            df = df.filter(subject.raw_filter)
        sides.append(df.agg(F.count(getattr(subject, layer)[1]).alias("n")).select(F.lit(layer).alias("layer"), "n"))
    return _side_by_side(sides, LAYERS, "n")


def layer_sums(subject: Layers, frames: dict[str, DataFrame]) -> DataFrame:
    """Sum (2 places) and mean (4 places) of the value in raw and mart, NULL or no rows counting as 0."""
    sides = []
    for layer in ("raw", "mart"):
        sums = frames[layer].agg(
            F.round(or_zero(F.sum(subject.value)), 2).alias("sum"),
            F.round(or_zero(F.avg(subject.value)), 4).alias("avg"),
        )
        sides.append(sums.select(F.lit(layer).alias("layer"), "sum", "avg"))
    return _side_by_side(sides, ("raw", "mart"), "sum", "avg")


def uncovered(subject: Layers, frames: dict[str, DataFrame]) -> DataFrame:
    """Staging rows whose id the mart does not have."""
    staging, mart = frames["staging"], frames["mart"]
    return staging.join(mart, staging[subject.staging[1]] == mart[subject.mart[1]], "left_anti")


def _side_by_side(sides: list[DataFrame], layers: tuple[str, ...], *metrics: str) -> DataFrame:
    return reduce(DataFrame.unionByName, sides).agg(
        *[
            F.max(F.when(F.col("layer") == layer, F.col(m))).alias(layer if len(metrics) == 1 else f"{m}_{layer}")
            for layer in layers
            for m in metrics
        ]
    )


def count_difference(raw: Column, mart: Column, extra: int = 0) -> Column:
    """Difference of the mart in percent of the raw count plus the rows the mart adds."""
    return F.when(raw > 0, pct_diff(raw + F.lit(extra), mart)).otherwise(pct_diff(raw, mart))


def _at(subject: Layers, layer: str, check: str) -> tuple[str, str, str]:
    table, column = getattr(subject, layer)
    return table, check, column


def overall(checks: DataFrame) -> DataFrame:
    """``error`` if anything could not be checked, else ``fail`` or ``pass``."""
    errors = F.count_if(F.col("status") == ERROR) > 0
    failures = F.count_if(F.col("status") != PASS) > 0
    return checks.agg(F.when(errors, ERROR).otherwise(verdict(~failures)).alias("overall"))
