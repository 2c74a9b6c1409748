"""Dimensions with surrogate keys, and the fact table.

Keys are hashes of the natural ids, so the fact computes its foreign keys itself: building it needs no join
and no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import decade_group, or_zero, surrogate_key, year_label
from starloom.lazy import LazyTables
from starloom.plans.staging import build_staging
from starloom.schemas import UNKNOWN_SEX
from starloom.sources.tables import literal_rows


@dataclass(frozen=True)
class Star:
    """The marts that the reports read, built lazily or stored."""

    tables: Mapping[str, DataFrame]

    @property
    def fact(self) -> DataFrame:
        return self.tables["fct_observations"]

    @property
    def indicator(self) -> DataFrame:
        return self.tables["dim_indicator"]

    @property
    def location(self) -> DataFrame:
        return self.tables["dim_location"]

    @property
    def period(self) -> DataFrame:
        return self.tables["dim_period"]

    @property
    def sex(self) -> DataFrame:
        return self.tables["dim_sex"]


def dim_indicator(stg: DataFrame) -> DataFrame:
    return _dimension(stg, "indicator", "indicator_code", "indicator_name", "category")


def dim_location(stg: DataFrame) -> DataFrame:
    return _dimension(stg, "location", "country_code", "country_name", "region_code")


def dim_period(stg: DataFrame) -> DataFrame:
    labelled = stg.withColumn("year_label", year_label("year")).withColumn("decade_group", decade_group("year"))
    return _dimension(labelled, "period", "year", "year_label", "decade_group")


def dim_sex(stg: DataFrame) -> DataFrame:
    """The sexes plus one member for observations that state none."""
    unknown = literal_rows(stg.sparkSession, [UNKNOWN_SEX], "sex_id BIGINT, sex_code STRING, sex_name STRING")
    return _dimension(stg.unionByName(unknown), "sex", "sex_code", "sex_name")


def _dimension(df: DataFrame, name: str, *attributes: str) -> DataFrame:
    return df.select(
        surrogate_key(f"{name}_id").alias(f"{name}_key"), F.col(f"{name}_id").alias(f"{name}_nk"), *attributes
    )


def fct_observations(stg: DataFrame) -> DataFrame:
    known = stg.withColumn("sex_id", or_zero("sex_id"))
    columns = []
    for name in ("observation", "indicator", "location", "period", "sex"):
        columns += [F.col(f"{name}_id"), surrogate_key(f"{name}_id").alias(f"{name}_key")]
    return known.select(*columns, "value")


def build_marts(staging: Mapping[str, DataFrame]) -> LazyTables:
    return LazyTables(
        dim_indicator=lambda: dim_indicator(staging["stg_indicators"]),
        dim_location=lambda: dim_location(staging["stg_locations"]),
        dim_period=lambda: dim_period(staging["stg_periods"]),
        dim_sex=lambda: dim_sex(staging["stg_sex"]),
        fct_observations=lambda: fct_observations(staging["stg_observations"]),
    )


def build_star(raw: Mapping[str, DataFrame]) -> Star:
    return Star(build_marts(build_staging(raw)))
