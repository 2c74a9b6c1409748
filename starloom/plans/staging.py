"""Cleaned views over the raw tables. Projections and filters only, so a query on top reads what it needs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import blank_to_null, trimmed_or, year_label
from starloom.lazy import LazyTables


def stg_indicators(raw: DataFrame) -> DataFrame:
    return raw.select(
        "indicator_id",
        F.trim("indicator_code").alias("indicator_code"),
        trimmed_or("indicator_name", "N/A").alias("indicator_name"),
        trimmed_or("category", "UNCATEGORIZED").alias("category"),
    )


def stg_locations(raw: DataFrame) -> DataFrame:
    return raw.select(
        "location_id",
        F.trim("country_code").alias("country_code"),
        blank_to_null("country_name").alias("country_name"),
        blank_to_null("region_code").alias("region_code"),
    )


def stg_periods(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("year").isNotNull()).select("period_id", "year")


def stg_sex(raw: DataFrame) -> DataFrame:
    return raw.select("sex_id", F.trim("sex_code").alias("sex_code"), F.trim("sex_name").alias("sex_name"))


def stg_observations(raw: DataFrame) -> DataFrame:
    columns = ["observation_id", "indicator_id", "location_id", "period_id", "sex_id", "value"]
    return raw.filter(F.col("value").isNotNull()).select(*columns)


def stg_dimensions(locations: DataFrame, periods: DataFrame, sex: DataFrame) -> DataFrame:
    """Ids and codes of three dimensions in one list, codes as they came."""
    parts = [
        (locations, "locations", "location_id", F.col("country_code")),
        (periods, "periods", "period_id", year_label("year")),
        (sex, "sex", "sex_id", F.col("sex_code")),
    ]
    listed = [df.select(F.lit(kind).alias("dim_type"), F.col(i).alias("id"), c.alias("code")) for df, kind, i, c in parts]
    return listed[0].unionByName(listed[1]).unionByName(listed[2])


def build_staging(raw: Mapping[str, DataFrame]) -> LazyTables:
    return LazyTables(
        stg_indicators=lambda: stg_indicators(raw["dim_indicators"]),
        stg_locations=lambda: stg_locations(raw["dim_locations"]),
        stg_periods=lambda: stg_periods(raw["dim_periods"]),
        stg_sex=lambda: stg_sex(raw["dim_sex"]),
        stg_observations=lambda: stg_observations(raw["fact_observations"]),
        stg_dimensions=lambda: stg_dimensions(raw["dim_locations"], raw["dim_periods"], raw["dim_sex"]),
    )
