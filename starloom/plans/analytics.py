"""The reports over the star."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import year_range
from starloom.operators.star import average, count_rows, first_with_dimensions, top
from starloom.plans.marts import Star


def observations_by_category(star: Star, n: int = 15) -> DataFrame:
    totals = count_rows(star.fact, [("indicator_id", star.indicator, "indicator_nk")], ["category"])
    return top(totals, n, "total", "category")


def top_indicators(star: Star, n: int = 10) -> DataFrame:
    by = ["indicator_code", "indicator_name"]
    return top(count_rows(star.fact, [("indicator_id", star.indicator, "indicator_nk")], by), n, "total", *by)


def observations_by_sex(star: Star) -> DataFrame:
    by = ["sex_code", "sex_name"]
    return top(count_rows(star.fact, [("sex_id", star.sex, "sex_nk")], by), None, "total", *by)


def yearly_average(star: Star, among: DataFrame | None = None) -> DataFrame:
    """Mean value per year and category, for the categories in ``among`` or else for all of them.

    An indicator without a category is in neither.
    """
    if among is None:
        listed = star.indicator.filter(F.col("category").isNotNull())
    else:
        listed = star.indicator.join(among.select("category"), "category", "left_semi")
    joins = [("indicator_id", listed, "indicator_nk"), ("period_id", star.period, "period_nk")]
    return average(star.fact, "value", joins, ["year", "category"]).orderBy("year", "category")


def top_locations(star: Star, n: int = 10) -> DataFrame:
    by = ["country_code", "country_name"]
    return top(count_rows(star.fact, [("location_id", star.location, "location_nk")], by), n, "total", *by)


def indicators_per_category(star: Star) -> DataFrame:
    counts = star.indicator.groupBy("category").agg(F.count(F.lit(1)).alias("total"))
    return top(counts, None, "total", "category")


def categories(star: Star) -> DataFrame:
    return star.indicator.select("category").distinct()


def observation_sample(star: Star, n: int = 1000) -> DataFrame:
    joins = [
        ("indicator_id", star.indicator, "indicator_nk"),
        ("location_id", star.location, "location_nk"),
        ("period_id", star.period, "period_nk"),
        ("sex_id", star.sex, "sex_nk"),
    ]
    columns = ["observation_id", "indicator_code", "country_code", "year", "sex_code", "value"]
    return first_with_dimensions(star.fact, "observation_id", n, joins, columns)


def volumes(tables: dict[str, DataFrame], name: str = "table_name", out: str = "n") -> DataFrame:
    """Row count per table."""
    counts = [df.agg(F.count(F.lit(1)).alias(out)).select(F.lit(t).alias(name), out) for t, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def key_uniqueness(keys: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, distinct keys and surplus rows per key column; a NULL key counts as surplus."""
    parts = []
    for label, (df, column) in keys.items():
        counted = df.agg(F.count(F.lit(1)).alias("total"), F.count_distinct(column).alias("uniques"))
        parts.append(
            counted.select(
                F.lit(label).alias("key"), "total", "uniques", (F.col("total") - F.col("uniques")).alias("duplicates")
            )
        )
    return reduce(DataFrame.unionByName, parts)


def headline_counts(star: Star) -> DataFrame:
    """Observations, indicators and locations in one row."""
    parts = {"observations": star.fact, "indicators": star.indicator, "locations": star.location}
    counts = volumes(parts)
    return counts.agg(*[F.max(F.when(F.col("table_name") == name, F.col("n"))).alias(name) for name in parts])


def period_range(star: Star) -> DataFrame:
    return star.period.agg(year_range(F.min("year"), F.max("year")).alias("period"))
