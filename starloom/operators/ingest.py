"""From landed observation items to typed rows, with nothing lost silently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import code_prefix, sex_code


# The fields of an item as they were landed.
READ = ["SpatialDim", "TimeDim", "Dim1", "NumericValue"]


def typed_observations(items: DataFrame) -> DataFrame:
    """Items with typed fields, an ``outcome`` (accept, drop where there is no value, or reject as unusable), and in ``read``
    the fields as they were, with their ``file`` if the reader was asked for it."""
    value, year = F.col("NumericValue").try_cast("double"), F.col("TimeDim").try_cast("long")
    file = F.col("file") if "file" in items.columns else F.lit(None).cast("string")
    typed = items.select(
        "indicator_code",
        F.col("SpatialDim").alias("country_code"),
        year.alias("year"),
        sex_code("Dim1").alias("sex_code"),
        value.alias("value"),
        F.struct(*[F.col(c).cast("string").alias(c) for c in READ], file.alias("file")).alias("read"),
        _outcome(value, year).alias("outcome"),
    )
    return typed


def _outcome(value: Column, year: Column) -> Column:
    return (
        F.when(F.col("NumericValue").isNull(), "drop")
        .when(F.col("SpatialDim").isNull() | year.isNull() | value.isNull(), "reject")
        .otherwise("accept")
    )


def valid_observations(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("outcome") == "accept").drop("outcome", "read")


REJECT_DDL = "indicator_code STRING, SpatialDim STRING, TimeDim STRING, Dim1 STRING, NumericValue STRING, file STRING, reason STRING"


def rejected_observations(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("outcome") == "reject").drop("outcome")


def rejects_of(typed: DataFrame, known: DataFrame) -> DataFrame:
    """Every item with a value that cannot be loaded, as it was read, with the reason: a field is missing or unreadable,
    or its indicator is not among the ``known`` ones."""
    unusable = rejected_observations(typed).withColumn("reason", F.lit("unusable field"))
    accepted = typed.filter(F.col("outcome") == "accept").drop("outcome")
    stray = accepted.join(known.select("indicator_code"), "indicator_code", "left_anti").withColumn("reason", F.lit("unknown indicator"))
    return unusable.unionByName(stray).select("indicator_code", "read.*", "reason")


def indicators_in(dim: DataFrame, category: str) -> DataFrame:
    return dim.filter(F.col("category") == category)


def categorise(indicators: DataFrame, code: str = "IndicatorCode", out: str = "Category") -> DataFrame:
    """Add the category: the part of the code before its first underscore."""
    return indicators.withColumn(out, code_prefix(code))
