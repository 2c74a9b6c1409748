"""One build: staging stays virtual, dimensions are rebuilt, facts are upserted."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.plans.marts import Star, build_marts
from starloom.plans.staging import build_staging
from starloom.sinks.publish import current, publish, publish_upsert, read_partitions, upsert_partitions

FACT = "fct_observations"


def build_warehouse(raw: Mapping[str, DataFrame], base: str) -> Star:
    """Publish the marts of ``raw`` under ``base`` and return them as stored.

    Every table becomes visible as a whole or not at all; the dimensions come first, so that a fact is never
    there before what it points to.
    """
    marts = build_marts(build_staging(raw))
    for name in marts:
        if name != FACT:
            publish(marts[name], f"{base}/{name}")
    publish_upsert(marts[FACT], f"{base}/{FACT}", ["observation_id"])
    return stored_star(marts[FACT].sparkSession, base)


def stored_star(spark: SparkSession, base: str) -> Star:
    names = ["dim_indicator", "dim_location", "dim_period", "dim_sex", FACT]
    return Star({name: current(spark, f"{base}/{name}") for name in names})


PERIOD = "period_id"


def build_increment(raw: Mapping[str, DataFrame], base: str, periods: list[int] | None = None) -> Star:
    """Bring the marts under ``base`` up to date where only the facts of ``periods`` have changed (default: all).

    The facts are partitioned by period, which a fact never leaves; only the partitions of these periods are read and
    written, of the raw facts as well as of the mart. Rows that are gone from the raw facts stay in the mart.
    Dimensions are small and rebuilt whole. Readers can see a partition missing while it is replaced; use
    :func:`build_warehouse` where the facts have to change all or nothing.
    """
    batch = raw["fact_observations"]
    if periods is not None:
        batch = batch.filter(F.col(PERIOD).isin(periods))
    marts = build_marts(build_staging(dict(raw) | {"fact_observations": batch}))
    spark = batch.sparkSession
    for name in marts:
        if name != FACT:
            publish(marts[name], f"{base}/{name}")
    upsert_partitions(marts[FACT], f"{base}/{FACT}", ["observation_id", PERIOD], PERIOD)
    names = ["dim_indicator", "dim_location", "dim_period", "dim_sex"]
    stored = {name: current(spark, f"{base}/{name}") for name in names}
    return Star(stored | {FACT: read_partitions(spark, f"{base}/{FACT}", PERIOD, T.LongType())})
