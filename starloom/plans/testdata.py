"""The given tables seen as raw star tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.lazy import LazyTables
from starloom.plans.marts import Star, build_star


# The given tables. Stating the types saves a job per table that would only read file footers.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf}/{name}.parquet")


def sales_raw(spark: SparkSession, sf: str, dirty: bool = False) -> LazyTables:
    """Line items as observations: parts are the indicators, suppliers the locations, ship years the periods,
    return flags the sexes (N states none), quantities the values.

    ``dirty`` pads codes and blanks out some attributes, so that staging has something to clean.
    """
    year = F.year("l_shipdate").cast("long")

    def spoil(column: str, value: str) -> Column:
        c = F.concat(F.lit("  "), F.col(column), F.lit(" "))
        return F.when(F.col(column) != value, c).otherwise(F.lit("  ")) if dirty else F.col(column)

    def indicators() -> DataFrame:
        return table(spark, sf, "part").select(
            F.col("p_partkey").alias("indicator_id"),
            spoil("p_brand", "").alias("indicator_code"),
            spoil("p_name", "red widget").alias("indicator_name"),
            spoil("p_type", "PROMO").alias("category"),
        )

    def locations() -> DataFrame:
        supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
        region = table(spark, sf, "region")
        places = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).join(
            region, nation["n_regionkey"] == region["r_regionkey"]
        )
        return places.select(
            F.col("s_suppkey").alias("location_id"),
            spoil("n_name", "").alias("country_code"),
            F.col("s_name").alias("country_name"),
            spoil("r_name", "ASIA").alias("region_code"),
        )

    def periods() -> DataFrame:
        years = table(spark, sf, "lineitem").select(year.alias("period_id")).distinct()
        known = F.when(F.col("period_id") != 1995, F.col("period_id")) if dirty else F.col("period_id")
        return years.select("period_id", known.alias("year"))

    def sex() -> DataFrame:
        flags = table(spark, sf, "lineitem").filter(F.col("l_returnflag") != "N").select("l_returnflag").distinct()
        return flags.select(
            _flag_id("l_returnflag").alias("sex_id"),
            F.col("l_returnflag").alias("sex_code"),
            F.concat(F.lit("flag "), F.col("l_returnflag")).alias("sex_name"),
        )

    def observations() -> DataFrame:
        quantity = F.col("l_quantity")
        return table(spark, sf, "lineitem").select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("observation_id"),
            F.col("l_partkey").alias("indicator_id"),
            F.col("l_suppkey").alias("location_id"),
            year.alias("period_id"),
            _flag_id("l_returnflag").alias("sex_id"),
            (F.when(quantity != 1, quantity) if dirty else quantity).alias("value"),
        )

    return LazyTables(
        dim_indicators=indicators,
        dim_locations=locations,
        dim_periods=periods,
        dim_sex=sex,
        fact_observations=observations,
    )


def _flag_id(column: str) -> Column:
    return F.when(F.col(column) == "A", 1).when(F.col(column) == "R", 2).cast("long")


def sales_star(spark: SparkSession, sf: str) -> Star:
    return build_star(sales_raw(spark, sf))


def event_raw(spark: SparkSession, sf: str) -> LazyTables:
    """Events as observations with a unique id: event types are the indicators, customers the locations, days
    of the month stand for the years from 1991 on, and the number in ``props`` gives the sex."""
    day = F.dayofmonth("ts").cast("long")

    def indicators() -> DataFrame:
        return (
            table(spark, sf, "events")
            .select("event_type")
            .distinct()
            .select(
                _event_id("event_type").alias("indicator_id"),
                F.col("event_type").alias("indicator_code"),
                F.initcap("event_type").alias("indicator_name"),
                F.substring("event_type", 1, 1).alias("category"),
            )
        )

    def locations() -> DataFrame:
        customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
        return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select(
            F.col("c_custkey").alias("location_id"),
            F.col("c_name").alias("country_code"),
            F.col("c_mktsegment").alias("country_name"),
            F.col("n_name").alias("region_code"),
        )

    def periods() -> DataFrame:
        days = table(spark, sf, "events").select(day.alias("period_id")).distinct()
        return days.withColumn("year", F.col("period_id") + 1990)

    def sex() -> DataFrame:
        codes = table(spark, sf, "events").select(event_sex().alias("sex_code"))
        return (
            codes.filter(F.col("sex_code").isNotNull())
            .distinct()
            .select(
                _sex_id("sex_code").alias("sex_id"),
                "sex_code",
                F.concat(F.lit("sex "), F.col("sex_code")).alias("sex_name"),
            )
        )

    def observations() -> DataFrame:
        return table(spark, sf, "events").select(
            F.col("event_id").alias("observation_id"),
            _event_id("event_type").alias("indicator_id"),
            F.col("user_id").alias("location_id"),
            day.alias("period_id"),
            event_sex([1, 2, 3]).cast("long").alias("sex_id"),
            "value",
        )

    return LazyTables(
        dim_indicators=indicators,
        dim_locations=locations,
        dim_periods=periods,
        dim_sex=sex,
        fact_observations=observations,
    )


def event_star(spark: SparkSession, sf: str) -> Star:
    return build_star(event_raw(spark, sf))


# The kinds of events and the sexes, in the order of their ids.
EVENT_KINDS = ["click", "view", "purchase", "signup", "error"]
SEXES = ["MLE", "FMLE", "BTSX"]


def event_number() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def event_sex(values: list | None = None) -> Column:
    """The sex by the number in steps of 25, none from 75 on; ``values`` replaces the codes."""
    step = F.floor(event_number() / 25).cast("int")
    return F.get(F.array(*[F.lit(v) for v in values or SEXES]), step)


def _event_id(column: str) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in EVENT_KINDS]), F.col(column)).cast("long")


def _sex_id(column: str) -> Column:
    return F.array_position(F.array(*[F.lit(code) for code in SEXES]), F.col(column)).cast("long")
