"""Queries: scalar functions, filters, staging and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import (
    code_prefix,
    decade_group,
    is_blank,
    landing_stamp,
    or_zero,
    sex_code,
    surrogate_key,
    trimmed_or,
    type_token,
    year_label,
)
from starloom.operators.ingest import categorise, indicators_in, typed_observations
from starloom.plans import marts as M
from starloom.plans.registry import query
from starloom.plans.staging import build_staging
from starloom.plans.testdata import event_raw, sales_raw, table

# The text that stands for NULL in a surrogate key, and the labels of the decades.
KEY = "md5(coalesce(cast({} as varchar), '_dbt_utils_surrogate_key_null_'))"
DECADE = (
    "case when {0} < 2000 then 'before_2000' when {0} < 2010 then '2000s' "
    "when {0} < 2020 then '2010s' else '2020s' end"
)
FLAG = "case l_returnflag when 'A' then 1 when 'R' then 2 end"
EVENT_ID = "case event_type when 'click' then 1 when 'view' then 2 when 'purchase' then 3 when 'signup' then 4 else 5 end"
K = "cast(json_extract_string(props, '$.k') as int)"
SEX_ID = f"case when {K} < 25 then 1 when {K} < 50 then 2 when {K} < 75 then 3 end"


# --- scalar functions ------------------------------------------------------------------------------------


@query(
    """select p_partkey, coalesce(nullif(trim(concat('  ', nullif(p_type, 'PROMO'), ' ')), ''), 'UNCATEGORIZED') category
       from part"""
)
def sca_trim_default(spark, sf):
    padded = F.when(F.col("p_type") != "PROMO", F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))).otherwise("   ")
    return table(spark, sf, "part").select("p_partkey", trimmed_or(padded, "UNCATEGORIZED").alias("category"))


@query(
    """select o_orderkey, coalesce(nullif(cast(substr(o_orderpriority, 1, 1) as bigint), 5), 0) p from orders"""
)
def sca_coalesce(spark, sf):
    level = F.substring("o_orderpriority", 1, 1).cast("long")
    return table(spark, sf, "orders").select("o_orderkey", or_zero(F.nullif(level, F.lit(5).cast("long"))).alias("p"))


@query("select o_orderkey, cast(year(o_orderdate) as varchar) year_label from orders")
def sca_cast_label(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", year_label(F.year("o_orderdate")).alias("year_label"))


@query(
    f"""select {DECADE.format("1980 + cast(l_quantity as int)")} decade_group, count(*) n from lineitem group by 1"""
)
def sca_decade_bucket(spark, sf):
    year = F.lit(1980) + F.col("l_quantity").cast("int")
    return table(spark, sf, "lineitem").groupBy(decade_group(year).alias("decade_group")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""select o_orderkey, {KEY.format("o_orderkey")} k,
               md5(concat(cast(o_custkey as varchar), '-',
                          coalesce(nullif(o_orderstatus, 'P'), '_dbt_utils_surrogate_key_null_'))) k2
        from orders"""
)
def sca_surrogate_key(spark, sf):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return table(spark, sf, "orders").select(
        "o_orderkey", surrogate_key("o_orderkey").alias("k"), surrogate_key("o_custkey", status).alias("k2")
    )


@query(
    """select p_partkey, split_part(replace(p_name, ' ', '_'), '_', 1) prefix, split_part(p_brand, '_', 1) whole
       from part"""
)
def sca_category_prefix(spark, sf):
    coded = table(spark, sf, "part").withColumn("code", F.replace(F.col("p_name"), F.lit(" "), F.lit("_")))
    return categorise(coded, "code", "prefix").select("p_partkey", "prefix", code_prefix("p_brand").alias("whole"))


@query(
    f"""select event_id, case when {K} < 25 then 'MLE' when {K} < 50 then 'FMLE' end code from events"""
)
def sca_sex_code(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    raw = F.when(k < 25, "SEX_MLE").when(k < 50, "FMLE").when(k < 75, "AGE_75").otherwise("")
    return table(spark, sf, "events").select("event_id", sex_code(raw).alias("code"))


@query("select p_type, split_part(lower(concat(p_type, ' PRECISION')), ' ', 1) token, count(*) n from part group by 1, 2")
def sca_type_token(spark, sf):
    token = type_token(F.concat(F.col("p_type"), F.lit(" PRECISION")))
    return table(spark, sf, "part").groupBy("p_type", token.alias("token")).agg(F.count(F.lit(1)).alias("n"))


@query("select event_id, strftime(ts, '%Y%m%d_%H%M%S') stamp from events")
def sca_landing_stamp(spark, sf):
    return table(spark, sf, "events").select("event_id", landing_stamp("ts").alias("stamp"))


# --- filters and projections -----------------------------------------------------------------------------


@query("select p_partkey, p_type category from part where p_type = 'PROMO'")
def flt_category(spark, sf):
    dim = table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("category"))
    return indicators_in(dim, "PROMO")


@query(
    """select event_id, case when event_type = 'error' then 'drop' when event_type = 'signup' then 'reject'
                             when event_type = 'view' then 'reject' else 'accept' end outcome
       from events"""
)
def flt_valid_obs(spark, sf):
    kind = F.col("event_type")
    items = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("indicator_code"),
        F.when(kind != "signup", F.col("user_id").cast("string")).alias("SpatialDim"),
        F.when(kind != "view", F.year("ts").cast("string")).otherwise("2019-2024").alias("TimeDim"),
        F.lit(None).cast("string").alias("Dim1"),
        F.when(kind != "error", F.col("value").cast("string")).alias("NumericValue"),
    )
    return typed_observations(items).select(F.col("indicator_code").cast("long").alias("event_id"), "outcome")


@query("select c_custkey from customer where c_mktsegment in ('BUILDING', 'MACHINERY')")
def flt_blank(spark, sf):
    segment = F.col("c_mktsegment")
    blanked = F.when(segment == "MACHINERY", "").when(segment != "BUILDING", segment)
    customer = table(spark, sf, "customer").select("c_custkey", blanked.alias("segment"))
    return customer.filter(is_blank("segment")).select("c_custkey")


@query("select p_brand, count(*) n from part where p_brand not like 'Brand#1%' group by 1")
def flt_not_like(spark, sf):
    kept = table(spark, sf, "part").filter(~F.col("p_brand").like("Brand#1%"))
    return kept.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@query("select c_custkey as code, c_name as nm from customer")
def prj_rename(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("code"), F.col("c_name").alias("nm"))


# --- staging ---------------------------------------------------------------------------------------------


def _staging(spark, sf, name):
    return build_staging(sales_raw(spark, sf, dirty=True))[name]


@query(
    """select p_partkey indicator_id, p_brand indicator_code,
              coalesce(nullif(p_name, 'red widget'), 'N/A') indicator_name,
              coalesce(nullif(p_type, 'PROMO'), 'UNCATEGORIZED') category
       from part"""
)
def stg_indicators(spark, sf):
    return _staging(spark, sf, "stg_indicators")


@query(
    """select s_suppkey location_id, n_name country_code, s_name country_name, nullif(r_name, 'ASIA') region_code
       from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""
)
def stg_locations(spark, sf):
    return _staging(spark, sf, "stg_locations")


@query(
    """select distinct cast(year(l_shipdate) as bigint) period_id, cast(year(l_shipdate) as bigint) "year"
       from lineitem where year(l_shipdate) <> 1995"""
)
def stg_periods(spark, sf):
    return _staging(spark, sf, "stg_periods")


@query(
    f"""select distinct cast({FLAG} as bigint) sex_id, l_returnflag sex_code, concat('flag ', l_returnflag) sex_name
        from lineitem where l_returnflag <> 'N'"""
)
def stg_sex(spark, sf):
    return _staging(spark, sf, "stg_sex")


@query(
    f"""select l_orderkey * 8 + l_linenumber observation_id, l_partkey indicator_id, l_suppkey location_id,
               cast(year(l_shipdate) as bigint) period_id, cast({FLAG} as bigint) sex_id, l_quantity as "value"
        from lineitem where l_quantity <> 1"""
)
def stg_observations(spark, sf):
    return _staging(spark, sf, "stg_observations")


@query(
    """select 'locations' dim_type, s_suppkey id, n_name code from supplier join nation on s_nationkey = n_nationkey
       union all
       select 'periods', y, cast(y as varchar) from (select distinct cast(year(l_shipdate) as bigint) y from lineitem) p
       union all
       select distinct 'sex', cast(case l_returnflag when 'A' then 1 else 2 end as bigint), l_returnflag
       from lineitem where l_returnflag <> 'N'"""
)
def stg_dimensions(spark, sf):
    return build_staging(sales_raw(spark, sf))["stg_dimensions"]


# --- marts -----------------------------------------------------------------------------------------------


@query(
    f"""select {KEY.format("p_partkey")} indicator_key, p_partkey indicator_nk, p_brand indicator_code,
               coalesce(nullif(p_name, 'red widget'), 'N/A') indicator_name,
               coalesce(nullif(p_type, 'PROMO'), 'UNCATEGORIZED') category
        from part"""
)
def dim_indicator(spark, sf):
    return M.dim_indicator(_staging(spark, sf, "stg_indicators"))


@query(
    f"""select {KEY.format("s_suppkey")} location_key, s_suppkey location_nk, n_name country_code,
               s_name country_name, nullif(r_name, 'ASIA') region_code
        from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""
)
def dim_location(spark, sf):
    return M.dim_location(_staging(spark, sf, "stg_locations"))


@query(
    f"""select {KEY.format("y - 1990")} period_key, y - 1990 period_nk, y as "year",
               cast(y as varchar) year_label, {DECADE.format("y")} decade_group
        from (select distinct cast(1990 + day(ts) as bigint) y from events) d"""
)
def dim_period(spark, sf):
    return M.dim_period(build_staging(event_raw(spark, sf))["stg_periods"])


@query(
    f"""select {KEY.format("sex_id")} sex_key, sex_id sex_nk, sex_code, sex_name
        from (select distinct cast({FLAG} as bigint) sex_id, l_returnflag sex_code, concat('flag ', l_returnflag) sex_name
              from lineitem where l_returnflag <> 'N'
              union all select 0, 'UNK', 'Unknown') s"""
)
def dim_sex_unknown_member(spark, sf):
    return M.dim_sex(_staging(spark, sf, "stg_sex"))


@query(
    f"""select observation_id, {KEY.format("observation_id")} observation_key,
               indicator_id, {KEY.format("indicator_id")} indicator_key,
               location_id, {KEY.format("location_id")} location_key,
               period_id, {KEY.format("period_id")} period_key,
               sex_id, {KEY.format("sex_id")} sex_key, "value"
        from (select event_id observation_id, cast({EVENT_ID} as bigint) indicator_id, user_id location_id,
                     cast(day(ts) as bigint) period_id, cast(coalesce({SEX_ID}, 0) as bigint) sex_id, "value"
              from events) e"""
)
def fct_observations(spark, sf):
    return M.fct_observations(build_staging(event_raw(spark, sf))["stg_observations"])
