"""Queries: reports over the star of line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators import current
from starloom.operators import summaries as Z
from starloom.operators.star import value_counts
from starloom.plans import analytics as A
from starloom.plans.marts import build_star
from starloom.plans.registry import query
from starloom.plans.testdata import event_star, sales_raw, sales_star, table
from starloom.session import materialise, scratch
from starloom.sinks.commits import commit_upsert, read_commit


@query(
    """select p_type category, count(*) total from lineitem join part on l_partkey = p_partkey
       group by 1 order by total desc, category limit 15"""
)
def ana_count_by_category(spark, sf):
    return A.observations_by_category(sales_star(spark, sf))


@query(
    """select p_brand indicator_code, p_name indicator_name, count(*) total
       from lineitem join part on l_partkey = p_partkey
       group by 1, 2 order by total desc, 1, 2 limit 10"""
)
def ana_top_indicators(spark, sf):
    return A.top_indicators(sales_star(spark, sf))


@query(
    """select case l_returnflag when 'N' then 'UNK' else l_returnflag end sex_code,
              case l_returnflag when 'N' then 'Unknown' else concat('flag ', l_returnflag) end sex_name,
              count(*) total
       from lineitem group by 1, 2"""
)
def ana_count_by_sex(spark, sf):
    return A.observations_by_sex(sales_star(spark, sf))


@query(
    """select cast(year(l_shipdate) as bigint) "year", p_type category, round(avg(l_quantity), 4) avg_value
       from lineitem join part on l_partkey = p_partkey
       where p_type in (select p_type from part group by p_type) group by 1, 2"""
)
def ana_trend_avg(spark, sf):
    return A.yearly_average(sales_star(spark, sf)).withColumn("avg_value", F.round("avg_value", 4))


@query(
    """select cast(year(l_shipdate) as bigint) "year", p_type category, round(avg(l_quantity), 4) avg_value
       from lineitem join part on l_partkey = p_partkey
       where p_type in (select p_type from part group by p_type having avg(p_retailprice) > (select avg(p_retailprice) from part))
       group by 1, 2"""
)
def ana_trend_avg_listed(spark, sf):
    """The same for the categories whose parts cost more than the average part."""
    prices = table(spark, sf, "part").select(F.col("p_type").alias("category"), "p_retailprice")
    mean = prices.agg(F.avg("p_retailprice")).scalar()
    dear = prices.groupBy("category").agg(F.avg("p_retailprice").alias("price")).filter(F.col("price") > mean)
    return A.yearly_average(sales_star(spark, sf), dear).withColumn("avg_value", F.round("avg_value", 4))


@query(
    """select n_name country_code, s_name country_name, count(*) total
       from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
       group by 1, 2 order by total desc, 1, 2 limit 10"""
)
def ana_top_locations(spark, sf):
    return A.top_locations(sales_star(spark, sf))


@query("select p_type category, count(*) total from part group by 1")
def ana_indicators_per_category(spark, sf):
    return A.indicators_per_category(sales_star(spark, sf))


@query(
    """select event_id observation_id, event_type indicator_code, c_name country_code,
              cast(1990 + day(ts) as bigint) "year",
              case when k < 25 then 'MLE' when k < 50 then 'FMLE' when k < 75 then 'BTSX' else 'UNK' end sex_code,
              "value"
       from (select *, cast(json_extract_string(props, '$.k') as int) k from events) e
       left join customer on user_id = c_custkey
       order by event_id limit 1000"""
)
def ana_denormalised_sample(spark, sf):
    return A.observation_sample(event_star(spark, sf))


@query(
    """select 'dim_indicator' tabela, count(*) mart_rows from part
       union all select 'dim_location', count(*) from supplier
       union all select 'dim_period', count(distinct year(l_shipdate)) from lineitem
       union all select 'dim_sex', count(distinct l_returnflag) from lineitem
       union all select 'fct_observations', count(*) from lineitem"""
)
def ana_volumes(spark, sf):
    return A.volumes(sales_star(spark, sf).tables, "tabela", "mart_rows").orderBy("tabela")


@query(
    """select 'dim_indicator.indicator_key' "key", count(*) total, count(*) uniques, count(*) - count(*) duplicates from part
       union all
       select 'fct_observations.observation_id', count(*), count(distinct l_orderkey * 8 + l_linenumber),
              count(*) - count(distinct l_orderkey * 8 + l_linenumber) from lineitem"""
)
def ana_uniqueness(spark, sf):
    star = sales_star(spark, sf)
    return A.key_uniqueness(
        {
            "dim_indicator.indicator_key": (star.indicator, "indicator_key"),
            "fct_observations.observation_id": (star.fact, "observation_id"),
        }
    )


@query(
    """select (select count(*) from lineitem) observations, (select count(*) from part) indicators,
              (select count(*) from supplier) locations"""
)
def kpi_counts(spark, sf):
    return A.headline_counts(sales_star(spark, sf))


@query(
    """select concat(cast(min(year(l_shipdate)) as varchar), '–', cast(max(year(l_shipdate)) as varchar)) period
       from lineitem"""
)
def kpi_period_range(spark, sf):
    return A.period_range(sales_star(spark, sf))


@query("select p_brand, count(*) n from part where p_brand is not null group by 1 order by n desc, p_brand limit 20")
def agg_value_counts(spark, sf):
    return value_counts(table(spark, sf, "part"), "p_brand", 20)


@query("select p_type category, count(*) n from part where p_type <> 'PROMO' group by 1")
def agg_value_counts_all(spark, sf):
    part = table(spark, sf, "part").select(F.nullif(F.col("p_type"), F.lit("PROMO")).alias("category"))
    return value_counts(part, "category")


@query("select distinct coalesce(nullif(p_type, 'PROMO'), 'UNCATEGORIZED') category from part")
def agg_distinct(spark, sf):
    return A.categories(build_star(sales_raw(spark, sf, dirty=True)))


# --- summaries that merge ----------------------------------------------------------------------------------


@query(
    """select event_type, event_id, md5('7:' || event_id) draw from events
       qualify row_number() over (partition by event_type order by draw, event_id) <= 100"""
)
def sample_per_type(spark, sf):
    """A hundred events of each type: of two halves, each sampled by itself, and merged."""
    events = table(spark, sf, "events").select("event_type", "event_id")
    halves = [Z.sample_per_group(events.filter(f"event_id % 2 = {i}"), "event_type", "event_id", 100, seed=7) for i in (0, 1)]
    return Z.merge_samples(materialise(halves[0], "sample").unionByName(halves[1]), "event_type", "event_id", 100)


@query("select l_suppkey, count(*) n from lineitem where l_suppkey is not null group by 1 order by n desc, l_suppkey limit 10")
def agg_leading_suppliers(spark, sf):
    """Suppliers are about equally frequent, so a summary of few counters proves nothing and all are counted."""
    return Z.top_keys(table(spark, sf, "lineitem"), "l_suppkey", 10, tracked=64).rows


@query("select user_id, n from (select case when event_id % 3 = 0 then 0 else user_id end user_id, count(*) n from events group by 1) order by n desc, user_id limit 1")
def agg_hot_user(spark, sf):
    """One user has a third of the events, which the summary proves."""
    events = table(spark, sf, "events").withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")))
    found = Z.top_keys(events, "user_id", 1, tracked=64)
    if not found.proved:
        raise AssertionError("a third of all rows was not told from the rest")
    return found.rows


@query("select l_returnflag, true near from lineitem group by 1 union all select 'all', true")
def agg_distinct_merged(spark, sf):
    """Sketches of the orders per return flag and line status, merged by flag and over all, are within 3 percent."""
    lines = table(spark, sf, "lineitem")
    stored = materialise(Z.distinct_sketches(lines, ["l_returnflag", "l_linestatus"], "l_orderkey"), "sketches")
    exact = lines.groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("exact"))
    in_all = lines.agg(F.count_distinct("l_orderkey").alias("exact")).select(F.lit("all").alias("l_returnflag"), "exact")
    about = Z.distinct_counts(stored, ["l_returnflag"]).unionByName(Z.distinct_counts(stored, []).select(F.lit("all").alias("l_returnflag"), "n"))
    both = about.join(exact.unionByName(in_all), "l_returnflag")
    return both.select("l_returnflag", (F.abs(F.col("n") - F.col("exact")) <= 0.03 * F.col("exact")).alias("near"))


@query(
    """select case event_type when 'error' then 'view' else event_type end event_type, count(*) total, count("value") n_values,
              round(cast(sum(cast("value" as decimal(28, 9))) as double), 6) sum_value,
              round(cast(sum(cast("value" as decimal(28, 9))) as double) / count("value"), 6) avg_value
       from events group by 1"""
)
def ana_kept_current(spark, sf):
    """Counts and averages per type of event, brought up to date after each of three loads, two of which correct or move rows."""
    day = F.dayofmonth("ts").alias("day")
    events = table(spark, sf, "events").select("event_id", day, "event_type", "value")
    base, report = scratch(spark, "current"), scratch(spark, "current-report")
    kind, odd = F.col("event_type"), F.col("event_id") % 2 == 1
    first = events.filter(kind != "purchase").withColumn("value", F.when(odd, 0.0).otherwise(F.col("value")))
    second = events.filter((kind != "purchase") & odd)
    third = events.filter(kind.isin("purchase", "error")).withColumn("event_type", F.when(kind == "error", "view").otherwise(kind))
    for load in (first, second, third):
        commit_upsert(load, base, ["event_id", "day"], "day")
        current.refresh(spark, base, report, ["event_type"], "value")
    found = current.read_report(spark, report)
    return found.withColumns({"sum_value": F.round(F.col("sum_value").cast("double"), 6), "avg_value": F.round("avg_value", 6)})


@query(
    """select extract(year from o_orderdate) * 100 + extract(month from o_orderdate) "month", count(*) total,
              cast(sum(case when o_orderkey % 7 = 0 then 1 else 0 end) as bigint) corrected
       from orders group by 1"""
)
def dml_commit_moves(spark, sf):
    """Orders filed under a wrong month are moved by commits that read only months that may hold them."""
    month = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("long").alias("month")
    orders = table(spark, sf, "orders").select("o_orderkey", month)
    base, wrong = scratch(spark, "moves"), F.col("o_orderkey") % 7 == 0
    filed = orders.select("o_orderkey", F.when(wrong, F.lit(0).cast("long")).otherwise(F.col("month")).alias("month"), F.lit(0).alias("corrected"))
    commit_upsert(filed, base, ["o_orderkey"], "month")
    commit_upsert(orders.filter(wrong).withColumn("corrected", F.lit(1)), base, ["o_orderkey"], "month")
    return read_commit(spark, base).groupBy("month").agg(F.count(F.lit(1)).alias("total"), F.sum("corrected").alias("corrected"))
