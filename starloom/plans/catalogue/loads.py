"""Queries: the load from landed files to the marts, with what it rejects and what it adds to the places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.ingest import REJECT_DDL
from starloom.plans.catalogue.storage import envelope_lines, page_of
from starloom.plans.loading import (
    DIMENSIONS,
    empty_raw,
    enrich_locations,
    load_dimensions,
    load_observations,
    store_dimensions,
    store_observations,
    stored_raw,
)
from starloom.plans.marts import build_star
from starloom.plans.registry import query
from starloom.plans.testdata import event_number, table
from starloom.schemas import CATEGORIZED_CSV
from starloom.session import materialise, scratch
from starloom.sinks import files
from starloom.sources import envelopes as E
from starloom.sources import tables as S

# Events as landed items: signups are of no listed indicator, errors have no value, some users are no place, some values no numbers.
_K = "cast(json_extract_string(props, '$.k') as int)"
_ITEMS = f"""select event_type indicator_code, case when user_id % 50 <> 7 then cast(user_id as varchar) end country_code,
                    cast(year(ts) as bigint) "year", case when {_K} < 25 then 'MLE' when {_K} < 50 then 'FMLE' end sex_code,
                    case when {_K} < 25 then 'SEX_MLE' when {_K} < 50 then 'FMLE' end sex_text,
                    case when event_type <> 'error' and user_id % 50 <> 8 then "value" end as "value",
                    case when event_type <> 'error' and user_id % 50 = 8 then 'x' || event_id end value_text,
                    case when event_id % 2 = 0 then 'even' else 'odd' end load_unit from events"""
_LOADABLE = "indicator_code not in ('signup', 'error') and country_code is not null and value_text is null"


def _listed(spark, sf, base: str) -> DataFrame:
    """The categorized list of the event types but one, read back from CSV."""
    listed = table(spark, sf, "events").filter("event_type <> 'signup'").select(F.col("event_type").alias("IndicatorCode")).distinct()
    named = listed.select("IndicatorCode", F.initcap("IndicatorCode").alias("IndicatorName"), F.substring("IndicatorCode", 1, 1).alias("Category"))
    files.write_csv(named, f"{base}/categorized")
    return S.read_csv(spark, f"{base}/categorized", CATEGORIZED_CSV, position="position")


def _landed(spark, sf, base: str) -> None:
    """All events as envelopes, in the landings ``even`` and ``odd``."""
    k = event_number()
    unreadable = F.concat(F.lit("x"), F.col("event_id").cast("string"))
    value = F.when(F.col("user_id") % 50 == 8, unreadable).otherwise(F.col("value").cast("string"))
    items = table(spark, sf, "events").select(
        F.col("event_type").alias("indicator_code"),
        F.when(F.col("user_id") % 50 != 7, F.col("user_id").cast("string")).alias("SpatialDim"),
        F.year("ts").alias("TimeDim"),
        F.when(k < 25, "SEX_MLE").when(k < 50, "FMLE").alias("Dim1"),
        F.when(F.col("event_type") != "error", value).alias("NumericValue"),
        "event_id",
    )
    for unit, rest in (("even", 0), ("odd", 1)):
        part = items.filter(F.col("event_id") % 2 == rest)
        envelope_lines(part, page_of("event_id"), "indicator_code").write.partitionBy("indicator_code").text(f"{base}/{unit}")


def _loaded(spark, sf) -> tuple[dict[str, DataFrame], str]:
    """Stored raw tables after two landings, the first of them loaded twice, and the folder of rejects."""
    base = scratch(spark, "load")
    store_dimensions(spark, f"{base}/raw", _listed(spark, sf, base))
    _landed(spark, sf, base)
    for unit in ("even", "odd", "even"):
        items = E.read_observations(spark, f"{base}/{unit}", file="file")
        store_observations(spark, f"{base}/raw", items, unit=unit, rejects=f"{base}/rejects")
    return stored_raw(spark, f"{base}/raw")[0], f"{base}/rejects"


@query(
    f"""select indicator_code, country_code, "year", coalesce(sex_code, 'UNK') sex_code, "value" from ({_ITEMS}) i
        where {_LOADABLE}"""
)
def load_end_to_end(spark, sf):
    """Landed envelopes to raw tables to marts, each fact with the codes of its dimensions."""
    star = build_star(_loaded(spark, sf)[0])
    facts = star.fact
    for dim, fk, nk in (
        (star.indicator, "indicator_id", "indicator_nk"),
        (star.location, "location_id", "location_nk"),
        (star.period, "period_id", "period_nk"),
        (star.sex, "sex_id", "sex_nk"),
    ):
        facts = facts.join(dim, facts[fk] == dim[nk])
    return facts.select("indicator_code", "country_code", "year", "sex_code", "value")


@query(
    f"""select load_unit, indicator_code, country_code "SpatialDim", cast("year" as varchar) "TimeDim", sex_text "Dim1", value_text,
               "value", load_unit file, case when country_code is null or value_text is not null then 'unusable field' else 'unknown indicator' end reason
        from ({_ITEMS}) i where ("value" is not null or value_text is not null)
                            and (country_code is null or value_text is not null or indicator_code = 'signup')"""
)
def load_rejects(spark, sf):
    """What the load could not take, as it is stored per landing: the fields as they were read, and where from."""
    stored = spark.read.schema(f"{REJECT_DDL}, load_unit STRING").parquet(_loaded(spark, sf)[1])
    text = F.col("NumericValue")
    return stored.select(
        "load_unit",
        "indicator_code",
        "SpatialDim",
        "TimeDim",
        "Dim1",
        F.when(text.startswith("x"), text).alias("value_text"),
        text.try_cast("double").alias("value"),
        F.regexp_extract("file", "/(even|odd)/", 1).alias("file"),
        "reason",
    )


@query(
    f"""select indicator_code, country_code, "year", coalesce(sex_code, 'none') sex_code, "value", 3 * count(*) n, 3 * count(*) ids from ({_ITEMS}) i
        where {_LOADABLE} group by all"""
)
def load_without_unit(spark, sf):
    """The same landings three times without naming a unit: every load adds, as nothing says that they are the same."""
    base = scratch(spark, "load-unnamed")
    raw = load_dimensions(empty_raw(spark), _listed(spark, sf, base))
    _landed(spark, sf, base)
    items = E.read_observations(spark, f"{base}/even").unionByName(E.read_observations(spark, f"{base}/odd"))
    for _ in range(3):
        raw = load_observations(raw, items)
        raw["fact_observations"] = materialise(raw["fact_observations"], "facts")
    facts = raw["fact_observations"]
    for name, id_ in DIMENSIONS.items():
        facts = facts.join(raw[name], id_, "left")
    keys = ["indicator_code", "country_code", "year", F.coalesce("sex_code", F.lit("none")).alias("sex_code"), "value"]
    return facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("observation_id").alias("ids"))


@query(
    f"""select distinct country_code, c_name country_name from ({_ITEMS}) i left join customer on country_code = cast(c_custkey as varchar)
        where {_LOADABLE}"""
)
def load_enriched(spark, sf):
    """Places that the load brought, with their names from a list."""
    raw = _loaded(spark, sf)[0]
    path = scratch(spark, "names")
    names = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("ISO3166-1-Alpha-3"), F.col("c_name").alias("official_name_en"))
    files.write_csv(names, path)
    lookup = S.read_csv(spark, path, names.schema, position="position")
    return enrich_locations(raw, lookup)["dim_locations"].select("country_code", "country_name")
