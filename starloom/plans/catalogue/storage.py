"""Queries: sources, sinks and keyed changes. Each one really writes to a fresh folder and reads back."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators import dml
from starloom.operators.checks import Check, null_counts, rows_of
from starloom.operators.ingest import typed_observations
from starloom.plans.analytics import volumes
from starloom.plans.build import build_increment, build_warehouse
from starloom.plans.catalogue.models import K, SEX_ID
from starloom.plans.registry import query
from starloom.plans.testdata import event_number, event_raw, event_sex, table
from starloom.schemas import CHECK_DDL, DIMENSION_ITEM, SEX_ROWS
from starloom.session import scratch
from starloom.sinks import commits, files, publish
from starloom.sources import envelopes as E
from starloom.sources import tables as S

ROWS_PER_ENVELOPE = 500


def envelope_lines(items: DataFrame, page: Column, *keep: str) -> DataFrame:
    """Items as envelopes, one JSON text per page. Pages are cut from unique ids, so none grows with the data."""
    fields = [c for c in items.columns if c not in keep]
    pages = items.groupBy(*keep, page.alias("__page")).agg(F.collect_list(F.struct(*fields)).alias("value"))
    body = F.to_json(F.struct(F.lit("api/$metadata#items").alias(E.CONTEXT), "value"))
    return pages.select(*keep, body.alias("line"))


def page_of(unique_id: str) -> Column:
    return F.floor(F.col(unique_id) / ROWS_PER_ENVELOPE)


# --- sources ---------------------------------------------------------------------------------------------


@query("select c_custkey, c_name, c_nationkey from customer")
def src_odata_envelope(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    path = scratch(spark, "odata")
    envelope_lines(customer, page_of("c_custkey")).write.text(path)
    return E.read_odata(spark, path, "c_custkey BIGINT, c_name STRING, c_nationkey INT")


@query(
    f"""select event_type indicator_code, cast(user_id as varchar) country_code, cast(year(ts) as bigint) "year",
               case when {K} < 25 then 'MLE' when {K} < 50 then 'FMLE' end sex_code,
               case when event_type <> 'error' then "value" end as "value",
               case when event_type = 'error' then 'drop' else 'accept' end outcome
        from events"""
)
def src_observations(spark, sf):
    k = event_number()
    items = table(spark, sf, "events").select(
        F.col("event_type").alias("indicator_code"),
        F.col("user_id").cast("string").alias("SpatialDim"),
        F.year("ts").alias("TimeDim"),
        F.when(k < 25, "SEX_MLE").when(k < 50, "FMLE").when(k < 75, "AGEGROUP_YEARS05-09").alias("Dim1"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("NumericValue"),
        "event_id",
    )
    path = scratch(spark, "observations")
    lines = envelope_lines(items, page_of("event_id"), "indicator_code")
    lines.write.partitionBy("indicator_code").text(path)
    return typed_observations(E.read_observations(spark, path)).drop("read")


@query('select cast(p_partkey as varchar) "Code", p_name "Title" from part')
def src_dimensions_json(spark, sf):
    part = table(spark, sf, "part")
    codes = part.select(F.col("p_partkey").cast("string").alias("Code"), F.col("p_name").alias("Title"), "p_partkey")
    path = scratch(spark, "dimensions")
    envelope_lines(codes, page_of("p_partkey")).write.text(path)
    return E.read_odata(spark, path, DIMENSION_ITEM)


@query(
    """select case lang when 'fr' then 'corrupt' when 'de' then 'no_value' else 'ok' end kind, count(*) n
       from documents group by 1"""
)
def src_corrupt_json(spark, sf):
    item = F.struct(F.col("doc_id").cast("string").alias("Code"), F.col("text").alias("Title"))
    whole = F.to_json(F.struct(F.lit("api/$metadata#docs").alias(E.CONTEXT), F.array(item).alias("value")))
    bare = F.to_json(F.struct(F.lit("api/$metadata#docs").alias(E.CONTEXT)))
    cut = F.substring(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int"))
    line = F.when(F.col("lang") == "fr", cut).when(F.col("lang") == "de", bare).otherwise(whole)
    path = scratch(spark, "corrupt")
    table(spark, sf, "documents").select(line.alias("line")).write.text(path)
    return E.envelope_status(spark, path, DIMENSION_ITEM)


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def src_csv(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    path = scratch(spark, "csv")
    files.write_csv(customer, path)
    return S.read_csv(spark, path, customer.schema, multi_line=False)


@query("select c_custkey, c_name, c_nationkey, c_acctbal from customer")
def src_csv_reordered(spark, sf):
    """A file whose header has the columns in another order, and one more."""
    customer = table(spark, sf, "customer").select("c_mktsegment", "c_acctbal", "c_name", "c_nationkey", "c_custkey")
    path = scratch(spark, "csv-reordered")
    files.write_csv(customer, path)
    return S.read_csv(spark, path, "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE")


@query(
    """select 'csv' source, 'row' kind, count(*) n from customer where c_nationkey <> 3
       union all select 'csv', 'reject', count(*) from customer where c_nationkey = 3
       union all select 'json', 'row', count(*) from events where event_type <> 'error'
       union all select 'json', 'reject', count(*) from events where event_type = 'error'"""
)
def src_rejects(spark, sf):
    """Numbers that are none in a CSV file, and envelopes that are cut off, one event each."""
    wrong = F.when(F.col("c_nationkey") == 3, "three").otherwise(F.col("c_nationkey").cast("string"))
    csv, landed = scratch(spark, "csv-wrong"), scratch(spark, "landed-wrong")
    files.write_csv(table(spark, sf, "customer").select("c_custkey", wrong.alias("c_nationkey")), csv)
    item = F.array(F.struct(F.col("event_id").cast("string").alias("Code"), F.col("event_type").alias("Title")))
    whole = F.to_json(F.struct(item.alias("value")))
    cut = F.substring(whole, F.lit(1), F.length(whole) - 5)
    events = table(spark, sf, "events")
    events.select(F.when(F.col("event_type") == "error", cut).otherwise(whole).alias("line")).write.text(landed)
    read = {
        "csv": S.read_csv_and_rejects(spark, csv, "c_custkey BIGINT, c_nationkey INT"),
        "json": E.read_odata_and_rejects(spark, landed, DIMENSION_ITEM),
    }
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(source).alias("source"), F.lit(kind).alias("kind"), "n")
        for source, parsed in read.items()
        for kind, df in (("row", parsed.rows), ("reject", parsed.rejects.select("record", "partly_read")))
    ]
    return reduce(DataFrame.unionByName, counts)


@query("select event_id, event_type from events")
def src_landed_default(spark, sf):
    """Many envelopes per landed file, read with the reader's defaults."""
    events = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("Code"), F.col("event_type").alias("Title"))
    base = scratch(spark, "landed")
    path = files.land_raw(events.select(F.array(F.struct("Code", "Title")).alias("value")), base, "events", datetime(2024, 1, 1))
    items = E.read_odata(spark, path, DIMENSION_ITEM)
    return items.select(F.col("Code").cast("bigint").alias("event_id"), F.col("Title").alias("event_type"))


@query(
    """select doc_id, case lang when 'fr' then '' when 'es' then null else lang end lang, md5(text) digest, n_chars
       from documents"""
)
def snk_csv_roundtrip(spark, sf):
    """Texts with line breaks and quotes; the empty text and NULL come back as what they are."""
    blanked = F.when(F.col("lang") == "fr", "").when(F.col("lang") != "es", F.col("lang")).alias("lang")
    documents = table(spark, sf, "documents").select("doc_id", "text", blanked, "n_chars")
    path = scratch(spark, "csv-text")
    files.write_csv(documents, path)
    back = S.read_csv(spark, path, documents.schema)
    return back.select("doc_id", "lang", F.md5("text").alias("digest"), "n_chars")


@query(
    """select 'dim_indicators' table_name, count(distinct event_type) n from events
       union all select 'dim_locations', count(*) from customer
       union all select 'dim_periods', count(distinct day(ts)) from events
       union all select 'dim_sex', count(distinct case when json_extract_string(props, '$.k')::int < 25 then 1
              when json_extract_string(props, '$.k')::int < 50 then 2
              when json_extract_string(props, '$.k')::int < 75 then 3 end) from events
       union all select 'fact_observations', count(*) from events"""
)
def src_raw_tables(spark, sf):
    base = scratch(spark, "raw")
    for name, df in event_raw(spark, sf).items():
        df.write.parquet(f"{base}/{name}")
    return volumes(S.read_raw_all(spark, base))


@query(
    f"""select v.sex_code, v.sex_name, count(*) n
        from (values ('MLE', 'Male', 1), ('FMLE', 'Female', 2), ('BTSX', 'Both sexes', 3)) v(sex_code, sex_name, id)
        join events on {SEX_ID} = v.id group by 1, 2"""
)
def src_values(spark, sf):
    sexes = S.literal_rows(spark, SEX_ROWS, "sex_code STRING, sex_name STRING")
    counts = table(spark, sf, "events").groupBy(event_sex().alias("sex_code")).agg(F.count(F.lit(1)).alias("n"))
    return sexes.join(counts, "sex_code")


@query(
    """select 'star_customer' table_name, count(*) n from customer
       union all select 'star_events', count(*) from events
       union all select 'star_orders', count(*) from orders
       union all select 'star_part', count(*) from part"""
)
def src_catalog(spark, sf):
    for name in ("customer", "events", "orders", "part", "nation"):
        publish.as_view(table(spark, sf, name), f"star_{name}")
    names = S.catalog_tables(spark, like="star\\_%", not_like="%nation")
    counts = volumes({name: spark.table(name) for name in names})
    for name in (*names, "star_nation"):
        publish.drop_view(spark, name)
    return counts


def _summary_sql(name, columns):
    return " union all ".join(
        f"select '{name}' table_name, {i} cid, '{c}' column_name, '{t}' data_type, true nullable, {str(i == 0).lower()} pk, "
        f"count({c}) filled from {name}"
        for i, (c, t) in enumerate(columns)
    )


SUMMARY_SQL = " union all ".join(
    [
        _summary_sql(
            "orders",
            [
                ("o_orderkey", "bigint"),
                ("o_custkey", "bigint"),
                ("o_orderstatus", "string"),
                ("o_totalprice", "double"),
                ("o_orderdate", "timestamp_ntz"),
                ("o_orderpriority", "string"),
            ],
        ),
        _summary_sql("labels", [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")]),
    ]
)


def _keyed(spark, sf, name, key):
    """A table whose key column is marked in the schema."""
    df = table(spark, sf, name)
    return df.withColumn(key, F.col(key).alias(key, metadata={"pk": True}))


def _summarised(spark, sf):
    return {"orders": _keyed(spark, sf, "orders", "o_orderkey"), "labels": _keyed(spark, sf, "labels", "doc_id")}


@query(SUMMARY_SQL)
def src_schema_summary(spark, sf):
    return S.schema_summary(_summarised(spark, sf))


@query(SUMMARY_SQL)
def snk_schema_summary(spark, sf):
    path = scratch(spark, "summary")
    files.write_schema_summary(_summarised(spark, sf), path)
    ddl = "table_name STRING, cid INT, column_name STRING, data_type STRING, nullable BOOLEAN, pk BOOLEAN, filled BIGINT"
    return spark.read.schema(ddl).json(path)


_FRESH = ["customer", "events", "labels", "lineitem", "orders", "part"]


@query(
    " union all ".join(
        f"select '{name}.parquet' file, true has_bytes, true stamp_agrees, count(*) n from {name}" for name in _FRESH
    )
)
def health_freshness(spark, sf):
    """Rows per stored file, with what its size and time say."""
    return reduce(DataFrame.unionByName, [S.file_rows(table(spark, sf, name)) for name in _FRESH])


# --- sinks -----------------------------------------------------------------------------------------------


@query(
    """select case o_orderstatus when 'F' then '20240101_000000' when 'O' then '20240102_063000'
              else '20240103_235959' end ingest_ts, o_orderstatus status, count(*) n, cast(sum(o_orderkey) as bigint) keys
       from orders group by 1, 2"""
)
def snk_landing(spark, sf):
    base = scratch(spark, "landing")
    orders = table(spark, sf, "orders")
    at = {"F": datetime(2024, 1, 1), "O": datetime(2024, 1, 2, 6, 30), "P": datetime(2024, 1, 3, 23, 59, 59)}
    for status, ts in at.items():
        files.land_raw(orders.filter(F.col("o_orderstatus") == status), base, "orders", ts)
    landed = spark.read.schema("o_orderkey BIGINT, o_orderstatus STRING, ingest_ts STRING").json(f"{base}/orders")
    return landed.groupBy("ingest_ts", F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")
    )


@query(
    """select 'events' as "table", 'value' as "column", 'fail' status,
              cast(count(*) - count(nullif(event_type, 'error')) as double) observed from events
       union all
       select 'orders', 'o_custkey', 'pass', cast(count(*) - count(o_custkey) as double) from orders"""
)
def snk_report_jsonl(spark, sf):
    path = scratch(spark, "report")
    events = table(spark, sf, "events").withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    for name, df, column in (("events", events, "value"), ("orders", table(spark, sf, "orders"), "o_custkey")):
        nulls = null_counts(df, [column])
        files.append_report(rows_of(nulls, Check("raw", name, "not_null", column, "c0", hi=0)), path)
    return spark.read.schema(CHECK_DDL).json(path).select("table", "column", "status", "observed")


@query("select count(*) n from orders where o_orderstatus = 'F'")
def mat_view(spark, sf):
    publish.as_view(table(spark, sf, "orders"), "starloom_orders")
    counted = spark.sql("select count(*) n from starloom_orders where o_orderstatus = 'F'")
    publish.drop_view(spark, "starloom_orders")
    return counted


@query("select c_mktsegment, count(*) n from customer group by 1")
def mat_table(spark, sf):
    path = scratch(spark, "table")
    spark.sql("DROP TABLE IF EXISTS starloom_customer")
    for _ in range(2):
        publish.as_table(table(spark, sf, "customer"), "starloom_customer", path)
    return spark.table("starloom_customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("select p_partkey from part where p_type = 'PROMO' union select l_partkey from lineitem")
def mat_temp(spark, sf):
    """A batch staged under a name, inserted where its key is new, and the name dropped again."""
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    publish.as_view(lines, "starloom_temp")
    known = table(spark, sf, "part").filter("p_type = 'PROMO'").select("p_partkey")
    merged = dml.insert_ignore(known, spark.table("starloom_temp"), "p_partkey")
    publish.drop_view(spark, "starloom_temp")
    return merged


@query("select s_suppkey, s_name, s_acctbal from supplier")
def ddl_recreate(spark, sf):
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    for _ in range(2):
        publish.recreate(spark, "starloom_supplier", supplier.schema, scratch(spark, "recreate"))
    supplier.write.insertInto("starloom_supplier")
    return spark.table("starloom_supplier")


@query(
    """select 'dim_indicator' table_name, count(distinct event_type) n from events
       union all select 'dim_location', count(*) from customer
       union all select 'dim_period', count(distinct day(ts)) from events
       union all select 'dim_sex', 1 + count(distinct least(cast(json_extract_string(props, '$.k') as int) // 25, 2)) from events where cast(json_extract_string(props, '$.k') as int) < 75
       union all select 'fct_observations', count(*) from events"""
)
def mat_warehouse(spark, sf):
    """Two builds of the star of events: the second rebuilds the dimensions and upserts the same facts."""
    base = scratch(spark, "warehouse")
    for _ in range(2):
        star = build_warehouse(event_raw(spark, sf), base)
    return volumes(star.tables)


@query(
    """select event_id observation_id, cast(day(ts) as bigint) period_id, case when day(ts) = 3 then "value" + 1000 else "value" end as "value"
       from events where day(ts) <> 5 or event_type <> 'error'"""
)
def mat_incremental(spark, sf):
    """All but some facts of the fifth, then the third with corrected values: one partition is rewritten."""
    raw = dict(event_raw(spark, sf))
    facts = raw["fact_observations"].filter("period_id <> 5 or indicator_id <> 5")
    base = scratch(spark, "increment")
    build_increment(raw | {"fact_observations": facts}, base)
    corrected = facts.withColumn("value", F.when(F.col("period_id") == 3, F.col("value") + 1000).otherwise(F.col("value")))
    star = build_increment(raw | {"fact_observations": corrected}, base, periods=[3])
    return star.fact.select("observation_id", "period_id", "value")


# --- keyed changes ---------------------------------------------------------------------------------------


def _known_and_corrected(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A table without the errors, and a batch that corrects purchases and brings the errors."""
    known = events.filter(F.col("event_type") != "error")
    batch = events.filter(F.col("event_type").isin("purchase", "error")).withColumn("value", F.col("value") + 1000)
    return known, batch


@query(
    """select event_id, event_type,
              case when event_type in ('purchase', 'error') then "value" + 1000 else "value" end as "value"
       from events"""
)
def dml_upsert(spark, sf):
    known, batch = _known_and_corrected(table(spark, sf, "events").select("event_id", "event_type", "value"))
    return dml.upsert(known, batch, ["event_id"])


@query(
    """select event_id, case when event_type <> 'error' then user_id end user_id,
              case when event_type in ('purchase', 'error') then 'new' end flag
       from events where event_type <> 'purchase' union all
       select event_id, null, 'new' from events where event_type = 'purchase'"""
)
def dml_schema_evolution(spark, sf):
    known, batch = _known_and_corrected(table(spark, sf, "events").select("event_id", "event_type", "value", "user_id"))
    merged = dml.upsert(known, batch.drop("user_id").withColumn("flag", F.lit("new")), ["event_id"])
    return merged.select("event_id", "user_id", "flag")


@query(
    """select p_brand, coalesce(min(case when p_type = 'PROMO' then p_partkey end), min(p_partkey)) first_key
       from part where p_brand <> 'Brand#7' group by p_brand
       union all select null, p_partkey from part where p_brand = 'Brand#7'"""
)
def dml_insert_ignore(spark, sf):
    part = table(spark, sf, "part")
    brands = part.select(F.nullif(F.col("p_brand"), F.lit("Brand#7")).alias("p_brand"), F.col("p_partkey").alias("first_key"), "p_type")
    known = brands.filter("p_type = 'PROMO' and p_brand is not null").groupBy("p_brand").agg(F.min("first_key").alias("first_key"))
    return dml.insert_ignore(known, brands.drop("p_type"), "p_brand")


@query("select p_brand, min(p_partkey) first_key, min_by(p_name, p_partkey) p_name from part group by p_brand")
def dml_first_wins(spark, sf):
    """Of the rows of a brand the one that stands first in the files, whatever its name."""
    path = scratch(spark, "csv-first")
    listed = table(spark, sf, "part").select("p_brand", F.col("p_partkey").alias("first_key"), "p_name")
    files.write_csv(listed.repartitionByRange("first_key").sortWithinPartitions("first_key"), path)
    back = S.read_csv(spark, path, listed.schema, multi_line=False, position="position")
    return dml.first_per_key(back, "p_brand", ["position"]).drop("position")


@query(
    """select n_nationkey, n_name, max_by(s_name, s_suppkey) filled from nation join supplier on s_nationkey = n_nationkey group by 1, 2
       union all select n_nationkey, n_name, null from nation where n_nationkey not in (select s_nationkey from supplier)"""
)
def dml_enrich_last_wins(spark, sf):
    """Nations without a name take that of their supplier that stands last in the files."""
    path = scratch(spark, "csv-last")
    suppliers = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_name", "s_suppkey")
    files.write_csv(suppliers.repartitionByRange("s_suppkey").sortWithinPartitions("s_suppkey"), path)
    lookup = S.read_csv(spark, path, "n_nationkey INT, s_name STRING", multi_line=False, position="position")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name", F.lit(None).cast("string").alias("filled"))
    return dml.enrich(nations, lookup, "n_nationkey", "filled", "s_name", F.col("position"))


@query(
    """select c_name, c_custkey id from customer where c_mktsegment = 'BUILDING'
       union all
       select c_name, (select max(c_custkey) from customer where c_mktsegment = 'BUILDING')
              + row_number() over (order by c_name) from customer where c_mktsegment <> 'BUILDING'"""
)
def dml_assign_ids(spark, sf):
    customer = table(spark, sf, "customer")
    known = customer.filter("c_mktsegment = 'BUILDING'").select("c_name", F.col("c_custkey").alias("id"))
    return dml.assign_ids(customer.select("c_name"), known, "c_name", "id").select("c_name", "id")


def _observations(spark, sf) -> DataFrame:
    return event_raw(spark, sf)["fact_observations"].drop("observation_id")


_FACTS = f"""select cast(case event_type when 'click' then 1 when 'view' then 2 when 'purchase' then 3
                                        when 'signup' then 4 else 5 end as bigint) indicator_id, user_id location_id, cast(day(ts) as bigint) period_id,
                    cast({SEX_ID} as bigint) sex_id, "value" from events"""
_KEY = "indicator_id, location_id, period_id, sex_id"


@query(
    f"""select row_number() over (order by indicator_id, location_id, period_id, sex_id nulls first, "value") observation_id,
               row_number() over (partition by {_KEY} order by "value") copy_no, {_KEY}, "value",
               cast(null as varchar) load_unit
        from ({_FACTS}) f"""
)
def dml_load_facts(spark, sf):
    return dml.load_facts(_observations(spark, sf))


@query(
    f"""with f as (select *, row_number() over (partition by {_KEY} order by "value") copy_no from ({_FACTS}) x),
             o as (select row_number() over (partition by indicator_id = 1
                          order by indicator_id, location_id, period_id, sex_id nulls first, copy_no) i, f.* from f)
        select case when indicator_id = 1 then i + (select count(*) from f where indicator_id <> 1) else i end observation_id,
               copy_no, {_KEY}, "value", cast(null as varchar) load_unit from o"""
)
def dml_reload_facts(spark, sf):
    """A load without clicks, then the whole payload: known facts keep their ids, clicks are numbered on."""
    observations = _observations(spark, sf).withColumn("load_unit", F.lit(None).cast("string"))
    base = scratch(spark, "facts")
    publish.publish(dml.load_facts(observations.filter("indicator_id <> 1")), base)
    known = publish.current(spark, base)
    return dml.upsert(known, dml.load_facts(observations, known), ["observation_id"])


@query(f"""select {_KEY}, "value", case when "value" < 20 then 'low' else 'high' end load_unit from ({_FACTS}) f""")
def dml_load_in_two_parts(spark, sf):
    """Low and high values come in two loads, the first of them twice; keys own rows of both, and none is lost."""
    observations = _observations(spark, sf)
    base = scratch(spark, "facts-parts")
    for unit, part in (("low", "value < 20"), ("high", "value >= 20"), ("low", "value < 20")):
        batch = observations.filter(part).withColumn("load_unit", F.lit(unit))
        known = publish.current(spark, base) if publish.exists(spark, base) else None
        loaded = dml.load_facts(batch, known)
        publish.publish(loaded if known is None else dml.upsert(known, loaded, ["observation_id"]), base)
    return publish.current(spark, base).drop("observation_id", "copy_no")


@query(
    """select c_custkey, case when c_mktsegment in ('BUILDING', 'MACHINERY') and c_acctbal >= 0 then c_mktsegment
                              when c_mktsegment = 'BUILDING' then '' when c_mktsegment = 'MACHINERY' then null
                              else c_mktsegment end seg
       from customer"""
)
def dml_enrich_update(spark, sf):
    customer = table(spark, sf, "customer")
    segment = F.col("c_mktsegment")
    blanked = F.when(segment == "BUILDING", "").when(segment != "MACHINERY", segment)
    lookup = customer.filter("c_acctbal >= 0").select("c_custkey", F.col("c_mktsegment").alias("found"))
    return dml.enrich(customer.select("c_custkey", blanked.alias("seg")), lookup, "c_custkey", "seg", "found")


@query(
    """select o_orderkey, case when o_orderstatus = 'P' then o_totalprice + 1 else o_totalprice end price from orders"""
)
def dml_atomic_publish(spark, sf):
    """Two published versions and a load that broke off; readers see the second."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), "o_orderstatus")
    base = scratch(spark, "publish")
    publish.publish(orders.drop("o_orderstatus"), base)
    fixed = orders.filter("o_orderstatus = 'P'").withColumn("price", F.col("price") + 1).drop("o_orderstatus")
    publish.publish_upsert(fixed, base, ["o_orderkey"])
    broken_off = orders.filter("o_orderstatus = 'F'").drop("o_orderstatus").write
    broken_off.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{base}/version=00000003")
    return publish.current(spark, base)


@query(
    """select event_id, case event_type when 'error' then 'view' else event_type end event_type,
              case when event_type = 'signup' then "value" + 1000 else "value" end as "value", partitions
       from events, (select count(distinct event_type) - 1 as partitions from events)"""
)
def dml_commit_upsert(spark, sf):
    """Signups get new values and errors become views in one commit; one that began from the state before it is refused."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    base, kind = scratch(spark, "commits"), F.col("event_type")
    before = commits.commit_upsert(events, base, ["event_id"], "event_type")
    batch = events.filter(kind.isin("signup", "error")).select(
        "event_id",
        F.when(kind == "error", "view").otherwise(kind).alias("event_type"),
        F.when(kind == "signup", F.col("value") + 1000).otherwise(F.col("value")).alias("value"),
    )
    after = commits.commit_upsert(batch, base, ["event_id"], "event_type", at=before)
    late = events.filter("event_type = 'click'").withColumn("value", F.lit(0.0))
    try:
        commits.commit_upsert(late, base, ["event_id"], "event_type", at=before)
    except commits.Overtaken:
        return commits.read_commit(spark, base).withColumn("partitions", F.lit(len(after.folders)).cast("long"))
    raise AssertionError("a commit from an old state was not refused")


@query(
    """select event_id, case event_type when 'error' then 'view' else event_type end event_type,
              case when event_type = 'signup' then "value" + 1000 else "value" end as "value"
       from events"""
)
def dml_upsert_partitions(spark, sf):
    """Signups get new values; errors become views, which leaves their partition empty."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    path = scratch(spark, "partitioned")
    publish.upsert_partitions(events, path, ["event_id"], "event_type")
    kind = F.col("event_type")
    batch = events.filter(kind.isin("signup", "error")).select(
        "event_id",
        F.when(kind == "error", "view").otherwise(kind).alias("event_type"),
        F.when(kind == "signup", F.col("value") + 1000).otherwise(F.col("value")).alias("value"),
    )
    publish.upsert_partitions(batch, path, ["event_id"], "event_type")
    return spark.read.parquet(path).select("event_id", "event_type", "value")
