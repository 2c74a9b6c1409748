"""Queries: landed files taken in as a stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from starloom.plans.registry import query
from starloom.plans.testdata import table
from starloom.schemas import struct
from starloom.session import scratch
from starloom.sinks.commits import read_commit
from starloom.sinks.files import land_raw
from starloom.sources.envelopes import envelope_schema, unpack
from starloom.streaming.commits import commit_available
from starloom.streaming.landing import ingest_available, landed_stream, upsert_available

FIRST, SECOND, THIRD = datetime(2024, 1, 31, 6), datetime(2024, 2, 1, 6), datetime(2024, 2, 2, 6)


@query("select event_id, event_type, case event_type when 'error' then '20240201_060000' else '20240131_060000' end ingest_ts from events")
def str_landing_ingest(spark, sf):
    """Envelopes landed twice, with a run of the stream after each landing and one more with nothing new."""
    events = table(spark, sf, "events").select("event_id", "event_type")
    base, out, state = (scratch(spark, name) for name in ("land", "stream-out", "stream-state"))
    schema = envelope_schema(events.schema)
    item = F.array(F.struct("event_id", "event_type")).alias("value")
    for ts, rows in (
        (FIRST, events.filter("event_type <> 'error'")),
        (SECOND, events.filter("event_type = 'error'")),
    ):
        land_raw(rows.select(item), base, "events", ts)
        for _ in range(1 if ts == FIRST else 2):
            stream = landed_stream(spark, f"{base}/events", schema)
            ingest_available(stream, out, state, lambda landed: unpack(landed, "ingest_ts"))
    return spark.read.parquet(out).select("event_id", "event_type", "ingest_ts")


@query(
    """select event_id, event_type, case when event_type in ('purchase', 'error') then "value" + 1000 else "value" end as "value"
       from events"""
)
def str_upsert(spark, sf):
    """All events land first; purchases and errors land again with other values and replace themselves."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    base, out, state = (scratch(spark, name) for name in ("land", "upsert-out", "upsert-state"))
    corrected = events.filter(F.col("event_type").isin("purchase", "error")).withColumn("value", F.col("value") + 1000)
    for ts, rows in ((FIRST, events), (SECOND, corrected)):
        land_raw(rows, base, "events", ts)
        stream = landed_stream(spark, f"{base}/events", struct("event_id BIGINT, event_type STRING, value DOUBLE"))
        upsert_available(stream, out, state, ["event_id"], "event_type")
    return spark.read.parquet(out).select("event_id", "event_type", "value")


@query(
    """select event_id, event_type, case when event_type in ('purchase', 'error') then "value" + 1000 else "value" end as "value"
       from events"""
)
def str_out_of_order(spark, sf):
    """The later landing, with the corrected values, is read before the earlier one, and stays."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    base, out, state = (scratch(spark, name) for name in ("land", "order-out", "order-state"))
    corrected = events.filter(F.col("event_type").isin("purchase", "error")).withColumn("value", F.col("value") + 1000)
    for ts, rows in ((SECOND, corrected), (FIRST, events)):
        land_raw(rows, base, "events", ts)
        stream = landed_stream(spark, f"{base}/events", struct("event_id BIGINT, event_type STRING, value DOUBLE"))
        upsert_available(stream, out, state, ["event_id"], "event_type")
    return spark.read.parquet(out).select("event_id", "event_type", "value")


@query(
    """select case event_type when 'signup' then 'reject' else 'row' end kind, event_type, count(*) n, cast(sum(event_id) as bigint) keys
       from (select case event_type when 'signup' then null else event_id end event_id, event_type from events) e group by 1, 2"""
)
def str_null_keys(spark, sf):
    """Events without an id are set aside; the landing is replayed from an empty checkpoint and changes nothing."""
    key = F.when(F.col("event_type") != "signup", F.col("event_id")).alias("event_id")
    events = table(spark, sf, "events").select(key, "event_type")
    base, out, rejects = (scratch(spark, name) for name in ("land", "null-out", "null-rejects"))
    land_raw(events, base, "events", FIRST)
    ddl = "event_id BIGINT, event_type STRING"
    for state in ("once", "again"):
        stream = landed_stream(spark, f"{base}/events", struct(ddl))
        upsert_available(stream, out, scratch(spark, state), ["event_id"], "event_type", rejects=rejects)
    found = {"row": spark.read.parquet(out), "reject": spark.read.schema(ddl).json(rejects)}
    parts = [
        df.groupBy(F.lit(kind).alias("kind"), F.col("event_type").cast("string").alias("event_type")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("keys")
        )
        for kind, df in found.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    """select case event_type when 'error' then 'reject' else 'row' end kind, count(*) n,
              cast(sum(case when event_type <> 'error' then event_id end) as bigint) keys
       from events group by 1"""
)
def str_corrupt_lines(spark, sf):
    """Landed lines of which some are cut off: the stream takes the others and keeps the text of those."""
    whole = F.to_json(F.struct("event_id", "event_type"))
    line = F.when(F.col("event_type") == "error", F.substring(whole, F.lit(1), F.length(whole) - 3)).otherwise(whole)
    base, out, rejects = (scratch(spark, name) for name in ("land", "corrupt-out", "corrupt-rejects"))
    table(spark, sf, "events").select(line.alias("line")).write.text(f"{base}/ingest_ts=20240131_060000")
    stream = landed_stream(spark, base, struct("event_id BIGINT, event_type STRING"), rejects=True)
    ingest_available(stream, out, scratch(spark, "corrupt-state"), rejects=rejects)
    rows = spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("keys"))
    broken = spark.read.parquet(rejects).agg(F.count("record").alias("n"), F.lit(None).cast("long").alias("keys"))
    return rows.select(F.lit("row").alias("kind"), "n", "keys").unionByName(broken.select(F.lit("reject").alias("kind"), "n", "keys"))


@query(
    """select case event_type when 'signup' then 'reject' else 'row' end kind, count(*) n,
              cast(sum(case when event_type <> 'signup' then event_id end) as bigint) keys
       from events group by 1"""
)
def str_type_errors(spark, sf):
    """Landed lines of which some have a text for a number, in a column that the transform drops: rejects all the same."""
    value = F.when(F.col("event_type") == "signup", F.lit("many")).otherwise(F.col("value").cast("string"))
    number = F.regexp_replace(F.to_json(F.struct("event_id", "event_type", value.alias("value"))), '"value":"([0-9.eE+-]+)"', '"value":$1')
    base, out, rejects = (scratch(spark, name) for name in ("land", "typed-out", "typed-rejects"))
    table(spark, sf, "events").select(number.alias("line")).write.text(f"{base}/ingest_ts=20240131_060000")
    stream = landed_stream(spark, base, struct("event_id BIGINT, event_type STRING, value DOUBLE"), rejects=True)
    ingest_available(stream, out, scratch(spark, "typed-state"), lambda landed: landed.select("event_id"), rejects=rejects)
    rows = spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("keys"))
    broken = spark.read.parquet(rejects).agg(F.count("record").alias("n"), F.lit(None).cast("long").alias("keys"))
    return rows.select(F.lit("row").alias("kind"), "n", "keys").unionByName(broken.select(F.lit("reject").alias("kind"), "n", "keys"))


@query(
    """select event_id, event_type, case when event_id % 10 = 3 then "value" + 1000 else "value" end as "value" from events"""
)
def str_upsert_in_place(spark, sf):
    """The partition is part of the key, so corrections that come before or after what they correct read only their own."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    base, out, state = (scratch(spark, name) for name in ("land", "place-out", "place-state"))
    corrected = events.filter("event_id % 10 = 3").withColumn("value", F.col("value") + 1000)
    for ts, rows in ((SECOND, corrected.filter("event_type <> 'view'")), (FIRST, events), (THIRD, corrected.filter("event_type = 'view'"))):
        land_raw(rows, base, "events", ts)
        stream = landed_stream(spark, f"{base}/events", struct("event_id BIGINT, event_type STRING, value DOUBLE"))
        upsert_available(stream, out, state, ["event_id", "event_type"], "event_type")
    return spark.read.parquet(out).select("event_id", "event_type", "value")


@query(
    """select event_id, event_type, case when event_type in ('purchase', 'error') then "value" + 1000 else "value" end as "value"
       from events"""
)
def str_state_upsert(spark, sf):
    """As str_out_of_order, with the latest landing per event kept as state, so that the table is not looked at."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    base, out, state = (scratch(spark, name) for name in ("land", "state-out", "state-state"))
    corrected = events.filter(F.col("event_type").isin("purchase", "error")).withColumn("value", F.col("value") + 1000)
    for ts, rows in ((SECOND, corrected), (FIRST, events)):
        land_raw(rows, base, "events", ts)
        stream = landed_stream(spark, f"{base}/events", struct("event_id BIGINT, event_type STRING, value DOUBLE"))
        commit_available(stream, out, state, ["event_id"], "event_type", horizon="2 days")
    return read_commit(spark, out).select("event_id", "event_type", "value")


@query(
    """select event_id, case when event_id % 10 = 3 then 'moved' else event_type end event_type, "value" from events"""
)
def str_commit_upsert(spark, sf):
    """Every tenth event lands again under another type, in commits that look only where its key may lie."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    base, out, state = (scratch(spark, name) for name in ("land", "commit-out", "commit-state"))
    moved = events.filter("event_id % 10 = 3").withColumn("event_type", F.lit("moved"))
    for ts, rows in ((FIRST, events), (SECOND, moved)):
        land_raw(rows, base, "events", ts)
        stream = landed_stream(spark, f"{base}/events", struct("event_id BIGINT, event_type STRING, value DOUBLE"))
        commit_available(stream, out, state, ["event_id"], "event_type")
    return read_commit(spark, out).select("event_id", "event_type", "value")
