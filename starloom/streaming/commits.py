"""Landed files as a stream into a committed table, each micro-batch visible at once, with the latest landing per key kept as state."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from starloom.operators.dml import any_null, distinct_keys, latest_per_key
from starloom.session import materialise
from starloom.sinks.commits import commit_upsert, near_keys, place_text, read_commit, read_text, snapshot
from starloom.sources.envelopes import CORRUPT
from starloom.streaming.landing import overtaken_keys

LANDED_FORMAT = "yyyyMMdd_HHmmss"
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "true"}
_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
_WINNER = "packed string, look boolean"
# State is kept per bucket of keys, as a call of Python for each key costs a millisecond. Fixed value: a checkpoint holds this many.
BUCKETS = 1 << 13
_STATE = "held binary, youngest bigint"
_KNOWN = pa.schema([("key", pa.string()), ("landed", pa.string()), ("ms", pa.int64())])


def commit_available(
    stream: DataFrame,
    base: str,
    checkpoint: str,
    keys: list[str],
    partition: str,
    latest_by: str = "ingest_ts",
    horizon: str | None = None,
    rejects: str | None = None,
) -> None:
    """Upsert everything that has landed since the last run into the committed table ``base``, then stop.

    Of the rows of a key, in the micro-batch and in the table, that of the latest landing counts, in whatever order landings are
    read. Without ``horizon`` every micro-batch looks for later landings in the partitions that may hold one of its keys.

    With a ``horizon`` such as ``2 days`` the latest landing of each key is kept as state of the stream. A micro-batch then needs
    no look at the table for a row whose landing is younger than the horizon before the latest landing seen: if the table
    had a later one, the state would know. Only keys without state that landed before that, or not later than what lay in the
    table when the stream first began, are looked up. State older than the horizon is removed. The stream must be the table's only writer.

    Malformed lines and rows with a NULL in their key go to the folder ``rejects``, one subfolder per micro-batch; without
    that folder they raise an error. A batch that is replayed after a failure gives the same rows.
    """
    spark = stream.sparkSession
    unusable = any_null(keys) if CORRUPT not in stream.columns else F.col(CORRUPT).isNotNull() | any_null(keys)
    rows = stream.drop(CORRUPT).schema
    packed = F.to_json(F.struct(*[F.col(c) for c in stream.columns]), _JSON).alias("packed")
    bad = stream.filter(unusable).select(packed, F.lit(None).cast("boolean").alias("look"))
    usable = stream.filter(~unusable).drop(CORRUPT)
    if horizon is None:
        good = usable.select(F.to_json(F.struct(*usable.columns), _JSON).alias("packed"), F.lit(True).alias("look"))
    else:
        good = _winners(usable, keys, latest_by, horizon, _floor(spark, base, checkpoint, latest_by))

    def apply(batch: DataFrame, number: int) -> None:
        batch = materialise(batch, "landed")
        broken = batch.filter("look is null")
        if rejects is not None:
            broken.select("packed").write.mode("overwrite").text(f"{rejects.rstrip('/')}/batch={number}")
        elif not broken.isEmpty():
            raise ValueError(f"micro-batch {number} has malformed lines or rows without a key; name a folder for them")
        found = batch.filter("look is not null").select(F.from_json("packed", rows, _JSON).alias("row"), "look").select("row.*", F.col("look").alias("__look"))
        latest = materialise(latest_per_key(found, keys, latest_by), "latest")
        looked = latest.filter("__look").drop("__look")
        latest = latest.drop("__look")
        at = snapshot(batch.sparkSession, base)
        if at.folders and latest_by in at.schema.names and not looked.isEmpty():
            latest = latest.join(materialise(_overtaken(looked, base, at, keys, partition, latest_by), "overtaken"), keys, "left_anti")
        if not latest.isEmpty():
            commit_upsert(latest, base, keys, partition, at=at)

    query = good.unionByName(bad).writeStream.foreachBatch(apply).outputMode("update" if horizon else "append")
    query = query.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    # A query takes its settings over when it starts. Expiry by the clock would ask for one more batch without data for ever.
    before = spark.conf.get(_NO_DATA)
    spark.conf.set(_NO_DATA, "false")
    try:
        started = query.start()
    finally:
        spark.conf.set(_NO_DATA, before)
    started.awaitTermination()


def _overtaken(looked: DataFrame, base: str, at, keys: list[str], partition: str, latest_by: str) -> DataFrame:
    """Those of the looked up keys of which the table has a later landing; only partitions that may hold one of them are read."""
    near = near_keys(distinct_keys(looked, keys), base, at)
    return overtaken_keys(looked, read_commit(looked.sparkSession, base, near), keys, partition, latest_by)


def _floor(spark: SparkSession, base: str, checkpoint: str, latest_by: str) -> str | None:
    """The latest landing in the table when the stream first began, kept beside its checkpoint."""
    path = f"{checkpoint.rstrip('/')}-floor/latest"
    kept = read_text(spark, path)
    if kept is None:
        at = snapshot(spark, base)
        known = at.schema is not None and latest_by in at.schema.names
        largest = read_commit(spark, base, at).agg(F.max(F.col(latest_by).cast("string"))).first()[0] if known else None
        place_text(spark, path, largest or "")
        kept = read_text(spark, path)
    return kept or None


def _winners(usable: DataFrame, keys: list[str], latest_by: str, horizon: str, floor: str | None) -> DataFrame:
    """Of each micro-batch the row of the latest landing per key, if no later one was seen, and whether the table must be looked at."""
    key = F.to_json(F.struct(*keys), _JSON)
    at = F.try_to_timestamp(F.col(latest_by).cast("string"), F.lit(LANDED_FORMAT))
    told = usable.select(
        key.alias("key"),
        F.to_json(F.struct(*usable.columns), _JSON).alias("packed"),
        F.coalesce(F.col(latest_by).cast("string"), F.lit("")).alias("landed"),
        at.alias("landed_at"),
        F.coalesce(F.unix_millis(at), F.lit(-1)).alias("ms"),
        F.pmod(F.xxhash64(key), F.lit(BUCKETS)).alias("bucket"),
    )
    # Idle buckets are checked by the clock, as by event time Spark would drop late rows; what has expired is decided by the watermark.
    timed = told.withWatermark("landed_at", horizon).groupBy("bucket")
    return timed.applyInPandasWithState(_latest_seen(floor), _WINNER, _STATE, "update", GroupStateTimeout.ProcessingTimeTimeout)


def _latest_seen(floor: str | None, check_ms: int = 3_600_000) -> Callable:
    """The function that keeps the state of one bucket of keys; an idle bucket is checked against the watermark every ``check_ms``."""

    def packed(known: pd.DataFrame) -> bytes:
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, _KNOWN, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(pa.Table.from_pandas(known, _KNOWN, preserve_index=False))
        return out.getvalue().to_pybytes()

    def latest(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.sort_values(["landed", "packed"]).drop_duplicates("key", keep="last")

    def run(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        if state.hasTimedOut:
            if state.get[1] < mark:
                state.remove()
            else:
                state.setTimeoutDuration(check_ms)
            return
        best = None
        for frame in frames:
            here = latest(frame[["key", "packed", "landed", "ms"]])
            best = here if best is None else latest(pd.concat([best, here]))
        if best is None or best.empty:
            return
        held = pa.ipc.open_stream(state.get[0]).read_all() if state.exists else _KNOWN.empty_table()
        known = held.to_pandas()
        best = best.merge(known.rename(columns={"landed": "stored"}).drop(columns="ms"), "left", "key")
        fresh = best["stored"].isna()
        wins = fresh | (best["landed"] >= best["stored"].fillna(""))
        best, fresh = best[wins], fresh[wins]
        look = fresh & ((best["ms"] < mark) | (False if floor is None else best["landed"] <= floor))
        # What lies behind the watermark is looked up if its key comes again, so it need not be known.
        kept = pd.concat([known[~known["key"].isin(best["key"])], best[_KNOWN.names]])
        kept = kept[kept["ms"] >= mark]
        if len(kept):
            state.update((packed(kept), int(kept["ms"].max())))
            state.setTimeoutDuration(check_ms)
        elif state.exists:
            state.remove()
        if len(best):
            yield pd.DataFrame({"packed": best["packed"].array, "look": look.to_numpy(bool)})

    return run
