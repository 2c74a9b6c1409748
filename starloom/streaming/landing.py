"""Landed files as a stream: each file is taken in once, also after a restart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.dml import any_null, latest_per_key, matching
from starloom.session import materialise
from starloom.sinks.publish import read_partitions, upsert_partitions
from starloom.sources.envelopes import CORRUPT, is_broken


def landed_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multi_line: bool = False,
    files_per_batch: int | None = None,
    rejects: bool = False,
) -> DataFrame:
    """New JSON files under ``path``, with the folder column ``ingest_ts`` of the landing that wrote them.

    A malformed line stops the stream with an error. With ``rejects`` it comes as a row whose column ``_corrupt_record`` holds
    its text, for the functions below to set aside.
    """
    corrupt = [T.StructField(CORRUPT, T.StringType())] if rejects else []
    with_ts = T.StructType([*schema.fields, *corrupt, T.StructField("ingest_ts", T.StringType())])
    reader = spark.readStream.schema(with_ts).option("multiLine", multi_line)
    reader = reader.option("mode", "PERMISSIVE" if rejects else "FAILFAST").option("columnNameOfCorruptRecord", CORRUPT)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def ingest_available(
    stream: DataFrame, out: str, checkpoint: str, transform: Callable | None = None, rejects: str | None = None
) -> None:
    """Append everything that has landed since the last run to the Parquet folder ``out``, then stop.

    Malformed lines, also those malformed only in a column that ``transform`` drops, of a stream made with ``rejects`` go to that folder, in a stream with a checkpoint of its own.
    """
    good = stream
    if CORRUPT in stream.columns:
        if rejects is None:
            raise ValueError("the stream keeps malformed lines; name a folder for them")
        # Both sides ask for every column of the file, so that a line is broken, or not, for both.
        broken = is_broken([c for c in stream.columns if c not in (CORRUPT, "ingest_ts")])
        _append(stream.filter(broken).select("ingest_ts", F.col(CORRUPT).alias("record")), rejects, f"{checkpoint}/rejects")
        good = stream.filter(~broken).drop(CORRUPT)
    _append(good if transform is None else transform(good), out, f"{checkpoint}/rows")


def _append(rows: DataFrame, out: str, checkpoint: str) -> None:
    query = (
        rows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def overtaken_keys(latest: DataFrame, target: DataFrame, keys: list[str], partition: str, latest_by: str) -> DataFrame:
    """The keys of a micro-batch of which the table has a later landing.

    Where the partition is part of the key, only the partitions of the batch can have them, and no other is read.
    """
    near = matching(target, latest, partition) if partition in keys else target
    stored = near.select(*keys, F.col(latest_by).alias("__stored"))
    return latest.join(stored, keys).filter(F.col("__stored") > F.col(latest_by)).select(*keys).distinct()


def upsert_available(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    keys: list[str],
    partition: str,
    latest_by: str = "ingest_ts",
    rows_move: bool | None = None,
    rejects: str | None = None,
) -> None:
    """Upsert everything that has landed since the last run into a partitioned table, then stop.

    The table keeps ``latest_by``; of the rows of a key, in the micro-batch and in the table, that of the latest landing counts,
    in whatever order the landings are read. Malformed lines and rows with a NULL in their key go to the folder ``rejects``,
    one subfolder per micro-batch; without that folder they raise an error. A batch that is replayed after a
    failure gives the same table and the same rejects.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in batch.columns else F.lit(False)
        unusable = corrupt | any_null(keys)
        batch = materialise(batch, "landed")
        broken = batch.filter(unusable)
        if rejects is not None:
            broken.write.mode("overwrite").json(f"{rejects.rstrip('/')}/batch={number}")
        elif not broken.isEmpty():
            raise ValueError(f"micro-batch {number} has malformed lines or rows without a key; name a folder for them")
        latest = latest_per_key(batch.filter(~unusable).drop(CORRUPT), keys, latest_by)
        target = read_partitions(spark, table, partition, latest.schema[partition].dataType)
        if target is not None and latest_by in target.columns:
            latest = materialise(latest, "latest")
            overtaken = overtaken_keys(latest, target, keys, partition, latest_by)
            latest = latest.join(materialise(overtaken, "overtaken"), keys, "left_anti")
        upsert_partitions(latest, table, keys, partition, rows_move)

    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
