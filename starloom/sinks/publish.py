"""Tables and views, published snapshots, and keyed upserts into stored tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.dml import distinct_keys, replace_keys, upsert
from starloom.session import materialise, scratch

VERSION = "version="


def as_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def drop_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)


def as_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    partition_by: tuple[str, ...] = (),
    bucket_by: tuple[int, str] | None = None,
) -> None:
    """Full rebuild of a table; ``path`` keeps it outside the warehouse folder.

    Bucketed by its key, a large table joins and takes upserts on that key without being shuffled again.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by is not None:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.saveAsTable(name)


def recreate(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> None:
    """Drop the table if it exists and create it empty in the given types."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    empty = spark.createDataFrame([], schema)
    as_table(empty, name, path)


# --- snapshots -------------------------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _versions(spark: SparkSession, base: str) -> list[tuple[int, bool]]:
    """(number, finished) of every version folder under ``base``."""
    fs, root = _fs(spark, base)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(VERSION):
            done = fs.exists(_fs(spark, f"{base}/{name}/_SUCCESS")[1])
            found.append((int(name[len(VERSION) :]), done))
    return sorted(found)


def publish(df: DataFrame, base: str) -> str:
    """Write ``df`` as the next version of a table, all or nothing.

    Spark leaves ``_SUCCESS`` only once every task has committed; readers pass over folders without it, so a
    load that fails half-way changes nothing. ``df`` may read the version it replaces.
    """
    spark = df.sparkSession
    taken = _versions(spark, base)
    path = f"{base}/{VERSION}{(taken[-1][0] if taken else 0) + 1:08d}"
    (
        df.write.mode("errorifexists")
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        .parquet(path)
    )
    return path


def exists(spark: SparkSession, base: str) -> bool:
    """Whether a finished version is there."""
    return any(finished for _, finished in _versions(spark, base))


def current(spark: SparkSession, base: str) -> DataFrame:
    """The newest finished version."""
    done = [number for number, finished in _versions(spark, base) if finished]
    if not done:
        raise FileNotFoundError(f"no finished version under {base}")
    return spark.read.parquet(f"{base}/{VERSION}{done[-1]:08d}")


def forget_versions(spark: SparkSession, base: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` finished versions, and what broke off before those. Returns the numbers."""
    versions = _versions(spark, base)
    done = [number for number, finished in versions if finished]
    if keep < 1 or len(done) <= keep:
        return []
    old = [number for number, _ in versions if number < done[-keep]]
    for number in old:
        fs, folder = _fs(spark, f"{base}/{VERSION}{number:08d}")
        fs.delete(folder, True)
    return old


def publish_upsert(batch: DataFrame, base: str, keys: list[str]) -> str:
    """Upsert ``batch`` into the published table and publish the result as its next version."""
    spark = batch.sparkSession
    if not exists(spark, base):
        return publish(batch, base)
    return publish(upsert(current(spark, base), batch, keys), base)


# --- partitioned upsert ----------------------------------------------------------------------------------


def upsert_partitions(
    batch: DataFrame,
    path: str,
    keys: list[str],
    partition: str,
    rows_move: bool | None = None,
    most_partitions: int = 10_000,
) -> None:
    """Upsert into a table partitioned by ``partition``, rewriting only the partitions it touches.

    Touched are the partitions of the batch and those in which its keys lie now, so a row may move. Finding
    the latter reads the key columns of the whole table; with ``rows_move=False``, the default where the partition is
    part of the key, no other partition is read. The new content is written aside first, because Spark cannot
    overwrite files it is reading.

    Run again after a failure at any point it gives the same table, but for rows with a NULL in their key: those never
    match and are added each time. It is not atomic: until it ends, a reader can see a moved row twice or miss a partition
    that is being replaced. The names of the touched partitions come to the driver, where they prune the read; more than
    ``most_partitions`` are written as a table and joined instead, which reads the whole table.
    """
    spark = batch.sparkSession
    rows_move = partition not in keys if rows_move is None else rows_move
    kind = batch.schema[partition].dataType
    target = read_partitions(spark, path, partition, kind)
    if target is None:
        _store_schema(spark, path, batch.schema)
        batch.write.mode("append").partitionBy(partition).parquet(path)
        return
    added = [f for f in batch.schema.fields if f.name not in target.columns]
    if added or _stored_schema(spark, path) is None:
        _store_schema(spark, path, T.StructType([*target.schema.fields, *added]))
    batch = materialise(batch, "upsert-batch")
    listed = distinct_keys(batch, keys)
    places = batch.select(partition, F.lit(True).alias("in_batch"))
    if rows_move:
        lying = target.join(listed, keys, "left_semi").select(partition, F.lit(False).alias("in_batch"))
        places = places.union(lying)
    touched = materialise(places.groupBy(partition).agg(F.max("in_batch").alias("in_batch")), "upsert-touched")
    found = touched.limit(most_partitions + 1).collect()
    names = None if len(found) > most_partitions else [r[0] for r in found]
    staged = scratch(spark, "upsert-stage")
    replace_keys(_within(target, partition, touched, names), batch, listed).write.parquet(staged)
    fresh = spark.read.parquet(staged)
    (
        fresh.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    left = touched.filter(~F.col("in_batch"))
    if names is None or any(not r[1] for r in found):
        filled = fresh.select(F.col(partition).alias("__touched")).distinct()
        emptied = left.join(filled, F.col(partition).eqNullSafe(F.col("__touched")), "left_anti")
        emptied = materialise(emptied, "upsert-emptied")
        gone = None if names is None else [r[0] for r in emptied.collect()]
        if not emptied.isEmpty():
            _drop_partitions(_within(read_partitions(spark, path, partition, kind), partition, emptied, gone))


# The schema lies beside the data, under a name that Spark passes over, so that no upsert has to read every footer.
_SCHEMA = "_starloom_schema.json"


def _store_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    fs, file = _fs(spark, f"{path.rstrip('/')}/{_SCHEMA}")
    out = fs.create(file, True)
    try:
        out.write(bytearray(nullable.json().encode()))
    finally:
        out.close()


def _stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    fs, file = _fs(spark, f"{path.rstrip('/')}/{_SCHEMA}")
    if not fs.exists(file):
        return None
    content = fs.open(file)
    try:
        return T.StructType.fromJson(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(content, "UTF-8")))
    finally:
        content.close()


def _has_data(spark: SparkSession, path: str) -> bool:
    fs, root = _fs(spark, path)
    return fs.exists(root) and any(s.getPath().getName()[0] not in "_." for s in fs.listStatus(root))


def _is_one_of(column: Column, values: list) -> Column:
    known = [v for v in values if v is not None]
    hit = column.isin(known)
    return hit | column.isNull() if len(known) < len(values) else hit


def _within(target: DataFrame, partition: str, touched: DataFrame, names: list | None) -> DataFrame:
    """The rows of ``target`` in the partitions that ``touched`` lists, by their names if these are at hand."""
    if names is not None:
        return target.filter(_is_one_of(F.col(partition), names))
    listed = touched.select(F.col(partition).alias("__touched"))
    return target.join(listed, F.col(partition).eqNullSafe(F.col("__touched")), "left_semi")


def read_partitions(spark: SparkSession, path: str, partition: str, kind: T.DataType) -> DataFrame | None:
    """A partitioned table with the columns of all its files, or None if it has none yet.

    The type of the partition column is stated, as Spark would otherwise read the folder ``p=01`` as number 1.
    """
    if not _has_data(spark, path):
        return None
    merged = _stored_schema(spark, path)
    if merged is None:
        # A table that was not written here: every footer is read, once.
        merged = spark.read.option("mergeSchema", True).parquet(path).schema
    fields = [f for f in merged.fields if f.name != partition]
    return spark.read.schema(T.StructType([*fields, T.StructField(partition, kind)])).parquet(path)


def _drop_partitions(stale: DataFrame) -> None:
    """Remove the folders of the given rows, whose partitions have moved; an overwrite by partition keeps them."""
    spark = stale.sparkSession
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")
    for row in stale.select(folder).distinct().collect():
        jpath = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row.folder))
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
