"""Partitioned tables whose upserts become visible all at once, and ids that no two loads get.

A table is a folder with ``data`` and ``commits``. A commit writes the new content of the partitions it touches under a fresh name
in ``data``, and then one small file in ``commits`` that names the folder of every partition. That file is made under the
next number and must not exist yet: so readers see the table before or after a commit and nothing between, and of two commits that
began from the same state one is refused. Files of partitions that a commit does not touch are neither read nor written.

Where rows can move between partitions, a commit also writes a Bloom filter of the keys of each partition it fills, in ``filters``,
so that the next one reads only partitions that may hold a key of its batch. Partitions without a filter of these keys are read.

The file names one folder per partition, so its size goes with their number; choose partitions by the thousand, not by the million.
The file system has to rename without overwriting, as HDFS does in one step.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.dml import distinct_keys, replace_keys
from starloom.session import materialise
from starloom.sinks import filters

FOLDER = "__folder"


class Overtaken(RuntimeError):
    """Another commit came first; read the table again and repeat."""


@dataclass(frozen=True)
class Snapshot:
    """The table as one commit left it: the folder of each partition, under the text of its value, and by the commit that wrote
    them the keys of their filters."""

    number: int = 0
    schema: T.StructType | None = None
    partition: str | None = None
    folders: dict[str | None, str] = field(default_factory=dict)
    filtered: dict[str, list[str]] = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, file = _fs(spark, path)
    content = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(content, "UTF-8")
    finally:
        content.close()


def _place(spark: SparkSession, path: str, text: str) -> bool:
    """Makes a file that must not exist, all at once; False if it does. It is written aside and renamed without overwriting."""
    jvm = spark._jvm
    folder, _, name = path.rpartition("/")
    fs, aside = _fs(spark, f"{folder}/_{uuid.uuid4().hex}")
    target = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(aside, target, no_options)
    except Py4JJavaError as error:
        fs.delete(aside, False)
        if fs.exists(target):
            return False
        raise error
    return True


def place_text(spark: SparkSession, path: str, text: str) -> bool:
    """Makes a small file unless it exists; says whether it did."""
    return _place(spark, path, text)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None if there is none."""
    fs, file = _fs(spark, path)
    return _read_text(spark, path) if fs.exists(file) else None


def kept_commits(spark: SparkSession, base: str) -> list[int]:
    """The numbers of the commits that were not forgotten."""
    return sorted(int(n.removesuffix(".json")) for n in _names(spark, f"{base}/commits") if n.endswith(".json"))


def snapshot(spark: SparkSession, base: str, number: int | None = None) -> Snapshot:
    """The newest commit, or that of a ``number``; of a table without any, one without partitions."""
    there = kept_commits(spark, base)
    if not there or number == 0:
        return Snapshot()
    number = max(there) if number is None else number
    told = json.loads(_read_text(spark, f"{base}/commits/{number:08d}.json"))
    return Snapshot(number, T.StructType.fromJson(told["schema"]), told["partition"], {k: v for k, v in told["folders"]}, told.get("filtered", {}))


def read_commit(spark: SparkSession, base: str, at: Snapshot | None = None, only: list[str | None] | None = None) -> DataFrame:
    """The rows of a snapshot (default: the newest); ``only`` names partitions, and no other is listed or read."""
    at = at or snapshot(spark, base)
    if at.schema is None:
        raise FileNotFoundError(f"no commit under {base}")
    wanted = [f"{base}/data/{f}" for p, f in at.folders.items() if only is None or p in only]
    if not wanted:
        return spark.createDataFrame([], at.schema)
    return spark.read.schema(at.schema).parquet(*wanted)


def _load(folder: str) -> str:
    """The name under which a commit wrote this folder."""
    return folder.partition("/")[0]


def near_keys(listed: DataFrame, base: str, at: Snapshot) -> Snapshot:
    """``at`` with only the partitions that may hold a key of ``listed``, by their filters; those without a filter stay in."""
    keys = listed.columns
    asked = {f for f in at.folders.values() if at.filtered.get(_load(f)) == keys}
    loads = sorted({_load(f) for f in asked})
    if not loads:
        return at
    known = listed.sparkSession.read.parquet(*[f"{base}/filters/{name}" for name in loads])
    # At most the folders that the commit names, which the driver holds.
    held = {r.folder for r in filters.may_hold(known, listed, keys).collect()}
    return replace(at, folders={p: f for p, f in at.folders.items() if f not in asked or f in held})


def _text(column: str | None) -> Column:
    return F.lit(None).cast("string") if column is None else F.col(column).cast("string")


def _folder_of(column: str | None) -> Column:
    """A folder name for any value, also NULL and one with characters that paths cannot have."""
    return F.coalesce(F.md5(_text(column).cast("binary")), F.lit("null"))


def _partitions(df: DataFrame, partition: str) -> dict[str | None, str]:
    rows = df.select(_text(partition).alias("value"), _folder_of(partition).alias("folder")).distinct().collect()
    return {r.value: r.folder for r in rows}


def _merged(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """All columns, those of the table first; all nullable, as files of before lack the new ones."""
    known = {} if old is None else {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        if known.setdefault(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} was {known[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType([T.StructField(name, kind) for name, kind in known.items()])


def commit_upsert(
    batch: DataFrame,
    base: str,
    keys: list[str],
    partition: str | None = None,
    rows_move: bool | None = None,
    at: Snapshot | None = None,
    written: bool = False,
) -> Snapshot:
    """Upsert ``batch`` by ``keys`` into the table under ``base``, all or nothing; without ``partition`` all of it is rewritten.

    Touched are the partitions of the batch and, unless ``rows_move`` is false (the default where the partition is part
    of the key), those in which its keys lie now: finding these reads the key columns of the partitions that may hold one by their
    filters. NULL keys never match.
    ``at`` is the snapshot that the batch was made from; if another commit has come since then, this one is refused with
    :class:`Overtaken` and nothing changes. A batch that is ``written``, such as a materialised one, is not written out again. If none of
    the partitions that it touches is there yet, its keys are not listed.
    """
    spark = batch.sparkSession
    at = at or snapshot(spark, base)
    if at.number and at.partition != partition:
        raise ValueError(f"the table is partitioned by {at.partition}")
    rows_move = partition is not None and partition not in keys if rows_move is None else rows_move
    schema = _merged(at.schema, batch.schema)
    batch = batch if written else materialise(batch, "commit-batch")
    touched = _partitions(batch, partition)
    content = batch
    if at.folders and (rows_move or not touched.keys().isdisjoint(at.folders)):
        listed = distinct_keys(batch, keys)
        if rows_move:
            near = near_keys(listed, base, at)
            if near.folders:
                touched |= _partitions(read_commit(spark, base, near).join(listed, keys, "left_semi"), partition)
        content = replace_keys(read_commit(spark, base, at, list(touched)), batch, listed)
    name = f"{at.number + 1:08d}-{uuid.uuid4().hex}"
    aligned = content.select(*[(F.col(f"`{f.name}`") if f.name in content.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
    aligned.withColumn(FOLDER, _folder_of(partition)).write.partitionBy(FOLDER).parquet(f"{base}/data/{name}")
    filled = set(_names(spark, f"{base}/data/{name}"))
    folders = {p: f for p, f in at.folders.items() if p not in touched}
    folders |= {p: f"{name}/{FOLDER}={f}" for p, f in touched.items() if f"{FOLDER}={f}" in filled}
    filtered = {load: k for load, k in at.filtered.items() if any(_load(f) == load for f in folders.values())}
    if rows_move and filled - {"_SUCCESS"}:
        written = spark.read.schema(T.StructType([*[schema[k] for k in keys], T.StructField(FOLDER, T.StringType())])).parquet(f"{base}/data/{name}")
        named = written.withColumn("folder", F.concat(F.lit(f"{name}/{FOLDER}="), F.col(FOLDER)))
        filters.build(named, "folder", keys).write.parquet(f"{base}/filters/{name}")
        filtered[name] = keys
    return _commit(spark, base, Snapshot(at.number + 1, schema, partition, folders, filtered))


def _commit(spark: SparkSession, base: str, new: Snapshot) -> Snapshot:
    told = {"schema": json.loads(new.schema.json()), "partition": new.partition, "folders": list(new.folders.items()), "filtered": new.filtered}
    if not _place(spark, f"{base}/commits/{new.number:08d}.json", json.dumps(told)):
        raise Overtaken(f"commit {new.number} of {base} was made by another load")
    return new


def forget_commits(spark: SparkSession, base: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` commits, and the data that none of those names. Returns the deleted numbers.

    Not while a commit is under way, whose data no commit names yet.
    """
    there = kept_commits(spark, base)
    old, kept = there[: -max(keep, 1)], there[-max(keep, 1) :]
    for n in old:
        fs, file = _fs(spark, f"{base}/commits/{n:08d}.json")
        fs.delete(file, False)
    named = {f for n in kept for f in snapshot(spark, base, n).folders.values()}
    for load in _names(spark, f"{base}/data"):
        inside = [f"{load}/{x}" for x in _names(spark, f"{base}/data/{load}") if x.startswith(FOLDER)]
        for folder in [x for x in inside if x not in named] if any(x in named for x in inside) else [load]:
            fs, path = _fs(spark, f"{base}/data/{folder}")
            fs.delete(path, True)
    loads = {_load(f) for f in named}
    for load in _names(spark, f"{base}/filters"):
        if load not in loads:
            fs, path = _fs(spark, f"{base}/filters/{load}")
            fs.delete(path, True)
    return old


def reserve_ids(spark: SparkSession, folder: str, n: int, first: int = 1) -> int:
    """The first of ``n`` ids that nobody else gets, counted on from the last reservation under ``folder``, or from ``first``.

    A reservation is a file named after its first id, which must not exist; whoever comes second counts on from it. Ids of a load
    that fails later stay unused.
    """
    while True:
        taken = [x for x in _names(spark, folder) if x[0] not in "_."]
        start = int(taken[-1]) + int(_read_text(spark, f"{folder}/{taken[-1]}")) if taken else first
        if n <= 0:
            return start
        if _place(spark, f"{folder}/{start:020d}", str(n)):
            return start
