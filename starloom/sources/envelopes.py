"""OData-style JSON envelopes: ``{"@odata.context": ..., "value": [{...}, ...]}``."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.schemas import OBSERVATION_ITEM, struct

CONTEXT = "@odata.context"
CORRUPT = "_corrupt_record"


def envelope_schema(item: str | T.StructType, corrupt: bool = False) -> T.StructType:
    item_type = struct(item) if isinstance(item, str) else item
    fields = [T.StructField(CONTEXT, T.StringType()), T.StructField("value", T.ArrayType(item_type))]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    return T.StructType(fields)


class Parsed(NamedTuple):
    """What could be read, and what could not: ``file``, ``record`` (its text) and ``partly_read``."""

    rows: DataFrame
    rejects: DataFrame


def _read_json(spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool, mode: str) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def is_broken(columns: list[str]) -> Column:
    """Whether a row read with a corrupt column is malformed. Spark parses only columns that are asked for, so this asks for
    all ``columns`` of the file, in a way that is always true."""
    return F.col(CORRUPT).isNotNull() & (F.pmod(F.hash(*[F.col(f"`{c}`") for c in columns]), F.lit(2)) >= 0)


def split_rejects(marked: DataFrame, columns: list[str]) -> Parsed:
    """Rows read with a corrupt column, divided; ``columns`` are the others of the file, of which the first tells what was
    partly read."""
    broken = is_broken(columns)
    rejects = marked.filter(broken).select(
        F.col("_metadata.file_path").alias("file"),
        F.col(CORRUPT).alias("record"),
        F.col(f"`{columns[0]}`").isNotNull().alias("partly_read"),
    )
    return Parsed(marked.filter(~broken).drop(CORRUPT), rejects)


def read_envelopes(spark: SparkSession, path: str | list[str], item: str | T.StructType, multi_line: bool = False) -> DataFrame:
    """One row per envelope; one that is malformed raises an error.

    Landed files hold one envelope per line, so that Spark can split large files. ``multi_line`` reads one envelope
    per file, as an HTTP response is saved.
    """
    return _read_json(spark, path, envelope_schema(item), multi_line, "FAILFAST")


def read_envelopes_and_rejects(
    spark: SparkSession, path: str | list[str], item: str | T.StructType, multi_line: bool = False
) -> Parsed:
    """The envelopes that can be read, and the malformed ones as rejects."""
    marked = _read_json(spark, path, envelope_schema(item, corrupt=True), multi_line, "PERMISSIVE")
    return split_rejects(marked, ["value", CONTEXT])


def read_odata(spark: SparkSession, path: str | list[str], item: str | T.StructType, multi_line: bool = False) -> DataFrame:
    """The items of all envelopes. An envelope without ``value`` adds no row, a malformed one raises an error."""
    return unpack(read_envelopes(spark, path, item, multi_line))


def read_odata_and_rejects(
    spark: SparkSession, path: str | list[str], item: str | T.StructType, multi_line: bool = False
) -> Parsed:
    envelopes = read_envelopes_and_rejects(spark, path, item, multi_line)
    return Parsed(unpack(envelopes.rows), envelopes.rejects)


def unpack(envelopes: DataFrame, *keep: str) -> DataFrame:
    """One row per item of ``value``, with the envelope's columns ``keep`` in front."""
    return envelopes.select(*keep, F.explode("value").alias("v")).select(*keep, "v.*")


def envelope_status(
    spark: SparkSession, path: str | list[str], item: str | T.StructType, multi_line: bool = False
) -> DataFrame:
    """Number of envelopes that are readable, carry no ``value``, or are malformed."""
    envelopes = _read_json(spark, path, envelope_schema(item, corrupt=True), multi_line, "PERMISSIVE")
    kind = (
        F.when(F.col(CORRUPT).isNotNull(), "corrupt").when(F.col("value").isNull(), "no_value").otherwise("ok")
    )
    return envelopes.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def _observation_schema(partition: str, corrupt: bool) -> T.StructType:
    return T.StructType([*envelope_schema(OBSERVATION_ITEM, corrupt).fields, T.StructField(partition, T.StringType())])


def read_observations(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, partition: str = "indicator_code", file: str | None = None
) -> DataFrame:
    """Observation items with the indicator they belong to; a malformed envelope raises an error. ``file`` names a column for
    the file an item comes from.

    The payload does not name its indicator, so it comes from the folder ``indicator_code=<code>/`` the
    envelope was landed in. Fields stay text; see :func:`starloom.operators.ingest.typed_observations`.
    """
    envelopes = _read_json(spark, path, _observation_schema(partition, False), multi_line, "FAILFAST")
    if file is None:
        return unpack(envelopes, partition)
    return unpack(envelopes.withColumn(file, F.col("_metadata.file_path")), partition, file)


def read_observations_and_rejects(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, partition: str = "indicator_code"
) -> Parsed:
    """The items of the envelopes that can be read, and the malformed ones as rejects."""
    marked = _read_json(spark, path, _observation_schema(partition, True), multi_line, "PERMISSIVE")
    envelopes = split_rejects(marked, ["value", CONTEXT])
    return Parsed(unpack(envelopes.rows, partition), envelopes.rejects)
