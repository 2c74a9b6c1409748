"""Tables, CSV files, catalog and schema metadata, file facts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from starloom.functions import iso_utc, landing_stamp, size_mb
from starloom.schemas import RAW_DDL, stored_schema, struct
from starloom.sources.envelopes import CORRUPT, Parsed, split_rejects


def read_raw(spark: SparkSession, name: str, base: str) -> DataFrame:
    """A raw table by name from a folder of Parquet tables, in its declared types; what loading adds is NULL in a table that
    was stored without it."""
    return spark.read.schema(stored_schema(name)).parquet(f"{base.rstrip('/')}/{name}")


def read_raw_all(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {name: read_raw(spark, name, base) for name in RAW_DDL}


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """A database table read in ``partitions`` ranges of ``column`` at once."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
            **options,
        )
        .load()
    )


# A text that no field holds stands for NULL when reading, so that the empty text in quotes stays apart from it.
_NO_FIELD = "\0"


def _csv_reader(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", _NO_FIELD)
        .option("emptyValue", "")
    )


def _file_schema(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> T.StructType:
    """The columns in the order of the file's header: the stated types, and text for columns nobody asked for."""
    header = _csv_reader(spark, multi_line).csv(path).columns
    if missing := set(schema.names) - set(header):
        raise ValueError(f"{path} has no column {', '.join(sorted(missing))}")
    return T.StructType([schema[c] if c in schema.names else T.StructField(c, T.StringType()) for c in header])


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool = True, position: str | None = None
) -> DataFrame:
    """CSV with a header, whose names tell the columns apart. Quotes are doubled inside quoted fields; an empty field
    is NULL and an empty text in quotes is the empty text.

    A number that cannot be read, a row of another length, and a file with another header raise an error.
    ``multi_line=False`` vouches that no text holds a line break, so that large files can be split. ``position``
    names a further column that orders the rows as they stand in the files.
    """
    schema = struct(schema) if isinstance(schema, str) else schema
    reader = _csv_reader(spark, multi_line).schema(_file_schema(spark, path, schema, multi_line))
    rows = reader.option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    return rows.select(*schema.names, *_position(position))


def read_csv_and_rejects(spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool = True) -> Parsed:
    """The rows that can be read, and the others as rejects."""
    schema = struct(schema) if isinstance(schema, str) else schema
    in_file = _file_schema(spark, path, schema, multi_line)
    marked = T.StructType([*in_file.fields, T.StructField(CORRUPT, T.StringType())])
    reader = _csv_reader(spark, multi_line).schema(marked).option("columnNameOfCorruptRecord", CORRUPT)
    parsed = split_rejects(reader.option("mode", "PERMISSIVE").csv(path), in_file.names)
    return Parsed(parsed.rows.select(*schema.names), parsed.rejects)


def _position(name: str | None) -> list[Column]:
    """File, part of the file and row in it. Ids rise within a part, whichever task reads it."""
    if name is None:
        return []
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return [place.alias(name)]


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    """A few rows stated in the code. Handed over as Arrow they become a local relation of known size, which
    Spark can broadcast; rows handed over one by one would look unboundedly large to it."""
    schema = struct(schema) if isinstance(schema, str) else schema
    rows = list(rows)
    columns = [pa.array([row[i] for row in rows], to_arrow_type(f.dataType)) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=schema.names), schema)


def catalog_tables(
    spark: SparkSession, like: str | None = None, not_like: str | None = None, database: str | None = None
) -> list[str]:
    """Sorted names of the tables and views in the catalog that match one LIKE pattern and not the other."""
    listed = spark.sql("SHOW TABLES" if database is None else f"SHOW TABLES IN {database}")
    names = listed.select(F.col("tableName").alias("name"))
    if like is not None:
        names = names.filter(F.col("name").like(like))
    if not_like is not None:
        names = names.filter(~F.col("name").like(not_like))
    return [row.name for row in names.distinct().orderBy("name").collect()]


def schema_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column: position, name, type, nullability, key flag and the number of filled rows."""
    parts = [_column_facts(name, df) for name, df in tables.items()]
    summary = parts[0]
    for part in parts[1:]:
        summary = summary.unionByName(part)
    return summary


def _column_facts(table: str, df: DataFrame) -> DataFrame:
    fields = df.schema.fields
    filled = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(i).alias("cid"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.nullable).alias("nullable"),
            F.lit(bool((f.metadata or {}).get("pk", False))).alias("pk"),
            F.col(f"c{i}").alias("filled"),
        )
        for i, f in enumerate(fields)
    ]
    return filled.select(F.inline(F.array(*rows)))


def file_stats(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Path, size and modification time per file. The files are listed, not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.col("length").alias("size_bytes"),
        size_mb("length").alias("size_mb"),
        iso_utc("modificationTime").alias("modified_at"),
    )


def file_rows(df: DataFrame) -> DataFrame:
    """Rows per file of a table that is read from files, with what its facts say: whether the file has bytes, and whether the
    landing stamp and the ISO form of its last change name the same moment."""
    changed = F.col("_metadata.file_modification_time")
    bare = F.regexp_replace(F.substring(iso_utc(changed), 1, 19), "[-:]", "")
    return df.groupBy(
        F.col("_metadata.file_name").alias("file"),
        (F.col("_metadata.file_size") > 0).alias("has_bytes"),
        (F.replace(landing_stamp(changed), F.lit("_"), F.lit("T")) == bare).alias("stamp_agrees"),
    ).agg(F.count(F.lit(1)).alias("n"))
