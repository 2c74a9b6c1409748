"""Build manifests as rows: one per node, whatever map of the manifest it stands in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.schemas import struct

NODE = (
    "struct<resource_type:string, name:string, source_name:string, file_key_name:string, "
    "columns:map<string,struct<data_type:string>>, "
    "config:struct<materialized:string,severity:string>, depends_on:struct<nodes:array<string>>>"
)
MANIFEST_DDL = f"nodes map<string,{NODE}>, sources map<string,{NODE}>"


def read_manifest(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Nodes and sources of one or many manifests as (node_id, node).

    Models and tests live in ``nodes``; sources live in ``sources``, or in ``nodes`` in old manifests.
    """
    manifest = spark.read.schema(struct(MANIFEST_DDL)).option("multiLine", multi_line).json(path)
    both = F.concat(
        F.map_entries(F.coalesce("nodes", F.create_map().cast(f"map<string,{NODE}>"))),
        F.map_entries(F.coalesce("sources", F.create_map().cast(f"map<string,{NODE}>"))),
    )
    return manifest.select(F.explode(both).alias("e")).select(
        F.col("e.key").alias("node_id"), F.col("e.value").alias("node")
    )
