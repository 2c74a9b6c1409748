"""Lineage from build manifests: nodes, direct edges, tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.checks import verdict


def _unique_name(dotted: Column) -> Column:
    """``source.<project>.<source>.<table>`` gives source.table, any other id its last part."""
    parts = F.split(dotted, "\\.")
    last = F.element_at(parts, -1)
    from_source = F.startswith(dotted, F.lit("source.")) & (F.size(parts) >= 3)
    return F.when(from_source, F.concat(F.element_at(parts, -2), F.lit("."), last)).otherwise(last)


def _materialized() -> Column:
    return F.coalesce("node.config.materialized", F.lit("view"))


def _layer(kind: Column) -> Column:
    return F.when(kind == "source", "source").when(_materialized() == "view", "staging").otherwise("mart")


def lineage_nodes(manifest: DataFrame) -> DataFrame:
    """Sources and models with their layer, materialisation and column names."""
    kind = F.col("node.resource_type")
    materialized = F.when(kind == "model", _materialized())
    name = F.when(kind == "source", F.concat_ws(".", "node.source_name", "node.name")).otherwise(F.col("node.name"))
    return manifest.filter(kind.isin("source", "model")).select(
        "node_id",
        name.alias("name"),
        kind.alias("kind"),
        _layer(kind).alias("layer"),
        materialized.alias("materialized"),
        F.map_keys(F.col("node.columns")).alias("columns"),
    )


def lineage_columns(manifest: DataFrame) -> DataFrame:
    """Documented columns of sources and models with their type, ``unknown`` where none is given."""
    listed = manifest.filter(F.col("node.resource_type").isin("source", "model"))
    return listed.select("node.name", F.explode("node.columns").alias("column", "c")).select(
        "name", "column", F.coalesce("c.data_type", F.lit("unknown")).alias("data_type")
    )


def lineage_edges(manifest: DataFrame) -> DataFrame:
    """(src, dst) for every direct dependency of a model."""
    models = manifest.filter(F.col("node.resource_type") == "model")
    edges = models.select(F.explode("node.depends_on.nodes").alias("dep"), F.col("node.name").alias("dst"))
    return edges.select(_unique_name(F.col("dep")).alias("src"), "dst")


def lineage_tests(manifest: DataFrame) -> DataFrame:
    tests = manifest.filter(F.col("node.resource_type") == "test")
    return tests.select(
        F.col("node.name").alias("name"),
        F.coalesce("node.file_key_name", F.lit("")).alias("model"),
        F.coalesce("node.config.severity", F.lit("error")).alias("severity"),
    )


def lineage_summary(manifest: DataFrame) -> DataFrame:
    """Numbers of sources, staging models, marts, tests and edges, as rows (item, n), from one pass."""
    kind = F.col("node.resource_type")
    item = F.when(kind == "test", "test").otherwise(_layer(kind))
    edges = F.when(kind == "model", F.coalesce(F.size("node.depends_on.nodes"), F.lit(0))).otherwise(0)
    counted = (
        manifest.filter(kind.isin("source", "model", "test"))
        .groupBy(item.alias("item"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(edges).alias("edges"))
    )
    both = F.array(F.struct("item", "n"), F.struct(F.lit("edge").alias("item"), F.col("edges").alias("n")))
    return counted.select(F.inline(both)).groupBy("item").agg(F.sum("n").alias("n"))


def lineage_gate(manifest: DataFrame) -> DataFrame:
    """One row: passes only if the manifest has both tests and edges."""
    n = {item: F.coalesce(F.max(F.when(F.col("item") == item, F.col("n"))), F.lit(0)) for item in ("test", "edge")}
    counts = lineage_summary(manifest).agg(n["test"].alias("tests"), n["edge"].alias("edges"))
    return counts.withColumn("status", verdict((F.col("tests") > 0) & (F.col("edges") > 0)))
