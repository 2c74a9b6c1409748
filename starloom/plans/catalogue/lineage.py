"""Queries: lineage of manifests, one per order, written by Spark.

Each order is a small project: a source, a staging view on it, a table for what is finished (F) or an
incremental model for what is open (O) on the view, and a test. Pending orders (P) stop at the view.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators import lineage as L
from starloom.plans.registry import query
from starloom.plans.testdata import table
from starloom.session import scratch
from starloom.sources.manifest import NODE, read_manifest


def _node(**fields: Column) -> Column:
    empty = F.lit(None)
    given = {
        "resource_type": empty,
        "name": empty,
        "source_name": empty,
        "file_key_name": empty,
        "columns": empty,
        "config": empty,
        "depends_on": empty,
    } | fields
    return F.struct(*[c.alias(name) for name, c in given.items()]).cast(NODE)


def _config(materialized: Column | None = None, severity: Column | None = None) -> Column:
    return F.struct(
        (F.lit(None) if materialized is None else materialized).cast("string").alias("materialized"),
        (F.lit(None) if severity is None else severity).cast("string").alias("severity"),
    )


def _needs(*ids: Column) -> Column:
    return F.struct(F.array(*ids).alias("nodes"))


def manifests(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    status = F.col("o_orderstatus")
    source_id = F.concat(F.lit("source.shop.raw.orders_"), key)
    view, mart = F.concat(F.lit("stg_"), key), F.concat(F.lit("fct_"), key)
    view_id, mart_id = F.concat(F.lit("model.shop."), view), F.concat(F.lit("model.shop."), mart)
    typed = F.create_map(
        F.lit("o_orderkey"), F.struct(F.lit("bigint").alias("data_type")), F.lit("note"), F.struct(F.lit(None).alias("data_type"))
    )
    source = _node(
        resource_type=F.lit("source"), name=F.concat(F.lit("orders_"), key), source_name=F.lit("raw"), columns=typed
    )
    staging = _node(resource_type=F.lit("model"), name=view, depends_on=_needs(source_id), columns=typed)
    built = F.when(status == "F", "table").otherwise("incremental")
    table_ = _node(
        resource_type=F.lit("model"), name=mart, config=_config(materialized=built), depends_on=_needs(view_id)
    )
    test = _node(
        resource_type=F.lit("test"),
        name=F.concat(F.lit("not_null_"), view),
        file_key_name=F.concat(F.lit("models."), view),
        config=_config(severity=F.when(status == "P", "warn")),
        depends_on=_needs(view_id),
    )
    short = F.create_map(view_id, staging, F.concat(F.lit("test.shop."), view), test)
    return orders.select(
        F.when(status == "P", short).otherwise(F.map_concat(short, F.create_map(mart_id, table_))).alias("nodes"),
        F.create_map(source_id, source).alias("sources"),
    )


def _manifest(spark, sf) -> DataFrame:
    path = scratch(spark, "manifest")
    # The keys are dealt out before they grow to manifests, as a small file is one task.
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    manifests(orders.repartition(spark.sparkContext.defaultParallelism)).write.json(path)
    return read_manifest(spark, path, multi_line=False)


@query(
    """select 'source' layer, 'source' kind, null materialized, count(*) n from orders
       union all select 'staging', 'model', 'view', count(*) from orders
       union all select 'mart', 'model', 'table', count(*) from orders where o_orderstatus = 'F'
       union all select 'mart', 'model', 'incremental', count(*) from orders where o_orderstatus = 'O'"""
)
def lin_nodes(spark, sf):
    nodes = L.lineage_nodes(_manifest(spark, sf))
    return nodes.groupBy("layer", "kind", "materialized").agg(F.count(F.lit(1)).alias("n"))


@query(
    """select concat('raw.orders_', o_orderkey) src, concat('stg_', o_orderkey) dst from orders
       union all
       select concat('stg_', o_orderkey), concat('fct_', o_orderkey) from orders where o_orderstatus <> 'P'"""
)
def lin_edges(spark, sf):
    return L.lineage_edges(_manifest(spark, sf))


@query(
    """select concat('not_null_stg_', o_orderkey) as "name", concat('models.stg_', o_orderkey) model,
              case o_orderstatus when 'P' then 'warn' else 'error' end severity from orders"""
)
def lin_tests(spark, sf):
    return L.lineage_tests(_manifest(spark, sf))


@query(
    """select "column", data_type, count(*) n
       from orders, (values ('o_orderkey', 'bigint'), ('note', 'unknown')) v("column", data_type), (values (1), (2)) w
       group by 1, 2"""
)
def lin_columns(spark, sf):
    """Sources and staging models document two columns each, one of them without a type."""
    listed = L.lineage_columns(_manifest(spark, sf))
    return listed.groupBy("column", "data_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    """select 'source' item, count(*) n from orders union all select 'staging', count(*) from orders
       union all select 'mart', count(*) from orders where o_orderstatus <> 'P'
       union all select 'test', count(*) from orders
       union all select 'edge', count(*) + count(nullif(o_orderstatus, 'P')) from orders"""
)
def lin_summary(spark, sf):
    return L.lineage_summary(_manifest(spark, sf))


@query(
    """select count(*) tests, count(*) + count(nullif(o_orderstatus, 'P')) edges,
              case when count(*) > 0 then 'pass' else 'fail' end status from orders"""
)
def lin_gate(spark, sf):
    return L.lineage_gate(_manifest(spark, sf))
