"""Connected components of a graph in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import in_parts, joined, materialise, temporary

SHARE = 1 << 18  # edges of a file of a round


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges`` (columns ``u`` and ``v``).

    Alternates two steps: every node links its larger neighbours, then its smaller ones, to the smallest it knows. Both keep
    the components, and after about as many rounds as the diameter has binary digits only stars are left. A node
    with very many neighbours is summed up before the shuffle, and its edges are a plain join that can be split.
    """
    with temporary(edges.sparkSession):
        return materialise(_stars(edges), "components", lasting=True)


def _stars(edges: DataFrame) -> DataFrame:
    edges = materialise(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while (now := _print(edges)) != before:
        before = now
        with in_parts(1 + now[0] // SHARE):
            edges = _round(edges)
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)


def _round(edges: DataFrame) -> DataFrame:
    # Edges of one file stay one partition, and nothing is shuffled.
    both = joined(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    large = both.filter("v > u").join(joined(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    large = joined(materialise(large, "large"))
    least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "least")
    linked = large.join(joined(least), "u")
    small = linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return materialise(joined(small).distinct(), "small")
