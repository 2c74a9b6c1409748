"""Samples, leading keys and distinct counts that merge."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from seedstar import rows

from starloom.operators import summaries as Z


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumn("g", F.when(F.col("id") < 3, "few").when(F.col("id") < 4000, "hot"))
    one = rows(Z.sample_per_group(df.coalesce(1), "g", "id", 40, seed=3))
    assert one == rows(Z.sample_per_group(df.repartition(7), "g", "id", 40, seed=3)) and Counter(r[1] for r in one) == {"few": 3, "hot": 40, None: 40}
    parts = [Z.sample_per_group(df.filter(f"id % 3 = {i}"), "g", "id", 40, seed=3) for i in range(3)]
    assert rows(Z.merge_samples(parts[0].unionByName(parts[2]).unionByName(parts[1]), "g", "id", 40)) == one
    assert rows(Z.sample_per_group(df, "g", "id", 40, seed=4)) != one
    assert Z.sample_per_group(df.limit(0), "g", "id", 40).count() == 0


def test_samples_are_uniform(spark):
    """Over many seeds each row is drawn about as often as any other."""
    df = spark.range(20).withColumn("g", F.lit("x"))
    drawn = Counter(r.id for seed in range(40) for r in Z.sample_per_group(df, "g", "id", 5, seed).collect())
    assert len(drawn) == 20 and all(2 <= n <= 20 for n in drawn.values())


def test_a_task_keeps_k_rows_before_the_shuffle(spark):
    plan = Z.sample_per_group(spark.range(1000).withColumn("g", F.col("id") % 3), "g", "id", 5)._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange", 1)[1]
    assert "WindowGroupLimit" in below and "Partial" in below


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k string")


def leading(values, k):
    return sorted(Counter(v for v in values if v is not None).items(), key=lambda x: (-x[1], x[0]))[:k]


@pytest.mark.parametrize(("kind", "proved"), [("skewed", True), ("flat", False), ("few", True), ("none", True)])
def test_leading_keys_are_exact(spark, kind, proved):
    rng = random.Random(2)
    values = {
        "skewed": [f"k{min(int(rng.paretovariate(0.7)), 5000)}" for _ in range(20000)] + [None] * 50,
        "flat": [f"k{i % 3000}" for i in range(12000)],
        "few": ["a"] * 5 + ["b"] * 5 + ["c"] * 5 + [None] * 30,
        "none": [None] * 3,
    }[kind]
    found = Z.top_keys(keys(spark, values).repartition(3), "k", 4, tracked=256)
    assert [tuple(r) for r in found.rows.collect()] == leading(values, 4) and found.proved == proved


def test_distinct_counts_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 5).alias("g"), (F.col("id") % 20_000).alias("v"))
    stored = Z.distinct_sketches(df, ["g"], "v")
    assert abs(Z.distinct_counts(stored, []).first()["n"] - 20_000) < 600
    assert all(abs(r["n"] - 4000) < 120 for r in Z.distinct_counts(stored, ["g"]).collect())


def test_distinct_verdicts_read_data_only_if_they_must(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("v"))
    stored = Z.distinct_sketches(df.withColumn("g", F.col("v") % 3), ["g"], "v")
    assert Z.distinct_verdict(stored, df, "v", 10_000, 30_000) == ("pass", False)
    assert Z.distinct_verdict(stored, df, "v", 30_000, 40_000) == ("fail", False)
    assert Z.distinct_verdict(stored, df, "v", 20_000, 40_000) == ("pass", True)
    assert Z.distinct_verdict(stored, df, "v", 20_001, 40_000) == ("fail", True)
    empty = df.limit(0)
    assert Z.distinct_verdict(Z.distinct_sketches(empty, [], "v"), empty, "v", 0, 0) == ("pass", False)
