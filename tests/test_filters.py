"""Filters of keys, and commits that read only partitions that may hold one."""

import pytest
from pyspark.sql import functions as F
from seedstar import rows

from starloom.session import scratch
from starloom.sinks import commits, filters
from starloom.sinks.commits import commit_upsert, forget_commits, near_keys, read_commit, snapshot

DDL = "k long, p string, v long"


@pytest.fixture()
def base(spark):
    return scratch(spark, "test-filters")


def test_no_key_is_missed_and_few_strangers_pass(spark):
    held = spark.range(20000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("s"), F.when(F.col("id") < 15000, "large").otherwise("small").alias("f"))
    built = filters.build(held, "f", ["k", "s"]).cache()
    # 15,000 keys need 11 blocks, so 16; 5,000 need 4.
    assert {r.folder: r.blocks for r in built.select("folder", "blocks").distinct().collect()} == {"large": 16, "small": 4}
    for low, high, folder in ((0, 5000, "large"), (15000, 20000, "small")):
        # One key at a time, each under a folder of its own to be asked for.
        each = held.filter((F.col("k") >= low) & (F.col("k") < high))
        found = filters.may_hold(built, each.filter(F.col("k") % 500 == 0), ["k", "s"])
        assert folder in {r.folder for r in found.collect()}
    names = [f"p{i}" for i in range(filters.HASHES)]
    for shift, least, most in ((0, 20000, 20010), (10**6, 0, 20)):
        asked = held.select((F.col("k") + shift).alias("k"), "s", "f").join(built.select(F.col("folder").alias("f"), "blocks").distinct(), "f")
        probed = asked.select("blocks", filters._block(["k", "s"]).alias("block"), *[c.alias(n) for c, n in zip(filters._places(["k", "s"]), names, strict=True)])
        hits = probed.join(built, ["blocks", "block"])
        for n in names:
            hits = hits.filter(filters._is_set(F.col("bitmap"), F.col(n)))
        assert least <= hits.count() <= most


def test_nulls_and_nothing(spark):
    some = spark.createDataFrame([(1, "a"), (None, "a"), (None, "b")], "k long, f string")
    built = filters.build(some, "f", ["k"])
    assert {r.folder for r in built.collect()} == {"a"}
    assert filters.may_hold(built, some.filter("k is null").select("k"), ["k"]).collect() == []
    assert rows(filters.may_hold(built, some.select("k"), ["k"])) == [("a",)]
    empty = filters.build(some.limit(0), "f", ["k"])
    assert empty.collect() == [] and filters.may_hold(empty, some.select("k"), ["k"]).collect() == []


def test_other_partitions_are_not_scanned(spark, base, monkeypatch):
    parts = [(i, f"p{i // 10}", i) for i in range(100)]
    one = commit_upsert(spark.createDataFrame(parts, DDL), base, ["k"], "p")
    listed = spark.createDataFrame([(3,), (57,), (1000,)], "k long")
    near = near_keys(listed, base, one)
    assert set(near.folders) == {"p0", "p5"}
    assert all(one.folders["p0"] in f or one.folders["p5"] in f for f in read_commit(spark, base, near).inputFiles())
    read, plain = [], commits.read_commit
    monkeypatch.setattr(commits, "read_commit", lambda s, b, at=None, only=None: read.append(set(at.folders) if only is None else set(only)) or plain(s, b, at, only))
    commit_upsert(spark.createDataFrame([(3, "p1", 30), (57, "new", 570), (1000, "new", 1)], DDL), base, ["k"], "p")
    assert read == [{"p0", "p5"}, {"p0", "p5", "p1", "new"}]
    want = {k: (p, v) for k, p, v in parts} | {3: ("p1", 30), 57: ("new", 570), 1000: ("new", 1)}
    assert {r.k: (r.p, r.v) for r in plain(spark, base).collect()} == want


def test_filters_follow_rows_keys_and_commits(spark, base):
    commit_upsert(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], DDL), base, ["k"], "p")
    # Rows that do not move write no filters; the partition is read by the next commit.
    two = commit_upsert(spark.createDataFrame([(3, "b", 3)], DDL), base, ["k"], "p", rows_move=False)
    assert len(two.filtered) == 1
    assert set(near_keys(spark.createDataFrame([(9,)], "k long"), base, two).folders) == {"b"}
    # Filters of other keys are not asked.
    assert near_keys(spark.createDataFrame([(9,)], "v long"), base, two) == two
    three = commit_upsert(spark.createDataFrame([(1, "b", 10), (2, "c", 20)], DDL), base, ["k"], "p")
    assert rows(read_commit(spark, base)) == [(1, "b", 10), (2, "c", 20), (3, "b", 3)]
    assert set(three.folders) == {"b", "c"} and snapshot(spark, base) == three
    assert near_keys(spark.createDataFrame([(9,)], "k long"), base, three).folders == {}
    forget_commits(spark, base, keep=1)
    assert commits._names(spark, f"{base}/filters") == list(three.filtered)
    commit_upsert(spark.createDataFrame([(3, "c", 30)], DDL), base, ["k"], "p")
    assert rows(read_commit(spark, base)) == [(1, "b", 10), (2, "c", 20), (3, "c", 30)]
