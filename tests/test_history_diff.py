"""Differences by row without comparing what is equal, and verdicts over runs."""

import random
from collections import Counter
from datetime import datetime, timedelta
from statistics import median

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from seedstar import rows

from starloom.operators import diff as D
from starloom.operators import history as Y
from starloom.schemas import CHECK_DDL
from starloom.session import scratch

DDL = "k long, a string, b double"


def frame(spark, data, ddl=DDL):
    return spark.createDataFrame(data, ddl)


def plain_diff(left, right):
    one, two = ({k: Counter(map(repr, (r[1:] for r in side if r[0] == k))) for k in {r[0] for r in side}} for side in (left, right))
    status = lambda k: "missing" if k not in two else "surplus" if k not in one else "changed"
    return sorted([(k, status(k)) for k in one.keys() | two.keys() if one.get(k) != two.get(k)], key=repr)


row = st.tuples(st.one_of(st.none(), st.integers(-20, 20)), st.sampled_from(["x", "y", None]), st.sampled_from([1.0, None]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, max_size=12), st.lists(row, max_size=12))
def test_differences_are_the_plain_ones(spark, left, right):
    found = D.diff_rows(frame(spark, left), frame(spark, right), "k", fanout=3, leaf=1)
    assert rows(found, "k", "status") == plain_diff(left, right)


def test_what_changed_is_named(spark):
    left = [(1, "x", 1.0), (2, "x", None), (3, None, 3.0), (4, "x", 4.0), (4, "x", 4.0), (5, "s", 5.0)]
    right = [(1, "x", 2.0), (2, None, None), (3, None, 3.0), (4, "x", 4.0), (5, "t", 6.0)]
    found = D.diff_rows(frame(spark, left), frame(spark, right), "k")
    # Of two equal rows one is gone, so the sums of both columns differ.
    assert rows(found, "k", "status", F.array_join("columns", "")) == [(1, "changed", "b"), (2, "changed", "a"), (4, "changed", "ab"), (5, "changed", "ab")]
    # Values that change places do not cancel out.
    assert rows(D.diff_rows(frame(spark, [(1, "x", 1.0), (1, "y", 2.0)]), frame(spark, [(1, "x", 2.0), (1, "y", 1.0)]), "k"), "k") == [(1,)]
    assert D.diff_rows(frame(spark, []), frame(spark, []), "k").count() == 0


def test_equal_ranges_are_not_read_again(spark):
    path = scratch(spark, "test-diff")
    spark.range(100_000).selectExpr("id k", "cast(id as string) a", "cast(id as double) b").repartitionByRange(20, "k").write.parquet(path)
    left = spark.read.parquet(path)
    right = left.withColumn("b", F.when(F.col("k").isin(31_000, 31_007, 77_777), -1.0).otherwise(F.col("b"))).filter("k <> 50")
    ranges = D.differing_ranges(left, right, "k", ["a", "b"], fanout=16, leaf=100)
    assert sum(r.rows for r in ranges) <= 300 and all(r.hi - r.lo < 100 for r in ranges)
    found = D.diff_rows(left, right, "k", fanout=16, leaf=100)
    assert rows(found, "k", "status") == [(31000, "changed"), (31007, "changed"), (50, "missing"), (77777, "changed")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert pushed and all("GreaterThanOrEqual(k" in line for line in pushed)


def test_cutting_stops_where_too_much_differs(spark):
    left = [(i * 7, "x", float(i)) for i in range(400)]
    right = [(k, a, b + 1) for k, a, b in left[:300]]
    found = D.diff_rows(frame(spark, left), frame(spark, right), "k", fanout=8, leaf=1, most=10)
    assert rows(found, "k", "status") == plain_diff(left, right)
    assert len(D.differing_ranges(frame(spark, left), frame(spark, right), "k", ["a", "b"], fanout=8, leaf=1, most=10)) <= 10


def report(spark, name, values, start=datetime(2024, 1, 1)):
    data = [("raw", name, "exists", None, "pass", v, None, None, None, start + timedelta(days=i)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, f"{CHECK_DDL}, run_at timestamp_ntz")


def history(spark, **tables):
    path = scratch(spark, "test-runs")
    for name, values in tables.items():
        Y.append_run(report(spark, name, values), path, F.col("run_at"))
    return Y.read_history(spark, path)


def test_volumes_against_plain_bands(spark):
    rng = random.Random(1)
    steady = [100.0 + rng.randint(-5, 5) for _ in range(30)]
    steady[20], steady[25], steady[22] = 20.0, 300.0, None
    held = [v for v in steady if v is not None]
    found = Y.volume_anomalies(history(spark, steady=steady, flat=[50.0] * 10 + [54.0, 51.0]))
    by_run = found.filter("table = 'steady'").orderBy("run_at").collect()
    assert len(by_run) == 29
    for i, r in enumerate(by_run):
        before = held[max(0, i - 14) : i]
        if not before:
            assert (r.n_before, r.median, r.status) == (0, None, "new")
            continue
        m = median(before)
        spread = max(1.4826 * median(abs(x - m) for x in before), 0.05 * m)
        off = "drop" if held[i] < m - 5 * spread else "surge" if held[i] > m + 5 * spread else None
        assert (r.n_before, r.median, r.spread) == (len(before), m, pytest.approx(spread))
        assert (r.status, r.detail) == (("new", None) if len(before) < 5 else ("fail", off) if off else ("pass", None))
    assert [(r.observed, r.detail) for r in by_run if r.status == "fail"] == [(20.0, "drop"), (300.0, "surge")]
    # A table that never changes has a band all the same.
    assert {r.status for r in found.filter("table = 'flat' and n_before >= 5").collect()} == {"pass"}


def test_stale_tables(spark):
    weekly = [float(i % 7 == 0) for i in range(60)]
    told = history(spark, daily=[1.0] * 60, stopped=[1.0] * 40 + [0.0] * 20, weekly=weekly, young=[1.0] * 3 + [0.0] * 57, silent=[1.0] * 30)
    found = {r.table: (r.last_change.date().isoformat(), r.median_gap, r.age, r.status) for r in Y.stale_tables(told).collect()}
    assert found == {
        "daily": ("2024-02-29", 1.0, 0.0, "pass"),
        "stopped": ("2024-02-09", 1.0, 20.0, "fail"),
        "weekly": ("2024-02-26", 7.0, 3.0, "pass"),
        "young": ("2024-01-03", 1.0, 57.0, "new"),
        "silent": ("2024-01-30", 1.0, 30.0, "fail"),
    }
    later = {r.table: r.status for r in Y.stale_tables(told, now=datetime(2024, 4, 15)).collect()}
    assert later["daily"] == later["weekly"] == "fail"


def test_a_run_that_is_reported_twice_counts_once(spark):
    path = scratch(spark, "test-twice")
    for _ in range(2):
        Y.append_run(report(spark, "t", [1.0, 2.0]).drop("run_at").limit(1), path, datetime(2024, 1, 1, 6))
    assert rows(Y.read_history(spark, path), "table", "observed", "run_at") == [("t", 1.0, datetime(2024, 1, 1, 6))]


def test_planted_faults_are_found(spark):
    """At a size where a day has enough events to tell."""
    from starloom.plans.catalogue import ALL

    folder = "/root/testdata/sf0.01"
    judged = ALL["health_volume_anomalies"].run(spark, folder).collect()
    assert ("click", "2024-01-20", "drop") in {(r.table, r.run_day, r.detail) for r in judged}
    assert sum(r.status == "fail" for r in judged) <= 4
    assert {r.table: r.status for r in ALL["health_stale_tables"].run(spark, folder).collect()} == {
        "click": "pass", "view": "pass", "purchase": "pass", "error": "pass", "signup": "fail"}
