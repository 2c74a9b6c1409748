"""Keyed changes against plain Python on random small tables."""

import json
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from seedstar import rows

from starloom.operators import dml
from starloom.operators import expectations as X
from starloom.plans.analytics import key_uniqueness

few = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.one_of(st.none(), st.integers(0, 4))
pairs = st.lists(st.tuples(keys, st.integers(0, 3)), max_size=12)


def frame(spark, data, ddl="k long, v long"):
    return spark.createDataFrame(data, ddl)


@few
@given(pairs, pairs)
def test_upsert_and_insert_ignore(spark, old, new):
    target, batch = frame(spark, old), frame(spark, new)
    listed = {k for k, _ in new if k is not None}
    assert rows(dml.upsert(target, batch, ["k"])) == sorted([r for r in old if r[0] not in listed] + new, key=repr)
    known = {k for k, _ in old}
    first = {k: min(v for key, v in new if key == k) for k in listed if k not in known}
    keyless = [r for r in new if r[0] is None]
    expected = sorted(old + list(first.items()) + keyless, key=repr)
    assert rows(dml.insert_ignore(target, batch, "k")) == expected


@few
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 1), st.just(1), keys, st.sampled_from([0.5, 1.0])), min_size=1, max_size=25))
def test_load_facts(spark, data):
    ddl = "indicator_id long, location_id long, period_id long, sex_id long, value double"
    loaded = rows(dml.load_facts(frame(spark, data, ddl)))
    ordered = sorted(data, key=lambda r: (r[:3], r[3] is not None, r[3] or 0, r[4]))
    copies, expected = Counter(), []
    for i, row in enumerate(ordered, 1):
        copies[row[:4]] += 1
        expected.append((i, *row[:4], copies[row[:4]], row[4], None))
    assert loaded == sorted(expected, key=repr)


@few
@given(pairs.filter(bool))
def test_uniqueness_counts(spark, data):
    df = frame(spark, data).selectExpr("k", "v", "cast(k as string) t")
    present = [k for k, _ in data if k is not None]
    repeated = sum(n for n in Counter(present).values() if n > 1)
    found = X.run_suite(df, [(X.UNIQUE, "t"), (X.UNIQUE, "k"), (X.NOT_NULL, "k"), (X.NOT_NULL, "gone")])
    got = rows(found, "position", "success", "element_count", "unexpected_count")
    nulls = len(data) - len(present)
    assert got == [
        (0, repeated == 0, len(data), repeated),
        (1, repeated == 0, len(data), repeated),
        (2, nulls == 0, len(data), nulls),
        (3, False, 0, 0),
    ]
    assert rows(key_uniqueness({"k": (df, "k")})) == [("k", len(data), len(set(present)), len(data) - len(set(present)))]


def test_suite_file():
    suite = {
        "expectation_suite_name": "x",
        "expectations": [
            {"expectation_type": kind, "kwargs": {"column": column}, "meta": {}} for kind, column in X.INDICATORS_SUITE
        ],
    }
    assert X.parse_suite(json.dumps(suite)) == X.INDICATORS_SUITE
    assert [len(s) for s in (X.INDICATORS_SUITE, X.CATEGORIZED_INDICATORS_SUITE, X.DIMENSIONS_SUITE)] == [4, 5, 3]
