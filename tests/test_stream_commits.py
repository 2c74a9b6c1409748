"""Streams into committed tables: the latest landing per key as state, and looks at the table only where they are needed."""

import random

import pytest
from pyspark.sql import functions as F
from seedstar import rows

from starloom.schemas import struct
from starloom.session import scratch
from starloom.sinks import commits as sink
from starloom.sinks.commits import commit_upsert, read_commit
from starloom.streaming import commits
from starloom.streaming.commits import commit_available
from starloom.streaming.landing import landed_stream

DDL = "k BIGINT, p STRING, v DOUBLE, t TIMESTAMP"


class Land:
    def __init__(self, spark):
        self.spark, self.path, self.base, self.state = spark, *(scratch(spark, n) for n in ("land", "table", "state"))

    def __call__(self, ts, *data):
        lines = [(line,) for line in data]
        self.spark.createDataFrame(lines, "line string").coalesce(1).write.mode("append").text(f"{self.path}/ingest_ts={ts}")

    def run(self, **options):
        stream = landed_stream(self.spark, self.path, struct(DDL), rejects="rejects" in options)
        commit_available(stream, self.base, options.pop("state", self.state), ["k"], "p", **options)

    def found(self):
        return {r.k: (r.p, r.v, r.ingest_ts) for r in read_commit(self.spark, self.base).collect()}


@pytest.fixture()
def land(spark):
    return Land(spark)


def line(k, p, v):
    return f'{{"k":{k},"p":"{p}","v":{v},"t":"2024-01-31T06:00:00.123456Z"}}'


@pytest.mark.parametrize("horizon", [None, "1 day"])
def test_latest_landing_wins_in_any_order(land, horizon):
    rng, want = random.Random(3), {}
    days = [f"202401{d:02d}_060000" for d in range(10, 15)]
    for ts in rng.sample(days, len(days)):
        batch = {k: (rng.choice("abc"), rng.random()) for k in rng.sample(range(20), 8)}
        land(ts, *[line(k, p, v) for k, (p, v) in batch.items()])
        land.run(horizon=horizon)
        for k, (p, v) in batch.items():
            want[k] = max(want.get(k, ("", 0, "")), (p, v, ts), key=lambda r: r[2])
        assert land.found() == want


def test_no_look_inside_the_horizon(land, monkeypatch):
    with monkeypatch.context() as patched:
        patched.setattr(commits, "_overtaken", lambda *_: pytest.fail("the table was looked at"))
        land("20240131_060000", line(1, "a", 1), line(2, "a", 2))
        land.run(horizon="2 days")
        land("20240130_060000", line(2, "b", 0), line(3, "b", 3))
        land.run(horizon="2 days")
        land("20240201_060000", line(1, "b", 9))
        land.run(horizon="2 days")
    assert land.found() == {1: ("b", 9.0, "20240201_060000"), 2: ("a", 2.0, "20240131_060000"), 3: ("b", 3.0, "20240130_060000")}
    looks, plain = [], commits._overtaken
    monkeypatch.setattr(commits, "_overtaken", lambda looked, *rest: looks.append(rows(looked.select("k"))) or plain(looked, *rest))
    # Landed long before: only the key without state is looked up.
    land("20240101_060000", line(1, "c", 0), line(4, "c", 4))
    land.run(horizon="2 days")
    assert looks == [[(4,)]]
    assert land.found()[1] == ("b", 9.0, "20240201_060000") and land.found()[4] == ("c", 4.0, "20240101_060000")


def test_a_table_of_before_is_looked_at(land, spark):
    stored = spark.createDataFrame([(1, "a", 5.0, "20240301_060000")], "k long, p string, v double, ingest_ts string")
    commit_upsert(stored, land.base, ["k"], "p")
    land("20240201_060000", line(1, "b", 0), line(2, "b", 2))
    land.run(horizon="1 day")
    assert land.found() == {1: ("a", 5.0, "20240301_060000"), 2: ("b", 2.0, "20240201_060000")}
    land("20240302_060000", line(1, "b", 7))
    land.run(horizon="1 day")
    assert land.found()[1] == ("b", 7.0, "20240302_060000")


def test_a_batch_that_breaks_off_is_replayed(land, monkeypatch):
    land("20240131_060000", line(1, "a", 1))
    land.run(horizon="1 day")
    land("20240201_060000", line(1, "b", 2), line(2, "b", 2))
    with monkeypatch.context() as broken:
        broken.setattr(commits, "commit_upsert", lambda *_, **__: 1 / 0)
        with pytest.raises(Exception, match="ZeroDivision"):
            land.run(horizon="1 day")
    assert land.found() == {1: ("a", 1.0, "20240131_060000")}
    land.run(horizon="1 day")
    assert land.found() == {1: ("b", 2.0, "20240201_060000"), 2: ("b", 2.0, "20240201_060000")}
    land.run(horizon="1 day")
    assert sink.kept_commits(land.spark, land.base) == [1, 2]


@pytest.mark.parametrize("horizon", [None, "1 day"])
def test_rejects_and_values_come_through(land, spark, horizon):
    bad = scratch(spark, "rejects")
    land("20240131_060000", line(1, "a", 1.25), '{"k":2,"p":', '{"p":"x","v":3}')
    with pytest.raises(Exception, match="without a key"):
        land.run(horizon=horizon, rejects=None, state=scratch(spark, "other"))
    land.run(horizon=horizon, rejects=bad)
    assert land.found() == {1: ("a", 1.25, "20240131_060000")}
    assert spark.read.text(bad).count() == 2
    kept = read_commit(spark, land.base).select(F.date_format("t", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).first()
    assert kept.t == "2024-01-31 06:00:00.123456"


def test_state_is_removed_only_behind_the_watermark():
    class State:
        def __init__(self, kept, mark):
            self.kept, self.mark, self.hasTimedOut, self.exists, self.armed = kept, mark, True, True, None

        get = property(lambda self: self.kept)
        getCurrentWatermarkMs = lambda self: self.mark

        def remove(self):
            self.kept = None

        def setTimeoutDuration(self, ms):  # noqa: N802
            self.armed = ms

    run = commits._latest_seen(None)
    old, young = State(("20240101_060000", 5), 6), State(("20240101_060000", 6), 6)
    assert list(run(("k",), [], old)) == [] and old.kept is None
    assert list(run(("k",), [], young)) == [] and young.kept is not None and young.armed


def test_a_call_keeps_the_state_of_many_keys():
    """One call for many keys, so that their number does not decide the time."""
    import pandas as pd
    import pyarrow as pa

    class State:
        exists, hasTimedOut, mark, get = False, False, 100, None  # noqa: N815

        getCurrentWatermarkMs = lambda self: self.mark
        setTimeoutDuration = lambda self, ms: None

        def update(self, kept):
            self.exists, self.get = True, kept

        def remove(self):
            self.exists, self.get = False, None

    run, state = commits._latest_seen(None), State()

    def feed(*frames):
        made = [pd.DataFrame(f, columns=["key", "packed", "landed", "ms"]) for f in frames]
        return sorted(map(tuple, pd.concat([*run((0,), made, state), pd.DataFrame(columns=["packed", "look"])]).itertuples(index=False)))

    first = [(f"k{i}", f"a{i:04}", "5", 500) for i in range(2000)]
    # The later landing of a key counts in whichever frame it is; what landed behind the watermark is looked up and not kept.
    assert feed(first[:1000], [("k3", "b3", "6", 600), ("old", "c", "0", 50)], first[1000:]) == sorted(
        [(p, False) for k, p, *_ in first if k != "k3"] + [("b3", False), ("c", True)]
    )
    held = lambda: pa.ipc.open_stream(state.get[0]).read_all().column("key").to_pylist()
    assert len(held()) == 2000 and state.get[1] == 600
    assert feed([("k3", "late", "5", 500), ("k4", "same", "5", 500), ("old", "d", "0", 50)]) == [("d", True), ("same", False)]
    state.mark = 550
    assert feed([("k5", "e", "5", 500), ("new", "f", "7", 700)]) == [("e", False), ("f", False)]
    assert sorted(held()) == ["k3", "new"]
    assert feed([("k5", "g", "5", 500)]) == [("g", True)]
