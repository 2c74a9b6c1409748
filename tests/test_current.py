"""Reports kept current by the changes of commits."""

import random
from decimal import Decimal

import pytest
from seedstar import rows

from starloom.operators import current
from starloom.session import scratch
from starloom.sinks import commits, publish
from starloom.sinks.commits import commit_upsert, forget_commits, read_commit, snapshot

DDL = "k long, p string, g string, v double"


@pytest.fixture()
def base(spark):
    return scratch(spark, "test-current")


def frame(spark, data, ddl=DDL):
    return spark.createDataFrame(data, ddl)


def plain(spark, base):
    groups = {}
    for r in read_commit(spark, base).collect():
        n = groups.setdefault(r.g, [0, 0, Decimal(0)])
        n[0] += 1
        if r.v is not None:
            n[1], n[2] = n[1] + 1, n[2] + Decimal(str(r.v))
    return {g: (a, b, c if b else None, float(c) / b if b else None) for g, (a, b, c) in groups.items()}


def stored(spark, report):
    return {r.g: (r.total, r.n_values, r.sum_value, r.avg_value) for r in current.read_report(spark, report).collect()}


def test_loads_with_corrections(spark, base):
    """After each of several random loads the stored report equals one over all rows."""
    rng, report = random.Random(5), f"{base}-report"
    for _ in range(4):
        keys = rng.sample(range(40), 15)
        batch = [(k, rng.choice(["a", "b", "c", None]), rng.choice(["x", "y", None]), rng.choice([None, rng.randrange(1000) / 100])) for k in keys]
        commit_upsert(frame(spark, batch), base, ["k"], "p")
        assert current.refresh(spark, base, report, ["g"], "v") == snapshot(spark, base).number
        assert stored(spark, report) == plain(spark, base)


def test_several_commits_at_once_and_groups_that_go(spark, base):
    report = f"{base}-report"
    commit_upsert(frame(spark, [(1, "a", "x", 1.0), (2, "b", "y", 0.1), (3, "b", "y", 0.2)]), base, ["k"], "p")
    current.refresh(spark, base, report, ["g"], "v")
    commit_upsert(frame(spark, [(1, "a", "z", 5.0)]), base, ["k"], "p")
    commit_upsert(frame(spark, [(1, "c", "y", 0.3), (4, "c", None, None)]), base, ["k"], "p")
    current.refresh(spark, base, report, ["g"], "v")
    assert stored(spark, report) == {"y": (3, 3, Decimal("0.600000000"), 0.6 / 3), None: (1, 0, None, None)}


def test_only_changed_partitions_are_read(spark, base):
    one = commit_upsert(frame(spark, [(1, "a", "x", 1.0), (2, "b", "x", 2.0)]), base, ["k", "p"], "p")
    two = commit_upsert(frame(spark, [(1, "a", "x", 3.0)]), base, ["k", "p"], "p")
    files = current.changes(spark, base, one, two).inputFiles()
    assert files and all(one.folders["a"] in f or two.folders["a"] in f for f in files)
    assert current.changes(spark, base, two, two) is None


def test_nothing_new_writes_nothing(spark, base, monkeypatch):
    report = f"{base}-report"
    commit_upsert(frame(spark, [(1, "a", "x", 1.0)]), base, ["k"], "p")
    current.refresh(spark, base, report, ["g"], "v")
    monkeypatch.setattr(current, "changes", lambda *_: pytest.fail("the table was read"))
    monkeypatch.setattr(publish, "publish", lambda *_: pytest.fail("the report was written"))
    assert current.refresh(spark, base, report, ["g"], "v") == 1


def test_a_refresh_that_breaks_off_is_repeated(spark, base, monkeypatch):
    report = f"{base}-report"
    commit_upsert(frame(spark, [(1, "a", "x", 1.0)]), base, ["k"], "p")
    current.refresh(spark, base, report, ["g"], "v")
    commit_upsert(frame(spark, [(1, "a", "x", 4.0), (2, "a", "x", None)]), base, ["k"], "p")
    with monkeypatch.context() as broken:
        broken.setattr(publish, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            current.refresh(spark, base, report, ["g"], "v")
    assert stored(spark, report)["x"][:2] == (1, 1)
    current.refresh(spark, base, report, ["g"], "v")
    assert stored(spark, report) == plain(spark, base)


def test_forgotten_commits_empty_tables_and_later_columns(spark, base):
    report = f"{base}-report"
    with pytest.raises(FileNotFoundError):
        current.refresh(spark, base, report, ["g"], "v")
    commit_upsert(frame(spark, []), base, ["k"], "p")
    current.refresh(spark, base, report, ["g"], "v")
    assert rows(current.read_report(spark, report)) == []
    commit_upsert(frame(spark, [(1, "a", "x", 1.0)]), base, ["k"], "p")
    current.refresh(spark, base, report, ["g"], "v")
    commit_upsert(frame(spark, [(2, "b", "x", 2.0, "new")], DDL + ", extra string"), base, ["k"], "p")
    commit_upsert(frame(spark, [(1, "b", "y", 3.0)]), base, ["k"], "p")
    forget_commits(spark, base, keep=1)
    assert commits.kept_commits(spark, base) == [4]
    current.refresh(spark, base, report, ["g"], "v")
    assert stored(spark, report) == plain(spark, base)
    # Other groups than the stored report has: all rows are read again.
    current.refresh(spark, base, report, ["extra"])
    assert {r.extra: r.total for r in current.read_report(spark, report).collect()} == {"new": 1, None: 1}
