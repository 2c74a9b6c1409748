"""Upserts that become visible all at once, ids that no two loads get, and loads that lose nothing."""

import pytest
from seedstar import rows

from starloom.plans import loading
from starloom.plans.loading import empty_raw, load_dimensions, load_observations, store_dimensions, store_observations, stored_raw
from starloom.session import scratch
from starloom.sinks import commits
from starloom.sinks.commits import commit_upsert, forget_commits, read_commit, reserve_ids, snapshot

DDL = "k long, p string, v long"


@pytest.fixture()
def base(spark):
    return scratch(spark, "test-commits")


def frame(spark, data, ddl=DDL):
    return spark.createDataFrame(data, ddl)


def test_rows_move_once(spark, base):
    first = [(1, "a", 1), (2, "a", 2), (3, "b/=%", 3), (4, None, 4), (None, "a", 5)]
    commit_upsert(frame(spark, first), base, ["k"], "p")
    assert rows(read_commit(spark, base)) == rows(frame(spark, first))
    # 2 and 3 leave their partitions, of which one is left empty; 4 gets a place; a NULL key matches nothing.
    after = commit_upsert(frame(spark, [(2, "c", 20), (3, "a", 30), (4, "", 40), (None, "a", 6)]), base, ["k"], "p")
    assert rows(read_commit(spark, base)) == rows(frame(spark, [(1, "a", 1), (2, "c", 20), (3, "a", 30), (4, "", 40), (None, "a", 5), (None, "a", 6)]))
    assert set(after.folders) == {"a", "c", ""}
    assert rows(read_commit(spark, base, only=["c", "gone"])) == [(2, "c", 20)]


def test_partitions_that_are_not_touched_keep_their_files(spark, base):
    one = commit_upsert(frame(spark, [(1, "a", 1), (2, "b", 2)]), base, ["k", "p"], "p")
    two = commit_upsert(frame(spark, [(1, "a", 9)]), base, ["k", "p"], "p")
    assert one.folders["b"] == two.folders["b"] and one.folders["a"] != two.folders["a"]
    files = read_commit(spark, base, only=["b"]).inputFiles()
    assert files and all("00000001-" in f for f in files)


def test_columns_come_later_and_types_stay(spark, base):
    commit_upsert(frame(spark, [(1, "a", 1)]), base, ["k"], "p")
    commit_upsert(frame(spark, [(2, "b", "new")], "k long, p string, extra string"), base, ["k"], "p")
    assert rows(read_commit(spark, base)) == [(1, "a", 1, None), (2, "b", None, "new")]
    with pytest.raises(ValueError, match="column v was bigint"):
        commit_upsert(frame(spark, [(1, "a", "x")], "k long, p string, v string"), base, ["k"], "p")
    with pytest.raises(ValueError, match="partitioned by p"):
        commit_upsert(frame(spark, [(1, "a", 1)]), base, ["k"], "k")


@pytest.mark.parametrize("step", ["replace_keys", "_names", "_place", "_commit", "_partitions"])
def test_a_failure_at_any_step_leaves_the_old_rows(spark, base, monkeypatch, step):
    before = [(1, "a", 1), (2, "a", 2), (3, "b", 3)]
    commit_upsert(frame(spark, before), base, ["k"], "p")
    batch = frame(spark, [(2, "b", 20), (4, "c", 4)])
    old = snapshot(spark, base)

    def fail(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(commits, step, fail)
        with pytest.raises(RuntimeError, match="lost"):
            commit_upsert(batch, base, ["k"], "p", at=old)
    assert snapshot(spark, base) == old
    assert rows(read_commit(spark, base)) == rows(frame(spark, before))
    commit_upsert(batch, base, ["k"], "p")
    assert rows(read_commit(spark, base)) == [(1, "a", 1), (2, "b", 20), (3, "b", 3), (4, "c", 4)]
    assert forget_commits(spark, base, keep=1) == [1]
    assert rows(read_commit(spark, base)) == [(1, "a", 1), (2, "b", 20), (3, "b", 3), (4, "c", 4)]


def test_a_reader_keeps_its_snapshot(spark, base):
    old = commit_upsert(frame(spark, [(1, "a", 1)]), base, ["k"], "p")
    commit_upsert(frame(spark, [(1, "b", 2)]), base, ["k"], "p")
    assert rows(read_commit(spark, base, old)) == [(1, "a", 1)] and rows(read_commit(spark, base)) == [(1, "b", 2)]


def test_of_two_commits_from_one_state_the_second_is_refused(spark, base):
    start = commit_upsert(frame(spark, [(1, "a", 1)]), base, ["k"], "p")
    commit_upsert(frame(spark, [(2, "a", 2)]), base, ["k"], "p", at=start)
    with pytest.raises(commits.Overtaken):
        commit_upsert(frame(spark, [(3, "a", 3)]), base, ["k"], "p", at=start)
    assert rows(read_commit(spark, base)) == [(1, "a", 1), (2, "a", 2)]


def test_a_table_without_partitions(spark, base):
    commit_upsert(frame(spark, [(1, "a", 1), (2, "a", 2)]), base, ["k"])
    commit_upsert(frame(spark, [(2, "b", 3)]), base, ["k"])
    assert rows(read_commit(spark, base)) == [(1, "a", 1), (2, "b", 3)]
    with pytest.raises(FileNotFoundError):
        read_commit(spark, f"{base}-none")


def test_reserved_ids_are_never_given_twice(spark, base, monkeypatch):
    assert [reserve_ids(spark, base, n, first=5) for n in (3, 1, 0, 2)] == [5, 8, 9, 9]
    # Another load takes the next ids after this one has looked, and before it takes them.
    place, taken = commits._place, []

    def slow(session, path, text):
        if not taken:
            taken.append(place(session, path, "10"))
        return place(session, path, text)

    monkeypatch.setattr(commits, "_place", slow)
    assert reserve_ids(spark, base, 4) == 21 and reserve_ids(spark, base, 1) == 25


def items(spark, data):
    """(indicator, place, year, sex, value) as read."""
    return spark.createDataFrame([(i, p, y, s, v, "f.json") for i, p, y, s, v in data], "indicator_code string, SpatialDim string, TimeDim string, Dim1 string, NumericValue string, file string")


def listed(spark):
    return spark.createDataFrame([("A", "Air", "X"), ("B", "Body", "X")], "IndicatorCode string, IndicatorName string, Category string")


DATA = [("A", "BRA", "2000", "MLE", "1.5"), ("A", "BRA", "2000", "MLE", "2.5"), ("B", "USA", "2001", None, "3"), ("A", "USA", "x1", "MLE", "4"),
        ("A", None, "2000", "SEX_FMLE", "5"), ("A", "BRA", "2000", "MLE", "n/a"), ("C", "BRA", "2000", "MLE", "6"), ("A", "BRA", "2000", "MLE", None)]


def test_loads_without_a_unit_only_add(spark, tmp_path):
    raw, rejects = load_dimensions(empty_raw(spark), listed(spark)), str(tmp_path / "rejects")
    for _ in range(3):
        raw = load_observations(raw, items(spark, DATA), rejects=rejects)
        raw["fact_observations"] = loading.materialise(raw["fact_observations"], "facts")
    facts = raw["fact_observations"]
    assert rows(facts, "observation_id", "value") == sorted([(i + 1, v) for i, v in enumerate([1.5, 2.5, 3.0] * 3)], key=repr)
    assert facts.select("load_unit").distinct().count() == 3
    stored = spark.read.parquet(rejects)
    assert stored.count() == 12 and stored.select("load_unit").distinct().count() == 3


def test_rejects_keep_what_was_read(spark, tmp_path):
    raw, rejects = load_dimensions(empty_raw(spark), listed(spark)), str(tmp_path / "rejects")
    expected = [
        ("A", "USA", "x1", "MLE", "4", "f.json", "unusable field"),
        ("A", None, "2000", "SEX_FMLE", "5", "f.json", "unusable field"),
        ("A", "BRA", "2000", "MLE", "n/a", "f.json", "unusable field"),
        ("C", "BRA", "2000", "MLE", "6", "f.json", "unknown indicator"),
    ]
    for unit in ("a/b", "none", "a/b"):
        load_observations(raw, items(spark, DATA), unit=unit, rejects=rejects)
    stored = spark.read.parquet(rejects)
    columns = ["indicator_code", "SpatialDim", "TimeDim", "Dim1", "NumericValue", "file", "reason"]
    for unit in ("a/b", "none"):
        assert rows(stored.filter(stored.load_unit == unit), *columns) == sorted(expected, key=repr)
    assert stored.count() == 8
    # A unit that comes again without faults has none.
    load_observations(raw, items(spark, DATA[:3]), unit="none", rejects=rejects)
    assert spark.read.schema(stored.schema).parquet(rejects).count() == 4


def test_stored_loads(spark, base):
    store_dimensions(spark, base, listed(spark))
    for unit, data in (("u1", DATA), ("u2", DATA[:3]), ("u1", DATA), ("u2", [("A", "BRA", "2000", "MLE", "9"), *DATA[1:3]])):
        store_observations(spark, base, items(spark, data), unit=unit)
    raw, seen = stored_raw(spark, base)
    assert rows(raw["dim_locations"], "location_id", "country_code") == [(1, "BRA"), (2, "USA")]
    assert rows(raw["fact_observations"], "load_unit", "observation_id", "value") == [
        ("u1", 1, 1.5), ("u1", 2, 2.5), ("u1", 3, 3.0), ("u2", 4, 2.5), ("u2", 5, 9.0), ("u2", 6, 3.0)]
    assert rows(raw["dim_indicators"], "indicator_code") == [("A",), ("B",)] and set(seen["fact_observations"].folders) == {"u1", "u2"}


def test_a_load_reads_only_its_own_unit(spark, base):
    store_dimensions(spark, base, listed(spark))
    store_observations(spark, base, items(spark, DATA), unit="u1")
    facts = stored_raw(spark, base, "u2")[0]["fact_observations"]
    assert facts.inputFiles() == [] and facts.count() == 0
    store_observations(spark, base, items(spark, DATA), unit="u2")
    commits_of = {p: f.split("-")[0] for p, f in snapshot(spark, f"{base}/fact_observations").folders.items()}
    assert commits_of == {"u1": "00000001", "u2": "00000002"}


def test_two_loads_at_once_lose_nothing(spark, base, monkeypatch):
    """While one load computes, another one brings a new place and facts, and is done first."""
    store_dimensions(spark, base, listed(spark))
    store_observations(spark, base, items(spark, DATA), unit="u1")
    load, other = loading._load, []

    def slow(raw, *args):
        done = load(raw, *args)
        if not other:
            other.append(True)
            store_observations(spark, base, items(spark, [("B", "PER", "2002", None, "7")]), unit="fast")
        return done

    monkeypatch.setattr(loading, "_load", slow)
    store_observations(spark, base, items(spark, [("B", "CHL", "2002", None, "8"), ("B", "ARG", "2003", None, "9")]), unit="slow")
    raw, _ = stored_raw(spark, base)
    places = rows(raw["dim_locations"], "location_id", "country_code")
    assert [p[0] for p in places] == [1, 2, 3, 4, 5] and {p[1] for p in places} == {"BRA", "USA", "PER", "CHL", "ARG"}
    named = raw["fact_observations"].join(raw["dim_locations"], "location_id").join(raw["dim_periods"], "period_id")
    assert rows(named.filter("load_unit <> 'u1'"), "country_code", "year", "value") == [("ARG", 2003, 9.0), ("CHL", 2002, 8.0), ("PER", 2002, 7.0)]
    ids = [r[0] for r in rows(raw["fact_observations"], "observation_id")]
    assert len(ids) == len(set(ids)) == 6


def test_a_load_of_a_new_unit_neither_looks_for_units_nor_lists_keys(spark, monkeypatch):
    """The batch names its unit, and nothing that it brings can lie in a partition that is not there."""
    from starloom.operators import dml

    monkeypatch.setattr(dml, "matching", lambda *_: pytest.fail("the batch was read for its units"))
    base, ddl = scratch(spark, "units"), "indicator_id long, location_id long, period_id long, sex_id long, value double, load_unit string"
    for unit, before in (("a", None), ("b", "a"), ("c", "b")):
        known = read_commit(spark, base) if before else spark.createDataFrame([], "observation_id long, load_unit string")
        batch = spark.createDataFrame([(1, 1, 1, 1, 5.0, unit), (1, 1, 1, 1, 4.0, unit)], ddl)
        loaded = dml.load_facts(batch, known, unit=unit)
        with monkeypatch.context() as patched:
            patched.setattr(commits, "distinct_keys", lambda *_: pytest.fail("keys were listed"))
            commits.commit_upsert(loaded, base, ["observation_id"], "load_unit", rows_move=False, written=True)
    found = read_commit(spark, base).orderBy("observation_id").collect()
    assert [(r.observation_id, r.copy_no, r.value, r.load_unit) for r in found] == [
        (i + 1, i % 2 + 1, 4.0 + i % 2, "abc"[i // 2]) for i in range(6)
    ]
    again = spark.createDataFrame([(2, 7.0, "a"), (9, 8.0, "a")], "observation_id long, value double, load_unit string")
    commits.commit_upsert(again, base, ["observation_id"], "load_unit", rows_move=False, written=True)
    assert sorted((r.observation_id, r.value) for r in read_commit(spark, base, only=["a"]).collect()) == [(1, 4.0), (2, 7.0), (9, 8.0)]
