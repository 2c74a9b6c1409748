import json
from datetime import datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from seedstar import SEED, make_raw, rows

from starloom.operators import dml
from starloom.operators import checks as C
from starloom.operators import reconcile as R
from starloom.operators.health import freshness_checks
from starloom.operators.ingest import categorise, rejected_observations, typed_observations, valid_observations
from starloom.operators.numbering import dense_ids, place_within, repeat_rows, sorted_slices
from starloom.plans.build import build_increment
from starloom.plans.loading import empty_raw, enrich_locations, load_dimensions, load_observations
from starloom.operators import lineage as L
from starloom.plans.catalogue import storage
from starloom.plans.testdata import table
from starloom.schemas import CATEGORIZED_CSV, DIMENSION_ITEM, INDICATORS_CSV, struct
from starloom.session import materialise, scratch, shared_root
from starloom.sinks import files, publish
from starloom.sources import envelopes as E
from starloom.sources import tables as S
from starloom.sources.manifest import read_manifest
from starloom.streaming.landing import ingest_available, landed_stream, overtaken_keys, upsert_available


def save(tmp_path, name, value):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value, indent=1))
    return str(path)


OBSERVATIONS = {
    "@odata.context": "x",
    "value": [
        {"SpatialDim": "BRA", "TimeDim": 2000, "Dim1": "SEX_MLE", "NumericValue": 1.5},
        {"SpatialDim": "USA", "TimeDim": 2001, "Dim1": "MLE", "NumericValue": 2},
        {"SpatialDim": "USA", "TimeDim": 2001, "Dim1": "AGEGROUP_YEARS05-09", "NumericValue": 3.0},
        {"SpatialDim": "USA", "TimeDim": 2001, "Dim1": "", "NumericValue": 4.0},
        {"SpatialDim": "USA", "TimeDim": 2001, "Dim1": None, "NumericValue": None},
        {"SpatialDim": "USA", "NumericValue": 5.0},
        {"SpatialDim": None, "TimeDim": 2001, "NumericValue": 6.0},
        {"SpatialDim": "USA", "TimeDim": "2001-2004", "NumericValue": 7.0},
        {"SpatialDim": "USA", "TimeDim": 2001, "NumericValue": "n/a"},
    ],
}


def landed_items(spark, tmp_path):
    save(tmp_path, "in/indicator_code=AIR_1/a.json", OBSERVATIONS)
    save(tmp_path, "in/indicator_code=AIR_2/b.json", {"@odata.context": "no value here"})
    return E.read_observations(spark, str(tmp_path / "in"), multi_line=True)


def test_observations_are_kept_dropped_or_rejected(spark, tmp_path):
    typed = typed_observations(landed_items(spark, tmp_path))
    assert rows(valid_observations(typed), "country_code", "year", "sex_code", "value") == [
        ("BRA", 2000, "MLE", 1.5),
        ("USA", 2001, "MLE", 2.0),
        ("USA", 2001, None, 3.0),
        ("USA", 2001, None, 4.0),
    ]
    assert rejected_observations(typed).count() == 4
    assert typed.count() == 9
    assert {r[0] for r in typed.select("indicator_code").collect()} == {"AIR_1"}


def test_dimension_envelope_and_truncated_file(spark, tmp_path):
    good = save(tmp_path, "good.json", {"value": [{"Code": "A", "Title": "x"}, {"Code": "B", "Title": None}]})
    cut = save(tmp_path, "cut.json", '{"@odata.context":"r","value":[{')
    bare = save(tmp_path, "bare.json", {"@odata.context": "r"})
    assert rows(E.read_odata(spark, good, DIMENSION_ITEM, multi_line=True)) == [("A", "x"), ("B", None)]
    assert rows(E.read_odata(spark, bare, DIMENSION_ITEM, multi_line=True)) == []
    kinds = rows(E.envelope_status(spark, [good, cut, bare], DIMENSION_ITEM, multi_line=True), "kind", "n")
    assert kinds == [("corrupt", 1), ("no_value", 1), ("ok", 1)]
    for path, lines in ((cut, True), (cut, False), (good, False)):
        with pytest.raises((PySparkException, Py4JJavaError)):
            E.read_odata(spark, path, DIMENSION_ITEM, multi_line=lines).collect()
    taken = E.read_odata_and_rejects(spark, [good, cut, bare], DIMENSION_ITEM, multi_line=True)
    assert rows(taken.rows) == [("A", "x"), ("B", None)]
    assert [r.file.rsplit("/", 1)[1] for r in taken.rejects.collect()] == ["cut.json"]
    assert taken.rejects.count() == 1


def test_landed_lines_are_all_read_by_default(spark, tmp_path):
    landed = spark.createDataFrame([([(str(i), "t")],) for i in range(3)], "value array<struct<Code:string,Title:string>>")
    path = files.land_raw(landed.coalesce(1), str(tmp_path), "d", datetime(2024, 1, 1))
    assert rows(E.read_odata(spark, path, DIMENSION_ITEM), "Code") == [("0",), ("1",), ("2",)]


def test_csv_is_read_by_its_header(spark, tmp_path):
    path = save(tmp_path, "a/1.csv", 'IndicatorName,More,IndicatorCode\n"two\nlines",x,A\n"",,B\n')
    assert rows(S.read_csv(spark, path, INDICATORS_CSV)) == [("A", "two\nlines"), ("B", "")]
    with pytest.raises(ValueError):
        S.read_csv(spark, path, "IndicatorCode STRING, Missing STRING")
    save(tmp_path, "a/2.csv", "IndicatorCode,More,IndicatorName\nC,x,c\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        S.read_csv(spark, str(tmp_path / "a"), INDICATORS_CSV).collect()
    wrong = save(tmp_path, "wrong.csv", "k,v\n1,1.5\n2,abc\n3,1,2\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        S.read_csv(spark, wrong, "v DOUBLE, k INT").collect()
    taken = S.read_csv_and_rejects(spark, wrong, "v DOUBLE, k INT")
    assert rows(taken.rows) == [(1.5, 1)] and rows(taken.rejects, "record") == [("2,abc",), ("3,1,2",)]
    assert taken.rows.count() == 1 and taken.rejects.count() == 2


def test_csv_text_survives(spark, tmp_path):
    texts = [("A_1", 'say "hi", twice'), ("B", "two\nlines"), ("C_2", None), ("D", "NA"), ("E", " padded "), ("F", "")]
    df = spark.createDataFrame(texts, INDICATORS_CSV)
    files.write_csv(categorise(df), str(tmp_path / "csv"))
    back = S.read_csv(spark, str(tmp_path / "csv"), CATEGORIZED_CSV)
    assert rows(back, "IndicatorCode", "IndicatorName") == sorted(texts, key=repr)
    assert rows(back, "Category") == [("A",), ("B",), ("C",), ("D",), ("E",), ("F",)]


def test_landing_is_never_overwritten(spark, tmp_path):
    path = files.land_raw(spark.range(2), str(tmp_path), "who", datetime(2024, 5, 6, 7, 8, 9))
    assert path.endswith("who/ingest_ts=20240506_070809")
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.land_raw(spark.range(1), str(tmp_path), "who", datetime(2024, 5, 6, 7, 8, 9))


def test_catalog_and_schema(spark, raw):
    for name in ("zeta", "alpha", "sqlite_sequence"):
        spark.range(1).createOrReplaceTempView(name)
    names = S.catalog_tables(spark, not_like="sqlite\\_%")
    assert [n for n in names if not n.startswith("starloom")] == ["alpha", "zeta"]
    assert S.catalog_tables(spark, like="%pha", not_like="z%") == ["alpha"]
    for name in ("zeta", "alpha", "sqlite_sequence"):
        spark.catalog.dropTempView(name)
    summary = S.schema_summary({"dim_sex": raw["dim_sex"]})
    assert rows(summary, "cid", "column_name", "data_type", "pk", "filled") == [
        (0, "sex_id", "bigint", True, 3),
        (1, "sex_code", "string", False, 3),
        (2, "sex_name", "string", False, 3),
    ]


def test_freshness(spark, tmp_path):
    save(tmp_path, "t/a.json", "x" * 1_048_576)
    checks = freshness_checks(spark, "raw", {"t": str(tmp_path / "t"), "gone": str(tmp_path / "gone")})
    assert rows(checks, "table", "check", "status", "observed") == [
        ("gone", "exists", "fail", None),
        ("t", "exists", "pass", 1.0),
        ("t", "size_mb", "pass", 1.0),
    ]


def test_file_stats(spark, tmp_path):
    save(tmp_path, "a.json", "x" * 2_097_152)
    stats = S.file_stats(spark, str(tmp_path), "*.json").collect()
    assert [(r["file"], r["size_bytes"], r["size_mb"]) for r in stats] == [("a.json", 2_097_152, 2.0)]
    assert stats[0]["modified_at"].endswith("+00:00")


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "x"

    class Session:
        sparkContext = Context

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError):
        shared_root(Session)
    Session.conf.get = staticmethod(lambda key, default=None: "hdfs://shared/tmp/")
    assert shared_root(Session) == "hdfs://shared/tmp"


# --- keyed changes ---------------------------------------------------------------------------------------


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k long, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "c"), (None, "m")], "k long, v string")
    merged = dml.upsert(target, batch, ["k"])
    expected = sorted([(1, "a"), (2, "B"), (3, "c"), (None, "m"), (None, "n")], key=repr)
    assert rows(merged) == expected
    once = dml.upsert(target.dropna(), batch.dropna(), ["k"])
    assert rows(dml.upsert(once, batch.dropna(), ["k"])) == rows(once)


def test_upsert_keeps_old_and_adds_new_columns(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, gone string")
    batch = spark.createDataFrame([(2, True)], "k long, added boolean")
    assert rows(dml.upsert(target, batch, ["k"]), "k", "gone", "added") == [(1, "a", None), (2, None, True)]


def test_insert_ignore(spark):
    target = spark.createDataFrame([("A", "old")], "k string, v string")
    batch = spark.createDataFrame([("A", "new"), ("B", "2"), ("B", "1"), (None, "x"), (None, "y")], "k string, v string")
    merged = dml.insert_ignore(target, batch, "k")
    assert rows(merged) == sorted([("A", "old"), ("B", "1"), (None, "x"), (None, "y")], key=repr)


def test_assign_ids_reuses_and_numbers_on(spark):
    dim = spark.createDataFrame([(7, "B", "Bee")], "id long, code string, name string")
    codes = spark.createDataFrame([("C",), ("A",), ("B",), (None,), ("C",)], "code string")
    again = dml.assign_ids(codes, dml.assign_ids(codes, dim, "code", "id"), "code", "id")
    assert rows(again) == sorted([(7, "B", "Bee"), (8, "A", None), (9, "C", None)], key=repr)


def test_enrich_fills_only_blanks(spark):
    dim = spark.createDataFrame([("A", None), ("B", ""), ("C", "  "), ("D", "kept"), ("E", "")], "c string, n string")
    lookup = spark.createDataFrame([("A", "a", 1), ("A", "b", 2), ("B", "x", 1), ("D", "y", 1)], "c string, f string, i int")
    filled = dml.enrich(dim, lookup, "c", "n", "f", F.col("i"))
    assert rows(filled) == [("A", "b"), ("B", "x"), ("C", "  "), ("D", "kept"), ("E", "")]


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "d", 1)], "k long, v string, t int")
    assert rows(dml.latest_per_key(df, ["k"], "t")) == [(1, "b", 3), (2, "d", 1)]
    keyless = spark.createDataFrame([(None, "a", 1), (None, "b", 2)], df.schema)
    assert dml.latest_per_key(df.unionByName(keyless), ["k"], "t").count() == 4


def test_first_per_key_prefers_a_real_value(spark):
    df = spark.createDataFrame([("A", None, 1), ("A", "real", 2), ("B", "z", 1), ("B", "a", 2)], "k string, v string, i int")
    assert rows(dml.first_per_key(df.drop("i"), "k")) == [("A", "real"), ("B", "a")]
    assert rows(dml.first_per_key(df, "k", ["i"]), "k", "v") == [("A", None), ("B", "z")]


@pytest.fixture()
def small_slices(spark):
    """Keep the slices of tiny tables apart, which Spark would otherwise merge."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_numbering_with_one_group_of_most_rows(spark, small_slices):
    """Nine rows of ten share a group, which has to be cut; the numbers are those of a plain ranking."""
    df = spark.range(4000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 7).cast("long").alias("g"), (F.hash("id") % 1000).alias("o"), "id"
    )
    slices = sorted_slices(df, ["g", "o", "id"])
    biggest = slices.filter("g is null").groupBy("__slice").count().agg(F.max("count")).first()[0]
    assert biggest < 3000
    got = rows(place_within(slices, n=["g"], i=[]), "id", "n", "i")
    ranked = df.selectExpr(
        "id", "row_number() over (partition by g order by o, id) n", "row_number() over (order by g nulls first, o, id) i"
    )
    assert got == rows(ranked)


def test_hot_keys_are_split(spark, tmp_path):
    """With nine rows of ten on one code, Spark divides the partition that code falls into."""
    hot = F.when(F.col("id") % 10 != 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id").cast("string")))
    facts = spark.range(0, 200_000, 1, 8).select(hot.alias("code"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    facts.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    dim = materialise(facts.select("code").distinct().withColumn("code_id", F.hash("code")), "dim")
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512KB",
    }
    before = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        for df in (
            dml.resolve_ids(facts, dim, "code", "code_id"),
            dml.upsert(facts, dim.select("code").filter("code <> 'hot'"), ["code"]),
            dml.enrich(facts.withColumn("name", F.lit("")), dim.withColumnRenamed("code_id", "f"), "code", "name", "f"),
        ):
            assert len(df.collect()) == 200_000
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_repeat_rows_in_blocks(spark):
    df = spark.createDataFrame([("a", 25), ("b", 1)], "v string, n long")
    repeated = repeat_rows(df, "n", "i", block=10)
    assert rows(repeated, "v", "i") == sorted([("a", i) for i in range(25)] + [("b", 0)], key=repr)


def test_dense_ids_continue(spark):
    df = spark.createDataFrame([("b",), ("a",)], "c string")
    assert rows(dense_ids(df, ["c"], "id", 5)) == [("a", 5), ("b", 6)]


def test_facts_keep_their_ids(spark, small_slices):
    ddl = "indicator_id long, location_id long, period_id long, sex_id long, value double, load_unit string"
    first = [(1, 1, 1, None, 5.0, "u"), (1, 1, 1, None, 5.0, "u"), (1, 1, 1, None, 3.0, "u"), (1, 2, 1, 1, 9.0, "u")]
    loaded = dml.load_facts(spark.createDataFrame(first, ddl))
    assert rows(loaded, "observation_id", "sex_id", "copy_no", "value") == [
        (1, None, 1, 3.0),
        (2, None, 2, 5.0),
        (3, None, 3, 5.0),
        (4, 1, 1, 9.0),
    ]
    base = scratch(spark, "test-facts")
    publish.publish(loaded, base)
    stored = publish.current(spark, base)
    assert rows(dml.load_facts(spark.createDataFrame(first, ddl), stored)) == []
    # Without a unit a load is one of its own, and only adds.
    more = dml.load_facts(spark.createDataFrame(first, ddl).drop("load_unit"), stored)
    assert rows(more, "observation_id", "value") == [(5, 3.0), (6, 5.0), (7, 5.0), (8, 9.0)]
    # A corrected value replaces the only row of its key, and a new key comes after the largest id.
    second = [(1, 2, 1, 1, 8.0, "u"), (0, 1, 1, 1, 1.0, "u")]
    merged = dml.upsert(stored, dml.load_facts(spark.createDataFrame(second, ddl), stored), ["observation_id"])
    assert rows(merged, "observation_id", "indicator_id", "value")[3:] == [(4, 1, 8.0), (5, 0, 1.0)]
    numbered = dml.with_copy_no(stored.drop("copy_no"))
    assert rows(numbered, "observation_id", "copy_no") == rows(stored, "observation_id", "copy_no")


def test_loading_files_twice_changes_nothing(spark, tmp_path):
    csv = save(tmp_path, "categorized.csv", "IndicatorCode,IndicatorName,Category\nAIR_1,Air,AIR\nAIR_1,Again,AIR\nX_1,Else,X\n")
    listed = S.read_csv(spark, csv, CATEGORIZED_CSV, position="position")
    items = landed_items(spark, tmp_path)
    base = scratch(spark, "test-load")

    def load(raw):
        loaded = load_observations(load_dimensions(raw, listed), items, "AIR", unit="landing")
        return {name: publish.current(spark, publish.publish(df, f"{base}/{name}").rsplit("/", 1)[0]) for name, df in loaded.items()}

    once = load(empty_raw(spark))
    assert rows(once["dim_indicators"]) == [(1, "AIR_1", "Air", "AIR"), (2, "X_1", "Else", "X")]
    assert rows(once["dim_sex"], "sex_id", "sex_code") == [(1, "BTSX"), (2, "FMLE"), (3, "MLE")]
    assert rows(once["dim_locations"], "location_id", "country_code") == [(1, "BRA"), (2, "USA")]
    assert rows(once["dim_periods"]) == [(1, 2000), (2, 2001)]
    facts = ["observation_id", "indicator_id", "location_id", "period_id", "sex_id", "value"]
    assert rows(once["fact_observations"], *facts) == [
        (1, 1, 1, 1, 3, 1.5),
        (2, 1, 2, 2, None, 3.0),
        (3, 1, 2, 2, None, 4.0),
        (4, 1, 2, 2, 3, 2.0),
    ]
    first = {name: rows(df) for name, df in once.items()}
    assert {name: rows(df) for name, df in load(once).items()} == first

    names = spark.createDataFrame([("BRA", "Brazil")], "`ISO3166-1-Alpha-3` string, official_name_en string")
    assert rows(enrich_locations(once, names)["dim_locations"], "country_code", "country_name") == [("BRA", "Brazil"), ("USA", None)]


# --- published tables ------------------------------------------------------------------------------------


def test_publish_passes_over_unfinished_versions(spark, tmp_path):
    base = str(tmp_path / "t")
    publish.publish(spark.range(3), base)
    (tmp_path / "t" / "version=00000002").mkdir()
    assert publish.current(spark, base).count() == 3
    path = publish.publish_upsert(spark.range(2, 5), base, ["id"])
    assert path.endswith("version=00000003")
    assert rows(publish.current(spark, base)) == [(0,), (1,), (2,), (3,), (4,)]
    with pytest.raises(FileNotFoundError):
        publish.current(spark, str(tmp_path / "none"))
    assert publish.forget_versions(spark, base, keep=2) == []
    publish.publish(spark.range(1), base)
    assert publish.forget_versions(spark, base, keep=2) == [1, 2]
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["version=00000003", "version=00000004"]
    assert publish.current(spark, base).count() == 1


def test_failed_load_changes_nothing(spark, tmp_path):
    base = str(tmp_path / "t")
    publish.publish(spark.range(3), base)
    with pytest.raises((PySparkException, Py4JJavaError)):
        publish.publish(spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), base)
    assert rows(publish.current(spark, base)) == [(0,), (1,), (2,)]


@pytest.mark.parametrize("part", ["string", "long", "date"])
def test_partitioned_upsert_moves_rows(spark, tmp_path, part):
    path = str(tmp_path / "t")
    day = {"string": ["a b", "c/d", "e"], "long": [1, 2, 3], "date": ["2024-01-01", "2024-01-02", "2024-01-03"]}[part]

    def frame(*data):
        return spark.createDataFrame(data, "k long, v string, p string").withColumn("p", F.col("p").cast(part))

    publish.upsert_partitions(frame((1, "x", day[0]), (2, "y", day[1]), (3, "z", None)), path, ["k"], "p")
    untouched = {f.name for f in (tmp_path / "t").rglob("*.parquet") if "HIVE_DEFAULT" in str(f)}
    for _ in range(2):
        publish.upsert_partitions(frame((1, "X", day[1]), (4, "w", day[2])), path, ["k"], "p")
    got = spark.read.parquet(path)
    assert rows(got.select("k", "v", F.col("p").cast("string"))) == sorted(
        [(1, "X", str(day[1])), (2, "y", str(day[1])), (3, "z", None), (4, "w", str(day[2]))], key=repr
    )
    assert untouched <= {f.name for f in (tmp_path / "t").rglob("*.parquet")}
    publish.upsert_partitions(frame((4, "W", day[2])), path, ["k"], "p", rows_move=False)
    assert rows(spark.read.parquet(path).filter("k = 4"), "v") == [("W",)]


def test_partitioned_upsert_of_more_partitions_than_are_listed(spark, tmp_path):
    """Rows that move, a partition left empty, the NULL one and an untouched one, all the same as by list."""

    def upserted(path, most):
        frame = lambda *data: spark.createDataFrame(data, "k long, v string, p string")
        old = [(k, "old", f"p{k:02}") for k in range(8)] + [(8, "old", "p07"), (9, "old", None), (10, "old", None)]
        publish.upsert_partitions(frame(*old), path, ["k"], "p")
        kept = {f.name for f in (tmp_path / path.split("/")[-1]).rglob("*.parquet") if "p=p06" in str(f)}
        new = frame((0, "new", "p00"), (1, "new", "p02"), (7, "new", "p03"), (9, "new", "p04"), (11, "new", "p05"), (12, "new", None))
        publish.upsert_partitions(new, path, ["k"], "p", most_partitions=most)
        folders = {f.name for f in (tmp_path / path.split("/")[-1]).glob("p=*")}
        assert kept <= {f.name for f in (tmp_path / path.split("/")[-1]).rglob("*.parquet")} and "p=p01" not in folders
        return rows(spark.read.parquet(path), "k", "v", "p")

    got = upserted(str(tmp_path / "joined"), 2)
    assert got == upserted(str(tmp_path / "listed"), 100)
    assert len(got) == 13 and sum(r[1] == "new" for r in got) == 6


@pytest.mark.parametrize("name, writer", [("src_landed_default", "land_raw"), ("dml_first_wins", "write_csv"), ("dml_enrich_last_wins", "write_csv")])
def test_queries_write_whole_tables_in_several_files(spark, monkeypatch, name, writer):
    """With the same rows as out of one file."""
    folder, written, plain = "/root/testdata/sf0.001", [], getattr(files, writer)
    query = getattr(storage, name)
    expected = rows(query(spark, folder))

    def noted(df, path, *more):
        written.append(plain(df, path, *more) or path)
        return written[-1]

    monkeypatch.setattr(files, writer, noted)
    monkeypatch.setattr(storage, "table", lambda *x: table(*x).repartition(3))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows(query(spark, folder)) == expected
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spark.read.text(written[0]).inputFiles()) > 1


def test_partition_names_stay_text_and_columns_are_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.upsert_partitions(spark.createDataFrame([(1, "a", "01"), (2, "b", "1")], "k long, v string, p string"), path, ["k"], "p")
    added = spark.createDataFrame([(3, True, "2")], "k long, flag boolean, p string")
    publish.upsert_partitions(added, path, ["k"], "p")
    publish.upsert_partitions(spark.createDataFrame([(1, "A", "01")], "k long, v string, p string"), path, ["k"], "p")
    stored = publish.read_partitions(spark, path, "p", spark.createDataFrame([], "p string").schema["p"].dataType)
    assert rows(stored, "k", "v", "flag", "p") == [(1, "A", None, "01"), (2, "b", None, "1"), (3, None, True, "2")]
    (tmp_path / "bare").mkdir()
    publish.upsert_partitions(added, str(tmp_path / "bare"), ["k"], "p")
    assert spark.read.parquet(str(tmp_path / "bare")).count() == 1


def test_tables_and_views(spark, tmp_path):
    publish.recreate(spark, "starloom_t", struct("id BIGINT"), str(tmp_path / "a"))
    assert spark.table("starloom_t").count() == 0
    publish.as_table(spark.range(5), "starloom_t", str(tmp_path / "a"))
    assert spark.table("starloom_t").count() == 5
    spark.sql("DROP TABLE starloom_t")
    publish.as_view(spark.range(2), "starloom_v")
    assert spark.table("starloom_v").count() == 2
    assert publish.drop_view(spark, "starloom_v") and not publish.drop_view(spark, "starloom_v")


def test_bucketed_table_is_not_shuffled_for_an_upsert(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    publish.as_table(spark.range(50), "starloom_b", str(tmp_path / "b"), bucket_by=(4, "id"))
    merged = dml.upsert(spark.table("starloom_b"), spark.range(40, 60), ["id"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    target_side = plan[plan.index("SortMergeJoin") : plan.index("Bucketed: true")]
    assert "Exchange" not in target_side
    assert merged.count() == 60
    spark.sql("DROP TABLE starloom_b")


# --- streams ---------------------------------------------------------------------------------------------


def test_stream_takes_each_file_once(spark, tmp_path):
    base, out, state = (str(tmp_path / n) for n in ("land", "out", "state"))
    schema = struct("id BIGINT")
    for hour, n in ((1, 2), (2, 3)):
        files.land_raw(spark.range(n), base, "x", datetime(2024, 1, 1, hour))
        for _ in range(2):
            ingest_available(landed_stream(spark, f"{base}/x", schema), out, state)
        assert spark.read.parquet(out).count() == (2 if hour == 1 else 5)


def test_replayed_stream_gives_the_same_table(spark, tmp_path):
    base, out = str(tmp_path / "land"), str(tmp_path / "out")
    ddl = "k BIGINT, v STRING, p STRING"
    for hour, data in ((1, [(1, "a", "x"), (2, "b", "x")]), (2, [(2, "B", "y"), (3, "c", "y")])):
        files.land_raw(spark.createDataFrame(data, ddl), base, "x", datetime(2024, 1, 1, hour))
    expected = [(1, "a", "x"), (2, "B", "y"), (3, "c", "y")]
    for state in ("one", "two"):
        stream = landed_stream(spark, f"{base}/x", struct(ddl))
        upsert_available(stream, out, str(tmp_path / state), ["k"], "p")
        assert rows(spark.read.parquet(out), "k", "v", "p") == expected


def test_stream_rows_without_key_or_form(spark, tmp_path):
    base, out, bad = (str(tmp_path / n) for n in ("land", "out", "bad"))
    save(tmp_path, "land/ingest_ts=20240101_010000/a.json", '{"k":1,"v":"a","p":"x"}\n{"k":null,"v":"b","p":"x"}\n{"k":2,"v":"c\n')
    for rejects, error in ((False, True), (True, False)):
        stream = landed_stream(spark, base, struct("k BIGINT, v STRING, p STRING"), rejects=rejects)
        run = lambda state: upsert_available(stream, out, str(tmp_path / state), ["k"], "p", rejects=bad if rejects else None)  # noqa: B023, E731
        if error:
            with pytest.raises((PySparkException, Py4JJavaError)):
                run("strict")
            continue
        for state in ("one", "two"):
            run(state)
            assert rows(spark.read.parquet(out), "k", "v") == [(1, "a")]
            assert spark.read.json(bad).count() == 2


def test_an_older_landing_does_not_win(spark, tmp_path):
    base, out = str(tmp_path / "land"), str(tmp_path / "out")
    for day, v, p in ((2, "new", "x"), (1, "old", "y")):
        files.land_raw(spark.createDataFrame([(1, v, p)], "k BIGINT, v STRING, p STRING"), base, "d", datetime(2024, 2, day))
        stream = landed_stream(spark, f"{base}/d", struct("k BIGINT, v STRING, p STRING"))
        upsert_available(stream, out, str(tmp_path / "state"), ["k"], "p")
    assert rows(spark.read.parquet(out), "k", "v", "p") == [(1, "new", "x")]


def test_increment_reads_and_writes_one_period(spark, raw, tmp_path):
    """Damaged files of the other periods do not matter, and are still there afterwards."""
    base = str(tmp_path / "w")
    build_increment(raw, base)
    folder = tmp_path / "w" / "fct_observations"
    others = [f for f in folder.rglob("part-*.parquet") if "period_id=2" not in str(f)]
    for f in others:
        f.write_bytes(b"damaged")
    star = build_increment(raw, base, periods=[2])
    assert all(f.read_bytes() == b"damaged" for f in others)
    fact = star.fact.filter("period_id = 2")
    assert "PartitionFilters: [isnotnull(period_id" in fact._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.observation_id for r in fact.collect()) == [3, 4]


def test_reconciliation_reads_each_layer_once_and_for_coverage(spark, tmp_path):
    frames = {}
    for layer in ("raw", "staging", "mart"):
        spark.range(5).withColumn("value", F.lit(1.0)).write.parquet(str(tmp_path / layer))
        frames[layer] = spark.read.parquet(str(tmp_path / layer))
    layers = R.Layers("x", ("r", "id"), ("s", "id"), ("m", "id"), value="value")
    scans = sum(
        part._jdf.queryExecution().executedPlan().toString().count("FileScan") for part in R.subject_checks(layers, frames, 0.1)
    )
    assert scans <= 5


def test_texts_are_counted_by_digest(spark, tmp_path):
    spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "t string").write.parquet(str(tmp_path / "t"))
    found = C.check_unique(spark.read.parquet(str(tmp_path / "t")), "t")
    assert rows(found, "t", "n") == [("a", 2)]


# --- lineage ---------------------------------------------------------------------------------------------


def test_lineage(spark, tmp_path):
    manifest = {
        "nodes": {
            "model.p.stg_a": {
                "resource_type": "model",
                "name": "stg_a",
                "depends_on": {"nodes": ["source.p.raw_db.a"]},
                "columns": {"id": {"data_type": "bigint"}, "x": {}},
            },
            "model.p.dim_a": {
                "resource_type": "model",
                "name": "dim_a",
                "config": {"materialized": "table"},
                "depends_on": {"nodes": ["model.p.stg_a"]},
            },
            "test.p.unique_a": {"resource_type": "test", "name": "unique_a", "config": {"severity": "warn"}},
            "test.p.not_null_a": {"resource_type": "test", "name": "not_null_a"},
        },
        "sources": {"source.p.raw_db.a": {"resource_type": "source", "name": "a", "source_name": "raw_db"}},
    }
    nodes = read_manifest(spark, save(tmp_path, "manifest.json", manifest))
    assert rows(L.lineage_nodes(nodes), "name", "layer", "materialized") == [
        ("dim_a", "mart", "table"),
        ("raw_db.a", "source", None),
        ("stg_a", "staging", "view"),
    ]
    assert rows(L.lineage_edges(nodes)) == [("raw_db.a", "stg_a"), ("stg_a", "dim_a")]
    assert rows(L.lineage_tests(nodes), "name", "severity") == [("not_null_a", "error"), ("unique_a", "warn")]
    assert rows(L.lineage_columns(nodes)) == [("stg_a", "id", "bigint"), ("stg_a", "x", "unknown")]
    assert L.lineage_gate(nodes).first().asDict() == {"tests": 2, "edges": 2, "status": "pass"}
    del manifest["nodes"]["test.p.unique_a"], manifest["nodes"]["test.p.not_null_a"]
    bare = read_manifest(spark, save(tmp_path, "bare.json", manifest))
    assert L.lineage_gate(bare).first()["status"] == "fail"
    old = {"nodes": manifest["nodes"] | manifest["sources"]}
    assert L.lineage_nodes(read_manifest(spark, save(tmp_path, "old.json", old))).count() == 3


def test_a_line_is_a_row_or_a_reject(spark, tmp_path):
    """Malformed in a column that the transform drops."""
    base = tmp_path / "land"
    save(tmp_path, "land/ingest_ts=20240101_000000/a.json", '{"id":1,"v":5}\n{"id":2,"v":"bad"}\n{"id":3\n{"id":null,"v":null}\n')
    stream = landed_stream(spark, str(base), struct("id BIGINT, v BIGINT"), rejects=True)
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    ingest_available(stream, out, str(tmp_path / "state"), lambda landed: landed.select("id"), rejects=rejects)
    assert rows(spark.read.parquet(out)) == sorted([(1,), (None,)], key=repr)
    assert rows(spark.read.parquet(rejects), "record") == [('{"id":2,"v":"bad"}',), ('{"id":3',)]


def test_a_micro_batch_reads_its_partitions_only(spark):
    path = scratch(spark, "test-near")
    publish.upsert_partitions(spark.createDataFrame([(i, "abc"[i % 3], "2") for i in range(9)], "k long, p string, ingest_ts string"), path, ["k", "p"], "p")
    target = publish.read_partitions(spark, path, "p", T.StringType())
    batch = spark.createDataFrame([(0, "a", "1"), (3, "a", "3"), (1, "c", "1")], "k long, p string, ingest_ts string")
    found = overtaken_keys(batch, target, ["k", "p"], "p", "ingest_ts")
    assert rows(found) == [(0, "a")]
    assert "PartitionFilters: [isnotnull(p" in (plan := found._jdf.queryExecution().toString()) or "PartitionFilters: [p" in plan
    moved = overtaken_keys(batch, target, ["k"], "p", "ingest_ts")
    assert rows(moved) == [(0,), (1,)]
