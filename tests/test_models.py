import hashlib

import pytest
from pyspark.sql import functions as F
from seedstar import SEED, make_raw, rows

from starloom.operators import checks as C
from starloom.operators import health as H
from starloom.operators import reconcile as R
from starloom.operators.contracts import MART_CONTRACTS, RAW_CONTRACTS, Contract, validate_all
from starloom.plans import analytics as A
from starloom.plans.build import build_warehouse
from starloom.plans.marts import Star, build_marts, build_star
from starloom.plans.staging import build_staging
from starloom.schemas import MART_DDL, struct
from starloom.session import scratch


def failing(checks):
    return {
        (r["table"], r["check"], r["column"]) for r in checks.filter(F.col("status") != "pass").collect()
    }


def all_checks(spark, raw):
    """What each family of checks finds in the star of ``raw``."""
    staging = build_staging(raw)
    marts = build_marts(staging)
    return {
        "contracts": failing(validate_all(spark, RAW_CONTRACTS, raw))
        | failing(validate_all(spark, MART_CONTRACTS, marts)),
        "tests": failing(C.column_tests(marts)) | failing(C.count_tests(staging, marts)),
        "reconcile": failing(R.reconcile(spark, raw, staging, marts)),
        "health": failing(H.reference_checks(spark, marts)),
    }


NOTHING = {"contracts": set(), "tests": set(), "reconcile": set(), "health": set()}


def facts(**change):
    """The seed facts with the first one changed."""
    names = ["observation_id", "indicator_id", "location_id", "period_id", "sex_id", "value"]
    first = dict(zip(names, SEED["fact_observations"][0])) | change
    return [tuple(first[n] for n in names), *SEED["fact_observations"][1:]]


def test_seed_marts(spark, raw):
    star = build_star(raw)
    counts = {t: df.count() for t, df in star.tables.items()}
    assert counts == {"dim_indicator": 3, "dim_location": 3, "dim_period": 5, "dim_sex": 4, "fct_observations": 10}
    assert star.fact.agg(F.round(F.sum("value"), 1)).first()[0] == 1603.9
    for name, ddl in MART_DDL.items():
        expected = [(f.name, f.dataType.simpleString()) for f in struct(ddl).fields]
        assert star.tables[name].dtypes == expected
    md5 = hashlib.md5(b"0").hexdigest()
    assert (md5, 0, "UNK", "Unknown") in rows(star.sex)


def test_seed_passes_everything(spark, raw):
    assert all_checks(spark, raw) == NOTHING
    marts = build_star(raw).tables
    report = C.column_tests(marts)
    assert report.count() == 32
    assert C.overall(report).first()[0] == "pass"
    assert H.health_overall(H.reference_checks(spark, marts)).first()[0] == "ok"


def test_reports_on_the_seed(raw):
    star = build_star(raw)
    assert [tuple(r) for r in A.observations_by_category(star).collect()] == [("NCD", 7), ("AIR", 3)]
    assert [r["total"] for r in A.observations_by_sex(star).collect()] == [4, 3, 3]
    assert A.period_range(star).first()[0] == "2000–2020"
    assert A.headline_counts(star).first().asDict() == {"observations": 10, "indicators": 3, "locations": 3}
    trend = rows(A.yearly_average(star).withColumn("avg_value", F.round("avg_value", 2)))
    assert trend == [(2000, "NCD", 215.4), (2005, "NCD", 255.4), (2010, "NCD", 163.0), (2015, "NCD", 210.0), (2020, "AIR", 42.1)]
    sample = [tuple(r) for r in A.observation_sample(star, 3).collect()]
    assert sample == [
        (1, "NCDMORT3070", "BRA", 2000, "MLE", 250.5),
        (2, "NCDMORT3070", "BRA", 2000, "FMLE", 180.3),
        (3, "NCDMORT3070", "USA", 2005, "BTSX", 320.1),
    ]


def test_average_ignores_missing_values_and_skew(spark, raw):
    fact = build_star(raw).fact.withColumn("value", F.when(F.col("value") < 200, F.col("value")))
    star = build_star(raw)
    averaged = A.yearly_average(type(star)({**star.tables, "fct_observations": fact}))
    assert {(r["year"], r["avg_value"]) for r in averaged.collect()} >= {(2015, None), (2000, 180.3)}


def test_average_meets_few_periods_after_the_facts_are_reduced(spark):
    """Facts are not gathered by period, of which there are few; groups of different size keep their weight."""
    values = [(1, 2000, 1.0), (1, 2000, 2.0), (2, 2000, 6.0), (2, 2001, 8.0), (3, 2000, 5.0), (1, 2002, 4.0), (1, 2001, None)]
    fact = spark.createDataFrame(values, "indicator_id long, period_id long, value double")
    period = spark.createDataFrame([(2000, 1), (2001, 1), (2000, 2)], "period_nk long, year long")
    indicator = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "indicator_nk long, category string")
    star = Star({"fct_observations": fact, "dim_period": period, "dim_indicator": indicator})
    averaged = A.yearly_average(star)
    assert rows(averaged) == [(1, "a", 17 / 4), (2, "a", 3.0)]
    plan = averaged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2


def test_missing_sex_becomes_unknown(spark):
    raw = make_raw(spark, fact_observations=facts(sex_id=None))
    assert all_checks(spark, raw) == NOTHING
    assert ("UNK", "Unknown", 1) in rows(A.observations_by_sex(build_star(raw)))


def test_missing_value(spark):
    found = all_checks(spark, make_raw(spark, fact_observations=facts(value=None)))
    assert found["contracts"] == {("fact_observations", "not_null", "value")}
    # Staging drops the row: one of ten is more than the tolerance, for the count only.
    assert found["reconcile"] == {("fct_observations", "count_raw_vs_mart", "observation_id")}
    assert found["tests"] == set() and found["health"] == set()
    layers = [layers for layers in R.LAYER_MAP if layers.name == "observations"]
    filtered = [R.Layers(**{**layers[0].__dict__, "raw_filter": "value is not null"})]
    raw = make_raw(spark, fact_observations=facts(value=None))
    staging = build_staging(raw)
    assert failing(R.reconcile(spark, raw, staging, build_marts(staging), filtered)) == set()


def test_orphan(spark):
    found = all_checks(spark, make_raw(spark, fact_observations=facts(location_id=99)))
    assert found["tests"] == {("fct_observations", "relationships", "location_key")}
    assert found["health"] == {("fct_observations", "orphans", "location_id")}
    assert found["contracts"] == set() and found["reconcile"] == set()


def test_duplicate_id(spark):
    found = all_checks(spark, make_raw(spark, fact_observations=facts(observation_id=2)))
    assert found["tests"] == {("fct_observations", "unique", c) for c in ("observation_id", "observation_key")}
    assert found["contracts"] == {
        (t, "pk_uniqueness", "observation_id") for t in ("fact_observations", "fct_observations")
    }
    assert found["reconcile"] == {(t, "uniqueness", "observation_id") for t in ("fact_observations", "fct_observations")}


def test_blank_name_and_missing_category(spark):
    indicators = [(1, " NCDMORT3070 ", "  ", "NCD"), (2, "NCDMORT2060", None, None), SEED["dim_indicators"][2]]
    raw = make_raw(spark, dim_indicators=indicators)
    cleaned = rows(build_star(raw).indicator, "indicator_code", "indicator_name", "category")
    assert cleaned[1:] == [("NCDMORT2060", "N/A", "UNCATEGORIZED"), ("NCDMORT3070", "N/A", "NCD")]
    assert all_checks(spark, raw) == NOTHING | {"contracts": {("dim_indicators", "not_null", "category")}}


def test_late_and_missing_year(spark):
    late = make_raw(spark, dim_periods=[*SEED["dim_periods"][:4], (5, 2030)])
    assert all_checks(spark, late) == NOTHING
    assert (2030, "2020s") in rows(build_star(late).period, "year", "decade_group")

    found = all_checks(spark, make_raw(spark, dim_periods=[*SEED["dim_periods"][:4], (5, None)]))
    assert found["contracts"] == {("dim_periods", "not_null", "year")}
    assert found["tests"] == {("fct_observations", "relationships", "period_key")}
    assert found["health"] == {("fct_observations", "orphans", "period_id")}
    assert found["reconcile"] == {("dim_period", "count_raw_vs_mart", "period_nk")}


def test_unknown_sex_code(spark):
    found = all_checks(spark, make_raw(spark, dim_sex=[(1, "XXX", "Male"), *SEED["dim_sex"][1:]]))
    assert found == NOTHING | {"tests": {("dim_sex", "accepted_values", "sex_code")}}


def test_emptied_dimension(spark):
    found = all_checks(spark, make_raw(spark, dim_locations=[]))
    assert found["contracts"] == {("dim_locations", "row_count", None), ("dim_location", "row_count", None)}
    assert found["tests"] == {("fct_observations", "relationships", "location_key")}
    assert found["health"] == {("fct_observations", "orphans", "location_id")}


def test_missing_and_retyped_columns(spark, raw):
    broken = raw["dim_locations"].drop("country_code").withColumn("location_id", F.col("location_id").cast("string"))
    report = {(r["check"], r["column"]): r for r in RAW_CONTRACTS[1].validate(spark, broken).collect()}
    assert report["columns_exist", None]["detail"] == "country_code"
    assert report["column_types", None]["detail"] == "location_id: expected bigint, got string"
    assert report["not_null", "country_code"]["status"] == "error"
    assert report["pk_uniqueness", "location_id"]["status"] == "pass"
    gone = RAW_CONTRACTS[1].validate(spark, raw["dim_locations"].drop("location_id")).collect()
    assert ("pk_uniqueness", "error") in {(r["check"], r["status"]) for r in gone}


def test_missing_tables_never_pass(spark, raw):
    """An absent table fails its contract, and is an error to reconciliation and health."""
    report = validate_all(spark, RAW_CONTRACTS, {"dim_sex": raw["dim_sex"]})
    status = {r["table"]: r["status"] for r in C.roll_up(report).collect()}
    assert status["dim_sex"] == "pass" and list(status.values()).count("fail") == 4
    assert C.overall(report).first()[0] == "fail"
    assert C.overall(report.limit(0)).first()[0] == "fail"

    staging = build_staging(raw)
    marts = dict(build_marts(staging))
    del marts["dim_period"]
    assert R.overall(R.reconcile(spark, raw, staging, marts)).first()[0] == "error"
    checks = H.reference_checks(spark, marts)
    assert failing(checks) == {("fct_observations", "orphans", "period_id")}
    assert H.health_overall(checks).first()[0] == "degraded"
    volume = H.volume_checks(spark, "mart", ["dim_period", "dim_sex"], marts)
    assert failing(volume) == {("dim_period", "exists", None)}


def test_violations_win_over_degraded(spark):
    marts = dict(build_star(make_raw(spark, fact_observations=facts(sex_id=99))).tables)
    del marts["dim_period"]
    assert H.health_overall(H.reference_checks(spark, marts)).first()[0] == "violations"


def test_null_keys_count_differently(spark):
    """NULL passes relationships and unique, is an orphan to health, and a surplus row to key checks."""
    child = spark.createDataFrame([(1,), (None,), (None,)], "k long")
    parent = spark.createDataFrame([(1,)], "p long")
    assert rows(C.check_relationship(child, "k", parent, "p")) == []
    assert rows(C.check_unique(child, "k")) == []
    assert rows(H.orphan_counts(child, [("k", parent, "p")])) == [("k", 2)]
    assert rows(A.key_uniqueness({"k": (child, "k")})) == [("k", 3, 1, 2)]


def test_values_lost_in_the_mart_fail(spark, raw):
    """A mart whose values sum to 0 is compared, not passed over."""
    staging = build_staging(raw)
    marts = dict(build_marts(staging))
    marts["fct_observations"] = marts["fct_observations"].withColumn("value", F.lit(0.0))
    assert failing(R.reconcile(spark, raw, staging, marts)) == {("fct_observations", "value_sum_raw_vs_mart", "value")}


@pytest.mark.parametrize("lost,expected", [(1, "pass"), (2, "fail")])
def test_tolerance_is_inclusive_for_counts(spark, lost, expected):
    """One row of a thousand is exactly 0.1 percent."""
    frames = {
        "raw": spark.range(1000),
        "staging": spark.range(1000),
        "mart": spark.range(1000 - lost),
    }
    layers = R.Layers("x", ("r", "id"), ("s", "id"), ("m", "id"))
    report = C.union_checks(spark, R.subject_checks(layers, frames, 0.1))
    status = {r["check"]: r["status"] for r in report.collect()}
    assert status["count_raw_vs_mart"] == expected
    assert status["coverage"] == "fail"


def test_contract_bounds_are_inclusive(spark):
    contract = Contract("raw", "t", "id BIGINT NOT NULL", ("id",), 3, 5)
    for n, status in ((2, "fail"), (3, "pass"), (5, "pass"), (6, "fail")):
        report = {r["check"]: r["status"] for r in contract.validate(spark, spark.range(n)).collect()}
        assert report["row_count"] == status


def test_build_twice_changes_nothing(spark, raw):
    base = scratch(spark, "test-warehouse")
    first = build_warehouse(raw, base)
    before = {name: rows(df) for name, df in first.tables.items()}
    second = build_warehouse(raw, base)
    assert {name: rows(df) for name, df in second.tables.items()} == before
    corrected = make_raw(spark, fact_observations=facts(value=1.0))
    third = build_warehouse(corrected, base)
    assert (1, 1.0) in rows(third.fact, "observation_id", "value")
    assert third.fact.count() == 10
