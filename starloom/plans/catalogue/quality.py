"""Queries: column tests, contracts, expectations, reconciliation and health."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators import checks as C
from starloom.operators import diff as D
from starloom.operators import expectations as X
from starloom.operators import health as H
from starloom.operators import history as Y
from starloom.operators import reconcile as R
from starloom.operators.contracts import MART_CONTRACTS, RAW_CONTRACTS, Contract, validate_all
from starloom.plans.analytics import volumes
from starloom.plans.marts import build_marts, build_star
from starloom.plans.registry import query
from starloom.plans.staging import build_staging
from starloom.plans.testdata import TABLES, event_raw, sales_raw, table
from starloom.session import scratch

REPORT = ["layer", "table", "check", "column", "status", "observed"]


def _without_errors(spark, sf):
    """Events whose type is NULL where it was an error."""
    return table(spark, sf, "events").withColumn("event_type", F.nullif(F.col("event_type"), F.lit("error")))


def _sales_marts(spark, sf):
    return build_star(sales_raw(spark, sf, dirty=True)).tables


def _row(layer, name, check, column, status, observed):
    """One expected check row as SQL; ``observed`` and ``status`` may use the aggregate of the FROM clause."""
    column = "cast(null as varchar)" if column is None else f"'{column}'"
    return (
        f"select '{layer}' layer, '{name}' \"table\", '{check}' \"check\", {column} \"column\", "
        f"{status} status, cast({observed} as double) observed"
    )


def _zero(expression):
    return f"case when {expression} = 0 then 'pass' else 'fail' end"


# --- column tests ----------------------------------------------------------------------------------------


@query("select text, count(*) n from documents where text is not null group by 1 having count(*) > 1")
def dq_unique(spark, sf):
    return C.check_unique(table(spark, sf, "documents"), "text")


@query(
    """select 'event_type' as "column", count(*) - count(nullif(event_type, 'error')) nulls from events
       union all select 'user_id', count(*) - count(user_id) from events"""
)
def dq_not_null(spark, sf):
    return C.check_not_null(_without_errors(spark, sf), "event_type", "user_id")


@query(
    """select event_type as "value", count(*) n from events
       where nullif(event_type, 'error') not in ('click', 'view', 'purchase') group by 1"""
)
def dq_accepted_values(spark, sf):
    return C.check_accepted(_without_errors(spark, sf), "event_type", ["click", "view", "purchase"])


@query(
    """select d.doc_id as "value", count(*) n from documents d left join labels l on d.doc_id = l.doc_id
       where l.doc_id is null group by 1"""
)
def dq_relationships(spark, sf):
    return C.check_relationship(table(spark, sf, "documents"), "doc_id", table(spark, sf, "labels"), "doc_id")


@query(
    """select a.c expected_rows, b.c actual_rows, case when a.c = b.c then 'pass' else 'fail' end status
       from (select count(*) c from documents) a, (select count(*) c from labels) b"""
)
def dq_row_count_match(spark, sf):
    return C.check_same_count(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query(
    """select count(distinct nullif(l_returnflag, 'N')) + 1 expected_rows, count(distinct l_returnflag) actual_rows,
              'pass' status from lineitem"""
)
def dq_row_count_plus_one(spark, sf):
    staging = build_staging(sales_raw(spark, sf))
    return C.check_same_count(staging["stg_sex"], build_marts(staging)["dim_sex"], offset=1)


_DUPLICATES = "(select count(*) from (select {0} from {1} group by 1 having count(*) > 1) d)"
_YEAR = "year(l_shipdate)"
# What the column tests find in the star of line items with its blanks and padding: repeated brands, nation
# names and line numbers, two return flags outside the accepted codes, and the year that staging dropped.
_FOUND = {
    ("dim_indicator", "indicator_code", "unique"): _DUPLICATES.format("p_brand", "part"),
    ("dim_location", "country_code", "unique"): _DUPLICATES.format(
        "n_name", "supplier join nation on s_nationkey = n_nationkey"
    ),
    ("dim_sex", "sex_code", "accepted_values"): "(select count(distinct l_returnflag) from lineitem where l_returnflag <> 'N')",
    ("fct_observations", "observation_id", "unique"): _DUPLICATES.format(
        "l_orderkey * 8 + l_linenumber", "lineitem where l_quantity <> 1"
    ),
    ("fct_observations", "observation_key", "unique"): _DUPLICATES.format(
        "l_orderkey * 8 + l_linenumber", "lineitem where l_quantity <> 1"
    ),
    ("fct_observations", "period_key", "relationships"): (
        f"(select count(*) from lineitem where l_quantity <> 1 and {_YEAR} = 1995)"
    ),
}


def _column_tests_sql():
    rows = []
    for name, columns in C.MART_TESTS.items():
        for column, kinds in columns.items():
            for kind in kinds:
                kind = kind if isinstance(kind, str) else next(iter(kind))
                found = _FOUND.get((name, column, kind), "0")
                rows.append(_row("mart", name, kind, column, _zero(found), found))
    return " union all ".join(rows)


@query(_column_tests_sql())
def dq_column_tests(spark, sf):
    return C.column_tests(_sales_marts(spark, sf)).select(*REPORT)


@query(
    " union all ".join(
        [
            _row("mart", "dim_indicator", "row_count_match", None, "'pass'", "count(*)") + " from part",
            _row("mart", "dim_location", "row_count_match", None, "'pass'", "count(*)") + " from supplier",
            _row("mart", "dim_period", "row_count_match", None, "'pass'", f"count(distinct nullif({_YEAR}, 1995))")
            + " from lineitem",
            _row("mart", "dim_sex", "row_count_match", None, "'pass'", "count(distinct l_returnflag)") + " from lineitem",
            _row("mart", "fct_observations", "row_count_match", None, "'pass'", "count(nullif(l_quantity, 1))")
            + " from lineitem",
        ]
    )
)
def dq_count_tests(spark, sf):
    staging = build_staging(sales_raw(spark, sf, dirty=True))
    return C.count_tests(staging, build_marts(staging)).select(*REPORT)


# --- contracts -------------------------------------------------------------------------------------------


def _not_null_ddl(name):
    return ", ".join(f"{c} NOT NULL" for c in TABLES[name].split(", "))


def _contract_sql(name, columns, keys, lo, hi, exist, types, nulls=None):
    """Expected report of a contract on ``name``; ``nulls`` replaces a column by an expression."""
    size = f"case when count(*) between {lo} and {hi} then 'pass' else 'fail' end"
    rows = [
        _row("raw", name, "columns_exist", None, *exist),
        _row("raw", name, "column_types", None, *types),
        _row("raw", name, "row_count", None, size, "count(*)") + f" from {name}",
    ]
    for c in columns:
        missing = f"count(*) - count({(nulls or {}).get(c, c)})"
        rows.append(_row("raw", name, "not_null", c, _zero(missing), missing) + f" from {name}")
    for key in keys:
        surplus = f"count(*) - count(distinct {key})"
        rows.append(_row("raw", name, "pk_uniqueness", key, _zero(surplus), surplus) + f" from {name}")
    return " union all ".join(rows)


def _columns(name):
    return [c.split()[0] for c in TABLES[name].split(", ")]


@query(
    _contract_sql("orders", _columns("orders"), ["o_orderkey"], 1, 20000, ("'fail'", "6"), ("'pass'", "0"))
    + " union all "
    + _row("raw", "orders", "not_null", "o_comment", "'error'", "null")
)
def dq_contract_columns(spark, sf):
    """A column the table does not have, next to everything else the contract asks for."""
    ddl = _not_null_ddl("orders") + ", o_comment STRING NOT NULL"
    contract = Contract("raw", "orders", ddl, ("o_orderkey",), 1, 20_000)
    return contract.validate(spark, table(spark, sf, "orders")).select(*REPORT)


@query(
    _contract_sql("customer", _columns("customer"), ["c_custkey", "c_name"], 1, 100, ("'pass'", "5"), ("'fail'", "1"))
)
def dq_contract_types(spark, sf):
    """One wrong type, one column of any type, and too many rows."""
    ddl = _not_null_ddl("customer").replace("c_nationkey INT", "c_nationkey BIGINT").replace("c_acctbal DOUBLE", "c_acctbal STRING")
    contract = Contract("raw", "customer", ddl, ("c_custkey", "c_name"), 1, 100, any_type=("c_acctbal",))
    return contract.validate(spark, table(spark, sf, "customer")).select(*REPORT)


@query(
    _row("raw", "orders", "row_count", None, "case when count(*) between 1 and 20000 then 'pass' else 'fail' end", "count(*)")
    + " from orders"
)
def dq_contract_rowcount(spark, sf):
    contract = Contract("raw", "orders", "o_orderkey BIGINT", (), 1, 20_000)
    report = contract.validate(spark, table(spark, sf, "orders"))
    return report.filter(F.col("check") == "row_count").select(*REPORT)


@query(
    _contract_sql("lineitem", [], ["l_orderkey", "l_shipdate"], 1, 5000000, ("'pass'", "2"), ("'pass'", "0"))
)
def dq_pk_uniqueness(spark, sf):
    contract = Contract("raw", "lineitem", "l_orderkey BIGINT, l_shipdate TIMESTAMP_NTZ", ("l_orderkey", "l_shipdate"))
    return contract.validate(spark, table(spark, sf, "lineitem")).select(*REPORT)


@query(
    _contract_sql(
        "orders",
        _columns("orders"),
        [],
        1,
        5000000,
        ("'pass'", "6"),
        ("'pass'", "0"),
        {"o_orderstatus": "nullif(o_orderstatus, 'P')"},
    )
)
def dq_contract_nulls(spark, sf):
    orders = table(spark, sf, "orders").withColumn("o_orderstatus", F.nullif(F.col("o_orderstatus"), F.lit("P")))
    return Contract("raw", "orders", _not_null_ddl("orders")).validate(spark, orders).select(*REPORT)


_SIZE = "case when count(*) between 3 and 300 then {} else {} end"


@query(
    f"""select layer, "table", status, cast(checks as bigint) checks, cast(not_passed as bigint) not_passed from (
        select * from (values ('raw', 'dim_periods', 'pass', 6, 0), ('raw', 'dim_sex', 'pass', 6, 0), ('mart', 'dim_indicator', 'pass', 8, 0),
              ('mart', 'dim_period', 'pass', 7, 0), ('mart', 'dim_sex', 'pass', 7, 0))
              v(layer, "table", status, checks, not_passed)
        union all select 'raw', 'dim_indicators', case when count(*) = 0 then 'pass' else 'fail' end, 7,
                         case when count(*) = 0 then 0 else 1 end from events where event_type = 'click'
        union all select 'raw', 'dim_locations', {_SIZE.format("'pass'", "'fail'")}, 6, {_SIZE.format(0, 1)} from customer
        union all select 'mart', 'dim_location', {_SIZE.format("'pass'", "'fail'")}, 7, {_SIZE.format(0, 1)} from customer
        union all select 'raw', 'fact_observations', case when count(*) <= 3000000 and count(*) = count(distinct event_id)
                  then 'pass' else 'fail' end, 9, 0 from events
        union all select 'mart', 'fct_observations', case when count(*) <= 3000000 and count(*) = count(distinct event_id)
                  then 'pass' else 'fail' end, 15, 0 from events) t"""
)
def dq_contract_summary(spark, sf):
    """The ten contracts over the star of events, rolled up per table. Clicks have lost their category."""
    raw = dict(event_raw(spark, sf))
    known = F.when(F.col("indicator_code") != "click", F.col("category"))
    raw["dim_indicators"] = raw["dim_indicators"].withColumn("category", known)
    marts = build_star(raw).tables
    report = validate_all(spark, RAW_CONTRACTS, raw).unionByName(validate_all(spark, MART_CONTRACTS, marts))
    return C.roll_up(report)


# --- expectations ----------------------------------------------------------------------------------------

RESULT = ["expectation", "column", "success", "element_count", "unexpected_count"]


def _expected(kind, column, success, looked_at, unexpected, source):
    return (
        f"select '{kind}' expectation, '{column}' \"column\", {success} success, "
        f"cast({looked_at} as bigint) element_count, cast({unexpected} as bigint) unexpected_count from {source}"
    )


def _repeated(column, source):
    return f"(select coalesce(sum(n), 0) from (select count({column}) n from {source} group by {column} having count({column}) > 1) d)"


@query(
    _expected(X.EXISTS, "o_orderkey", "true", "count(*)", "0", "orders")
    + " union all "
    + _expected(X.EXISTS, "missing", "false", "count(*)", "0", "orders")
)
def exp_column_exists(spark, sf):
    return X.run_suite(table(spark, sf, "orders"), [(X.EXISTS, "o_orderkey"), (X.EXISTS, "missing")]).select(*RESULT)


@query(
    _expected(X.NOT_NULL, "event_type", "count(*) = count(nullif(event_type, 'error'))", "count(*)",
              "count(*) - count(nullif(event_type, 'error'))", "events")
)
def exp_not_null(spark, sf):
    return X.run_suite(_without_errors(spark, sf), [(X.NOT_NULL, "event_type")]).select(*RESULT)


@query(
    _expected(X.UNIQUE, "text", "count(*) = count(distinct text)", "count(*)", _repeated("text", "documents"), "documents")
)
def exp_unique(spark, sf):
    return X.run_suite(table(spark, sf, "documents"), [(X.UNIQUE, "text")]).select(*RESULT)


@query(
    " union all ".join(
        [
            _expected(X.EXISTS, "IndicatorCode", "true", "count(*)", "0", "part"),
            _expected(X.NOT_NULL, "IndicatorCode", "false", "count(*)", "count(*) - count(nullif(p_brand, 'Brand#7'))", "part"),
            _expected(
                X.UNIQUE,
                "IndicatorCode",
                "false",
                "count(*)",
                _repeated("p_brand", "(select nullif(p_brand, 'Brand#7') p_brand from part)"),
                "part",
            ),
            _expected(X.EXISTS, "IndicatorName", "true", "count(*)", "0", "part"),
        ]
    )
)
def exp_suite(spark, sf):
    code = F.nullif(F.col("p_brand"), F.lit("Brand#7"))
    indicators = table(spark, sf, "part").select(code.alias("IndicatorCode"), F.col("p_name").alias("IndicatorName"))
    return X.run_suite(indicators, X.INDICATORS_SUITE).select(*RESULT)


@query(
    " union all ".join(
        [
            _expected(X.EXISTS, "IndicatorCode", "true", "count(*)", "0", "part"),
            _expected(X.EXISTS, "IndicatorName", "true", "count(*)", "0", "part"),
            _expected(X.EXISTS, "Category", "true", "count(*)", "0", "part"),
            _expected(X.NOT_NULL, "IndicatorCode", "true", "count(*)", "0", "part"),
            _expected(X.NOT_NULL, "Category", "count(*) = count(nullif(p_type, 'PROMO'))", "count(*)", "count(*) - count(nullif(p_type, 'PROMO'))", "part"),
        ]
    )
)
def exp_categorized_suite(spark, sf):
    category = F.nullif(F.col("p_type"), F.lit("PROMO")).alias("Category")
    listed = table(spark, sf, "part").select(F.col("p_brand").alias("IndicatorCode"), F.col("p_name").alias("IndicatorName"), category)
    return X.run_suite(listed, X.CATEGORIZED_INDICATORS_SUITE).select(*RESULT)


def _codes_sql(code, source, bad):
    """The suites of code lists: the code is NULL where ``bad`` holds."""
    broken = f"count(*) filter (where {bad})"
    return " union all ".join(
        [
            _expected(X.EXISTS, "Code", "true", "count(*)", "0", source),
            _expected(X.EXISTS, "Title", "true", "count(*)", "0", source),
            _expected(X.NOT_NULL, "Code", f"{broken} = 0", "count(*)", broken, source),
        ]
    )


@query(_codes_sql("s_suppkey", "supplier", "s_acctbal < 0"))
def exp_dimensions_suite(spark, sf):
    code = F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey").cast("string")).alias("Code")
    return X.run_suite(table(spark, sf, "supplier").select(code, F.col("s_name").alias("Title")), X.DIMENSIONS_SUITE).select(*RESULT)


@query(_codes_sql("c_custkey", "customer", "c_mktsegment = 'BUILDING'"))
def exp_regions_suite(spark, sf):
    code = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey").cast("string")).alias("Code")
    return X.run_suite(table(spark, sf, "customer").select(code, F.col("c_name").alias("Title")), X.REGIONS_SUITE).select(*RESULT)


# --- reconciliation --------------------------------------------------------------------------------------

OBSERVATIONS = next(layers for layers in R.LAYER_MAP if layers.name == "observations")


def _sales_layers(spark, sf, dirty=True):
    raw = sales_raw(spark, sf, dirty)
    staging = build_staging(raw)
    return {
        "raw": raw["fact_observations"],
        "staging": staging["stg_observations"],
        "mart": build_marts(staging)["fct_observations"],
    }


@query(
    "select count(*) raw, count(nullif(l_quantity, 1)) staging, count(nullif(l_quantity, 1)) mart from lineitem"
)
def rec_layer_counts(spark, sf):
    return R.layer_counts(OBSERVATIONS, _sales_layers(spark, sf))


@query(
    """select round(abs(a - b) / cast(a as double) * 100, 2) pct,
              case when abs(a - b) / cast(a as double) * 100 > 0.1 then 'fail' else 'pass' end status
       from (select count(*) a, count(nullif(l_quantity, 1)) b from lineitem) t"""
)
def rec_pct_diff(spark, sf):
    difference = R.count_difference(F.col("raw"), F.col("mart"))
    counts = R.layer_counts(OBSERVATIONS, _sales_layers(spark, sf))
    return counts.select(
        F.round(difference, 2).alias("pct"), C.verdict(difference <= F.lit(R.TOLERANCE_PCT)).alias("status")
    )


@query(
    """select 'raw' layer, cast(count(*) - count(distinct l_orderkey * 8 + l_linenumber) as double) observed from lineitem
       union all
       select 'mart', cast(count(*) - count(distinct l_orderkey * 8 + l_linenumber) as double)
       from lineitem where l_quantity <> 1"""
)
def rec_uniqueness(spark, sf):
    return C.union_checks(spark, R.uniqueness_checks(OBSERVATIONS, _sales_layers(spark, sf))).select("layer", "observed")


@query(
    """select 'count_raw_vs_mart' "check", 'pass' status, cast(0 as double) observed from lineitem having count(*) > 0
       union all
       select 'value_sum_raw_vs_mart', case when abs(r - m) / abs(r) * 100 < 0.1 then 'pass' else 'fail' end,
              round(abs(r - m) / abs(r) * 100, 2)
       from (select round(sum(-l_quantity), 2) r, round(sum(case when l_returnflag = 'A' then -1 else -l_quantity end), 2) m
             from lineitem) t"""
)
def rec_value_differs(spark, sf):
    """Values that sum to less than nothing, of which the mart has lost those of one flag."""
    raw = sales_raw(spark, sf)["fact_observations"].withColumn("value", -F.col("value"))
    lost = F.when(F.col("sex_id") == 1, F.lit(-1.0)).otherwise(F.col("value"))
    frames = {"raw": raw, "staging": raw, "mart": raw.withColumn("value", lost)}
    report = C.union_checks(spark, R.subject_checks(OBSERVATIONS, frames, R.TOLERANCE_PCT))
    return report.filter(F.col("check").endswith("_raw_vs_mart")).select("check", "status", "observed")


@query(
    """select round(coalesce(sum(q), 0), 2) sum_raw, round(coalesce(avg(q), 0), 4) avg_raw,
              round(coalesce(sum(q), 0), 2) sum_mart, round(coalesce(avg(q), 0), 4) avg_mart
       from (select nullif(l_quantity, 1) q from lineitem) l"""
)
def rec_sums(spark, sf):
    return R.layer_sums(OBSERVATIONS, _sales_layers(spark, sf))


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def rec_coverage(spark, sf):
    layers = R.Layers("documents", ("documents", "doc_id"), ("documents", "doc_id"), ("labels", "doc_id"))
    frames = {"staging": table(spark, sf, "documents"), "mart": table(spark, sf, "labels")}
    return R.uncovered(layers, frames).select("doc_id")


_SUBJECTS = [
    ("dim_indicators", "stg_indicators", "dim_indicator", "indicator", "count(distinct event_type)", "events", 0),
    ("dim_locations", "stg_locations", "dim_location", "location", "count(*)", "customer", 0),
    ("dim_periods", "stg_periods", "dim_period", "period", "count(distinct day(ts))", "events", 0),
]


def _reconcile_sql():
    rows = []
    for raw, stg, mart, name, n, source, extra in _SUBJECTS:
        nk = f"{name}_nk"
        rows += [
            _row("raw", raw, "count", f"{name}_id", "'pass'", n) + f" from {source}",
            _row("staging", stg, "count", f"{name}_id", "'pass'", n) + f" from {source}",
            _row("mart", mart, "count", nk, "'pass'", n) + f" from {source}",
            _row("mart", mart, "count_raw_vs_mart", nk, "'pass'", "0"),
            _row("raw", raw, "uniqueness", f"{name}_id", "'pass'", "0"),
            _row("mart", mart, "uniqueness", nk, "'pass'", "0"),
            _row("mart", mart, "coverage", nk, "'pass'", "0"),
        ]
    # The mart of the facts lacks the errors.
    kept = "count(*) filter (where event_type <> 'error')"
    lost, all_, some = f"count(*) - {kept}", "round(sum(value), 2)", "round(sum(value) filter (where event_type <> 'error'), 2)"
    share, worth = f"({lost}) / cast(count(*) as double) * 100", f"abs({all_} - {some}) / abs({all_}) * 100"
    rows += [
        _row(layer, name, check, column, status, n) + " from events"
        for layer, name, check, column, status, n in (
            ("raw", "fact_observations", "count", "observation_id", "'pass'", "count(*)"),
            ("staging", "stg_observations", "count", "observation_id", "'pass'", "count(*)"),
            ("mart", "fct_observations", "count", "observation_id", "'pass'", kept),
            ("mart", "fct_observations", "count_raw_vs_mart", "observation_id", f"case when {share} <= 0.1 then 'pass' else 'fail' end", f"round({share}, 2)"),
            ("raw", "fact_observations", "uniqueness", "observation_id", "'pass'", "count(*) - count(distinct event_id)"),
            ("mart", "fct_observations", "uniqueness", "observation_id", "'pass'", "count(*) - count(distinct event_id)"),
            ("mart", "fct_observations", "coverage", "observation_id", _zero(lost), lost),
            ("mart", "fct_observations", "value_sum_raw_vs_mart", "value", f"case when {worth} < 0.1 then 'pass' else 'fail' end", f"round({worth}, 2)"),
        )
    ]
    rows += [
        _row("raw", "dim_sex", "count", "sex_id", "'pass'", "3"),
        _row("staging", "stg_sex", "count", "sex_id", "'pass'", "3"),
        _row("mart", "dim_sex", "count", "sex_nk", "'pass'", "4"),
        _row("mart", "dim_sex", "count_raw_vs_mart", "sex_nk", "'pass'", "0"),
        _row("raw", "dim_sex", "uniqueness", "sex_id", "'pass'", "0"),
        _row("mart", "dim_sex", "uniqueness", "sex_nk", "'pass'", "0"),
        _row("mart", "dim_sex", "coverage", "sex_nk", "'pass'", "0"),
    ]
    return " union all ".join(rows)


@query(_reconcile_sql())
def rec_report(spark, sf):
    """All five subjects of the star of events, whose facts have lost the errors in the mart."""
    raw = event_raw(spark, sf)
    marts = dict(build_star(raw).tables)
    marts["fct_observations"] = marts["fct_observations"].filter("indicator_id <> 5")
    return R.reconcile(spark, raw, build_staging(raw), marts).select(*REPORT)


@query(
    """select case when abs(count(*) - count(nullif(l_quantity, 1))) / cast(count(*) as double) * 100 > 0.1
                     or count(*) > count(distinct l_orderkey * 8 + l_linenumber) then 'fail' else 'pass' end overall
       from lineitem"""
)
def rec_overall(spark, sf):
    return R.overall(C.union_checks(spark, R.subject_checks(OBSERVATIONS, _sales_layers(spark, sf), R.TOLERANCE_PCT)))


# --- health ----------------------------------------------------------------------------------------------


@query(
    """select 'lineitem' t, count(*) n from lineitem union all select 'part', count(*) from part
       union all select 'documents', count(*) from documents"""
)
def health_volumes(spark, sf):
    return volumes({t: table(spark, sf, t) for t in ("lineitem", "part", "documents")}, "t")


@query(
    """select 'doc_id' fk, count(*) orphans from documents d left join labels l on d.doc_id = l.doc_id where l.doc_id is null
       union all
       select 'l_partkey', count(*) from lineitem left join part on nullif(l_partkey, 0) = p_partkey where p_partkey is null"""
)
def health_orphans(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("l_partkey", F.nullif(F.col("l_partkey"), F.lit(0).cast("long")))
    documents = H.orphan_counts(table(spark, sf, "documents"), [("doc_id", table(spark, sf, "labels"), "doc_id")])
    return documents.unionByName(H.orphan_counts(lines, [("l_partkey", table(spark, sf, "part"), "p_partkey")]))


@query(
    " union all ".join(
        [
            _row("mart", "fct_observations", "orphans", "indicator_id", "'pass'", "0"),
            _row("mart", "fct_observations", "orphans", "location_id", "'pass'", "0"),
            _row("mart", "fct_observations", "orphans", "period_id", _zero("count(*)"), "count(*)")
            + f" from lineitem where l_quantity <> 1 and {_YEAR} = 1995",
            _row("mart", "fct_observations", "orphans", "sex_id", "'pass'", "0"),
        ]
    )
)
def health_references(spark, sf):
    """Facts of the year that staging dropped have lost their period."""
    return H.reference_checks(spark, _sales_marts(spark, sf)).select(*REPORT)


@query(
    f"""select case when count(*) > 0 then 'violations' else 'ok' end overall
        from lineitem where l_quantity <> 1 and {_YEAR} = 1995"""
)
def health_overall(spark, sf):
    raw = sales_raw(spark, sf, dirty=True)
    marts = build_star(raw).tables
    report = H.volume_checks(spark, "raw", list(raw), raw).unionByName(H.volume_checks(spark, "mart", list(marts), marts))
    return H.health_overall(report.unionByName(H.reference_checks(spark, marts)))


# --- differences by row, and runs over time ----------------------------------------------------------------


@query(
    """select o_orderkey, 'changed' status, 'o_orderpriority,o_totalprice' columns from orders where o_orderkey between 500 and 900 and o_orderkey % 7 = 0
       union all select o_orderkey, 'changed', 'o_totalprice' from orders where o_orderkey between 500 and 900 and o_orderkey % 7 = 1
       union all select o_orderkey, 'missing', '' from orders where o_orderkey between 500 and 900 and o_orderkey % 7 = 2
       union all select o_orderkey + 1000000000, 'surplus', '' from orders where o_orderkey between 500 and 900 and o_orderkey % 7 = 3"""
)
def rec_diff(spark, sf):
    """Orders against a copy that went wrong in one stretch of keys: changed, missing and surplus ids, and what changed."""
    orders = table(spark, sf, "orders")
    rest = F.when(F.col("o_orderkey").between(500, 900), F.col("o_orderkey") % 7)
    copy = orders.withColumn("rest", rest).filter("rest is null or rest <> 2")
    priority = F.when(F.col("rest") == 0, F.lit(None)).otherwise(F.col("o_orderpriority"))
    price = F.when(F.col("rest").isin(0, 1), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    copy = copy.withColumns({"o_orderpriority": priority, "o_totalprice": price})
    added = copy.filter("rest = 3").withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000)
    found = D.diff_rows(orders, copy.unionByName(added).drop("rest"), "o_orderkey")
    return found.withColumn("columns", F.array_join(F.array_sort("columns"), ","))


def _daily_runs(spark, sf):
    """A history of daily row counts per event type, in which most clicks of one day and all signups after the 22nd are lost."""
    day, kind = F.to_date("ts"), F.col("event_type")
    lost = ((kind == "click") & (day == "2024-01-20") & (F.col("event_id") % 10 > 0)) | ((kind == "signup") & (day > "2024-01-22"))
    counts = table(spark, sf, "events").filter(~lost).groupBy(day.cast("timestamp_ntz").alias("run_at"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    text = lambda value: F.lit(value).cast("string")
    report = counts.select(
        *[F.lit(v).alias(n) for n, v in (("layer", "raw"), ("check", "exists"), ("status", "pass"))],
        F.col("event_type").alias("table"), text(None).alias("column"), text(None).alias("detail"),
        F.col("n").cast("double").alias("observed"), *[F.lit(None).cast("double").alias(c) for c in ("expected_min", "expected_max")], "run_at",
    )
    path = scratch(spark, "runs")
    for part in ("run_at < '2024-01-16'", "run_at >= '2024-01-16'"):
        Y.append_run(report.filter(part), path, F.col("run_at"))
    return Y.read_history(spark, path)


_RUNS = """with runs as (select event_type, cast(ts as date) d, count(*) n from events
           where not (event_type = 'click' and cast(ts as date) = '2024-01-20' and event_id % 10 > 0)
             and not (event_type = 'signup' and cast(ts as date) > '2024-01-22') group by 1, 2)"""


@query(
    f"""{_RUNS}, placed as (select *, row_number() over (partition by event_type order by d) i from runs),
            seen as (select p.event_type, p.d, p.i, any_value(p.n) n, count(q.n) n_before, median(q.n) m from placed p
                     left join placed q on q.event_type = p.event_type and q.i between p.i - 14 and p.i - 1 group by 1, 2, 3),
            far as (select s.event_type, s.d, any_value(s.n) n, any_value(n_before) n_before, any_value(m) m, median(abs(q.n - m)) away from seen s
                    left join placed q on q.event_type = s.event_type and q.i between s.i - 14 and s.i - 1 group by 1, 2),
            band as (select *, greatest(1.4826 * away, 0.05 * abs(m)) spread from far)
        select event_type "table", cast(d as varchar) run_day, cast(n as double) observed, n_before, m as "median",
               round(m - 5 * spread, 6) low, round(m + 5 * spread, 6) high,
               case when n_before < 5 then 'new' when n < m - 5 * spread or n > m + 5 * spread then 'fail' else 'pass' end status,
               case when n_before >= 5 then case when n < m - 5 * spread then 'drop' when n > m + 5 * spread then 'surge' end end detail
        from band"""
)
def health_volume_anomalies(spark, sf):
    judged = Y.volume_anomalies(_daily_runs(spark, sf))
    told = [F.round(c, 6).alias(c) for c in ("low", "high")]
    return judged.select("table", F.col("run_at").cast("date").cast("string").alias("run_day"), "observed", F.col("n_before").cast("long").alias("n_before"), "median", *told, "status", "detail")


@query(
    f"""{_RUNS}, gaps as (select event_type, d, d - lag(d) over (partition by event_type order by d) gap,
                                 row_number() over (partition by event_type order by d desc) i from runs),
            usual as (select event_type, max(d) last_day, median(gap) m, count(gap) n from gaps where i <= 14 group by 1),
            far as (select u.event_type, any_value(last_day) last_day, any_value(m) m, any_value(n) n, median(abs(gap - m)) away
                    from usual u join gaps g on g.event_type = u.event_type and i <= 14 group by 1),
            aged as (select *, (select max(d) from runs) - last_day age, m + 5 * greatest(1.4826 * away, 0.5 * m) most from far)
        select event_type "table", cast(last_day as varchar) last_day, cast(age as double) age, round(most, 6) "limit",
               case when n < 5 then 'new' when age > most then 'fail' else 'pass' end status from aged"""
)
def health_stale_tables(spark, sf):
    found = Y.stale_tables(_daily_runs(spark, sf))
    day = F.col("last_change").cast("date").cast("string").alias("last_day")
    return found.select("table", day, "age", F.round("limit", 6).alias("limit"), "status")
