"""Column tests that return what violates them, and check rows that sum them up."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.star import orphans
from starloom.schemas import CHECK_DDL, struct
from starloom.session import materialise

PASS, FAIL, ERROR = "pass", "fail", "error"


def _digest(df: DataFrame, column: str) -> Column:
    """What stands for a value in a shuffle: of a text its SHA-256 digest."""
    is_text = dict(df.dtypes)[column] == "string"
    return F.unhex(F.sha2(F.col(column), 256)) if is_text else F.col(column)


def check_unique(df: DataFrame, column: str, out: str = "n") -> DataFrame:
    """Values that occur more than once; NULL is not one of them.

    Digests are counted, and texts are fetched for the repeated digests only, whose list is written out so that its
    size is known to the join.
    """
    digest, n = _digest(df, column), F.count(F.lit(1)).alias(out)
    present = df.filter(F.col(column).isNotNull())
    repeated = present.groupBy(digest.alias("__digest")).agg(n).filter(F.col(out) > 1)
    if dict(df.dtypes)[column] != "string":
        return repeated.withColumnRenamed("__digest", column)
    listed = materialise(repeated, "repeated")
    found = present.select(digest.alias("__digest"), column).join(listed, "__digest")
    return found.groupBy("__digest").agg(F.first(column).alias(column), F.first(out).alias(out)).drop("__digest")


def surplus_groups(df: DataFrame, column: str) -> DataFrame:
    """Sizes ``n`` of the groups of equal values with more than one row.

    Only the sizes are asked for, so long texts travel as their SHA-256 digest.
    """
    sizes = df.filter(F.col(column).isNotNull()).groupBy(_digest(df, column).alias("__digest")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.select("n").filter(F.col("n") > 1)


def null_counts(df: DataFrame, columns: list[str], *more: Column) -> DataFrame:
    """NULLs of the columns as c0, c1, ... and further aggregates, in one row from one pass."""
    return df.agg(*[F.expr(f"count_if(`{c}` is null)").alias(f"c{i}") for i, c in enumerate(columns)], *more)


def check_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Number of NULLs per column, as one row per column."""
    pairs = ", ".join(f"{sql_text(c)}, c{i}" for i, c in enumerate(columns))
    return null_counts(df, list(columns)).selectExpr(f"stack({len(columns)}, {pairs}) as (column, nulls)")


def check_accepted(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the list with their number of rows; NULL passes."""
    return df.filter(~F.col(column).isin(values)).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def check_relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent with their number of rows; a NULL child passes."""
    return orphans(child.filter(F.col(column).isNotNull()), column, parent, parent_column)


def check_same_count(expected: DataFrame, actual: DataFrame, offset: int = 0) -> DataFrame:
    """Both row counts and the verdict, as one row; ``offset`` rows more are expected in ``actual``."""
    sides = [
        df.agg(F.expr(f"count(*) + {plus}").alias("n")).selectExpr(f"'{side}' as side", "n")
        for df, side, plus in ((expected, "expected", offset), (actual, "actual", 0))
    ]
    counts = sides[0].unionByName(sides[1]).agg(
        *[F.expr(f"max(n) filter (where side = '{side}')").alias(f"{side}_rows") for side in ("expected", "actual")]
    )
    return counts.withColumn("status", F.expr(f"if(expected_rows = actual_rows, '{PASS}', '{FAIL}')"))


# --- check rows ------------------------------------------------------------------------------------------


def verdict(ok: Column) -> Column:
    return F.when(ok, PASS).otherwise(FAIL)


def sql_text(value: str | None) -> str:
    """A string as SQL literal."""
    if value is None:
        return "cast(null as string)"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


@dataclass(frozen=True)
class Check:
    """One row of the result schema that all quality operators share.

    ``observed``, ``status`` and ``detail`` are SQL over the aggregate that answers the check. Without a
    status the check passes if the observed value keeps to the bounds.
    """

    layer: str
    table: str
    check: str
    column: str | None = None
    observed: str | None = None
    lo: float | None = None
    hi: float | None = None
    status: str | None = None
    detail: str | None = None

    def sql(self) -> str:
        observed = f"cast({self.observed or 'null'} as double)"
        bounds = [f"{observed} >= {self.lo}"] * (self.lo is not None) + [f"{observed} <= {self.hi}"] * (self.hi is not None)
        status = self.status or f"if({' and '.join(bounds) or 'true'}, '{PASS}', '{FAIL}')"
        fields = [
            sql_text(self.layer),
            sql_text(self.table),
            sql_text(self.check),
            sql_text(self.column),
            status,
            observed,
            f"cast({'null' if self.lo is None else self.lo} as double)",
            f"cast({'null' if self.hi is None else self.hi} as double)",
            f"cast({self.detail or 'null'} as string)",
        ]
        return ", ".join(fields)


def rows_of(df: DataFrame, *checks: Check) -> DataFrame:
    """The check rows that an aggregate of one row answers."""
    names = ", ".join(f"`{f.name}`" for f in struct(CHECK_DDL).fields)
    return df.selectExpr(f"stack({len(checks)}, {', '.join(c.sql() for c in checks)}) as ({names})")


def known_rows(spark: SparkSession, *checks: Check) -> DataFrame:
    """Check rows that follow from metadata alone."""
    return rows_of(spark.range(0, 1, 1, 1), *checks)


def violations(df: DataFrame, layer: str, table: str, check: str, column: str, total: str) -> DataFrame:
    """Turn a list of violations into one check row; none found means pass."""
    found = df.agg(F.expr(f"coalesce({total}, 0)").alias("n"))
    return rows_of(found, Check(layer, table, check, column, "n", hi=0))


def union_checks(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], struct(CHECK_DDL))
    return reduce(DataFrame.unionByName, parts)


def roll_up(checks: DataFrame) -> DataFrame:
    """Verdict per table: anything that did not pass fails it."""
    clean = F.every(F.col("status") == PASS)
    return checks.groupBy("layer", "table").agg(
        verdict(clean).alias("status"),
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("status") != PASS).alias("not_passed"),
    )


def overall(checks: DataFrame) -> DataFrame:
    """One verdict for all checks. No check at all is a failure too."""
    return checks.agg(verdict(F.coalesce(F.every(F.col("status") == PASS), F.lit(False))).alias("overall"))


# --- column tests as data --------------------------------------------------------------------------------

# The tests of the mart columns. A relationship names (parent table, parent column).
MART_TESTS = {
    "dim_indicator": {
        "indicator_key": ["unique", "not_null"],
        "indicator_code": ["unique", "not_null"],
        "category": ["not_null"],
    },
    "dim_location": {
        "location_key": ["unique", "not_null"],
        "country_code": ["unique", "not_null"],
    },
    "dim_period": {
        "period_key": ["unique", "not_null"],
        "year": ["unique", "not_null"],
        "decade_group": [{"accepted_values": ["before_2000", "2000s", "2010s", "2020s"]}],
    },
    "dim_sex": {
        "sex_key": ["unique", "not_null"],
        "sex_code": ["unique", "not_null", {"accepted_values": ["MLE", "FMLE", "BTSX", "UNK"]}],
    },
    "fct_observations": {
        "observation_id": ["unique", "not_null"],
        "observation_key": ["unique", "not_null"],
        "indicator_id": ["not_null"],
        "location_id": ["not_null"],
        "period_id": ["not_null"],
        "sex_id": ["not_null"],
        "value": ["not_null"],
        "indicator_key": [{"relationships": ("dim_indicator", "indicator_key")}],
        "location_key": [{"relationships": ("dim_location", "location_key")}],
        "period_key": [{"relationships": ("dim_period", "period_key")}],
        "sex_key": [{"relationships": ("dim_sex", "sex_key")}],
    },
}

# Staging and mart tables of equal size, with the rows the mart adds.
SAME_COUNTS = [
    ("stg_indicators", "dim_indicator", 0),
    ("stg_locations", "dim_location", 0),
    ("stg_periods", "dim_period", 0),
    ("stg_sex", "dim_sex", 1),
    ("stg_observations", "fct_observations", 0),
]


def column_tests(tables: Mapping[str, DataFrame], tests: dict = MART_TESTS, layer: str = "mart") -> DataFrame:
    """Run column tests; one check row each. The NULL tests of a table share one pass."""
    parts = []
    for table, columns in tests.items():
        df = tables[table]
        required = [c for c, kinds in columns.items() if "not_null" in kinds]
        if required:
            rows = [Check(layer, table, "not_null", c, f"c{i}", hi=0) for i, c in enumerate(required)]
            parts.append(rows_of(null_counts(df, required), *rows))
        for column, kinds in columns.items():
            for kind in kinds:
                if kind == "unique":
                    found, name, total = surplus_groups(df, column), "unique", "count(*)"
                elif isinstance(kind, dict) and "accepted_values" in kind:
                    found, name, total = check_accepted(df, column, kind["accepted_values"]), "accepted_values", "sum(n)"
                elif isinstance(kind, dict) and "relationships" in kind:
                    parent, parent_column = kind["relationships"]
                    found = check_relationship(df, column, tables[parent], parent_column)
                    name, total = "relationships", "sum(n)"
                elif kind == "not_null":
                    continue
                else:
                    raise ValueError(f"unknown column test {kind}")
                parts.append(violations(found, layer, table, name, column, total))
    return union_checks(next(iter(tables.values())).sparkSession, parts)


def count_tests(
    staging: Mapping[str, DataFrame], marts: Mapping[str, DataFrame], pairs: list[tuple[str, str, int]] | None = None
) -> DataFrame:
    """Row count consistency of staging and marts, one check row per pair."""
    parts = []
    for source, table, offset in pairs or SAME_COUNTS:
        counts = check_same_count(staging[source], marts[table], offset)
        row = Check(
            "mart", table, "row_count_match", None, "actual_rows", status="status", detail="concat('expected ', expected_rows)"
        )
        parts.append(rows_of(counts, row))
    return union_checks(next(iter(marts.values())).sparkSession, parts)
