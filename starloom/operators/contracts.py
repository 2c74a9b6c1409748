"""Contracts: the columns, types, size and keys a table has to have."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.checks import ERROR, FAIL, Check, known_rows, null_counts, rows_of, sql_text, union_checks
from starloom.schemas import MART_DDL, RAW_DDL, struct


@dataclass(frozen=True)
class Contract:
    """``ddl`` names the expected columns; NOT NULL marks those without gaps, ``any_type`` those of any type."""

    layer: str
    table: str
    ddl: str
    keys: tuple[str, ...] = ()
    min_rows: int = 1
    max_rows: int = 5_000_000
    any_type: tuple[str, ...] = ()

    def schema(self) -> T.StructType:
        return struct(self.ddl)

    def validate(self, spark: SparkSession, df: DataFrame | None) -> DataFrame:
        """One check row per check, passed or not.

        Row count and NULL counts come from one pass without a shuffle. Each key is counted in a pass of
        its own that reads only the key, so the distinct count does not carry the other metrics along.
        """
        if df is None:
            return known_rows(spark, self._check("table_exists", status=f"'{FAIL}'", detail="'table not found'"))
        keys = [key for key in self.keys if key in df.columns]
        return union_checks(spark, [self._profile(df), *[self._key(df, key) for key in keys]])

    def _check(self, check: str, column: str | None = None, observed: str | None = None, **more) -> Check:
        return Check(self.layer, self.table, check, column, observed, **more)

    def _schema_rows(self, df: DataFrame) -> list[Check]:
        actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        expected = {f.name: f.dataType.simpleString() for f in self.schema().fields}
        missing = [c for c in expected if c not in actual]
        wrong = [
            f"{c}: expected {t}, got {actual[c]}"
            for c, t in expected.items()
            if c in actual and c not in self.any_type and actual[c] != t
        ]
        found = str(len(expected) - len(missing))
        return [
            self._check("columns_exist", None, found, lo=len(expected), detail=sql_text(", ".join(missing) or None)),
            self._check("column_types", None, str(len(wrong)), hi=0, detail=sql_text("; ".join(wrong) or None)),
        ]

    def _profile(self, df: DataFrame) -> DataFrame:
        required = [f.name for f in self.schema().fields if not f.nullable]
        counted = [c for c in required if c in df.columns]
        rows = [
            *self._schema_rows(df),
            self._check("row_count", None, "n", lo=self.min_rows, hi=self.max_rows),
            *[self._check("not_null", c, f"c{i}", hi=0) for i, c in enumerate(counted)],
        ]
        for check, columns in (("not_null", required), ("pk_uniqueness", self.keys)):
            for c in columns:
                if c not in df.columns:
                    rows.append(self._check(check, c, status=f"'{ERROR}'", detail="'column not found'"))
        return rows_of(null_counts(df, counted, F.count(F.lit(1)).alias("n")), *rows)

    def _key(self, df: DataFrame, key: str) -> DataFrame:
        counted = df.agg(F.expr(f"count(*) - count(distinct `{key}`)").alias("surplus"))
        return rows_of(counted, self._check("pk_uniqueness", key, "surplus", hi=0))


# Table, key, smallest and largest number of rows.
_RAW = [
    ("dim_indicators", "indicator_id", 3, 5_000),
    ("dim_locations", "location_id", 3, 300),
    ("dim_periods", "period_id", 1, 100),
    ("dim_sex", "sex_id", 3, 10),
    ("fact_observations", "observation_id", 1, 3_000_000),
]
_MART = [
    ("dim_indicator", "indicator_key", 3, 5_000),
    ("dim_location", "location_key", 3, 300),
    ("dim_period", "period_key", 1, 100),
    ("dim_sex", "sex_key", 4, 10),
    ("fct_observations", "observation_id", 1, 3_000_000),
]

RAW_CONTRACTS = [Contract("raw", t, RAW_DDL[t], (key,), lo, hi) for t, key, lo, hi in _RAW]
MART_CONTRACTS = [Contract("mart", t, MART_DDL[t], (key,), lo, hi) for t, key, lo, hi in _MART]


def validate_all(spark: SparkSession, contracts: list[Contract], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Check rows of all contracts; a table that is not given fails."""
    return union_checks(spark, [c.validate(spark, tables.get(c.table)) for c in contracts])
