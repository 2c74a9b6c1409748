"""Table and file schemas as Spark DDL."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw tables. A column without NOT NULL may be empty.
RAW_DDL = {
    "dim_indicators": (
        "indicator_id BIGINT NOT NULL, indicator_code STRING NOT NULL, "
        "indicator_name STRING, category STRING NOT NULL"
    ),
    "dim_locations": (
        "location_id BIGINT NOT NULL, country_code STRING NOT NULL, country_name STRING, region_code STRING"
    ),
    "dim_periods": "period_id BIGINT NOT NULL, year BIGINT NOT NULL",
    "dim_sex": "sex_id BIGINT NOT NULL, sex_code STRING NOT NULL, sex_name STRING",
    "fact_observations": (
        "observation_id BIGINT NOT NULL, indicator_id BIGINT NOT NULL, location_id BIGINT NOT NULL, "
        "period_id BIGINT NOT NULL, sex_id BIGINT, value DOUBLE NOT NULL"
    ),
}

# What loading adds to the facts: the load a fact came with, and its number among facts of equal key.
LOADED_DDL = {"fact_observations": "load_unit STRING, copy_no BIGINT"}

# The mart tables.
MART_DDL = {
    "dim_indicator": (
        "indicator_key STRING NOT NULL, indicator_nk BIGINT NOT NULL, indicator_code STRING NOT NULL, "
        "indicator_name STRING, category STRING NOT NULL"
    ),
    "dim_location": (
        "location_key STRING NOT NULL, location_nk BIGINT NOT NULL, country_code STRING NOT NULL, "
        "country_name STRING, region_code STRING"
    ),
    "dim_period": (
        "period_key STRING NOT NULL, period_nk BIGINT NOT NULL, year BIGINT NOT NULL, "
        "year_label STRING, decade_group STRING"
    ),
    "dim_sex": "sex_key STRING NOT NULL, sex_nk BIGINT NOT NULL, sex_code STRING NOT NULL, sex_name STRING",
    "fct_observations": (
        "observation_id BIGINT NOT NULL, observation_key STRING NOT NULL, "
        "indicator_id BIGINT NOT NULL, indicator_key STRING NOT NULL, "
        "location_id BIGINT NOT NULL, location_key STRING NOT NULL, "
        "period_id BIGINT NOT NULL, period_key STRING NOT NULL, "
        "sex_id BIGINT NOT NULL, sex_key STRING NOT NULL, value DOUBLE NOT NULL"
    ),
}

# Columns that identify a row, marked in the schema metadata.
PRIMARY_KEY = {
    "dim_indicators": "indicator_id",
    "dim_locations": "location_id",
    "dim_periods": "period_id",
    "dim_sex": "sex_id",
    "fact_observations": "observation_id",
}

# The items inside the JSON envelopes. Observation fields stay text so that a bad number is
# rejected on its own instead of spoiling the envelope it came in.
INDICATOR_ITEM = "IndicatorCode STRING, IndicatorName STRING"
DIMENSION_ITEM = "Code STRING, Title STRING"
OBSERVATION_ITEM = "SpatialDim STRING, TimeDim STRING, Dim1 STRING, NumericValue STRING"

# The CSV files.
INDICATORS_CSV = "IndicatorCode STRING, IndicatorName STRING"
CATEGORIZED_CSV = "IndicatorCode STRING, IndicatorName STRING, Category STRING"

# The sexes every load starts from, and the member that stands for "not stated".
SEX_ROWS = [("MLE", "Male"), ("FMLE", "Female"), ("BTSX", "Both sexes")]
UNKNOWN_SEX = (0, "UNK", "Unknown")

CHECK_DDL = (
    "layer STRING, table STRING, check STRING, column STRING, status STRING, observed DOUBLE, "
    "expected_min DOUBLE, expected_max DOUBLE, detail STRING"
)


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def raw_schema(table: str) -> T.StructType:
    """Schema of a raw table, with its key column marked in the field metadata."""
    key = PRIMARY_KEY[table]
    return T.StructType(
        [
            T.StructField(f.name, f.dataType, f.nullable, {"pk": f.name == key})
            for f in struct(RAW_DDL[table]).fields
        ]
    )


def stored_schema(table: str) -> T.StructType:
    """Schema of a raw table as the loads store it."""
    added = struct(LOADED_DDL[table]).fields if table in LOADED_DDL else []
    return T.StructType([*raw_schema(table).fields, *added])
