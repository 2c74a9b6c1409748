"""The seed star and helpers that several test modules share."""

from starloom.schemas import raw_schema

# The seed star: 3 indicators, 3 locations, 5 years, 3 sexes, 10 facts.
SEED = {
    "dim_indicators": [
        (1, "NCDMORT3070", "Mortality rate 30-70", "NCD"),
        (2, "NCDMORT2060", "Mortality rate 20-60", "NCD"),
        (3, "AIR_1", "Air pollution indicator", "AIR"),
    ],
    "dim_locations": [
        (1, "BRA", "Brazil", "AMR"),
        (2, "USA", "United States", "AMR"),
        (3, "GBR", "United Kingdom", "EUR"),
    ],
    "dim_periods": [(1, 2000), (2, 2005), (3, 2010), (4, 2015), (5, 2020)],
    "dim_sex": [(1, "MLE", "Male"), (2, "FMLE", "Female"), (3, "BTSX", "Both sexes")],
    "fact_observations": [
        (1, 1, 1, 1, 1, 250.5),
        (2, 1, 1, 1, 2, 180.3),
        (3, 1, 2, 2, 3, 320.1),
        (4, 1, 3, 2, 1, 190.7),
        (5, 2, 2, 3, 2, 150.2),
        (6, 2, 1, 4, 1, 210.0),
        (7, 2, 3, 3, 3, 175.8),
        (8, 3, 1, 5, 1, 45.3),
        (9, 3, 2, 5, 2, 38.9),
        (10, 3, 3, 5, 3, 42.1),
    ],
}


def make_raw(spark, **changes):
    """The seed as raw tables; ``changes`` maps a table to its rows instead of the seed's.

    Declared NOT NULL columns are made nullable, as faulty input is what the checks are for.
    """
    tables = {}
    for name, rows in (SEED | changes).items():
        schema = raw_schema(name)
        for field in schema.fields:
            field.nullable = True
        tables[name] = spark.createDataFrame(rows, schema)
    return tables


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted([tuple(r) for r in picked.collect()], key=repr)
