"""Loading landed files into the raw tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.dml import UNIT, assign_ids, enrich, fresh_unit, insert_with_ids, load_facts, resolve_ids, upsert
from starloom.operators.ingest import indicators_in, rejects_of, typed_observations, valid_observations
from starloom.schemas import RAW_DDL, SEX_ROWS, stored_schema
from starloom.session import materialise
from starloom.sinks.commits import Overtaken, Snapshot, commit_upsert, read_commit, reserve_ids, snapshot
from starloom.sources.tables import literal_rows


def empty_raw(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], stored_schema(name)) for name in RAW_DDL}


POSITION = "position"


def _ordered_by(df: DataFrame) -> list[str]:
    """The column that tells where rows stood in their file, if the reader was asked for it."""
    return [POSITION] if POSITION in df.columns else []


def load_dimensions(raw: Mapping[str, DataFrame], categorized: DataFrame) -> dict[str, DataFrame]:
    """Add the indicators of a categorized list and the sexes; codes already known stay as they are.

    Of a code that is listed more than once the first row counts, if the list was read with ``position="position"``.
    """
    order = _ordered_by(categorized)
    indicators = categorized.select(
        F.col("IndicatorCode").alias("indicator_code"),
        F.col("IndicatorName").alias("indicator_name"),
        F.col("Category").alias("category"),
        *order,
    )
    sexes = literal_rows(categorized.sparkSession, SEX_ROWS, "sex_code STRING, sex_name STRING")
    return dict(raw) | {
        "dim_indicators": insert_with_ids(
            raw["dim_indicators"], indicators, "indicator_code", "indicator_id", order
        ).drop(*order),
        "dim_sex": insert_with_ids(raw["dim_sex"], sexes, "sex_code", "sex_id"),
    }


# What a folder name cannot hold, beside what it would end at.
_UNSAFE = re.compile(r"[\x00-\x1f\x7f\"#%'*/:=?\\{}\[\]^]")


def _keep_rejects(rejected: DataFrame, folder: str, unit: str) -> None:
    """As Parquet, one subfolder per unit; those of a unit that is loaded again replace what it had."""
    name = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", unit)
    rejected.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{UNIT}={name}")


def load_observations(
    raw: Mapping[str, DataFrame],
    items: DataFrame,
    category: str | None = None,
    unit: str | None = None,
    rejects: str | None = None,
) -> dict[str, DataFrame]:
    """Add observation items to the facts, and the places, years and sexes they bring to the dimensions.

    Only items of known indicators are taken, of one ``category`` if given. Every lookup is one join for all
    rows. ``unit`` names what is loaded, such as a landing: loading the same unit again changes nothing, another unit only
    adds. A load without a unit is one of its own, so its facts and its rejects come in addition to all there are.
    Items that cannot be loaded are added as Parquet under the folder ``rejects``, one subfolder per unit.
    """
    unit = unit or fresh_unit()
    dims, loaded = _load(raw, items, category, unit, rejects)
    known = raw["fact_observations"]
    if UNIT not in known.columns or known.filter(F.col(UNIT) == unit).isEmpty():
        facts = known.unionByName(loaded, allowMissingColumns=True)
    else:
        facts = upsert(known, loaded, ["observation_id"])
    return dict(raw) | dims | {"fact_observations": facts}


def _load(
    raw: Mapping[str, DataFrame],
    items: DataFrame,
    category: str | None,
    unit: str,
    rejects: str | None,
    reserve: Callable[[int], int] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The dimensions with what the items bring, and the facts that are new or corrected."""
    typed = materialise(typed_observations(items), "typed")
    if rejects is not None:
        _keep_rejects(rejects_of(typed, raw["dim_indicators"]), rejects, unit)
    indicators = raw["dim_indicators"] if category is None else indicators_in(raw["dim_indicators"], category)
    wanted = indicators.select("indicator_id", "indicator_code")
    valid = valid_observations(typed).join(wanted, "indicator_code")
    # One pass over the items for the codes of all three dimensions.
    codes = materialise(valid.select("country_code", "year", "sex_code").distinct(), "codes")
    named = {"dim_locations": ("country_code", "location_id"), "dim_periods": ("year", "period_id"), "dim_sex": ("sex_code", "sex_id")}
    dims, keyed = {}, valid
    for name, (code, id_) in named.items():
        after = assign_ids(codes.select(code).distinct(), raw[name], code, id_)
        dims[name] = after if after is raw[name] else materialise(after, name)
        keyed = resolve_ids(keyed, dims[name], code, id_)
    loaded = load_facts(keyed.withColumn(UNIT, F.lit(unit)), raw["fact_observations"], reserve=reserve, unit=unit)
    return dims, materialise(loaded, "loaded")


FACTS = "fact_observations"
DIMENSIONS = {"dim_indicators": "indicator_id", "dim_locations": "location_id", "dim_periods": "period_id", "dim_sex": "sex_id"}


def stored_raw(spark: SparkSession, base: str, unit: str | None = None) -> tuple[dict[str, DataFrame], dict[str, Snapshot]]:
    """The raw tables under ``base`` and the commits they come from; of the facts those of one ``unit`` if given."""
    seen = {name: snapshot(spark, f"{base}/{name}") for name in RAW_DDL}
    raw = {
        name: empty_raw(spark)[name]
        if not at.number
        else read_commit(spark, f"{base}/{name}", at, [unit] if unit is not None and name == FACTS else None)
        for name, at in seen.items()
    }
    return raw, seen


def store_dimensions(spark: SparkSession, base: str, categorized: DataFrame, tries: int = 5) -> None:
    """:func:`load_dimensions` into the tables under ``base``."""

    def once() -> None:
        raw, seen = stored_raw(spark, base)
        _commit_dimensions(base, raw, load_dimensions(raw, categorized), seen)

    _until_first(once, tries)


def store_observations(
    spark: SparkSession,
    base: str,
    items: DataFrame,
    category: str | None = None,
    unit: str | None = None,
    rejects: str | None = None,
    tries: int = 5,
) -> str:
    """:func:`load_observations` into the tables under ``base``; returns the unit.

    Facts are partitioned by unit, so a load reads and writes those of its own unit and no others, and its cost goes with the
    batch. Ids of facts are reserved, and a dimension that another load changed meanwhile is read again: loads that
    run at once get distinct ids and lose nothing.
    """
    unit = unit or fresh_unit()

    def once() -> DataFrame:
        raw, seen = stored_raw(spark, base, unit)
        dims, loaded = _load(raw, items, category, unit, rejects, lambda n: reserve_ids(spark, f"{base}/_ids", n))
        _commit_dimensions(base, raw, dims, seen)
        return loaded

    loaded = _until_first(once, tries)
    if not loaded.isEmpty():
        # Other loads add other units: what was computed stays right, whichever commit comes first.
        _until_first(lambda: commit_upsert(loaded, f"{base}/{FACTS}", ["observation_id"], UNIT, rows_move=False, written=True), tries)
    return unit


def _commit_dimensions(base: str, raw: Mapping[str, DataFrame], after: Mapping[str, DataFrame], seen: Mapping[str, Snapshot]) -> None:
    for name, id_ in DIMENSIONS.items():
        if name not in after or after[name] is raw[name]:
            continue
        added = after[name].join(raw[name].select(id_), id_, "left_anti").select(*after[name].columns)
        if not added.isEmpty():
            commit_upsert(added, f"{base}/{name}", [id_], at=seen[name])


def _until_first(attempt: Callable, tries: int):
    for left in reversed(range(tries)):
        try:
            return attempt()
        except Overtaken:
            if not left:
                raise


def enrich_locations(raw: Mapping[str, DataFrame], lookup: DataFrame) -> dict[str, DataFrame]:
    """Fill missing country names from a list with the columns ``ISO3166-1-Alpha-3`` and ``official_name_en``.

    Of a code that is listed more than once the last row counts, if the list was read with ``position="position"``.
    """
    order = _ordered_by(lookup)
    names = lookup.select(
        F.col("ISO3166-1-Alpha-3").alias("country_code"), F.col("official_name_en").alias("official"), *order
    )
    last = F.col(POSITION) if order else None
    filled = enrich(raw["dim_locations"], names, "country_code", "country_name", "official", last)
    return dict(raw) | {"dim_locations": filled}
