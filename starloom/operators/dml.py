"""Keyed changes to a table, each expressed as the table after the change."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import is_blank
from starloom.operators.numbering import ROW, SLICE, dense_ids, place_within, repeat_rows, sorted_slices
from starloom.session import materialise

FACT_KEY = ["indicator_id", "location_id", "period_id", "sex_id"]


def distinct_keys(batch: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of a batch, written out.

    Their size is then known before the join is planned, so a short list is broadcast and the large side
    stays where it is. For a long list Spark can divide the partition of a frequent key, which it does only
    if both sides of the join come straight from a shuffle and not from an aggregate.
    """
    return materialise(batch.select(*keys).distinct(), "keys")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Replace the rows whose key is in the batch, append the others, delete nothing.

    NULL keys never match. Columns only one side has are kept and are NULL for the other side's rows.
    """
    return replace_keys(target, batch, distinct_keys(batch, keys))


def replace_keys(target: DataFrame, batch: DataFrame, listed: DataFrame) -> DataFrame:
    """The rows of ``target`` without the listed keys, and the batch."""
    kept = target.join(listed, listed.columns, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def latest_per_key(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """The row with the greatest ``by`` for each key; equal ones are told apart by their other columns.

    An aggregate rather than a ranking, so that copies of one key are reduced before the shuffle. Rows with a NULL in
    their key are no copies of each other and are all kept.
    """
    rest = [c for c in df.columns if c not in keys]
    packed = F.max(F.struct(F.col(by).alias("__by"), *rest)).alias("__row")
    latest = df.filter(~any_null(keys)).groupBy(*keys).agg(packed)
    keyed = latest.select(*[f"__row.{c}" if c in rest else c for c in df.columns])
    return keyed.unionByName(df.filter(any_null(keys)))


def any_null(columns: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def first_per_key(batch: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """The first row of each non-NULL key by the columns ``order``, such as the position in a file.

    Rows that agree there, or without ``order`` all of a key, go by their other columns, smallest first and NULL last.
    """
    rest = [c for c in batch.columns if c != key]
    if not rest:
        return batch.filter(F.col(key).isNotNull()).distinct()
    ranked = [*(order or []), *[c for c in rest if c not in (order or [])]]
    by = F.struct(*[x for c in ranked for x in (F.col(c).isNull(), F.col(c))])
    first = batch.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*rest), by).alias("__row"))
    return first.select(*[c if c == key else f"__row.{c}" for c in batch.columns])


def insert_ignore(target: DataFrame, batch: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """Add the batch rows whose key is new, one per key; rows already there win.

    Rows with a NULL key are all added, as a UNIQUE column allows any number of them.
    """
    new = first_per_key(batch, key, order).join(target.select(key), key, "left_anti").select(*batch.columns)
    keyless = batch.filter(F.col(key).isNull())
    return target.unionByName(new.unionByName(keyless), allowMissingColumns=True)


def insert_with_ids(
    dim: DataFrame, batch: DataFrame, code: str, id_: str, order: list[str] | None = None
) -> DataFrame:
    """:func:`insert_ignore` into a dimension whose new rows take ids after the largest in use, in code order.

    Columns the batch lacks are NULL in its rows. Rows without a code get no id and are left out.
    """
    coded = batch.filter(F.col(code).isNotNull()).withColumn(code, F.col(code).cast(dim.schema[code].dataType))
    added = first_per_key(coded.drop(id_), code, order).join(dim.select(code), code, "left_anti")
    if added.isEmpty():
        return dim
    numbered = dense_ids(added, [code], id_, _largest(dim, id_) + 1)
    return dim.unionByName(
        numbered.withColumn(id_, F.col(id_).cast(dim.schema[id_].dataType)), allowMissingColumns=True
    )


def assign_ids(codes: DataFrame, dim: DataFrame, code: str, id_: str) -> DataFrame:
    """``dim`` with a row added for every code it lacks; other attributes of the new rows are NULL."""
    return insert_with_ids(dim, codes.select(code), code, id_)


def _largest(df: DataFrame, id_: str) -> int:
    return df.agg(F.coalesce(F.max(id_), F.lit(0)).cast("long")).first()[0]


def resolve_ids(df: DataFrame, dim: DataFrame, code: str, id_: str) -> DataFrame:
    """Replace the column ``code`` by the dimension's id; rows without a match keep a NULL id.

    Give the dimension as a stored table, for the reasons told in :func:`distinct_keys`.
    """
    return df.join(dim.select(code, id_), code, "left").drop(code)


UNIT = "load_unit"


def fresh_unit() -> str:
    """A name for a load that was given none, so that nothing it brings can take the place of what another load brought."""
    return f"load-{uuid.uuid4().hex}"


def load_facts(
    observations: DataFrame,
    target: DataFrame | None = None,
    key: list[str] | None = None,
    prune: str = "period_id",
    reserve: Callable[[int], int] | None = None,
    unit: str | None = None,
) -> DataFrame:
    """Observations with their ids, ready to be upserted by ``observation_id``.

    One business key may own several rows; ``copy_no`` numbers them by value. Loads are told apart by the column
    ``load_unit``: unit, key and ``copy_no`` identify a fact. So loading a unit again
    changes nothing, a corrected value replaces the old one wherever the key owns a single row of the unit, and a
    fact that came with another unit is never touched. Without that column a load into a ``target`` is a unit of its own and
    only adds. Known facts keep their id, new ones are numbered on from the largest in use in the order of key and
    ``copy_no``; or from what ``reserve`` answers to their number, where several loads may run at once.

    Of ``target`` only the units and the values of ``prune`` that the batch has are read, which skips partitions where it is
    partitioned so. A unit that is not there yet is numbered without a join, and of one that has not changed nothing is sorted.
    ``unit`` names the only unit of the batch, which then is not looked for in its rows.
    """
    key = key or FACT_KEY
    if UNIT not in observations.columns:
        observations = observations.withColumn(UNIT, F.lit(None if target is None else fresh_unit()).cast("string"))
    full = [*key, UNIT]
    columns = ["observation_id", *key, "copy_no", "value", UNIT]
    # Equal rows are told apart by a count, which also keeps them together until they are spread again.
    same = observations.groupBy(*full, "value").agg(F.count(F.lit(1)).alias("__n"))
    stored = None
    if target is not None:
        target = target if UNIT in target.columns else target.withColumn(UNIT, F.lit(None).cast("string"))
        stored = matching(target, observations, UNIT) if unit is None else target.filter(F.col(UNIT) == unit)
        stored = None if stored.isEmpty() else matching(stored, observations, prune)
    if stored is not None and _unchanged(same, stored, full):
        return observations.sparkSession.createDataFrame([], target.select(*[c for c in columns if c in target.columns]).schema)
    slices = sorted_slices(repeat_rows(same, "__n", "__i").drop("__n"), [*full, "value", "__i"])
    if stored is None:
        first = 1 if target is None and reserve is None else _first_id(slices, target, reserve)
        numbered = place_within(slices, observation_id=[], copy_no=full)
        return numbered.withColumn("observation_id", F.col("observation_id") + (first - 1)).select(*columns)
    rows = place_within(slices, copy_no=full)
    fact = F.struct(*[F.col(c) for c in [*full, "copy_no"]]).alias("__fact")
    ids = stored.select(fact, "observation_id")
    wanted = rows.select(*full, "copy_no", "value", fact)
    matched = materialise(wanted.join(ids, "__fact", "left").drop("__fact"), "facts")
    known = matched.filter(F.col("observation_id").isNotNull())
    new = matched.filter(F.col("observation_id").isNull()).drop("observation_id")
    if new.isEmpty():
        return known.select(*columns)
    first = _first_id(new, target, reserve)
    return known.unionByName(dense_ids(new, [*full, "copy_no"], "observation_id", first)).select(*columns)


def _first_id(new: DataFrame, target: DataFrame | None, reserve: Callable[[int], int] | None) -> int:
    if reserve is not None:
        return reserve(new.count())
    return 1 + (0 if target is None else _largest(target, "observation_id"))


def _unchanged(same: DataFrame, stored: DataFrame, full: list[str]) -> bool:
    """Whether the stored facts of each key in the batch are those of the batch, by a fold of hashes of values and counts."""
    have = stored.groupBy(*full, "value").agg(F.count(F.lit(1)).alias("__n"))
    both = same.withColumn("__new", F.lit(True)).unionByName(have.withColumn("__new", F.lit(False)))
    fold = lambda side: F.bit_xor(F.when(side, F.xxhash64("value", "__n")))
    keys = both.groupBy(*full).agg(fold(F.col("__new")).alias("now"), fold(~F.col("__new")).alias("then"))
    return keys.filter(F.col("now").isNotNull() & ~F.col("now").eqNullSafe(F.col("then"))).isEmpty()


def matching(target: DataFrame, batch: DataFrame, column: str, most: int = 1000) -> DataFrame:
    """The rows of ``target`` with a value of ``column`` that occurs in the batch, as a list the scan can prune by; all of
    them for a column that is not there or has more than ``most`` values in the batch."""
    if column not in target.columns or column not in batch.columns:
        return target
    values = [r[0] for r in batch.select(column).distinct().limit(most + 1).collect()]
    if len(values) > most:
        return target
    known = F.col(column).isin([v for v in values if v is not None])
    return target.filter(known | F.col(column).isNull() if None in values else known)


def with_copy_no(facts: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Facts stored without ``copy_no``, numbered within their business key by value and then by id. Loads write the number,
    so only tables of another origin need this."""
    key = key or FACT_KEY
    slices = sorted_slices(facts, [*key, "value", "observation_id"])
    return place_within(slices, copy_no=key).drop(SLICE, ROW)


def enrich(
    dim: DataFrame, lookup: DataFrame, code: str, name: str, lookup_name: str, order: Column | None = None
) -> DataFrame:
    """Fill blank names from a lookup by code; names that are there, or have no match, stay as they are.

    A code listed more than once counts with its last entry by ``order``, or its greatest name.
    """
    value = F.max(lookup_name) if order is None else F.max_by(lookup_name, order)
    listed = lookup.filter(F.col(code).isNotNull()).groupBy(code).agg(value.alias("__found"))
    found = materialise(listed, "lookup")
    filled = F.when(is_blank(name) & F.col("__found").isNotNull(), F.col("__found")).otherwise(F.col(name))
    return dim.join(found, code, "left").withColumn(name, filled).select(*dim.columns)
