"""Joins and aggregates over a star.

Facts that are counted by one key are first reduced to one row per key, then joined: the reduction starts before the
shuffle, so a key that holds a large share of the facts costs no more than any other. Averages are joined with one dimension
first, where the adaptive skew join divides a large key, and reduced before they meet the others. No side is broadcast by
hint: Spark does so only where the measured size allows it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import materialise

Join = tuple[str, DataFrame, str]


def count_rows(fact: DataFrame, joins: list[Join], by: list[str], out: str = "total") -> DataFrame:
    """Number of facts per ``by`` columns of the joined dimensions; each join is (fact key, dimension, its key)."""
    reduced = fact.groupBy(*[fk for fk, _, _ in joins]).agg(F.count(F.lit(1)).alias("__n"))
    return _join_all(reduced, joins).groupBy(*by).agg(F.sum("__n").alias(out))


def average(fact: DataFrame, value: str, joins: list[Join], by: list[str], out: str = "avg_value") -> DataFrame:
    """Mean of ``value`` per ``by`` columns. Only the first join meets the facts themselves: what comes out is reduced to sums and counts
    per group and remaining keys, and the other joins meet these. So name the join with the most keys first; one with few
    would gather the facts in as few partitions."""
    (fk, dim, nk), *rest = joins
    later = [k for k, _, _ in rest]
    narrow = fact.select(*dict.fromkeys([fk, *later, value]))
    first = narrow.join(dim, narrow[fk] == dim[nk])
    kept = [c for c in dict.fromkeys([*later, *by]) if c in first.columns]
    reduced = first.groupBy(*kept).agg(F.sum(value).alias("__sum"), F.count(value).alias("__n"))
    mean = F.try_divide(F.sum("__sum"), F.sum("__n"))
    return _join_all(reduced, rest).groupBy(*by).agg(mean.alias(out))


def _join_all(df: DataFrame, joins: list[Join]) -> DataFrame:
    return reduce(lambda left, j: left.join(j[1], left[j[0]] == j[1][j[2]]), joins, df)


def top(df: DataFrame, n: int | None, total: str, *ties: str) -> DataFrame:
    """Largest first; equal totals in the order of ``ties``."""
    ordered = df.orderBy(F.desc(total), *ties)
    return ordered if n is None else ordered.limit(n)


def first_with_dimensions(
    fact: DataFrame, order: str, n: int, joins: list[Join], columns: list[str]
) -> DataFrame:
    """The first ``n`` facts with their dimension columns, as a left join of everything would give.

    Left joins drop no fact, so the limit goes first. The ``n`` facts are written out, because every join
    looks at them; each dimension is then narrowed to their keys, and it is this bound of ``n`` that makes
    the broadcast safe.
    """
    needed = {order, *columns, *[fk for fk, _, _ in joins]}
    head = materialise(fact.select(*[c for c in fact.columns if c in needed]).orderBy(order).limit(n), "head")
    out = head
    for fk, dim, nk in joins:
        keys = F.broadcast(head.select(F.col(fk).alias("__key")).distinct())
        found = dim.join(keys, dim[nk] == F.col("__key"), "left_semi")
        out = out.join(found, out[fk] == found[nk], "left")
    return out.select(*columns).orderBy(order).limit(n)


def value_counts(df: DataFrame, column: str, n: int | None = None, out: str = "n") -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(out))
    return top(counts, n, out, column)


def orphans(fact: DataFrame, fk: str, dim: DataFrame, nk: str) -> DataFrame:
    """Facts without a dimension row, one row per key value with its number of facts; a NULL key is one of them.

    Both sides are reduced to one row per key before they meet.
    """
    keys = fact.groupBy(F.col(fk).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col(nk).alias("__nk")).distinct()
    return keys.join(known, F.col("value") == F.col("__nk"), "left_anti")
