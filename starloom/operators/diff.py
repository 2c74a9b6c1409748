"""Which rows of two tables differ, without comparing what is equal.

The key columns are read for their bounds, and both tables once to sum up hashes of rows per range of keys. Sums do not depend on the order of rows, and count copies.
Ranges whose sums agree are done with; only those that differ are read again, with the bounds pushed down to the files, and cut
finer, level by level, until they are short. What is left is compared by key.

Only the bounds of ranges that differ come to the driver, never more than ``most``: where more differ, the cutting stops one
level earlier. A table of 10**12 rows with one changed row is read once in whole and then twice or three times in one short range.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGED, MISSING, SURPLUS = "changed", "missing", "surplus"


@dataclass(frozen=True)
class Range:
    """Keys from ``lo`` to ``hi``, both included, with the rows that the larger side has there; NULL keys if ``lo`` is None."""

    lo: int | None
    hi: int | None
    rows: int

    def holds(self, key: str) -> Column:
        return F.col(key).isNull() if self.lo is None else F.col(key).between(self.lo, self.hi)


def row_hash(columns: list[str]) -> Column:
    """A hash that tells NULL from what stands beside it."""
    return F.xxhash64(*[x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def _sum(hashed: Column) -> Column:
    return F.sum(hashed.cast("decimal(20,0)"))


def within(df: DataFrame, key: str, ranges: list[Range] | None) -> DataFrame:
    """The rows in any of the ranges, neighbouring ones merged; all of them for None."""
    if ranges is None:
        return df
    merged: list[Range] = []
    for r in sorted(ranges, key=lambda r: (r.lo is not None, r.lo)):
        if merged and r.lo is not None and merged[-1].hi is not None and merged[-1].hi + 1 == r.lo:
            merged[-1] = Range(merged[-1].lo, r.hi, merged[-1].rows + r.rows)
        else:
            merged.append(r)
    return df.filter(reduce(Column.__or__, [r.holds(key) for r in merged], F.lit(False)))


def _cells(key: str, ranges: list[Range], fanout: int) -> Column:
    """The number of the piece a key lies in, of ``fanout`` equal pieces per range; that of the range for NULL."""
    cell = F.lit(None).cast("long")
    for i, r in enumerate(ranges):
        if r.lo is None:
            place = F.lit(0).cast("long")
        else:
            width = -(-(r.hi - r.lo + 1) // fanout)
            place = F.floor((F.col(key) - F.lit(r.lo)) / F.lit(width)).cast("long") if width > 1 else (F.col(key) - F.lit(r.lo)).cast("long")
        cell = F.when(r.holds(key), F.lit(i * fanout).cast("long") + place).otherwise(cell)
    return cell


def _piece(r: Range, number: int, fanout: int, rows: int) -> Range:
    if r.lo is None:
        return Range(None, None, rows)
    width = -(-(r.hi - r.lo + 1) // fanout)
    return Range(r.lo + number * width, min(r.hi, r.lo + (number + 1) * width - 1), rows)


def _both(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    pick = lambda df, side: df.select(F.col(f"`{key}`").cast("long").alias("k"), row_hash(columns).alias("h"), F.lit(side).alias("left"))
    return pick(left, True).unionByName(pick(right, False))


def differing_ranges(
    left: DataFrame, right: DataFrame, key: str, columns: list[str], fanout: int = 64, leaf: int = 10_000, most: int = 512
) -> list[Range]:
    """The shortest ranges of keys found in which the tables differ; none if they are equal."""
    names = [key, *columns]
    ends = _both(left, right, key, [key]).agg(F.min("k"), F.max("k"), F.count(F.lit(1)), F.count("k")).first()
    ranges = [Range(ends[0], ends[1], ends[2])] if ends[3] else []
    ranges += [Range(None, None, ends[2])] if ends[2] > ends[3] else []
    first = True
    while ranges and (first or any(r.rows > leaf and r.lo is not None and r.lo < r.hi for r in ranges)):
        sides = [within(df.select(*names), key, None if first else ranges) for df in (left, right)]
        both = _both(*sides, key, names).withColumn("cell", _cells("k", ranges, fanout))
        side = lambda kind: (F.count_if(kind), F.coalesce(_sum(F.when(kind, F.col("h"))), F.lit(0)))
        sums = [x.alias(n) for x, n in zip([*side(F.col("left")), *side(~F.col("left"))], ["n1", "s1", "n2", "s2"], strict=True)]
        differ = both.groupBy("cell").agg(*sums).filter("n1 <> n2 or s1 <> s2").select("cell", F.greatest("n1", "n2").alias("n"))
        found = differ.limit(most + 1).collect()
        if len(found) > most:
            break
        ranges = [_piece(ranges[r.cell // fanout], r.cell % fanout, fanout, r.n) for r in found]
        first = False
    return ranges


def diff_rows(
    left: DataFrame, right: DataFrame, key: str, columns: list[str] | None = None, fanout: int = 64, leaf: int = 10_000, most: int = 512
) -> DataFrame:
    """The keys whose rows differ: ``status`` is ``changed``, ``missing`` (only in ``left``) or ``surplus`` (only in ``right``);
    ``columns`` names what changed, and is empty where it is the number of rows.

    The key is a whole number. Several rows of a key are compared as a whole, in any order, and so are all those without a key.
    """
    columns = columns or [c for c in left.columns if c != key]
    ranges = differing_ranges(left, right, key, columns, fanout, leaf, most)

    def folded(df: DataFrame, side: str) -> DataFrame:
        held = within(df.select(F.col(f"`{key}`"), *[F.col(f"`{c}`") for c in columns]), key, ranges)
        sums = F.struct(*[_sum(row_hash([c])).alias(f"c{i}") for i, c in enumerate(columns)])
        return held.groupBy(F.col(f"`{key}`").alias(key)).agg(F.struct(F.count(F.lit(1)).alias("n"), _sum(row_hash(columns)).alias("s"), sums.alias("c")).alias(side))

    one, two = folded(left, "one"), folded(right, "two").withColumnRenamed(key, "__key")
    both = one.join(two, one[key].eqNullSafe(two["__key"]), "full")
    status = F.when(F.col("two").isNull(), MISSING).when(F.col("one").isNull(), SURPLUS)
    status = status.when((F.col("one.n") != F.col("two.n")) | (F.col("one.s") != F.col("two.s")), CHANGED)
    named = [F.when(F.col(f"one.c.c{i}") != F.col(f"two.c.c{i}"), F.lit(c)) for i, c in enumerate(columns)]
    changed = F.when(status == CHANGED, F.array_compact(F.array(*named))).otherwise(F.array().cast("array<string>"))
    return both.select(F.coalesce(key, "__key").alias(key), status.alias("status"), changed.alias("columns")).filter("status is not null")
