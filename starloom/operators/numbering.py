"""Numbering rows in order without sending a table, or one large group, through a single task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import materialise

SLICE, ROW = "__slice", "__row_in_slice"
_GROUP = "__group"
# Fixed value: monotonically_increasing_id keeps the partition above this bit and the row below it.
_ROW_BITS = 33


def sorted_slices(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` sorted into slices, with each row's slice and its place there.

    The range partitioning cuts by the values of ``order``, so a group of rows that agree in its first
    columns is spread over as many slices as its size asks for. ``order`` has to tell all rows apart. The
    result is written out: slice and place have to stay the same in every use, and across retries.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    numbered = ranged.withColumn("__mono", F.monotonically_increasing_id())
    placed = numbered.select(
        *df.columns,
        F.shiftright("__mono", _ROW_BITS).alias(SLICE),
        F.col("__mono").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(ROW),
    )
    return materialise(placed, "slices")


def place_within(slices: DataFrame, first: int = 1, **outs: list[str]) -> DataFrame:
    """Consecutive numbers from ``first`` within each group of equal keys; each of ``outs`` names a column and
    its keys, which lead the order of the slices. No keys means the whole table.

    A group runs through consecutive slices. One row per group and slice tells how many of its rows lie in
    earlier slices; adding that to the place in the slice needs no group in one piece.
    """
    placed = slices
    for out, keys in outs.items():
        group = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0))
        earlier = Window.partitionBy(_GROUP).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("__n").over(earlier), F.lit(0))
        shifts = (
            slices.groupBy(group.alias(_GROUP), SLICE)
            .agg(F.min(ROW).alias("__begin"), F.count(F.lit(1)).alias("__n"))
            .select(_GROUP, SLICE, (before - F.col("__begin")).alias("__shift"))
        )
        if not keys:
            # One row per slice, so never more than there are shuffle partitions.
            shifts = F.broadcast(shifts)
        joined = placed.withColumn(_GROUP, group).join(shifts, [_GROUP, SLICE])
        placed = joined.select(*placed.columns, (F.col("__shift") + F.col(ROW) + first).alias(out))
    return placed


def dense_ids(df: DataFrame, order: list[str], out: str, first: int = 1) -> DataFrame:
    """Consecutive numbers over the whole table in the given order, which has to be unique per row."""
    return place_within(sorted_slices(df, order), first, **{out: []}).drop(SLICE, ROW)


def repeat_rows(df: DataFrame, times: str, index: str, block: int = 100_000) -> DataFrame:
    """Each row ``times`` times, numbered from 0 in ``index``.

    A row to be repeated very often is first cut into blocks, which are then spread over the tasks.
    """
    columns = df.columns
    begins = F.sequence(F.lit(0).cast("long"), F.col(times) - 1, F.lit(block).cast("long"))
    blocks = df.withColumn("__from", F.explode(begins)).repartition(*[F.col(c) for c in columns], F.col("__from"))
    last = F.least(F.col("__from") + F.lit(block), F.col(times)) - 1
    return blocks.select(*columns, F.explode(F.sequence(F.col("__from"), last)).alias(index))
