"""Counts and averages kept current by what commits changed, without reading the rest of the table.

A report holds one row per group with its number of rows, its number of values and their exact sum, and the commit that it
reflects. To bring it up to date, only partitions whose folder differs between that commit and the newest are read, before and
after: rows that went are subtracted, rows that came are added, and rows that stayed in a rewritten partition cancel out.
So the cost follows the changed partitions and the size of the report, whatever the size of the table and however many commits came
between. Sums are decimals, as those of doubles do not cancel exactly.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.sinks import publish
from starloom.sinks.commits import Snapshot, kept_commits, read_commit, snapshot

SIGN = "__sign"
AS_OF, ROWS, VALUES, SUM = "as_of", "total", "n_values", "sum_value"


def changes(spark: SparkSession, base: str, old: Snapshot, new: Snapshot) -> DataFrame | None:
    """Rows of the partitions that differ between two commits of a table: ``__sign`` 1 for those of ``new``, -1 for those of ``old``.

    None if no partition differs. Rows that stayed in a partition that was rewritten come with both signs. Columns that were added
    later are NULL in older rows.
    """
    parts = []
    for side, other, sign in ((old, new, -1), (new, old, 1)):
        folders = {p: f for p, f in side.folders.items() if other.folders.get(p) != f}
        if folders:
            rows = read_commit(spark, base, replace(side, folders=folders, schema=new.schema))
            parts.append(rows.withColumn(SIGN, F.lit(sign)))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _summed(rows: DataFrame, by: list[str], value: str | None, scale: int) -> DataFrame:
    """Signed sums per group; a value is rounded to ``scale`` digits, and one that does not fit 28 digits, or is no number, raises an error."""
    exact = F.lit(None).cast(f"decimal(28,{scale})") if value is None else F.col(f"`{value}`").cast(f"decimal(28,{scale})")
    return rows.groupBy(*by).agg(
        F.sum(SIGN).cast("long").alias(ROWS),
        F.coalesce(F.sum(F.when(exact.isNotNull(), F.col(SIGN))), F.lit(0)).cast("long").alias(VALUES),
        F.coalesce(F.sum(F.when(F.col(SIGN) > 0, exact).otherwise(-exact)), F.lit(0)).cast(f"decimal(38,{scale})").alias(SUM),
    )


def refresh(spark: SparkSession, base: str, report: str, by: list[str], value: str | None = None, scale: int = 9) -> int:
    """Bring the stored report of the committed table ``base`` up to its newest commit, all or nothing; returns that commit's number.

    The first time, after the report's commit was forgotten, and where the stored report is of other groups, all rows are read.
    A refresh that breaks off leaves the report as it was; run again it reads the same changes. Of two at once one is refused.
    NULL is a group. Groups whose last row has gone are dropped.
    """
    new = snapshot(spark, base)
    stored = publish.current(spark, report) if publish.exists(spark, report) else None
    known = None
    if stored is not None and stored.columns == [*by, ROWS, VALUES, SUM, AS_OF]:
        known = stored.select(AS_OF).first()
    if known is not None and known[0] == new.number:
        return new.number
    kept = known is not None and known[0] in kept_commits(spark, base)
    delta = changes(spark, base, snapshot(spark, base, known[0]) if kept else Snapshot(), new)
    if delta is None and not kept:
        delta = spark.createDataFrame([], new.schema).withColumn(SIGN, F.lit(1)) if new.schema else None
    if delta is None and not kept:
        raise FileNotFoundError(f"no commit under {base}")
    if delta is None:
        rows = stored.drop(AS_OF)
    else:
        rows = _summed(delta, by, value, scale)
        if kept:
            both = stored.drop(AS_OF).unionByName(rows)
            rows = both.groupBy(*by).agg(*[F.sum(c).cast(both.schema[c].dataType).alias(c) for c in (ROWS, VALUES, SUM)])
        rows = rows.filter(F.col(ROWS) != 0)
    publish.publish(rows.withColumn(AS_OF, F.lit(new.number).cast("long")), report)
    return new.number


def read_report(spark: SparkSession, report: str, mean: str = "avg_value") -> DataFrame:
    """The groups of a stored report with rows, values, sum and mean; NULL is the mean, and the sum, of no value."""
    some = F.col(VALUES) > 0
    stored = publish.current(spark, report).drop(AS_OF)
    return stored.withColumn(mean, F.when(some, F.col(SUM).cast("double") / F.col(VALUES))).withColumn(SUM, F.when(some, F.col(SUM)))
