"""Runs of checks over time: volumes out of their band, and tables that have gone stale.

The band of a run is set by the runs before it, by their median and the median distance from it: so one bad run, or a few, neither
shift nor widen it. A run with too few before it is not judged. History is what the JSON Lines reports hold, of one row per
run and check, so windows over it stay small however large the tables are; the runs of one check are one window.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.operators.checks import FAIL, PASS
from starloom.schemas import CHECK_DDL
from starloom.sinks.files import append_report

RUN = "run_at"
SUBJECT = ["layer", "table", "check", "column"]
NEW = "new"  # too few runs to judge by
# Fixed value: what makes the median distance an estimate of the standard deviation of normal values.
TO_SIGMA = 1.4826


def append_run(checks: DataFrame, path: str, at: datetime | Column) -> None:
    """Add the check rows of a run, or of several where ``at`` is a column, to the history."""
    append_report(checks.withColumn(RUN, (F.lit(at) if isinstance(at, datetime) else at).cast("timestamp_ntz")), path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All check rows of a history, with the time of their run. A run that was reported twice counts as its greatest row."""
    rows = spark.read.schema(f"{CHECK_DDL}, {RUN} TIMESTAMP_NTZ").json(path)
    rest = [c for c in rows.columns if c not in (*SUBJECT, RUN)]
    return rows.groupBy(*SUBJECT, RUN).agg(F.max(F.struct(*rest)).alias("row")).select(*SUBJECT, RUN, "row.*")


def _median(values: Column) -> Column:
    """Of an array of numbers without NULL; NULL if it is empty."""

    def middle(ordered: Column) -> Column:
        n = F.size(ordered)
        return (F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))) / 2

    return F.transform(F.array(F.array_sort(values)), middle)[0]


def robust_band(rows: DataFrame, subject: list[str], value: str, order: str, runs: int, floor: float) -> DataFrame:
    """``rows`` with ``n_before``, ``median`` and ``spread`` of ``value`` over the ``runs`` rows before each, of its subject.

    The spread is the median distance from the median, as a standard deviation, and at least the share ``floor`` of the median.
    """
    before = Window.partitionBy(*subject).orderBy(order).rowsBetween(-runs, -1)
    seen = rows.withColumn("__seen", F.collect_list(F.col(value).cast("double")).over(before))
    known = seen.withColumn("n_before", F.size("__seen")).withColumn("median", _median(F.col("__seen")))
    distance = _median(F.transform("__seen", lambda x: F.abs(x - F.col("median"))))
    spread = F.greatest(F.lit(TO_SIGMA) * distance, F.lit(floor) * F.abs("median"))
    return known.withColumn("spread", spread).drop("__seen")


def volume_anomalies(history: DataFrame, runs: int = 14, least: int = 5, width: float = 5.0, floor: float = 0.05) -> DataFrame:
    """Each run of each check with the band of its observed value and a verdict.

    ``fail`` lies more than ``width`` spreads from the median of the ``runs`` before, with ``drop`` or ``surge`` as detail;
    with fewer than ``least`` of them a run is ``new``. Runs that observed nothing are left out.
    """
    held = history.filter(F.col("observed").isNotNull()).select(*SUBJECT, RUN, "observed")
    band = robust_band(held, SUBJECT, "observed", RUN, runs, floor)
    low, high = F.col("median") - width * F.col("spread"), F.col("median") + width * F.col("spread")
    band = band.withColumns({"low": low, "high": high})
    off = F.when(F.col("observed") < F.col("low"), "drop").when(F.col("observed") > F.col("high"), "surge")
    judged = F.when(F.col("n_before") < least, NEW).when(off.isNotNull(), FAIL).otherwise(PASS)
    return band.withColumn("status", judged).withColumn("detail", F.when(judged == FAIL, off))


def stale_tables(
    history: DataFrame,
    now: datetime | None = None,
    runs: int = 14,
    least: int = 5,
    width: float = 5.0,
    floor: float = 0.5,
    grew: Callable[[str], Column] | None = None,
) -> DataFrame:
    """The last change of each check's subject, the days since, and whether they are more than it usually lets pass.

    A run counts as a change if it observed more than nothing; ``grew`` can say otherwise from the column's name. The usual
    gap is the median of the last ``runs`` gaps between changes, the limit ``width`` spreads above, each at least the
    share ``floor`` of the median. ``now`` is the latest run of the whole history unless given.
    """
    changed = (grew or (lambda name: F.col(name) > 0))("observed")
    changes = history.filter(F.coalesce(changed, F.lit(False))).select(*SUBJECT, RUN)
    by_run = Window.partitionBy(*SUBJECT).orderBy(RUN)
    days = (F.unix_micros(F.col(RUN).cast("timestamp")) / 86_400_000_000).alias("__day")
    gaps = changes.select(*SUBJECT, RUN, days).withColumn("gap", F.col("__day") - F.lag("__day").over(by_run))
    recent = F.row_number().over(Window.partitionBy(*SUBJECT).orderBy(F.desc(RUN)))
    last = gaps.withColumn("__recent", recent).filter(F.col("__recent") <= runs)
    known = last.groupBy(*SUBJECT).agg(F.max(RUN).alias("last_change"), F.max("__day").alias("__last"), F.collect_list("gap").alias("__gaps"))
    known = known.withColumn("median_gap", _median(F.col("__gaps")))
    distance = _median(F.transform("__gaps", lambda x: F.abs(x - F.col("median_gap"))))
    spread = F.greatest(TO_SIGMA * distance, F.lit(floor) * F.col("median_gap"))
    latest = history.agg(F.max(RUN)).first()[0] if now is None else now
    today = F.unix_micros(F.lit(latest).cast("timestamp_ntz").cast("timestamp")) / 86_400_000_000
    aged = known.withColumn("age", today - F.col("__last"))
    limit = F.col("median_gap") + width * spread
    judged = F.when(F.size("__gaps") < least, NEW).when(F.col("age") > limit, FAIL).otherwise(PASS)
    return aged.select(*SUBJECT, "last_change", "median_gap", "age", limit.alias("limit"), judged.alias("status"))
