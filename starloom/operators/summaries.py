"""Small summaries that merge: samples per group, leading keys with proof, and distinct counts.

Each is built per task or per batch, stored if wanted, and put together with others of its kind, in any order and with the same
result as over all rows at once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.checks import FAIL, PASS

DRAW = "draw"


def sample_per_group(df: DataFrame, group: str, id_: str, k: int, seed: int = 0) -> DataFrame:
    """``k`` rows of each group (all of a smaller one), drawn by the hash of their id, with that hash as ``draw``.

    The ``k`` smallest hashes are a uniform sample without replacement, and the same for any partitioning of the input. Every task
    keeps ``k`` rows of a group before the shuffle, so that a group of any size moves little. The id has to tell rows apart.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(f"`{id_}`").cast("string")).cast("binary"))
    return merge_samples(df.withColumn(DRAW, draw), group, id_, k)


def merge_samples(samples: DataFrame, group: str, id_: str, k: int) -> DataFrame:
    """One sample from the union of several that were drawn with the same seed: that of all their rows together."""
    place = F.row_number().over(Window.partitionBy(f"`{group}`").orderBy(DRAW, f"`{id_}`"))
    return samples.withColumn("__place", place).filter(F.col("__place") <= k).drop("__place")


# Fixed value: a summary of frequent items with a table of M places errs by at most 3.5 / M of the rows; the table has a third more
# places than counters, and what it leaves out can be off by that much twice.
ERROR_OF_COUNTERS = 2 * 3.5 * 0.75


@dataclass(frozen=True)
class Leading:
    """The leading keys, and whether the summary proved them or all keys had to be counted."""

    rows: DataFrame
    proved: bool


def top_keys(df: DataFrame, key: str, k: int, tracked: int = 10_000) -> Leading:
    """The ``k`` most frequent keys other than NULL with their counts ``n``, ties by key; exact.

    Every task sums its keys up in a summary of at most ``tracked`` counters, and the merged one names candidates, which are
    counted exactly, in a pass that shuffles counts of candidates only. What is no candidate is bounded by the summary's error,
    and by the smallest estimate where there are more candidates than were asked for. If rank ``k`` lies above that bound, the
    candidates are proved to be right; otherwise, as where all keys are about as frequent, all of them are counted.
    """
    held = df.filter(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias(key))
    wanted = min(max(10 * k, 100), tracked)
    found = held.agg(F.expr(f"approx_top_k(`{key}`, {wanted}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    estimates = [(r["item"], r["count"]) for r in found["top"] or []]
    everything = held.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    if not estimates:
        return Leading(everything.orderBy(F.desc("n"), key).limit(k), found["n"] == 0)
    # At most ``wanted`` rows, here and in the counts below.
    candidates = F.broadcast(df.sparkSession.createDataFrame([(x,) for x, _ in estimates], held.schema))
    counted = held.join(candidates, key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    exact = sorted(counted.collect(), key=lambda r: (-r["n"], r[key]))
    others = max(ERROR_OF_COUNTERS / tracked * found["n"], min(n for _, n in estimates) if len(estimates) == wanted else 0)
    no_others = sum(r["n"] for r in exact) == found["n"]
    if no_others or (len(exact) >= k and exact[k - 1]["n"] > others):
        return Leading(df.sparkSession.createDataFrame(exact[:k], counted.schema), True)
    return Leading(everything.orderBy(F.desc("n"), key).limit(k), False)


# Of the size of a sketch: 2**14 registers have a standard error of 0.8 %; five of them are taken as certain.
LOG_REGISTERS, ERROR, CERTAIN = 14, 0.0082, 5


def distinct_sketches(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """A sketch of the distinct values of ``column`` for each group, to be stored beside the data and merged later."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.col(f"`{column}`"), F.lit(LOG_REGISTERS)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: list[str]) -> DataFrame:
    """The sketches of larger groups, from those of smaller ones."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_counts(sketches: DataFrame, by: list[str]) -> DataFrame:
    """About how many distinct values each group has (``n``), without reading the data again."""
    return merge_sketches(sketches, by).withColumn("n", F.hll_sketch_estimate("sketch")).drop("sketch")


def distinct_verdict(sketches: DataFrame, data: DataFrame, column: str, lo: int, hi: int) -> tuple[str, bool]:
    """Whether ``column`` has from ``lo`` to ``hi`` distinct values, and whether ``data`` had to be read to tell.

    The sketches tell where the bounds are further away than their error; only otherwise the values are counted.
    """
    about = distinct_counts(sketches, []).first()
    n = 0 if about is None or about["n"] is None else about["n"]
    off = CERTAIN * ERROR * n
    if lo <= n - off and n + off <= hi:
        return PASS, False
    if n + off < lo or n - off > hi:
        return FAIL, False
    exact = data.agg(F.count_distinct(F.col(f"`{column}`"))).first()[0]
    return (PASS if lo <= exact <= hi else FAIL), True
