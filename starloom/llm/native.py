"""Column expressions shared by the operators that stay in DataFrame functions."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that separate words, space and tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body, or a lambda in it, uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words between runs of white space; none for null."""
    trimmed = F.btrim(text, F.lit(SPACES))
    empty = F.array().cast("array<string>")
    return F.when(trimmed != "", F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(empty)


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case and every other character as it is.

    ``lower`` is fast and says the same unless the text has other capitals, which takes bytes beyond ASCII.
    """
    other = (F.octet_length(text) > F.length(text)) & text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]")
    plain = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(other, plain).otherwise(F.lower(text))


def gram_hashes(hashes: Column, k: int) -> Column:
    """Hashes of the runs of ``k`` neighbours; none if there are fewer than ``k``."""
    return let(
        hashes,
        lambda h: F.transform(
            F.slice(h, F.lit(1), F.greatest(F.size(h) - (k - 1), F.lit(0))),
            lambda first, i: F.xxhash64(first, *[F.get(h, i + j) for j in range(1, k)]),
        ),
    )


def covered(starts: Column, length: int) -> Column:
    """How many places the runs of ``length`` that begin at the sorted ``starts`` cover together."""
    begin = F.struct(F.lit(-length).alias("last"), F.lit(0).cast("long").alias("total"))
    step = lambda acc, p: F.struct(
        p.alias("last"), (acc["total"] + F.least(F.lit(length), p - acc["last"])).cast("long").alias("total")
    )
    return F.aggregate(starts, begin, step, lambda acc: acc["total"])

