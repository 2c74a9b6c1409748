"""Bloom filters of the keys that each folder of a table holds, kept as small tables of bitmaps.

A filter has one block of 32,768 bits for every 1,365 keys of its folder, up to the next power of two, so that a key has at least
24 bits. A key goes to one block by its hash and sets eight bits there: a folder without the key is taken for one that may
hold it about once in 20,000 keys, and one with the key never is missed. Blocks, not folders, are the groups of the
aggregate, so a folder with a great part of all rows is spread like the others.

Asking costs one look-up per key and folder, without a shuffle of the table; reading the keys themselves is left to
the folders that may hold one. With very many keys, hundred thousand and more, most folders may hold one by chance, and little is saved.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 15  # the length of a bitmap of Spark's bitmap functions
BITS_PER_KEY, HASHES = 24, 8


def _places(keys: list[str]) -> list[Column]:
    """Eight places in a block, from two hashes of 60 bits."""
    hashes = [F.xxhash64(F.lit(seed), *keys) for seed in (1, 2)]
    return [F.shiftright(hashes[i // 4], 15 * (i % 4)).bitwiseAND(BITS - 1) for i in range(HASHES)]


def _block(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), *keys), F.col("blocks"))


def build(rows: DataFrame, folder: str, keys: list[str]) -> DataFrame:
    """The filters of ``rows``: a row per ``folder`` and block, with ``blocks``, ``block`` and ``bitmap``. Keys with a NULL are left out."""
    rows = rows.select(F.col(folder).alias("folder"), *keys).na.drop(subset=keys)
    needed = F.greatest(F.count(F.lit(1)) * BITS_PER_KEY / F.lit(BITS), F.lit(1.0))
    blocks = F.pow(F.lit(2.0), F.ceil(F.log2(needed))).cast("long")
    # One row per folder: as many as the commit names, which the driver holds.
    sizes = rows.groupBy("folder").agg(blocks.alias("blocks"))
    set_bits = rows.join(F.broadcast(sizes), "folder").select("folder", "blocks", _block(keys).alias("block"), F.explode(F.array(*_places(keys))).alias("place"))
    return set_bits.groupBy("folder", "blocks", "block").agg(F.bitmap_construct_agg("place").alias("bitmap"))


def _is_set(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bitmap, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, place.bitwiseAND(7).cast("int")) == 1


def may_hold(filters: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """The folders that may hold one of the listed keys; no other folder does."""
    # Numbers of blocks are powers of two, so these are some forty at most.
    sizes = [r[0] for r in filters.select("blocks").distinct().collect()]
    if not sizes:
        return filters.select("folder")
    asked = listed.select(*keys).na.drop().withColumn("blocks", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])))
    names = [f"place_{i}" for i in range(HASHES)]
    probes = asked.select("blocks", _block(keys).alias("block"), *[c.alias(n) for c, n in zip(_places(keys), names, strict=True)])
    hits = probes.join(filters, ["blocks", "block"])
    return hits.filter(reduce(Column.__and__, [_is_set(F.col("bitmap"), F.col(n)) for n in names])).select("folder").distinct()
