"""Mixing sources to target weights by pivotal dependent rounding.

A source of size s and target t is taken t / s times. Each document gets the whole part of that as copies, and the
fraction is rounded by the pivotal method: two fractions meet, and mass, in words, moves at random from one to the
other until one of them is 0 or 1, so that the words taken of both stay what they were. The other goes on to the next
meeting. So a source misses its target by at most half of the one document that is left at the end. Documents meet within blocks of their source and size class; the one fraction a block leaves over meets those of
other blocks, level by level, in a reduction tree until one is left per source. Blocks hold about ``BLOCK`` rows
whatever the size of a source, so a source with most of the rows is spread over as many tasks as it fills.

Random numbers are hashes of ids and a seed, so reruns agree. Rows with the same id, source and size are one unit: the
fractions of all its rows are added up, the whole part of the sum is shared out as one copy more to so many of the rows, and the
rest is rounded like that of a single row. So repeated rows can differ by a copy. Null texts have size 0 and are taken 0 words; a null id is an id of its own, a
null source a source of its own. Further columns pass through.
"""

from __future__ import annotations

from itertools import chain, count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import materialise, temporary
from starloom.operators.numbering import dense_ids, place_within, sorted_slices

BLOCK, MOST = 128, 3
# Doubles carry this much error in a sum of fractions; what is nearer to 0 or 1 counts as whole.
EPSILON = 1e-9


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def cycle_weights(sizes: DataFrame, cycle: int = 3) -> DataFrame:
    """``sizes`` (one row per ``source``) with ``weight`` 1, 2, ... ``cycle``, repeating, in code point order, null last."""
    ordered = sizes.withColumn("is_null", F.col("source").isNull()).withColumn("name", F.coalesce("source", F.lit("")))
    numbered = dense_ids(ordered, ["is_null", "name"], "place", first=0)
    return numbered.withColumn("weight", (F.col("place") % cycle + 1).cast("double")).drop("is_null", "name", "place")


def targets(weighted: DataFrame, most: int = MOST) -> DataFrame:
    """``weighted`` (``source``, ``source_size``, ``weight``) with ``target``: shares of all sizes by weight, at most
    ``most`` times the size, the excess shared again by weight among those below.

    The final shares are ``weight`` times one factor, or the limit where that is lower. The factor rises from
    round to round and each round is one aggregate; only the factor comes to the driver.
    """
    weighted = materialise(weighted, "weights")
    limit = (F.col("source_size") * most).cast("double")
    factor = 0.0
    while True:
        full = limit <= factor * F.col("weight")
        got = weighted.agg(
            F.sum(F.col("source_size").cast("double")).alias("all"),
            F.sum(F.when(full, limit).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not got["all"] or not got["open"]:
            break
        new = (got["all"] - got["fixed"]) / got["open"]
        if new <= factor * (1 + 1e-15):
            break
        factor = new
    return weighted.withColumn("target", F.least(limit, factor * F.col("weight")))


def _uniform(*parts: Column) -> Column:
    """A number from 0 to below 1 that depends on the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0**-53)


def _meet(entries: Column, seed: int) -> Column:
    """Folds the entries (``id``, ``p``) of a block: who is rounded up, and the fraction that is left.

    The mass that moves is counted in words: of two documents, one gains as many words as the other loses. Up and
    down are chosen so that the expected fractions stay as they are.
    """
    entry = "struct<id:struct<doc:string,source:string,size:bigint>,p:double>"
    none = F.lit(None).cast(entry)
    begin = F.struct(none.alias("open"), F.array().cast(f"array<{entry}>").alias("up"))

    def step(acc: Column, new: Column) -> Column:
        old = acc["open"]
        s, t = old["id"]["size"], new["id"]["size"]
        gain = F.least(s * (1 - old["p"]), t * new["p"])
        loss = F.least(s * old["p"], t * (1 - new["p"]))
        moved = F.when(_uniform(F.lit(seed), old["id"], new["id"]) * (gain + loss) < loss, gain).otherwise(-loss)
        after = F.array(
            F.struct(old["id"].alias("id"), (old["p"] + moved / s).alias("p")),
            F.struct(new["id"].alias("id"), (new["p"] - moved / t).alias("p")),
        )
        between = F.filter(after, lambda x: (x["p"] > EPSILON) & (x["p"] < 1 - EPSILON))
        risen = F.filter(after, lambda x: x["p"] >= 1 - EPSILON)
        met = F.struct(F.get(between, F.lit(0)).cast(entry).alias("open"), F.concat(acc["up"], risen.cast(f"array<{entry}>")).alias("up"))
        first = F.struct(new.cast(entry).alias("open"), acc["up"].alias("up"))
        return F.when(old.isNull(), first).otherwise(met)

    return F.aggregate(entries, begin, step)


def _level(open_: DataFrame, keys: list[str], seed: int, block: int) -> DataFrame:
    """One level of the tree: (``keys``, ``id``, ``p``) in blocks of about ``block`` rows."""
    counts = materialise(open_.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "counts")
    same = None
    for k in keys:
        same = open_[k].eqNullSafe(counts[k]) if same is None else same & open_[k].eqNullSafe(counts[k])
    blocks = F.ceil(F.col("n") / block)
    place = F.pmod(F.xxhash64(F.lit(seed), F.col("id")), blocks).alias("place")
    dealt = open_.join(counts, same).select(*[open_[k] for k in keys], "id", "p", place)
    order = F.struct(F.col("id.size").alias("size"), F.xxhash64(F.lit(seed), "id").alias("by"), "id", "p")
    blocked = dealt.groupBy(*keys, "place").agg(F.sort_array(F.collect_list(order)).alias("all"))
    entries = F.transform("all", lambda x: F.struct(x["id"].alias("id"), x["p"].alias("p")))
    return materialise(blocked.select(*keys, _meet(entries, seed).alias("met")), "level")


def round_up(units: DataFrame, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """The ``id`` of the ``units`` (``source``, ``id``, ``p`` between 0 and 1) whose fraction becomes 1."""
    exact = units.withColumn("size_class", F.floor(4 * F.log2(F.col("id.size") + 1)))
    open_ = exact.filter((F.col("p") > EPSILON) & (F.col("p") < 1 - EPSILON))
    chosen, keys = None, ["source", "size_class"]
    level = 0
    while True:
        met = _level(open_, keys, seed + level, block)
        up = met.select(F.explode("met.up").alias("u")).select("u.id")
        chosen = up if chosen is None else chosen.unionByName(up)
        open_ = met.filter(F.col("met.open").isNotNull()).select(*keys, F.col("met.open.id").alias("id"), F.col("met.open.p").alias("p"))
        level += 1
        # The most fractions that any group still has; one number.
        most = open_.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if most > 1:
            continue
        if keys == ["source"]:
            break
        # One per source and size class; classes meet next, in the order of size.
        keys, block = ["source"], 1 << 20
        open_ = open_.select("source", "id", "p")
    # One document per source: rounded to the nearest, which keeps the miss below half of its size.
    last = open_.filter(F.col("p") >= 0.5).select("id")
    return chosen.unionByName(last)


def _units(docs: DataFrame, doc: str, source: str, text: str, columns: list[str]) -> DataFrame:
    id_ = F.struct(
        F.col(f"`{doc}`").cast("string").alias("doc"),
        F.col(f"`{source}`").cast("string").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"),
    )
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), id_.alias("id"))


def copies_of(sized: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """From a written table with the struct ``id``: per source ``source_size``, ``target`` and the ``whole`` copies; and the ids
    that get one copy more."""
    with temporary(sized.sparkSession):
        per_source = sized.groupBy(F.col("id.source").alias("source")).agg(F.sum("id.size").alias("source_size"))
        aimed = targets(cycle_weights(materialise(per_source, "sources")))
        ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
        near = F.round(ratio)
        ratio = F.when(F.abs(ratio - near) < EPSILON, near).otherwise(ratio)
        split = [F.floor(ratio).alias("whole"), (ratio - F.floor(ratio)).alias("p")]
        aimed = materialise(aimed.select(F.col("source").alias("of"), "source_size", "target", *split), "targets", lasting=True)
        units = sized.filter(F.col("id.size") > 0).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
        fractions = units.join(aimed, F.col("id.source").eqNullSafe(F.col("of")))
        mass = F.col("n") * F.col("p")
        sure = F.floor(mass + EPSILON)  # rows of the unit that get a copy more in any case
        fractions = fractions.select(F.col("id.source").alias("source"), "id", "n", sure.alias("sure"), F.greatest(mass - sure, F.lit(0.0)).alias("p"))
        up = round_up(fractions.select("source", "id", "p"), seed).select("id", F.lit(1).alias("n"), F.lit(1).cast("long").alias("extra"))
        repeated = fractions.filter("n > 1").select("id", "n", F.col("sure").alias("extra"))
        extra = up.unionByName(repeated).groupBy("id").agg(F.max("n").alias("n"), F.sum("extra").alias("extra"))
        extra = extra.filter("extra > 0").select(F.col("id").alias("chosen"), "n", "extra")
        return aimed, materialise(extra, "chosen", lasting=True)


def _turns(partly: DataFrame) -> DataFrame:
    """Numbers in ``turn`` the rows of each unit, of which only some get a copy more. Equal rows are told apart by a mark, so
    that no unit has to be in one task."""
    content = F.xxhash64(F.to_json(F.struct("row")))
    marked = materialise(partly.select("*", content.alias("content"), F.monotonically_increasing_id().alias("mark")), "marked")
    unit = ["unit_doc", "unit_source", "unit_size"]
    return place_within(sorted_slices(marked, [*unit, "content", "mark"]), turn=unit).select(*partly.columns, "turn")


def _with_copies(sized: DataFrame, aimed: DataFrame, chosen: DataFrame) -> DataFrame:
    unit = [F.col(f"id.{x}").alias(f"unit_{x}") for x in ("doc", "source", "size")]
    placed = sized.select("row", *unit).join(aimed, F.col("unit_source").eqNullSafe(F.col("of")))
    chosen = chosen.select(*[F.col(f"chosen.{x}").alias(f"chosen_{x}") for x in ("doc", "source", "size")], "n", "extra")
    same = (
        F.col("unit_doc").eqNullSafe(F.col("chosen_doc"))
        & F.col("unit_source").eqNullSafe(F.col("chosen_source"))
        & (F.col("unit_size") == F.col("chosen_size"))
    )
    # The chosen grow with the documents, so they are sorted and merged at every size and never broadcast.
    told = placed.join(chosen.hint("merge"), same, "left")
    if chosen.filter("extra < n").isEmpty():
        told = told.withColumn("turn", F.lit(1).cast("long"))
    else:
        some = F.coalesce(F.col("extra") < F.col("n"), F.lit(False))
        told = told.filter(~some).withColumn("turn", F.lit(1).cast("long")).unionByName(_turns(told.filter(some)))
    more = F.coalesce(F.col("turn") <= F.col("extra"), F.lit(False)).cast("int")
    copies = F.when(F.col("unit_size") > 0, F.col("whole") + more).otherwise(F.lit(0))
    return told.select("row", F.col("unit_size").alias("size"), "source_size", "target", copies.cast("long").alias("copies"))


def mix(
    docs: DataFrame, doc: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0, keep: list[str] | None = None
) -> DataFrame:
    """``docs`` as a struct ``row`` (of the columns ``keep``, default all) with ``size``, ``source_size``, ``target``
    and ``copies``."""
    sized = materialise(_units(docs, doc, source, text, docs.columns if keep is None else keep), "sizes")
    return _with_copies(sized, *copies_of(sized, seed))


def copied(docs: DataFrame, doc: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0) -> DataFrame:
    """Each row of ``docs`` as often as the mix takes it, with a further column ``copy`` from 1 (``mix_copy`` where that
    name is taken, then ``mix_copy_2`` and so on; capitals make no other name).

    The sizes are written out without the texts and counted again for the result.
    """
    units = _units(docs, doc, source, text, docs.columns)
    with temporary(docs.sparkSession):
        sized = materialise(units.select("id"), "sizes")
        found = [materialise(x, "mix", lasting=True) for x in copies_of(sized, seed)]
    taken = _with_copies(units, *found).filter(F.col("copies") > 0)
    times = taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    names = chain(["copy", "mix_copy"], (f"mix_copy_{i}" for i in count(2)))
    taken_names = {c.lower() for c in docs.columns}
    return times.select("row.*", F.col("copy").alias(next(n for n in names if n not in taken_names)))
