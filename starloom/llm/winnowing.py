"""Benchmark decontamination by winnowing.

Of the hashes of all runs of ``K`` words, the smallest in each window of runs is a fingerprint. Two texts that share
``SPAN`` words share a fingerprint inside that span, so joining the fingerprints of documents with those of
the benchmark misses no span of that length. Each hit is then extended: the words around it on both sides are
compared, and the places where ``SPAN`` words agree are kept. Items of fewer than ``SPAN`` words are one window as a
whole; they are looked up by a hash of their length, and only lengths that occur in the benchmark are looked for.

Words are compared as words, never by hash alone. Null and empty texts have no words: never hit, never an item.
Ids may be null (an item without id hits but is not counted or listed) or repeated (each row is judged; a repeated
item id counts once). Further columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.native import ascii_lower, gram_hashes, let
from starloom.llm.tables import materialise, temporary

SPAN, K = 10, 5


def item_words(text: Column) -> Column:
    """Runs of ASCII letters and digits and of characters beyond ASCII, A to Z in lower case."""
    split = F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def inner(parts: Column) -> Column:
        # Only the first and the last part can be empty.
        first = F.when(F.get(parts, F.lit(0)) == "", 2).otherwise(1)
        last = F.size(parts) - F.when(F.get(parts, F.size(parts) - 1) == "", 1).otherwise(0)
        return F.slice(parts, first, F.greatest(last - first + 1, F.lit(0)))

    return let(split, inner)


def _smallest(grams: Column, span: int, k: int, value) -> Column:
    """The least ``value`` (of hash and place) in each window of runs."""
    window = span - k + 1
    return F.transform(
        F.slice(grams, F.lit(1), F.greatest(F.size(grams) - (window - 1), F.lit(0))),
        lambda g, i: F.least(*[value(F.get(grams, i + j), i + j) for j in range(window)]),
    )


def _grams(words: Column, k: int) -> Column:
    return gram_hashes(F.transform(words, lambda w: F.xxhash64(w)), k)


def print_hashes(words: Column, span: int = SPAN, k: int = K) -> Column:
    """The distinct hashes of the winnowed runs; empty for fewer than ``span`` words."""
    return let(_grams(words, k), lambda grams: F.array_distinct(_smallest(grams, span, k, lambda h, p: h)))


def fingerprints(words: Column, span: int = SPAN, k: int = K) -> Column:
    """Hash and place of each winnowed run, neighbouring windows with the same one counted once."""
    placed = let(_grams(words, k), lambda grams: _smallest(grams, span, k, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
    return let(placed, lambda s: F.filter(s, lambda x, i: ~x["p"].eqNullSafe(F.get(s, i - 1)["p"])))


def short_runs(words: Column, length: int) -> Column:
    """Hash and place of every run of ``length`` words."""
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (length - 1), F.lit(0)))
    salted = lambda i: F.xxhash64(F.lit(length), *[F.get(words, i + j) for j in range(length)])
    return F.transform(starts, lambda w, i: F.struct(salted(i).alias("h"), i.alias("p")))


def benchmark_prints(items: DataFrame, item: str, text: str, span: int, k: int) -> DataFrame:
    """One row per distinct fingerprint context of the benchmark: ``h``, the words around it as ``context``, where in the
    context the fingerprint is (``before``), the length of window looked for, and ``windows``: a number per context.

    Items with the same words around a fingerprint share its row; ``item_prints`` lists which items they are.
    """
    worded = items.select(F.col(f"`{item}`").alias("item"), item_words(F.col(f"`{text}`")).alias("words"))
    long = worded.filter(F.size("words") >= span).select("item", "words", F.explode(fingerprints(F.col("words"), span, k)))
    low = F.greatest(F.col("col.p") - (span - k), F.lit(0))
    high = F.least(F.col("col.p") + span, F.size("words"))
    long = long.select(
        "item",
        F.col("col.h").alias("h"),
        F.slice("words", low + 1, high - low).alias("context"),
        (F.col("col.p") - low).alias("before"),
        F.lit(span).alias("length"),
    )
    n = F.size("words")
    short = worded.filter((n > 0) & (n < span))
    hashed = F.lit(None).cast("long")
    for m in range(1, span):
        hashed = F.when(n == m, F.xxhash64(F.lit(m), *[F.get("words", F.lit(j)) for j in range(m)])).otherwise(hashed)
    short = short.select("item", hashed.alias("h"), F.col("words").alias("context"), F.lit(0).alias("before"), n.alias("length"))
    return long.unionByName(short)


def find_hits(
    docs: DataFrame, items: DataFrame, item: str = "item_id", text: str = "text", span: int = SPAN, k: int = K, keep: list[str] | None = None
) -> DataFrame:
    """``docs`` as a struct ``row`` (of the columns ``keep``, default all) with ``n_words``, ``n_hit`` (words inside an occurrence
    of an item's window) and ``items`` (the sorted distinct ids of items with such a window, as strings).
    """
    with temporary(docs.sparkSession):
        worded, judged = _search(docs, items, item, text, span, k, docs.columns if keep is None else keep)
        worded = materialise(worded.select("row", "key", F.col("w.n_words").alias("n_words")), "worded", lasting=True)
    empty = F.array().cast("array<string>")
    return worded.join(judged, "key", "left").select(
        "row", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", empty).alias("items")
    )


def _key(docs: DataFrame, text: str) -> Column:
    """What tells rows apart; rows that agree in all columns share it."""
    return F.struct(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("a"), F.hash(f"`{text}`").alias("b"))


def _search(docs: DataFrame, items: DataFrame, item: str, text: str, span: int, k: int, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """A written table of ``row``, ``key`` and counts for all rows, and a lasting one of ``key``, ``n_hit`` and ``items`` for those near the
    benchmark."""
    prints = materialise(benchmark_prints(items, item, text, span, k), "prints")
    contexts = materialise(prints.groupBy("h", "context", "before", "length").agg(F.min(F.lit(1)).alias("one")).drop("one"), "contexts")
    # At most span - 1 lengths.
    lengths = sorted(r["length"] for r in contexts.filter(F.col("length") < span).select("length").distinct().collect())

    keyed = docs.select(F.struct("*").alias("row"), _key(docs, text).alias("key"), F.col(f"`{text}`").alias("text"))

    # First the hashes alone, for all documents; then places and words, for those with a hash of the benchmark.
    def hashes(words: Column) -> Column:
        short = [F.transform(short_runs(words, m), lambda x: x["h"]) for m in lengths]
        found = F.flatten(F.array(print_hashes(words, span, k), *short))
        return F.struct(F.size(words).cast("long").alias("n_words"), found.alias("prints"))

    worded = keyed.select((F.struct(*[f"row.`{c}`" for c in keep]) if keep else F.lit(True)).alias("row"), "key", let(item_words(F.col("text")), hashes).alias("w"))
    worded = materialise(worded, "words")
    asked = worded.select("key", F.explode("w.prints").alias("h"))
    touched = materialise(asked.join(contexts.select("h").distinct(), "h", "left_semi").select("key").distinct(), "touched")
    near = materialise(keyed.select("key", "text").join(touched, "key", "left_semi").dropDuplicates(["key"]), "near")

    def marks(words: Column) -> Column:
        return F.flatten(F.array(fingerprints(words, span, k), *[short_runs(words, m) for m in lengths]))

    marked = near.select("key", F.explode(let(item_words(F.col("text")), marks)).alias("m"))
    hits = marked.select("key", F.col("m.h").alias("h"), F.col("m.p").alias("p")).join(contexts, "h")
    by_doc = materialise(hits, "hits").groupBy("key").agg(
        F.collect_list(F.struct("p", "h", "context", "before", "length")).alias("hits")
    )

    joined = near.join(by_doc, "key").withColumn("words", item_words(F.col("text")))
    checked = F.transform(
        "hits",
        lambda x: F.struct(
            x["h"].alias("h"), x["context"].alias("context"), x["before"].alias("before"), x["length"].alias("length"),
            F.filter(
                F.transform(
                    F.sequence(F.lit(0), F.greatest(F.size(x["context"]) - x["length"], F.lit(0))),
                    lambda o: F.when(
                        (x["p"] - x["before"] + o >= 0)
                        & (F.slice(F.col("words"), F.greatest(x["p"] - x["before"] + o, F.lit(0)) + 1, x["length"])
                           == F.slice(x["context"], o + 1, x["length"])),
                        x["p"] - x["before"] + o,
                    ),
                ),
                lambda s: s.isNotNull(),
            ).alias("starts"),
        ),
    )
    found = F.filter(checked, lambda x: F.size(x["starts"]) > 0)
    placed = joined.select("key", F.size("words").alias("n"), found.alias("found"))
    placed = materialise(placed, "found")

    spans = F.sort_array(
        F.flatten(F.transform("found", lambda x: F.transform(x["starts"], lambda s: F.struct(s.alias("s"), (s + x["length"]).alias("e")))))
    )
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))
    union = F.aggregate(
        spans,
        begin,
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["e"]).alias("end"),
            (acc["total"] + F.greatest(x["e"] - F.greatest(acc["end"], x["s"]), F.lit(0))).cast("long").alias("total"),
        ),
        lambda acc: acc["total"],
    )
    which = placed.filter(F.size("found") > 0).select("key", F.explode("found").alias("f"))
    which = which.select("key", "f.h", "f.context", "f.before", "f.length").distinct()
    ids = prints.filter(F.col("item").isNotNull()).select("h", "context", "before", "length", F.col("item").cast("string").alias("item"))
    named = which.join(ids.distinct(), ["h", "context", "before", "length"]).groupBy("key").agg(
        F.sort_array(F.collect_set("item")).alias("items")
    )
    empty = F.array().cast("array<string>")
    judged = placed.select("key", union.alias("n_hit")).join(named, "key", "left")
    judged = judged.select("key", "n_hit", F.coalesce("items", empty).alias("items"))
    return worded, materialise(judged, "judged", lasting=True)


def keep_clean(docs: DataFrame, items: DataFrame, item: str = "item_id", text: str = "text", span: int = SPAN, k: int = K) -> DataFrame:
    """The rows of ``docs`` without a hit word, with their columns."""
    with temporary(docs.sparkSession):
        _, judged = _search(docs, items, item, text, span, k, [])
        hit = materialise(judged.filter("n_hit > 0").select("key"), "hit", lasting=True)
    return docs.select(F.struct("*").alias("row"), _key(docs, text).alias("key")).join(hit, "key", "left_anti").select("row.*")
