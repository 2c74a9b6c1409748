"""How the words of a source differ from those of other sources and of the whole language, from in-mapper stripes.

A stripe is what is known of one term in one language: in how many documents it is, and how often in each source. Each task
folds whole documents into stripes in a hash table, writes the table out whenever it has grown to a fixed number of cells, and
goes on with an empty one. Partial stripes meet by language and term and add up, in aggregates that can spill: so a word of
every document costs a few rows per task. Merged stripes of enough documents are kept, and give the totals.

Each kept stripe then directly yields what its term adds to the divergence of every two sources, summed in the task, and
how much each source overuses it, of which a task keeps the leading terms. Shares are whole numbers of parts in
10**9, and all arithmetic is exact in 64 bits: quotients are taken in three digits of 1,000, so counts may reach 9 * 10**15.

Null texts, languages and sources are taken as empty ones. A row is a document, also where rows are repeated. Groups without terms
take part with counts of zero, and a language without kept terms has pairs of value 0 and no terms. An empty table
gives an empty result; other columns are not read. What the driver holds is one row per language and source, the square root of the result.
"""

from __future__ import annotations

import string
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.tables import materialise, temporary

CELLS = 1 << 19  # counts in a task's table of stripes, and sums of pairs in its result
DENSE = 1 << 20  # counts of stripes that are worked on at once

# Letters of ASCII in lower case and all that lies beyond ASCII stay, the rest separates.
_LETTERS = string.ascii_letters.encode()
TERM = bytes((b + 32 if 65 <= b <= 90 else b) if b in _LETTERS or b >= 128 else 32 for b in range(256))


class _Table:
    """A task's hash table: of each language, the documents of each term and its occurrences by source."""

    def __init__(self):
        self.df: dict[str, Counter] = defaultdict(Counter)
        self.counts: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def fold(self, lang: str, source: str, text: bytes) -> None:
        terms = text.translate(TERM).split()
        self.counts[lang, source].update(terms)
        self.df[lang].update(set(terms))

    def cells(self) -> int:
        return sum(map(len, self.counts.values()))

    def stripes(self) -> Iterator[pa.RecordBatch]:
        """A batch for each language; a term has its sources in a list."""
        for lang, terms in self.df.items():
            own = {source: counts for (x, source), counts in self.counts.items() if x == lang}
            place = {term: i for i, term in enumerate(terms)}
            row = np.fromiter(chain.from_iterable(map(place.__getitem__, c) for c in own.values()), np.int64)
            n = np.fromiter(chain.from_iterable(c.values() for c in own.values()), np.int64)
            source = np.repeat(np.arange(len(own)), [len(c) for c in own.values()])
            order = np.argsort(row, kind="stable")
            ends = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=len(terms)))), pa.int32())
            sources = pa.array(list(own), pa.string()).take(pa.array(source[order]))
            lists = [pa.ListArray.from_arrays(ends, x) for x in (sources, pa.array(n[order]))]
            term = pa.array(list(terms), pa.binary()).cast(pa.string())
            columns = [pa.array([lang] * len(terms), pa.string()), term, pa.array(list(terms.values()), pa.int64()), *lists]
            yield pa.record_batch(columns, ["lang", "term", "df", "sources", "counts"])


def _fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial stripes of whole documents."""
    table = _Table()
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            table.fold(lang, source, text.as_py().encode())
        if table.cells() >= CELLS:
            yield from table.stripes()
            table = _Table()
    yield from table.stripes()


def merged_stripes(docs: DataFrame) -> DataFrame:
    """``lang``, ``term``, ``df`` and ``counts`` (source and n) from non-null columns lang, source and text."""
    partial = docs.select("lang", "source", "text").mapInArrow(_fold, "lang string, term string, df long, sources array<string>, counts array<long>")
    # Dealt by term once; both aggregates work on what is then together.
    cells = partial.repartition("lang", "term").select("lang", "term", "df", F.posexplode(F.arrays_zip("sources", "counts")).alias("i", "cell"))
    own = F.when(F.col("i") == 0, F.col("df"))  # a partial stripe counts its documents once
    cells = cells.groupBy("lang", "term", F.col("cell.sources").alias("source")).agg(F.sum("cell.counts").alias("n"), F.sum(own).alias("df"))
    return cells.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.collect_list(F.struct("source", "n")).alias("counts"))


def shares(counts: np.ndarray, totals: np.ndarray | int) -> np.ndarray:
    """1 + floor(10**9 * (count + 1) / total), three digits at a time, as the product can exceed 64 bits."""
    quotient, rest = np.divmod(counts + 1, totals)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, totals)
        quotient = quotient * 1000 + digits
    return 1 + quotient


class _Audit:
    """What one task knows of its stripes: sums of pairs by language and source, and the leading terms of each source."""

    def __init__(self, groups: dict[str, tuple[list[str], np.ndarray, int]], top: int):
        self.groups, self.top = groups, top
        self.pairs: dict[tuple[str, int], np.ndarray] = {}
        self.terms: dict[tuple[str, int], list[tuple[int, str]]] = {}

    def add(self, lang: str, terms: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, used, kept = self.groups[lang]
        p, q = shares(counts, used + kept), shares(counts.sum(1), used.sum() + kept)
        for a in range(len(used)):
            mine = p[:, a]
            away = mine[:, None] - p
            sums = (away * away // p).sum(0)
            self.pairs[lang, a] = self.pairs.get((lang, a), 0) + sums
            if len(self.pairs) * len(sums) > CELLS:
                yield self.sums()
            more = np.flatnonzero((counts[:, a] > 0) & (mine > q))
            if len(more):
                value = (mine[more] - q[more]) ** 2 // q[more]
                if len(value) > self.top:
                    lead = value >= np.partition(value, -self.top)[-self.top]  # ties stay for now
                    more, value = more[lead], value[lead]
                both = self.terms.get((lang, a), []) + list(zip((-value).tolist(), terms[more], strict=True))
                self.terms[lang, a] = sorted(both)[: self.top]  # code points sort as their UTF-8 does

    def sums(self) -> pa.RecordBatch:
        rows = [
            (lang, self.groups[lang][0][a], "pair", self.groups[lang][0][b], v)
            for (lang, a), sums in self.pairs.items()
            for b, v in enumerate(sums.tolist())
            if a != b
        ]
        self.pairs = {}
        return self._batch(rows)

    def leading(self) -> pa.RecordBatch:
        return self._batch([(lang, self.groups[lang][0][a], "term", t, -v) for (lang, a), terms in self.terms.items() for v, t in terms])

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else ((),) * 5
        kinds = [pa.string()] * 4 + [pa.int64()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "source", "part", "item", "value"])


def _emitted(stripes: DataFrame, groups: dict[str, tuple[list[str], np.ndarray, int]], top: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit = _Audit(groups, top)
        place = {lang: {s: i for i, s in enumerate(g[0])} for lang, g in groups.items()}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            terms = np.array(batch.column(1).to_pylist(), object)
            cells = batch.column(2)
            sizes = cells.value_lengths().to_numpy()
            source, n = cells.flatten().flatten()
            source = source.dictionary_encode()
            names, codes = source.dictionary.to_pylist(), source.indices.to_numpy()
            row, n = np.repeat(np.arange(len(sizes)), sizes), n.to_numpy()
            for lang in sorted(set(langs)):
                at = np.array([place[lang].get(s, -1) for s in names])
                width = len(place[lang])
                mine = np.flatnonzero(langs == lang)
                for part in np.array_split(mine, -(-len(mine) * width // DENSE)):
                    rank = np.full(len(langs), -1)
                    rank[part] = np.arange(len(part))
                    cell = rank[row] >= 0
                    counts = np.zeros((len(part), width), np.int64)
                    counts[rank[row[cell]], at[codes[cell]]] = n[cell]
                    yield from audit.add(lang, terms[part], counts)
        yield audit.sums()
        yield audit.leading()

    return stripes.select("lang", "term", "counts").mapInArrow(run, "lang string, source string, part string, item string, value long")


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 3, top: int = 200) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``.

    Part ``pair`` has each other source of the language, with the sum over its kept terms (those of ``min_docs`` documents) of
    the squared difference of shares by the other's share. Part ``term`` has the ``top`` terms that the source uses more than the language.
    """
    named = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))]
    held = docs.select(*named)
    with temporary(docs.sparkSession):
        stripes = materialise(merged_stripes(held).filter(F.col("df") >= min_docs).select("lang", "term", "counts"), "stripes")
        kept = {r["lang"]: r["count"] for r in stripes.groupBy("lang").count().collect()}  # one row per language
        cells = stripes.select("lang", F.explode("counts").alias("cell"))
        used = cells.groupBy("lang", F.col("cell.source").alias("source")).agg(F.sum("cell.n").alias("n"))
        groups = held.select("lang", "source").distinct()
        rows = groups.join(used, ["lang", "source"], "left").orderBy("lang", "source").collect()  # one row per group
        known: dict[str, tuple[list[str], np.ndarray, int]] = {}
        for name, members in groupby(rows, key=lambda r: r["lang"]):
            own = list(members)
            known[name] = [r["source"] for r in own], np.array([r["n"] or 0 for r in own], np.int64), kept.get(name, 0)
        found = materialise(_emitted(stripes, known, top), "divergences", lasting=True)
    all_pairs = groups.join(groups.withColumnRenamed("source", "item"), "lang").filter("source <> item")
    none = all_pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    summed = found.unionByName(none).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return summed.withColumn("rank", rank).filter((F.col("part") == "pair") | (F.col("rank") <= top))
