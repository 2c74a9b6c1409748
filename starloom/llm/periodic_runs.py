"""Runs of repeating words, found by catching squares on dyadic blocks.

A square is a stretch of words that is followed by itself. For every power of two the words of a text fall into blocks
of that size. Once a block is complete it becomes a catcher: it compares its fingerprint with that of each window of its size
that later words complete at a distance of two to four blocks, so each appended word is compared with two catchers per size.
Half of any square with a period in that range holds a whole block, so no square escapes. A caught distance is a candidate
period. Matches of neighbouring blocks at one distance are one comparison that has advanced over both; its ends are found
word by word, less than a block on either side. A comparison over at least one period is a square, each further word another
one, and all of them merge into one run. Multiples of a period cover the same stretch as the period, which is kept.

The words of a piece of many texts are appended together: each numpy operation does for all words what the online
method does for one. A text needs 2 n comparisons per power of two up to its longest possible period, and memory in proportion
to its words, however repetitive it is. Words are compared by their exact names in the piece, blocks by 64-bit
fingerprints, and whatever is reported has been compared word by word.

Null, empty and blank texts have no words and no runs; their collapsed text is empty. Repeated rows and null ids are rows
as any others, and further columns pass through in ``row``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.textops import blocks, mix

RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _caught(prints: np.ndarray, size: int, lag: int, sel: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Catchers, as the number of their block, and the distances at which a window of the same text equals the block."""
    width = 2 * size if size > 1 else 3
    watched = np.zeros(len(prints) + lag + width + size, np.uint64)
    watched[: len(prints)] = prints
    catchers, step = prints[::size], watched.strides[0]
    windows = np.lib.stride_tricks.as_strided(watched[lag:], (len(catchers), width), (size * step, step), writeable=False)
    block, column = np.nonzero(windows == catchers[:, None])
    distance = column + lag
    last = block * size + distance + size - 1
    inside = last < len(sel)
    inside[inside] = doc[block[inside] * size] == doc[last[inside]]
    return block[inside], distance[inside]


def _comparisons(block: np.ndarray, distance: np.ndarray, old: np.ndarray, size: int, sel: np.ndarray, doc: np.ndarray):
    """Distance, first word and end of what neighbouring blocks matched at one distance; none of it may be ``old``."""
    order = np.argsort(distance, kind="stable")  # blocks come in order
    block, distance = block[order], distance[order]
    new = np.ones(len(block), bool)
    new[1:] = (np.diff(block) != 1) | (np.diff(distance) != 0) | (doc[block[1:] * size] != doc[block[:-1] * size])
    at = np.flatnonzero(new)
    if not len(at):
        return at, at, at
    begin, n = sel[block[at] * size], np.diff(np.append(at, len(block)))
    fresh = ~np.logical_or.reduceat(old[order], at)
    return distance[at][fresh], begin[fresh], (begin + n * size)[fresh]


def find_runs(words: np.ndarray, counts: np.ndarray, exponent: int = 4, least: int = 6) -> np.ndarray:
    """Rows of (text, start, length, period), sorted, of all runs with a length of ``least`` words and ``exponent`` periods.

    ``words`` are the names of the words of all texts, one text after the other, and ``counts`` how many each has. A run is
    maximal and has its smallest period; ``exponent`` is at least two.
    """
    ends = np.cumsum(counts)
    begins = ends - counts
    doc = np.repeat(np.arange(len(counts)), counts)
    sel = np.arange(len(words))
    prints = mix(words.astype(np.uint64) + np.uint64(1))
    known = np.full(len(words), -1)  # a run found at a smaller size that covers the word
    found: list[np.ndarray] = []
    size, runs = 1, 0
    while True:
        lag = 2 * size if size > 1 else 1
        longer = counts[doc] >= exponent * lag
        sel, doc, prints = sel[longer], doc[longer], prints[longer]
        if not len(sel):
            break
        block, distance = _caught(prints, size, lag, sel, doc)
        # Inside a known run, distances that are multiples of its period tell nothing new: they end where it ends.
        run = known[sel[block * size]]
        again = (run >= 0) & (run == known[sel[block * size + distance + size - 1]])
        again[again] = distance[again] % np.concatenate(found)[run[again], 2] == 0 if again.any() else False
        period, s, e = _comparisons(block, distance, again, size, sel, doc)
        need = np.maximum(exponent * period, least) - period
        open_ = e - s + 2 * (size - 1) >= need
        period, s, e, need = period[open_], s[open_], e[open_], need[open_]
        if size > 1:
            text = np.searchsorted(ends, s, "right")
            for i, (p, a, b) in enumerate(zip(period.tolist(), s.tolist(), e.tolist(), strict=True)):
                low, high = max(a - size, begins[text[i]]), min(b + size, ends[text[i]] - p)
                differ = np.flatnonzero(words[low:a] != words[low + p : a + p])
                s[i] = low + differ[-1] + 1 if len(differ) else low
                differ = np.flatnonzero(words[b:high] != words[b + p : high + p])
                e[i] = b + differ[0] if len(differ) else max(high, b)
        enough = e - s >= need
        new = np.stack([s, e + period, period], 1)[enough]
        for a, b, _ in new:
            cover = known[a:b]
            cover[cover < 0] = runs
            runs += 1
        found.append(new)
        half = prints[size:]
        prints = np.append(mix(prints[: len(half)] * np.uint64(0x9E3779B97F4A7C15) + half), np.zeros(min(size, len(prints)), np.uint64))
        size *= 2
    if not runs:
        return np.zeros((0, 4), np.int64)
    got = np.concatenate(found)
    got = got[np.lexsort((got[:, 2], got[:, 1], got[:, 0]))]
    least_period = np.ones(len(got), bool)
    least_period[1:] = (got[1:, :2] != got[:-1, :2]).any(1)
    got = got[least_period]
    # Blocks were compared by fingerprints; what is reported holds word by word.
    for a, b, p in got.tolist():
        assert (words[a : b - p] == words[a + p : b]).all(), "two different blocks have one fingerprint"
    text = np.searchsorted(ends, got[:, 0], "right")
    return np.stack([text, got[:, 0] - begins[text], got[:, 1] - got[:, 0], got[:, 2]], 1)


def _lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), values)


def _collapse(piece: pa.RecordBatch, exponent: int, least: int) -> pa.RecordBatch:
    texts = pc.fill_null(piece.column("text"), "")
    split = pc.ascii_split_whitespace(texts)
    values, counts = split.flatten(), split.value_lengths().to_numpy()
    doc = np.repeat(np.arange(len(counts)), counts)
    empty = pc.equal(values, "").to_numpy(zero_copy_only=False)  # before the first word or after the last
    values, doc = values.filter(pa.array(~empty)), doc[~empty]
    counts = np.bincount(doc, minlength=len(counts))
    names = values.dictionary_encode().indices.to_numpy()
    runs = find_runs(names, counts, exponent, least)
    text, start, length, period = runs.T
    cover = np.zeros(len(names) + 1, np.int64)
    at = np.cumsum(counts)[text] - counts[text] + start
    np.add.at(cover, at + period, 1)
    np.add.at(cover, at + length, -1)
    kept = np.cumsum(cover[:-1]) == 0
    words = _lists(values.filter(pa.array(kept)), np.bincount(doc[kept], minlength=len(counts)))
    fields = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
    listed = _lists(fields, np.bincount(text, minlength=len(counts)))
    return pa.record_batch(
        [piece.column("row"), pa.array(counts), listed, pc.binary_join(words, " ")], ["row", "n_words", "runs", "collapsed"]
    )


def runs_of(docs: DataFrame, text: str = "text", keep: list[str] | None = None, exponent: int = 4, least: int = 6) -> DataFrame:
    """``docs`` as a struct ``row`` (of the columns ``keep``, default all), with ``n_words``, ``runs`` (start, length and
    period in words, by start and period) and ``collapsed``, the words joined by one space of which each run keeps its
    first period."""
    if exponent < 2:
        raise ValueError("a run has at least two periods")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in blocks(batch):
                yield _collapse(piece, exponent, least)

    columns = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([rows.schema["row"]]).add("n_words", "long").add("runs", T.DataType.fromDDL(RUN))
    return rows.mapInArrow(run, schema.add("collapsed", "string"))
