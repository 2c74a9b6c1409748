"""Removal of lines that several documents hold, by two Bloom filters and an exact count of what they suspect.

A line's key is the line without white space around it and with A to Z in lower case. Keys are named by 128-bit hashes. Every
task packs the distinct names of its documents in blocks, with the document of each, and writes the blocks out. Only the first
half of each distinct name then travels, to the segment of filters that its value selects: the filter of hashes seen once and the
one of hashes seen twice or more. A hash that the first filter may hold goes to the second; afterwards what the second filter
may hold is suspected, which never misses a repeat, and now and then takes a single line for one. Filters over all lines
would grow with the corpus, so they are cut in segments of a fixed number of hashes, and none is broadcast.
Blocks get back which of their hashes are suspected, and only those lines, by name and document, shuffle once more, to be counted
exactly. A key in enough documents keeps its lines in the document that is chosen to hold it and loses them in all others.

A line that a third of all documents share reaches its segment at most twice per block, is summed up per task before it
is counted, and meets its verdict in a join that the adaptive skew join can divide.

Documents are named by a whole-number id; rows that share an id are one document, and each loses the same lines. Rows with
a null id do not count and stay whole. Null and empty texts are one empty line. Repeated rows stay repeated, further columns
pass through in ``row``, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.tables import materialise, temporary

BLOCK = 1 << 16  # names in a block, and those of one more batch
SEGMENT = 1 << 20  # hashes in a segment of the filters
LEAST_SEGMENTS = 64
CELLS, PROBES = 16, 4  # of a filter per hash


def line_names(text: str | None, least: int) -> list[bytes | None]:
    """The name of each line's key; None if the key has fewer than ``least`` code points."""
    names = []
    for line in (text or "").encode().lower().split(b"\n"):  # of bytes, only A to Z have lower case
        key = line.strip()  # and only space and tab to carriage return are white space
        long = len(key) >= least and (key.isascii() or len(key.decode()) >= least)
        names.append(xxhash.xxh3_128_digest(key) if long else None)
    return names


class Bloom:
    """A Bloom filter for a known number of 64-bit hashes. A cell is a byte, so that numpy can set many at once."""

    def __init__(self, hashes: int):
        self.mask = np.uint64((1 << max(10, (CELLS * hashes - 1).bit_length())) - 1)
        self.cells = np.zeros(int(self.mask) + 1, bool)

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        for i in range(PROBES):
            yield (hashes + np.uint64(i) * step) & self.mask

    def add(self, hashes: np.ndarray) -> None:
        for place in self._places(hashes):
            self.cells[place] = True

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        held = np.ones(len(hashes), bool)
        for place in self._places(hashes):
            held &= self.cells[place]
        return held


def suspected(hashes: np.ndarray, at_once: int = 1 << 16) -> np.ndarray:
    """Which hashes may be there twice or more. At no time more than ``at_once`` hashes are compared with each other."""
    once, twice = Bloom(len(hashes)), Bloom(len(hashes))
    for i in range(0, len(hashes), at_once):
        new, counts = np.unique(hashes[i : i + at_once], return_counts=True)
        twice.add(new[(counts > 1) | once.may_hold(new)])
        once.add(new)
    return twice.may_hold(hashes)


def _block(names: list[bytes], refs: list[int], number: int) -> pa.RecordBatch:
    block = (TaskContext.get().partitionId() << 32) + number
    packed = [b"".join(names), np.array(refs, "<i8").tobytes()]
    return pa.record_batch([pa.array([block]), pa.array([len(refs)]), *[pa.array([x], pa.binary()) for x in packed]], ["block", "n", "names", "refs"])


def _named(docs: DataFrame, least: int) -> DataFrame:
    """Blocks of the distinct names of each document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, refs, number = [], [], 0
        for batch in batches:
            for ref, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = set(line_names(text.as_py(), least)) - {None}
                names += found
                refs += [ref] * len(found)
            if len(refs) >= BLOCK:
                yield _block(names, refs, number)
                names, refs, number = [], [], number + 1
        if refs:
            yield _block(names, refs, number)

    return docs.filter("ref is not null").select("ref", "text").mapInArrow(run, "block long, n long, names binary, refs binary")


def _hashes(names: pa.Scalar) -> np.ndarray:
    """The first halves of packed names."""
    return np.frombuffer(names.as_buffer(), "<u8")[::2]


def _dealt(blocks: DataFrame, segments: int) -> DataFrame:
    """The distinct hashes of each block by segment, those that two documents of the block hold twice."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, names in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                hashes, counts = np.unique(_hashes(names), return_counts=True)
                hashes = np.repeat(hashes, np.minimum(counts, 2))
                segment = (hashes >> np.uint64(8)) % np.uint64(segments)
                order = np.argsort(segment, kind="stable")
                hashes, segment = hashes[order], segment[order]
                first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
                parts = [x.tobytes() for x in np.split(hashes, first[1:])]
                columns = [segment[first].astype(np.int64), np.full(len(first), block)]
                yield pa.record_batch([*map(pa.array, columns), pa.array(parts, pa.binary())], ["segment", "block", "hashes"])

    return blocks.select("block", "names").mapInArrow(run, "segment long, block long, hashes binary")


def _suspects(group: pa.Table) -> pa.Table:
    """For each block what the filters of one segment suspect of its hashes."""
    parts = [np.frombuffer(x.as_buffer(), "<u8") for x in group["hashes"]]
    flags = np.split(suspected(np.concatenate(parts)), np.cumsum([len(p) for p in parts])[:-1])
    out = [(block, p[f].tobytes()) for block, p, f in zip(group["block"].to_pylist(), parts, flags, strict=True) if f.any()]
    blocks, hashes = zip(*out, strict=True) if out else ((), ())
    return pa.table([pa.array(blocks, pa.int64()), pa.array(hashes, pa.binary())], ["block", "hashes"])


def _picked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The names that are suspected, each with its document."""
    for batch in batches:
        for names, refs, hashes in zip(*batch.columns, strict=True):
            wanted = np.frombuffer(b"".join(hashes.as_py()), "<u8")
            at = np.flatnonzero(np.isin(_hashes(names), wanted))
            packed = np.frombuffer(names.as_buffer(), "S1").reshape(-1, 16)[at].tobytes()
            split = pa.Array.from_buffers(pa.binary(16), len(at), [None, pa.py_buffer(packed)]).cast(pa.binary())
            yield pa.record_batch([split, pa.array(np.frombuffer(refs.as_buffer(), "<i8")[at])], ["name", "ref"])


def repeated_lines(docs: DataFrame, least: int = 20, documents: int = 3) -> DataFrame:
    """From columns ``ref`` and ``text`` the ``ref`` of each document that loses lines, with the ``names`` of their keys."""
    with temporary(docs.sparkSession):
        blocks = materialise(_named(docs, least), "line-blocks")
        hashes = blocks.agg(F.sum("n")).first()[0] or 0
        dealt = _dealt(blocks, max(LEAST_SEGMENTS, -(-hashes // SEGMENT)))
        found = dealt.groupBy("segment").applyInArrow(_suspects, "block long, hashes binary")
        found = found.groupBy("block").agg(F.collect_list("hashes").alias("hashes"))
        picked = blocks.select("block", "names", "refs").join(found, "block").select("names", "refs", "hashes")
        lines = materialise(picked.mapInArrow(_picked, "name binary, ref long").distinct(), "line-suspects")
        counted = lines.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.max("ref").alias("holder"))
        lost = lines.join(counted.filter(F.col("n") >= documents), "name").filter("ref < holder")
        return materialise(lost.groupBy("ref").agg(F.collect_list("name").alias("names")), "line-lost", lasting=True)


def dedup_lines(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", keep: list[str] | None = None, least: int = 20, documents: int = 3
) -> DataFrame:
    """``docs`` as a struct ``row`` (of the columns ``keep``, default all), with ``n_lines``, ``n_dropped`` and ``kept``.

    Lines go whose key has ``least`` code points and is in ``documents`` documents, except from that with the largest id.
    """
    if documents < 2:
        raise ValueError("what one document holds is no repeat")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, kept = [], []
            for value, names in zip(batch.column(1), batch.column(2), strict=True):
                held, gone = value.as_py() or "", set(names.as_py() or ())
                lines = held.split("\n")
                if gone:
                    lines = [x for x, name in zip(lines, line_names(held, least), strict=True) if name not in gone]
                counts.append((held.count("\n") + 1, held.count("\n") + 1 - len(lines)))
                kept.append("\n".join(lines) if gone else held)
            total, dropped = zip(*counts, strict=True) if counts else ((), ())
            columns = [pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())]
            yield pa.record_batch([batch.column(0), *columns], ["row", "n_lines", "n_dropped", "kept"])

    columns = docs.columns if keep is None else keep
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{doc}`").cast("long").alias("ref"), F.col(f"`{text}`").alias("text")
    )
    joined = rows.join(repeated_lines(rows.select("ref", "text"), least, documents), "ref", "left").select("row", "text", "names")
    schema = T.StructType([rows.schema["row"]]).add("n_lines", "long").add("n_dropped", "long")
    return joined.mapInArrow(run, schema.add("kept", "string"))
