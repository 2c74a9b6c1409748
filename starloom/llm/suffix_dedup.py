"""Removal of strings that repeat across documents, by prefix doubling.

Positions get names for the strings of 1, 2, 4, 8, 16 and 32 bytes that begin there, each name made of a pair of names
of half the length; the pair of two names of 32 bytes at distance 18 names the string of ``LENGTH`` bytes. Names are hashes of
the pairs and not ranks, so the same string has the same name in every task and no round has to shuffle all positions to
agree on names. What Spark sorts is the positions that can matter, in three rounds of growing length:

1. Of the ``WINDOW`` strings of ``K`` bytes in a string of ``LENGTH`` bytes, one has the smallest name: its anchor. Equal strings have
   equal anchors, so only anchors, about one in fourteen positions, are sorted by name. An anchor whose name is in one document
   only is unique and drops out.
2. Anchors that are left are ranked by the name of everything that a string of ``LENGTH`` bytes around them can reach. Where a
   smaller document has the same surroundings, all of it repeats.
3. For the others, one per document and surroundings, the strings of ``LENGTH`` bytes that have them as anchor are sorted by
   name, and those that a smaller document has too repeat. This is the threshold.

Before the first sort each task drops what its own documents decide: of equal surroundings it sends the smallest
document, and of an anchor with many surroundings also only the smallest, as all of them go on to the third round. So a
passage that a third of all documents share costs a few rows per task.

Texts are whole and long ones are worked on in overlapping pieces. Null and empty texts have no bytes. Rows without id
lose nothing and nothing is lost on their account; rows with the same id do not count as repeats of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.textops import _BYTE, PIECE, begins_run, blocks, buffers, from_six_bytes, mix, six_bytes
from starloom.llm.tables import few_files, materialise, release, temporary

LENGTH, K = 50, 24
WINDOW = LENGTH - K + 1
REACH = LENGTH - K  # bytes on either side of an anchor that its strings can reach
MANY = 8  # surroundings of an anchor that a task sends on
_MARGIN, _HELD = 128, 1 << 20
_ODD = [np.uint64(x * 2 + 1) for x in np.random.default_rng(99).integers(1 << 61, 1 << 62, 12).tolist()]
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)
_48 = np.uint64((1 << 48) - 1)
REPEATS, OPEN = 0, 1  # what is known of an anchor's surroundings: a smaller document has them, or the third round decides


class Names:
    """Names of the strings in some bytes that are cut into documents at ``offsets``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        n = len(data)
        self.data, self.offsets, self.n = data, offsets, n
        with np.errstate(over="ignore"):
            name = _BYTE[np.concatenate([data, np.zeros(64, np.uint8)])]
            by_length = {}
            for i, half in enumerate((1, 2, 4, 8, 16)):
                name = name[:-half] * _ODD[i] + name[half:]
                by_length[2 * half] = name
            self.n16, self.n32 = by_length[16], by_length[32]
            short = mix(self.n16[:n] * _ODD[5] + by_length[8][16 : 16 + n])
        short[self._tails(K - 1)] = _MOST
        self.short = short
        self.least = self._slide(short, np.minimum, _MOST)
        self.least[self._tails(LENGTH - 1)] = 0  # no string of LENGTH bytes begins here

    @cached_property
    def whole(self) -> np.ndarray:
        """Names of the strings of LENGTH bytes; only the third round asks for them."""
        with np.errstate(over="ignore"):
            return mix(self.n32[: self.n] * _ODD[6] + self.n32[18 : 18 + self.n])

    def _tails(self, length: int) -> np.ndarray:
        """The last ``length`` positions of every document."""
        ends, begins = self.offsets[1:], self.offsets[:-1]
        at = ends[:, None] - np.arange(1, length + 1)
        return at[at >= begins[:, None]]

    @staticmethod
    def _slide(x: np.ndarray, best: np.ufunc, fill: np.uint64) -> np.ndarray:
        """``best`` of each value and the WINDOW - 1 after it."""
        y = np.concatenate([x, np.full(WINDOW, fill, np.uint64)])
        for step in (1, 2, 4, 8):
            y = best(y[:-step], y[step:])
        return best(y[: len(x)], y[WINDOW - 16 : WINDOW - 16 + len(x)])

    def anchors(self) -> np.ndarray:
        if not self.n:
            return np.zeros(0, np.int64)
        padded = np.concatenate([np.zeros(WINDOW - 1, np.uint64), self.least])
        most = self._slide(padded, np.maximum, np.uint64(0))[: self.n]
        return np.flatnonzero((most == self.short) & (most != 0))

    def around(self, at: np.ndarray) -> np.ndarray:
        """Names of 48 bits of the surroundings of anchors, cut at the ends of the document."""
        doc = np.searchsorted(self.offsets, at, "right") - 1
        begins, ends = self.offsets[doc], self.offsets[doc + 1]
        low, high = np.maximum(at - REACH, begins), np.minimum(at + LENGTH, ends)
        with np.errstate(over="ignore"):
            left = np.maximum(at - REACH, 0)
            names = mix(self.n32[left] * _ODD[7] + self.n32[at + LENGTH - 44] * _ODD[8] + self.n16[np.minimum(at + LENGTH - 16, len(self.n16) - 1)] * _ODD[9])
        raw = self.data
        for i in np.flatnonzero((low > at - REACH) | (high < at + LENGTH)):
            cut = hashlib.blake2b(raw[low[i] : high[i]].tobytes(), digest_size=8, salt=(int(at[i] - low[i])).to_bytes(8, "little"))
            names[i] = int.from_bytes(cut.digest(), "little")
        return names & _48

    def marked(self) -> tuple[np.ndarray, np.ndarray]:
        """The anchors and the names of their surroundings."""
        at = self.anchors()
        return at, self.around(at)

    def starts(self, at: np.ndarray) -> np.ndarray:
        """Where the strings of LENGTH bytes begin that have one of these anchors."""
        places = at[:, None] - np.arange(WINDOW)
        fits = (places >= 0) & (self.least[np.maximum(places, 0)] == self.short[at][:, None])
        return np.unique(places[fits])


def pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[Names, int, int, int]]:
    """Names of the data, or of pieces of one long document: with where the piece begins, and the part of it that counts."""
    if len(data) <= 2 * PIECE or len(offsets) > 2:
        yield Names(data, offsets), 0, 0, len(data)
        return
    for a in range(0, len(data), PIECE):
        b = min(a + PIECE, len(data))
        low, high = max(0, a - _MARGIN), min(len(data), b + _MARGIN)
        yield Names(data[low:high], np.array([0, high - low])), low, a - low, b - low


def together(texts: Iterable[tuple[int, np.ndarray]]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Numbered texts in lists of about PIECE bytes; a long one is alone."""
    held, size = [], 0
    for number, data in texts:
        if held and size + len(data) > PIECE:
            yield held
            held, size = [], 0
        held.append((number, data))
        size += len(data)
    if held:
        yield held


def by_text(block: list[tuple[int, np.ndarray]], prepare=lambda names: None) -> Iterator[tuple]:
    """For each text of a block: its number, names that cover it, what ``prepare`` makes of them, from where to where it lies in
    them, and what to add to a place there to get the place in the text. Parts of a long text come one by one."""
    offsets = np.concatenate([[0], np.cumsum([len(data) for _, data in block])]).astype(np.int64)
    joined = block[0][1] if len(block) == 1 else np.concatenate([data for _, data in block])
    for names, begin, low, high in pieces(joined, offsets):
        made = prepare(names)
        for k, (number, _) in enumerate(block):
            first, last = (low, high) if len(block) == 1 else (offsets[k], offsets[k + 1])
            yield number, names, made, int(first), int(last), begin if len(block) == 1 else -int(offsets[k])


def _ids(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.diff(x, prepend=np.int64(0)).astype("<i8").tobytes())


def _from_ids(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i8")).astype(np.int64)


def _sorted_classes(h: np.ndarray, f: np.ndarray, doc: np.ndarray):
    """Rows by anchor, surroundings and document; whether they begin a class; the smallest document of the class."""
    order = np.lexsort((doc, f, h))
    h, f, doc = h[order], f[order], doc[order]
    once = begins_run(h, f, doc)
    h, f, doc = h[once], f[once], doc[once]
    begins = begins_run(h, f)
    return h, f, doc, begins, doc[np.maximum.accumulate(np.where(begins, np.arange(len(h)), 0))]


def _per_anchor(h: np.ndarray, begins: np.ndarray, doc: np.ndarray):
    """For each row, of its anchor: the number of classes, the smallest and the largest document."""
    group = np.cumsum(begins_run(h)) - 1
    n = int(group[-1]) + 1 if len(group) else 0
    classes = np.bincount(group, begins, n).astype(np.int64)
    at = np.flatnonzero(begins_run(h))
    low = np.minimum.reduceat(doc, at) if n else doc
    high = np.maximum.reduceat(doc, at) if n else doc
    return classes[group], low[group], high[group]


def anchors_of(docs: DataFrame, buckets: int) -> DataFrame:
    """Packed anchors by ``bucket`` of their name, and what the task already knows, as rows without names."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        names = ["bucket", "kind", "h", "f", "d"]

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            h, f, doc = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            h, f, doc, begins, least = _sorted_classes(h, f, doc)
            classes, low, _ = _per_anchor(h, begins, doc)
            many = classes > MANY
            send = begins & (~many | (doc == low))
            out = []
            for kind, keep in ((None, send), (REPEATS, doc > least), (OPEN, begins & many)):
                hk, fk, dk = h[keep], f[keep], doc[keep]
                bucket = (hk if kind is None else mix(dk.view(np.uint64))) % np.uint64(buckets)
                order = np.lexsort((dk, bucket))
                hk, fk, dk, bucket = hk[order], fk[order], dk[order], bucket[order].astype(np.int64)
                for part in np.split(np.arange(len(bucket)), np.flatnonzero(np.diff(bucket)) + 1):
                    if len(part):
                        name = six_bytes(hk[part] & _48) if kind is None else None
                        out.append((int(bucket[part[0]]), kind, name, six_bytes(fk[part]), _ids(dk[part])))
            if out:
                kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

        for whole in batches:
            for batch in blocks(whole):
                ids = batch.column(0).to_numpy()
                data, offsets = buffers(batch.column(1))
                for found, begin, low, high in pieces(data, offsets):
                    at = found.anchors()
                    at = at[(at >= low) & (at < high)]
                    doc = ids[np.searchsorted(offsets, at + begin, "right") - 1]
                    held.append((found.short[at], found.around(at), doc))
                if sum(len(x[0]) for x in held) >= _HELD:
                    yield from flush()
        yield from flush()

    return docs.mapInArrow(run, "bucket int, kind int, h binary, f binary, d binary")


def rank(anchors: DataFrame) -> DataFrame:
    """``doc``, surroundings ``f`` and ``kind`` for the anchors that are not unique."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        now = None

        def emit(doc: np.ndarray, f: np.ndarray, kind: np.ndarray) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(doc), 1 << 16):
                cut = slice(i, i + (1 << 16))
                yield pa.record_batch([pa.array(doc[cut]), pa.array(f[cut].astype(np.int64)), pa.array(kind[cut].astype(np.int32))], ["doc", "f", "kind"])

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                h, f, doc, begins, least = _sorted_classes(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held.clear()
                classes, low, high = _per_anchor(h, begins, doc)
                repeats, open_ = doc > least, begins & (classes > 1) & (low < high)
                keep = repeats | open_
                yield from emit(doc[keep], f[keep], np.where(repeats[keep], REPEATS, OPEN))

        for batch in batches:
            for bucket, kind, h, f, d in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if bucket != now:
                    yield from flush()
                    now = bucket
                doc, around = _from_ids(d), from_six_bytes(f)
                if kind is None:
                    held.append((from_six_bytes(h), around, doc))
                else:
                    yield from emit(doc, around, np.full(len(doc), kind))
        yield from flush()

    dealt = anchors.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "doc bigint, f bigint, kind int")


def open_strings(docs: DataFrame, buckets: int) -> DataFrame:
    """``id`` and ``name`` of the strings at ``open`` surroundings of the packed texts ``z`` that a document with a smaller id has too.

    Dealt to ``buckets`` by name, packed. Of a name a task sends its smallest document; for the others it knows the answer.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            name, doc = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            bucket = (name % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((doc, name, bucket))
            name, doc, bucket = name[order], doc[order], bucket[order]
            begins = begins_run(name)
            least = doc[np.maximum.accumulate(np.where(begins, np.arange(len(name)), 0))]
            out = []
            for known, keep in ((False, begins), (True, doc > least)):
                at = np.flatnonzero(keep)
                for part in np.split(at, np.flatnonzero(np.diff(bucket[at])) + 1):
                    if len(part):
                        out.append((int(bucket[part[0]]), known, name[part].tobytes(), _ids(doc[part])))
            kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["bucket", "known", "name", "d"])

        for batch in batches:
            ids = batch.column(0).to_numpy()
            texts = ((i, np.frombuffer(opener.decompress(z.as_py()), np.uint8)) for i, z in enumerate(batch.column(1)))
            for block in together(texts):
                for i, found, (at, around), low, high, _ in by_text(block, Names.marked):
                    a, b = np.searchsorted(at, (low, high))
                    open_ = np.array(batch.column(2)[i].as_py(), np.int64).astype(np.uint64)
                    names = np.unique(found.whole[found.starts(at[a:b][np.isin(around[a:b], open_)])])
                    held.append((names, np.full(len(names), ids[i])))
                if sum(len(x[0]) for x in held) >= _HELD:
                    yield from flush()
        yield from flush()

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        now = None

        def emit(name: np.ndarray, doc: np.ndarray) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(doc), 1 << 16):
                cut = slice(i, i + (1 << 16))
                yield pa.record_batch([pa.array(doc[cut]), pa.array(name[cut].view(np.int64))], ["id", "name"])

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                name, doc = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                order = np.lexsort((doc, name))
                name, doc = name[order], doc[order]
                least = doc[np.maximum.accumulate(np.where(begins_run(name), np.arange(len(name)), 0))]
                yield from emit(name[doc > least], doc[doc > least])

        for batch in batches:
            for bucket, known, name, d in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if bucket != now:
                    yield from flush()
                    now = bucket
                rows = np.frombuffer(name, np.uint64), _from_ids(d)
                if known:
                    yield from emit(*rows)
                else:
                    held.append(rows)
        yield from flush()

    packed = docs.mapInArrow(run, "bucket int, known boolean, name binary, d binary")
    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, "id bigint, name bigint")


_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
_RESULT = [("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string"), ("kept", "string")]


def _result(data: np.ndarray, gone: np.ndarray | None, texts: bool) -> tuple:
    if gone is None or not gone.any():
        raw = data.tobytes()
        return len(data), 0, 0, hashlib.sha256(raw).hexdigest(), raw.decode("utf-8", "ignore") if texts else None
    kept = data[~gone].tobytes()
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if texts else None


def _cover(size: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    change = np.bincount(begins, minlength=size + 1) - np.bincount(ends, minlength=size + 1)
    return np.cumsum(change)[:size] > 0


def _struct(row: T.StructField, more: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([row, *T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in more)).fields])


def repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", keep: list[str] | None = None, texts: bool = False) -> DataFrame:
    """The columns ``keep`` (default all but the text) as a struct ``row``, with ``n_bytes``, ``n_removed``, ``n_spans`` (maximal runs that
    are removed), ``kept_sha256`` and, with ``texts``, what is ``kept``, without characters that were cut in two."""
    columns = [c for c in docs.columns if c != text] if keep is None else keep
    with temporary(docs.sparkSession):
        return _repeats(docs, doc, text, columns, texts)


def _repeats(docs: DataFrame, doc: str, text: str, columns: list[str], texts_: bool) -> DataFrame:
    spark = docs.sparkSession
    buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_, text_ = F.col(f"`{doc}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text")
    named = docs.select(id_, text_).filter("id is not null and text is not null")
    marks = rank(anchors_of(named, buckets))
    known = marks.groupBy("doc").agg(
        F.collect_list(F.when(F.col("kind") == REPEATS, F.col("f"))).alias("repeats"),
        F.collect_list(F.when(F.col("kind") == OPEN, F.col("f"))).alias("open"),
    )

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = [packer.compress((x.as_py() or "").encode()) for x in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["row", "id", "z"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), id_, text_)
    row = rows.schema["row"]
    packed = rows.mapInArrow(pack, _struct(row, [("id", "bigint"), ("z", "binary")]))

    def second(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Covers what is known to repeat, and keeps the surroundings that are still open."""
        opener = zstandard.ZstdDecompressor()
        numbers = lambda cell: np.array(cell.as_py() or [], np.int64).astype(np.uint64)
        for batch in batches:
            n = batch.num_rows
            sizes, edges, still, done = [0] * n, [[]] * n, [None] * n, [None] * n

            def texts() -> Iterator[tuple[int, np.ndarray]]:
                for i in range(n):  # noqa: B023
                    data = np.frombuffer(opener.decompress(batch.column(2)[i].as_py()), np.uint8)  # noqa: B023
                    sizes[i] = len(data)  # noqa: B023
                    if batch.column(3)[i].is_valid:  # noqa: B023
                        yield i, data
                    elif not texts_:
                        done[i] = _result(data, None, False)  # noqa: B023

            for block in together(texts()):
                parts = {i: ([], [], []) for i, _ in block}
                for i, found, (at, around), low, high, shift in by_text(block, Names.marked):
                    a, b = np.searchsorted(at, (low, high))
                    here, near = at[a:b], around[a:b]
                    same = here[np.isin(near, numbers(batch.column(3)[i]))] + shift
                    parts[i][0].append(np.maximum(same - REACH, 0))
                    parts[i][1].append(np.minimum(same + LENGTH, sizes[i]))
                    parts[i][2].append(near[np.isin(near, numbers(batch.column(4)[i]))])
                for i, data in block:
                    begins, ends, open_ = (np.concatenate(x) for x in parts[i])
                    gone = _cover(len(data), begins, ends)
                    still[i] = np.unique(open_).view(np.int64) if len(open_) else None
                    if still[i] is None and not texts_:
                        done[i] = _result(data, gone, False)
                    else:
                        edges[i] = np.flatnonzero(np.diff(gone, prepend=False, append=False))
            # A text that is decided is needed no more, unless the texts are asked for.
            packed_ = [None if d is not None else z.as_py() for z, d in zip(batch.column(2), done, strict=True)]
            results = [d or (None,) * len(_RESULT) for d in done]
            cells = list(zip(*results, strict=True)) or [()] * len(_RESULT)
            more = [pa.array(c, k) for c, k in zip(cells, _KINDS, strict=True)]
            more += [pa.array(packed_, pa.binary()), pa.array(edges, pa.list_(pa.int32())), pa.array(still, pa.list_(pa.int64()))]
            yield pa.record_batch([batch.column(0), batch.column(1), *more], ["row", "id", *[c for c, _ in _RESULT], "z", "edges", "open"])

    joined = packed.join(known, F.col("id") == F.col("doc"), "left").select("row", "id", "z", "repeats", "open")
    schema = _struct(row, [("id", "bigint"), *_RESULT, ("z", "binary"), ("edges", "array<int>"), ("open", "array<bigint>")])
    half = materialise(few_files(joined.mapInArrow(second, schema)), "second", lasting=True)
    release(spark)

    found_ = open_strings(half.filter("open is not null").select("id", "z", "open"), buckets)
    hits = found_.groupBy("id").agg(F.collect_set("name").alias("hits"))
    hits = materialise(few_files(hits.select(F.col("id").alias("of"), "hits")), "hits", lasting=True)

    def third(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Covers the strings that were found in a smaller document."""
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            n = batch.num_rows
            out, covers = [None] * n, {}

            def cover(i: int, data: np.ndarray) -> None:
                edges = np.array(batch.column(2)[i].as_py(), np.int64)  # noqa: B023
                begins, ends = covers.get(i, ([], []))  # noqa: B023
                gone = _cover(len(data), np.concatenate([edges[::2], *begins]), np.concatenate([edges[1::2], *ends]))
                out[i] = _result(data, gone, texts_)  # noqa: B023

            def texts() -> Iterator[tuple[int, np.ndarray]]:
                for i in range(n):  # noqa: B023
                    data = np.frombuffer(opener.decompress(batch.column(1)[i].as_py()), np.uint8)  # noqa: B023
                    if batch.column(3)[i].is_valid:  # noqa: B023
                        yield i, data
                    else:
                        cover(i, data)  # noqa: B023

            for block in together(texts()):
                for i, found, _, low, high, shift in by_text(block):
                    hits_ = np.array(batch.column(3)[i].as_py(), np.int64).view(np.uint64)
                    at = low + np.flatnonzero((found.least[low:high] != 0) & np.isin(found.whole[low:high], hits_)) + shift
                    begins, ends = covers.setdefault(i, ([], []))
                    begins.append(at)
                    ends.append(at + LENGTH)
                for i, data in block:
                    cover(i, data)
            cells = list(zip(*out, strict=True)) or [()] * len(_RESULT)
            yield pa.record_batch([batch.column(0), *[pa.array(c, k) for c, k in zip(cells, _KINDS, strict=True)]], ["row", *[c for c, _ in _RESULT]])

    open_ = half.filter("z is not null").select("row", "id", "z", "edges")
    met = open_.join(hits, F.col("id") == F.col("of"), "left").select("row", "z", "edges", "hits")
    decided = few_files(met.mapInArrow(third, _struct(row, _RESULT)))
    return half.filter("z is null").select("row", *[c for c, _ in _RESULT]).unionByName(decided)


def cleaned(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the strings that repeat, with their columns; documents of which nothing is left are dropped.

    A null text comes back as the empty text. ``n_chars``, where there is such a column, tells the new length.
    """
    found = repeats(docs, doc, text, texts=True)
    shown = found.filter((F.col("n_removed") == 0) | (F.col("kept") != "")).withColumnRenamed("kept", "left")
    of = {c: F.col(f"row.`{c}`") for c in docs.columns if c != text} | {text: F.col("left")}
    if "n_chars" in docs.columns:
        of["n_chars"] = F.when(F.col("n_removed") == 0, of["n_chars"]).otherwise(F.length("left")).cast(docs.schema["n_chars"].dataType)
    return shown.select(*[of[c].alias(c) for c in docs.columns])
