"""A hierarchical Pitman-Yor language model over words.

Each context is a restaurant, and every word of the corpus, and the beginning of a text, is a context: customers are the words
that follow it, and each table a word that came down from the parent restaurant. That is the one of the class of the word
before, one of ``CONTEXTS`` by its last two bytes; its parent is shared by all classes, and the shared one's is uniform over
the words seen and one unseen. No pair of words is left out, however rare, and the contexts grow with the corpus.

How customers sit is sampled. A sweep reseats, in every restaurant, all customers of a word one after the other by the
Chinese restaurant process, against what the parent gives that word just now, and accepts the new seating by the
Metropolis-Hastings rule; the tables then are the customers of the parent and are reseated there. A round sweeps all pairs
against the totals of the restaurants and the classes' probabilities of the round before, then all words in classes and the shared parent.
Customers from the 64th on are seated in runs, with one draw of the number of new tables for each run, so that a word seen a
billion times costs a few hundred draws. Tables are averaged over the sweeps of the last round, and probabilities come from the averages.

Pairs are dealt to buckets by their hash, so neither a frequent word nor a frequent context comes to one task; contexts, and
words in classes, are dealt by theirs. A bucket of pairs sends the sums of its tables and gets back, in the same order,
what the restaurants have in all. For scoring, texts are gathered in chunks; a chunk asks once for each pair, context and
word in a class that it holds. The words seen most often, at most ``FREQUENT``, are broadcast as a table of fixed size and not asked for. Rows that
travel are packed: a part of a sorted array in each. Words are named by 59 bits, pairs by 64.

Null texts have the end token alone. Rows without id are scored and never learned from. Rows that repeat id and text
are scored each. Without training rows every token has probability 1.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from starloom.llm.textops import LOWER, SPACE, begins_run, blocks, buffers, mix, rows_of, word_hashes
from starloom.llm.tables import in_parts, materialise, temporary

CONTEXTS, BITS = 32, 5
FREQUENT = 1 << 18
STRENGTH = 1.0
_HELD = 1 << 20  # tokens a task counts before it hands the counts on
_CHUNK = 5 << 20  # bytes of text in a chunk
_BUCKET = 1 << 23  # bytes of text for each bucket
_FILE = 4  # buckets that a task writes to one file
_SMALL = 64  # so few records travel as they are
_END = np.uint64(0x5DEECE66D1234567)
_BEGIN = np.uint64(0x2545F4914F6CDD1D) >> np.uint64(BITS) << np.uint64(BITS)

# What a packed row holds; those of a bucket come in this order, so tables come before what is asked of them.
_MANY, _SINGLE, _KEPT, _BASE, _BASE_IN, _ROOMS, _IN, _BEFORE, _WORD, _PAIR, _CHUNKS, _TOTALS = range(12)
_DDL = "to bigint, kind int, source bigint, n int, data binary"
_NAMES = ["to", "kind", "source", "n", "data"]
_BYTE = np.dtype("u1")
_NUMBER = np.dtype("f8")
_KEY = np.dtype("u8")
_TWO = np.dtype([("before", "u8"), ("word", "u8")])
_CELL = np.dtype([("before", "u8"), ("word", "u8"), ("n", "i8")])
_SUM = np.dtype([("key", "u8"), ("n", "i8"), ("one", "i8"), ("pairs", "i8")])  # tokens, pairs seen once, all pairs
_SEATS = np.dtype([("key", "u8"), ("tables", "f8")])
_PARENT = np.dtype([("kept", "f8"), ("root", "f8")])
_PAIRS = np.dtype([("key", "u8"), ("kept", "f4")])
_ROOM = np.dtype([("key", "u8"), ("n", "i8"), ("tables", "f4")])
_CLASS = np.dtype([("key", "u8"), ("kept", "f4"), ("n", "i8"), ("arrived", "f8"), ("parent_tables", "f8")])  # the last three are the word's
_SEEN = np.dtype([("n", "i8"), ("tables", "f4")])
_KNOWN = np.dtype([("n", "i8"), ("kept", "f4"), ("root", "f4")])


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, context and word of every token of the ``text`` column, ends included.

    The context is the word before, with its class in the low bits.
    """
    data, offsets = buffers(batch.column(batch.schema.get_field_index("text")))
    hashes, places = word_hashes(data, offsets, lower=True)
    rows, n = rows_of(places, offsets), batch.num_rows
    # The last byte of a word is the one before the next space or the end of the text.
    stop = np.flatnonzero(SPACE[data])
    ends = offsets[rows + 1].copy()
    if len(stop):
        at = np.searchsorted(stop, places)
        ends = np.minimum(ends, np.where(at < len(stop), stop[np.minimum(at, len(stop) - 1)], len(data)))
    last = LOWER[data[ends - 1]].astype(np.uint64)
    before = np.where(ends - 1 > places, LOWER[data[np.maximum(ends - 2, 0)]], 0).astype(np.uint64)
    classes = mix(last * np.uint64(257) + before + np.uint64(1)) >> np.uint64(64 - BITS)
    # Tokens of a row: its words, then its end. The context of the first is the beginning, of class 0.
    all_rows = np.concatenate([rows, np.arange(n)])
    order = np.argsort(all_rows, kind="stable")
    words = np.concatenate([hashes, np.full(n, _END)])[order] >> np.uint64(BITS)
    own = np.concatenate([classes, np.zeros(n, np.uint64)])[order]
    context = np.concatenate([[_BEGIN], (words[:-1] << np.uint64(BITS)) | own[:-1]])
    all_rows = all_rows[order]
    context[np.concatenate([[True], all_rows[1:] != all_rows[:-1]])[: len(context)]] = _BEGIN
    return all_rows, context[: len(words)], words


def _pair(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(mix(before) + word)


def _in_class(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of a word in the class of the context; the low bits are the class."""
    return (word << np.uint64(BITS)) | (before & np.uint64(CONTEXTS - 1))


def _class(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64(CONTEXTS - 1)).astype(np.int64)


def _place(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a key. It rises with the key, and all classes of a word are in one."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _sorted_by(of: np.dtype) -> str | None:
    """The field whose differences are kept: keys come sorted, and pairs are sorted by context, as their order says nothing."""
    return next((x for x in ("key", "before") if x in (of.names or ())), None)


def _planes(records: np.ndarray) -> bytes:
    """Differences of what is sorted, then byte by byte of the records, compressed."""
    name, records = _sorted_by(records.dtype), np.array(records)
    if name == "before":
        records = records[np.argsort(records[name])]
    if name:
        records[name][1:] = np.diff(records[name])
    elif records.dtype == _KEY:
        records[1:] = np.diff(records)
    return pa.compress(np.ascontiguousarray(records.view(np.uint8).reshape(len(records), -1).T), "zstd", asbytes=True)


def _from_planes(data: np.ndarray, n: int, of: np.dtype) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, n * of.itemsize, "zstd"), np.uint8)
    records, name = np.ascontiguousarray(planes.reshape(of.itemsize, n).T).reshape(-1).view(of), _sorted_by(of)
    if name:
        records[name] = np.cumsum(records[name], dtype=np.uint64)
    return np.cumsum(records, dtype=np.uint64) if of == _KEY else records


def _packed(to, kind: int, source, ends: np.ndarray, records: np.ndarray) -> pa.RecordBatch:
    """Rows of the records up to each of ``ends``; ``n`` is how many, or 0 if they are not compressed."""
    sizes, n = np.diff(ends, prepend=0), len(ends)
    small = (sizes < _SMALL) | (records.dtype == _BYTE)
    if small.all():
        offsets = np.concatenate([[0], ends * records.dtype.itemsize]).astype(np.int32)
        binary = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(records).view(np.uint8))])
    else:
        binary = pa.array([records[e - k : e].tobytes() if few else _planes(records[e - k : e]) for e, k, few in zip(ends, sizes, small, strict=True)], pa.binary())
    columns = ((to, np.int64), (kind, np.int32), (source, np.int64), (np.where(small, 0, sizes), np.int32))
    return pa.record_batch([*(pa.array(np.broadcast_to(np.asarray(x, t), n)) for x, t in columns), binary], _NAMES)


def _dealt(kind: int, source: int, buckets: int, keys: np.ndarray, records: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each bucket with its part of the records, which are sorted by ``keys``."""
    if len(keys):
        place = _place(keys, buckets)
        begin = np.flatnonzero(begins_run(place))
        yield _packed(place[begin], kind, source, np.append(begin[1:], len(keys)), records)


def _row(to: int, kind: int, records: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(records):
        yield _packed(to, kind, 0, np.array([len(records)]), records)


def _records(kind: np.dtype, *columns: np.ndarray) -> np.ndarray:
    out = np.empty(len(columns[0]), kind)
    for name, x in zip(kind.names, columns, strict=True):
        out[name] = x
    return out


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column, and how many are in each row."""
    data, offsets = buffers(column)
    return data, np.diff(offsets)


@dataclass(frozen=True)
class _Part:
    """Packed rows that follow each other."""

    sources: np.ndarray
    n: np.ndarray
    data: pa.Array

    def records(self, of: np.dtype) -> tuple[np.ndarray, np.ndarray]:
        """The records, and how many are in each row."""
        data, sizes = _bytes(self.data)
        if not self.n.any():
            return data.view(of), sizes // of.itemsize
        rows = zip(np.cumsum(sizes), sizes, self.n, strict=True)
        parts = [_from_planes(data[e - k : e], int(n), of) if n else data[e - k : e].view(of) for e, k, n in rows]
        return np.concatenate(parts), np.where(self.n, self.n, sizes // of.itemsize)


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, _Part]]:
    """Bucket, kind and rows; the rows are sorted."""
    for batch in batches:
        if not batch.num_rows:
            continue
        to, kind, source, n = (batch.column(i).to_numpy() for i in range(4))
        begin = np.flatnonzero(begins_run(to, kind))
        for i, j in zip(begin, np.append(begin[1:], batch.num_rows), strict=True):
            yield int(to[i]), int(kind[i]), _Part(source[i:j], n[i:j], batch.column(4).slice(i, j - i))


class _Held:
    """All packed rows of a bucket."""

    def __init__(self):
        self.parts: dict[int, list[_Part]] = {}
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def records(self, kind: int, of: np.dtype) -> np.ndarray:
        return self.rows(kind, of)[0]

    def table(self, kind: int) -> np.ndarray:
        """A table of the model, decoded once."""
        if kind not in self.tables:
            found = self.records(kind, _TABLES[kind])
            self.tables[kind] = found, np.ascontiguousarray(found if kind == _SINGLE else found["key"])
        return self.tables[kind][0]

    def keys(self, kind: int) -> np.ndarray:
        self.table(kind)
        return self.tables[kind][1]

    def rows(self, kind: int, of: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The records of a kind, of each row its source, and where its records end."""
        parts = self.parts.get(kind, [])
        if not parts:
            return np.zeros(0, of), np.zeros(0, np.int64), np.zeros(0, np.int64)
        records, sizes = (np.concatenate(x) for x in zip(*(p.records(of) for p in parts), strict=True))
        return records, np.concatenate([p.sources for p in parts]), np.cumsum(sizes)


def _grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, _Held]]:
    at, held = None, _Held()
    for to, kind, part in _runs(batches):
        if to != at:
            if at is not None:
                yield at, held
            at, held = to, _Held()
        held.parts.setdefault(kind, []).append(part)
    if at is not None:
        yield at, held


@contextmanager
def _temporary(spark: SparkSession, buckets: int) -> Iterator[None]:
    """As :func:`temporary`; packed rows, which are long, go to Python in batches of few bytes, and several buckets to a file."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "4m")
    try:
        with temporary(spark), in_parts(-(-buckets // _FILE)):
            yield
    finally:
        spark.conf.set(name, before)


def _exchanged(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.repartitionById(buckets, (F.col("to") % buckets).cast("int")).sortWithinPartitions("to", "kind", "source")


def _once(keys: np.ndarray) -> np.ndarray:
    """Each key once, in order; numpy's own way of it hashes and takes fifty times as long."""
    keys = np.sort(keys)
    return keys[begins_run(keys)]


def _inverse(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, and which of them each is."""
    order = np.argsort(keys)
    ordered = keys[order]
    begins = begins_run(ordered)
    of = np.empty(len(keys), np.int32)
    of[order] = np.cumsum(begins) - 1
    return ordered[begins], of


def _sums(keys: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """Each key once, in order, and the sums of the columns."""
    order = np.argsort(keys)
    keys = keys[order]
    begin = np.flatnonzero(begins_run(keys))
    return [keys[begin], *(np.add.reduceat(x[order], begin) if len(begin) else x for x in columns)]


def count(docs: DataFrame, buckets: int, text: str = "text") -> DataFrame:
    """Pairs of context and word by bucket: those seen more than once as ``many``, the others as ``single``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                before, word = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                keys = _pair(before, word)
                order = np.argsort(keys)
                keys = keys[order]
                begin = np.flatnonzero(begins_run(keys))
                n, first = np.diff(np.append(begin, len(keys))), order[begin]
                keys, before, word, many = keys[begin], before[first], word[first], n > 1
                yield from _dealt(_MANY, 0, buckets, keys[many], _records(_CELL, before[many], word[many], n[many]))
                yield from _dealt(_SINGLE, 0, buckets, keys[~many], _records(_TWO, before[~many], word[~many]))

        for whole in batches:
            for batch in blocks(whole):
                held.append(_keys(batch)[1:])
                if sum(len(x) for x, _ in held) >= _HELD:
                    yield from flush()
        yield from flush()

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for to, held in _grouped(batches):
            many, single = held.records(_MANY, _CELL), held.records(_SINGLE, _TWO)
            before, word = (np.concatenate([many[x], single[x]]) for x in ("before", "word"))
            n = np.concatenate([many["n"], np.ones(len(single), np.int64)])
            keys = _pair(before, word)
            order = np.argsort(keys)
            begin = np.flatnonzero(begins_run(keys[order]))
            n, first = np.add.reduceat(n[order], begin), order[begin]
            before, word, several = before[first], word[first], n > 1
            cells = _records(_CELL, before[several], word[several], n[several])
            alone = _records(_TWO, before[~several], word[~several])
            row = {"to": to, "once": len(alone), "twice": int((n == 2).sum())}
            for name, x in (("many", cells), ("single", alone)):
                packed = _packed(to, 0, 0, np.array([len(x)]), x) if len(x) else None
                row |= {f"{name}_n": packed and packed["n"][0].as_py(), name: packed and packed["data"][0].as_py()}
            yield pa.RecordBatch.from_pylist([row], schema)

    ddl = "to bigint, once bigint, twice bigint, many_n int, many binary, single_n int, single binary"
    types = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(name, types[t]) for name, t in map(str.split, ddl.split(", "))])
    parts = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, _DDL)
    return _exchanged(parts, buckets).mapInArrow(pack, ddl)


def _rows_of(cells: DataFrame, column: str, kind: int) -> DataFrame:
    """A column of the buckets of pairs as packed rows."""
    return cells.filter(F.col(column).isNotNull()).selectExpr("to", f"{kind} AS kind", "0L AS source", f"{column}_n AS n", f"{column} AS data")


def _cells(row: pa.RecordBatch, column: str, of: np.dtype) -> np.ndarray:
    """The pairs in a column of one row."""
    n = row[f"{column}_n"].to_numpy(zero_copy_only=False)
    return np.zeros(0, of) if row[column].null_count else _Part(n, n, row[column]).records(of)[0]


def _base(cells: DataFrame, buckets: int) -> DataFrame:
    """Of each context, and of each word in a class, the tokens, the pairs seen once and all pairs; and totals."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                many, single = (_cells(batch.slice(i, 1), name, of) for name, of in (("many", _CELL), ("single", _TWO)))
                before, word = (np.concatenate([many[x], single[x]]) for x in ("before", "word"))
                n = np.concatenate([many["n"], np.ones(len(single), np.int64)])
                one = (n == 1).astype(np.int64)
                for kind, keys in ((_BASE, before), (_BASE_IN, _in_class(before, word))):
                    keys, *sums = _sums(keys, n, one, np.ones(len(keys), np.int64))
                    yield from _dealt(kind, batch.column(0)[i].as_py(), buckets, keys, _records(_SUM, keys, *sums))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for to, held in _grouped(batches):
            for kind in (_BASE, _BASE_IN):
                found = held.records(kind, _SUM)
                found = _records(_SUM, *_sums(*(found[x] for x in _SUM.names)))
                yield from _row(to, kind, found)
            if len(found):
                classes, words = _class(found["key"]), np.diff(np.flatnonzero(begins_run(found["key"] >> np.uint64(BITS))), append=len(found))
                seen = [(x == k).sum() for x in (found["pairs"], words) for k in (1, 2)]
                tables = np.bincount(classes, minlength=CONTEXTS)
                numbers = [np.bincount(classes, found["pairs"], CONTEXTS), tables, [len(words), found["n"].sum(), *seen]]
                yield from _row(to, _TOTALS, np.concatenate(numbers).astype(float).view(_BYTE))

    return _exchanged(cells.drop("once", "twice").mapInArrow(run, _DDL), buckets).mapInArrow(pack, _DDL)


def _word_batches(words: np.ndarray, total: np.ndarray, begin: np.ndarray, contexts: np.ndarray, kept: np.ndarray, arrived: np.ndarray, parent_tables: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(words), 1 << 14):
        j = min(i + (1 << 14), len(words))
        cut = pa.array((begin[i : j + 1] - begin[i]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(cut, pa.array(x[begin[i] : begin[j]])) for x in (contexts, kept)]
        columns = [pa.array(words[i:j]), pa.array(total[i:j]), *lists, pa.array(arrived[i:j]), pa.array(parent_tables[i:j])]
        yield pa.record_batch(columns, ["w", "c", "contexts", "kept", "arrived", "parent_tables"])


@dataclass(frozen=True)
class Totals:
    """Of the restaurants: discounts of words as contexts, of classes and of the parent, customers and tables per class,
    customers and tables of the parent, and the number of words."""

    word_discount: float
    discount: float
    parent_discount: float
    customers: np.ndarray
    tables: np.ndarray
    parent_customers: float
    parent_tables: float
    words: int

    def uniform(self) -> float:
        return 1 / (self.words + 1)

    def parent_new(self) -> float:
        """Weight of a new table in the parent."""
        return STRENGTH + self.parent_discount * self.parent_tables

    def parent_chance(self, numerator):
        """Probability in the parent of a word with this sum of customers less discounts."""
        return (numerator + self.parent_new() * self.uniform()) / (STRENGTH + self.parent_customers)

    def class_chance(self, classes, kept, root):
        """Probability in a class of a word that keeps this there and in the parent."""
        new = STRENGTH + self.discount * self.tables[classes]
        return (kept + new * self.parent_chance(root)) / (STRENGTH + self.customers[classes])


def seat(customers: np.ndarray, new: np.ndarray, discount: float, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Tables after all customers of one dish sat down, and the log of the product of the weights they chose among.

    ``new`` is the weight of a new table. The arrays are sorted by falling number of customers.
    """
    tables, log_weight = np.ones(len(customers)), np.log(new)
    seated, most = 1, int(customers[0]) if len(customers) else 0
    rising = -customers
    while seated < most:
        active = int(np.searchsorted(rising, -seated, "left"))  # those with more customers than are seated
        step = 1 if seated < 64 else seated // 16
        n = np.minimum(customers[:active] - seated, step)
        among = new[:active] + seated + (n - 1) / 2 - discount * tables[:active]
        chance = np.minimum(new[:active] / among, 1)
        opened = random.random(active) < chance if step == 1 else random.binomial(n, chance)
        tables[:active] += opened
        log_weight[:active] += n * np.log(among)
        seated += step
    return tables, log_weight


def sweeps(word: np.ndarray, context: np.ndarray, customers: np.ndarray, totals: Totals, n: int, burn: int, random: np.random.Generator):
    """Averages over ``n`` sweeps after ``burn``: tables of each cell, and per word customers and tables in the parent."""
    n_words = int(word[-1]) + 1 if len(word) else 0
    # A single customer sits alone in every sweep.
    order = np.flatnonzero(customers > 1)
    order = order[np.argsort(-customers[order], kind="stable")]
    customers = customers[order]
    d, d0 = totals.discount, totals.parent_discount
    restaurant = (STRENGTH + d * totals.tables)[context]
    tables, weight = np.ones(len(word)), None
    parent = totals.parent_chance(np.bincount(word, tables, n_words) * (1 - d0))
    sums = [np.zeros(len(word)), np.zeros(n_words), np.zeros(n_words)]
    own, of_word = restaurant[order], word[order]
    for i in range(burn + n):
        got, got_weight = seat(customers, own * parent[of_word], d, random)
        if weight is None:
            tables[order], weight = got, got_weight
        else:
            take = np.log(random.random(len(order))) < got_weight - weight
            tables[order[take]], weight[take] = got[take], got_weight[take]
        arrived = np.bincount(word, tables, n_words)
        first = np.flatnonzero(arrived > 1)
        first = first[np.argsort(-arrived[first], kind="stable")]
        parent_tables = np.ones(n_words)
        parent_tables[first], _ = seat(arrived[first].astype(np.int64), np.full(len(first), totals.parent_new() * totals.uniform()), d0, random)
        parent = totals.parent_chance(arrived - d0 * parent_tables)
        if i >= burn:
            for total, x in zip(sums, (tables, arrived, parent_tables), strict=True):
                total += x / n
    return sums


def _reseated(customers: np.ndarray, new: np.ndarray, discount: float, n: int, burn: int, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Tables of each pair: the average over ``n`` sweeps after ``burn``, and those of the last."""
    order = np.argsort(-customers, kind="stable")
    customers, new = customers[order], new[order]
    mean, now, weight = np.zeros(len(order)), None, None
    for i in range(burn + n):
        got, got_weight = seat(customers, new, discount, random)
        if now is None:
            now, weight = got, got_weight
        else:
            take = np.log(random.random(len(order))) < got_weight - weight
            now[take], weight[take] = got[take], got_weight[take]
        if i >= burn:
            mean += now / n
    out = np.empty((2, len(order)))
    out[:, order] = mean, now
    return out[0], out[1]


def _generator(keys: np.ndarray, round_: int) -> np.random.Generator:
    """The same draws whenever the same keys are sampled in the same round."""
    return np.random.default_rng([round_, int(keys[0]) & 0x7FFFFFFFFFFFFFFF, len(keys)])


def _pairs_seated(cells: DataFrame, state: DataFrame | None, buckets: int, totals: Totals, round_: int, n: int, burn: int, last: bool) -> DataFrame:
    """Sums of the tables of pairs per context, and per word in a class. Without ``state`` each pair has one table."""
    first = state is None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for to, held in _grouped(batches):
            many = held.records(_MANY, _CELL)
            keys = _pair(many["before"], many["word"])
            order = np.argsort(keys)
            keys, many = keys[order], many[order]
            before, of_before = _inverse(many["before"])
            word, of_word = _inverse(_in_class(many["before"], many["word"]))
            if first:
                mean = now = np.ones(len(many))
            else:
                # Answers come by bucket, so in the order of the keys.
                tables, parent = held.records(_BEFORE, _NUMBER), held.records(_WORD, _PARENT)
                chance = totals.class_chance(_class(word), parent["kept"], parent["root"])
                new = (STRENGTH + totals.word_discount * tables)[of_before] * chance[of_word]
                mean, now = _reseated(many["n"], new, totals.word_discount, n, burn, _generator(keys, round_))
                if last:
                    yield from _row(to, _KEPT, _records(_PAIRS, keys, many["n"] - totals.word_discount * mean))
            yield from _dealt(_BEFORE, to, buckets, before, _records(_SEATS, before, np.bincount(of_before, mean, len(before))))
            yield from _dealt(_WORD, to, buckets, word, _records(_SEATS, word, np.bincount(of_word, now, len(word))))

    rows = _rows_of(cells, "many", _MANY)
    if not first:
        rows = _exchanged(rows.union(state.filter(F.col("kind").isin(_BEFORE, _WORD))), buckets)
    return rows.mapInArrow(run, _DDL)


def _parents_seated(seated: DataFrame, base: DataFrame, buckets: int, totals: Totals, round_: int, n: int, burn: int, first: bool, last: bool) -> DataFrame:
    """For the buckets of pairs, the tables of contexts and what words keep in classes and the parent; totals; the state of the last round."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for to, held in _grouped(batches):
            yield from _row(to, _KEPT, held.records(_KEPT, _PAIRS))
            own, (found, sources, ends) = held.records(_BASE, _SUM), held.rows(_BEFORE, _SEATS)
            at = np.searchsorted(own["key"], found["key"])
            tables = own["one"] + np.bincount(at, found["tables"], len(own))
            if len(ends):
                yield _packed(sources, _BEFORE, to, ends, tables[at])
            if last:
                yield from _row(to, _ROOMS, _records(_ROOM, own["key"], own["n"], tables))
            own, (found, sources, ends) = held.records(_BASE_IN, _SUM), held.rows(_WORD, _SEATS)
            if not len(own):
                continue
            at = np.searchsorted(own["key"], found["key"])
            customers = own["one"] + np.rint(np.bincount(at, found["tables"], len(own))).astype(np.int64)
            classes, begin = _class(own["key"]), begins_run(own["key"] >> np.uint64(BITS))
            word, begin = np.cumsum(begin) - 1, np.flatnonzero(begin)
            if first:
                tables, arrived, parent_tables = np.ones(len(own)), np.bincount(word).astype(float), np.ones(len(begin))
            else:
                tables, arrived, parent_tables = sweeps(word, classes, customers, totals, n, burn, _generator(own["key"], round_))
            kept, root = customers - totals.discount * tables, arrived - totals.parent_discount * parent_tables
            if len(ends):
                yield _packed(sources, _WORD, to, ends, _records(_PARENT, kept[at], root[word[at]]))
            numbers = [np.bincount(classes, x, CONTEXTS) for x in (customers, tables)]
            yield from _row(to, _TOTALS, np.concatenate([*numbers, [parent_tables.sum()]]).view(_BYTE))
            if last:
                of_word = (np.add.reduceat(own["n"], begin), arrived, parent_tables)
                yield from _row(to, _IN, _records(_CLASS, own["key"], kept, *(x[word] for x in of_word)))

    return _exchanged(seated.union(base), buckets).mapInArrow(run, _DDL)


def _words(state: DataFrame) -> DataFrame:
    """The words with what the parent and each class keep of their customers after discounts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, part in _runs(batches):
            for i in range(len(part.n)):
                cells, _ = _Part(part.sources[i : i + 1], part.n[i : i + 1], part.data.slice(i, 1)).records(_CLASS)
                words = (cells["key"] >> np.uint64(BITS)).astype(np.int64)
                begin = np.flatnonzero(begins_run(words))
                lists = _class(cells["key"]).astype(np.int32), np.ascontiguousarray(cells["kept"])
                n, *of_parent = (np.ascontiguousarray(cells[x][begin]) for x in ("n", "arrived", "parent_tables"))
                yield from _word_batches(words[begin], n, np.append(begin, len(cells)), *lists, *of_parent)

    ddl = "w bigint, c bigint, contexts array<int>, kept array<float>, arrived double, parent_tables double"
    return state.filter(F.col("kind") == _IN).mapInArrow(run, ddl)


def _collected(rows: DataFrame) -> np.ndarray | None:
    """The sum of the totals, of which one short row per bucket comes to the driver."""
    found = rows.filter(F.col("kind") == _TOTALS).select("data").toArrow()["data"].to_pylist()
    return np.sum([np.frombuffer(x, np.float64) for x in found], axis=0) if found else None


@dataclass(frozen=True)
class Model:
    words: DataFrame  # w, c, contexts, kept, arrived, parent_tables
    single: DataFrame  # pairs seen once, packed
    state: DataFrame  # other pairs, contexts and words, packed
    totals: Totals
    tokens: int
    buckets: int


def _bytes_of(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(f"`{text}`").cast("long")).alias("n")).first()["n"] or 0


def fit(docs: DataFrame, text: str = "text", rounds: int = 2, n: int = 4, burn: int = 3) -> Model:
    """A model of all rows of ``docs``."""
    buckets = max(-(-_bytes_of(docs, text) // _BUCKET), 1)
    with _temporary(docs.sparkSession, buckets):
        with _temporary(docs.sparkSession, buckets):
            cells = materialise(count(docs, buckets, text), "pairs", lasting=True)
        return _fit(cells, buckets, rounds, n, burn)


def _fit(cells: DataFrame, buckets: int, rounds: int, n: int, burn: int) -> Model:
    spark = cells.sparkSession
    with _temporary(spark, buckets):
        base = materialise(_base(cells, buckets), "contexts", lasting=True)
    found, pairs = _collected(base), cells.agg(F.sum("once").alias("once"), F.sum("twice").alias("twice")).first()
    if found is None:
        found = np.zeros(2 * CONTEXTS + 6)
    customers, tables = found[:CONTEXTS], found[CONTEXTS : 2 * CONTEXTS]
    words, tokens, *seen = (int(x) for x in found[2 * CONTEXTS :])
    # Discounts from how many pairs, words in a class, and words are sent up once and twice.
    held = lambda one, two: float(np.clip(one / max(one + 2 * two, 1), 0.1, 0.95))
    totals = Totals(held(pairs["once"] or 0, pairs["twice"] or 0), held(*seen[:2]), held(*seen[2:]), customers, tables, float(tables.sum()), float(words), words)
    base, state = base.filter(F.col("kind") != _TOTALS), None
    for r in range(-1, rounds + 1):
        last = r == rounds
        with _temporary(spark, buckets):
            seated = _pairs_seated(cells, state, buckets, totals, r, n if last else 1, burn, last)
            state = materialise(_parents_seated(seated, base, buckets, totals, r, n if last else 1, burn, r < 0, last), "seated", lasting=True)
            found = _collected(state)
        if found is not None:
            tables = found[CONTEXTS : 2 * CONTEXTS]
            totals = Totals(totals.word_discount, totals.discount, totals.parent_discount, found[:CONTEXTS], tables, float(tables.sum()), found[-1], words)
    state = materialise(state.filter(F.col("kind").isin(_KEPT, _ROOMS, _IN)), "model", lasting=True)
    single = materialise(_rows_of(cells, "single", _SINGLE).mapInArrow(_single_keys, _DDL), "single", lasting=True)
    return Model(_words(state), single, state, totals, tokens, buckets)


def _single_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            pairs, _ = _Part(*(batch.column(j).slice(i, 1).to_numpy() for j in (2, 3)), batch.column(4).slice(i, 1)).records(_TWO)
            yield from _row(batch.column(0)[i].as_py(), _SINGLE, np.sort(_pair(pairs["before"], pairs["word"])))


def _bucket(c: Column) -> Column:
    return F.floor(8 * F.log2(c)).cast("int")


def _found(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the sorted ``keys`` each asked one is, and whether it is among them."""
    if not len(keys):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return at, keys[at] == asked


@dataclass(frozen=True)
class _Asked:
    """What a chunk of texts asks: the rows of its tokens by pair, how often it has each, and each context and word in a
    class once, with which of them the pairs have; all in the order of the keys."""

    rows: np.ndarray
    times: np.ndarray
    pairs: int
    contexts: np.ndarray
    context: np.ndarray
    words: np.ndarray
    word: np.ndarray


def _texts(chunk: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of a chunk, in the blocks that came in."""
    yield from pa.ipc.open_stream(pa.py_buffer(chunk))


def _asked(texts: Iterable[pa.RecordBatch]) -> _Asked:
    tokens, n = [], 0
    for batch in texts:
        rows, before, word = _keys(batch)
        tokens.append(((rows + n).astype(np.int32), before, word))
        n += batch.num_rows
    rows, before, word = (np.concatenate(x) for x in zip(*tokens, strict=True))
    del tokens
    keys = _pair(before, word)
    order = np.argsort(keys)
    keys = keys[order]
    begin = np.flatnonzero(begins_run(keys))
    rows, keys, times, first = rows[order], keys[begin], np.diff(np.append(begin, len(keys))), order[begin]
    before, word = before[first], word[first]
    return _Asked(rows, times, len(keys), *_inverse(before), *_inverse(_in_class(before, word)))


def _chunks(texts: DataFrame) -> DataFrame:
    """Rows of ids and texts in chunks, each of which has a number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, made = [], 0, TaskContext.get().partitionId() << 32

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size, made
            if held:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as out:
                    for batch in held:
                        out.write_batch(batch)
                texts = np.frombuffer(sink.getvalue(), _BYTE)
                yield _packed(made, _CHUNKS, 0, np.array([len(texts)]), texts)
                held, size, made = [], 0, made + 1

        for whole in batches:
            for batch in blocks(whole):
                held.append(batch)
                size += len(_bytes(batch.column(1))[0]) + batch.num_rows
                if size >= _CHUNK:
                    yield from flush()
        yield from flush()

    return texts.mapInArrow(run, _DDL)


_TABLES = {_SINGLE: _KEY, _KEPT: _PAIRS, _ROOMS: _ROOM, _IN: _CLASS}


def _tables(model: Model, kinds: tuple[int, ...], parts: int) -> DataFrame:
    """Tables of the model, each bucket divided in ``parts``."""
    rows, buckets = model.state.union(model.single).filter(F.col("kind").isin(*kinds)), model.buckets * parts

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, kind, part in _runs(batches):
            for i in range(len(part.n)):
                records, _ = _Part(part.sources[i : i + 1], part.n[i : i + 1], part.data.slice(i, 1)).records(_TABLES[kind])
                yield from _dealt(kind, 0, buckets, records if kind == _SINGLE else records["key"], records)

    return rows.mapInArrow(run, _DDL) if parts > 1 else rows


def _answers(rows: DataFrame, buckets: int, t: Totals) -> DataFrame:
    """For each row that asks, the answers in the order of its keys."""

    def of_pairs(held: _Held, asked: np.ndarray) -> np.ndarray:
        answer = np.where(_found(held.keys(_SINGLE), asked)[1], 1 - t.word_discount, 0).astype(np.float32)
        place, hit = _found(held.keys(_KEPT), asked)
        answer[hit] = held.table(_KEPT)["kept"][place[hit]]
        return answer

    def of_contexts(held: _Held, asked: np.ndarray) -> np.ndarray:
        place, hit = _found(held.keys(_ROOMS), asked)
        answer, found = np.zeros(len(asked), _SEEN), held.table(_ROOMS)[place[hit]]
        for name in _SEEN.names:
            answer[name][hit] = found[name]
        return answer

    def of_words(held: _Held, asked: np.ndarray) -> np.ndarray:
        keys, answer = held.keys(_IN), np.zeros(len(asked), _KNOWN)
        if len(keys):
            # The first class in which the word may be; any class of the word has what is the word's.
            place = np.minimum(np.searchsorted(keys, asked >> np.uint64(BITS) << np.uint64(BITS)), len(keys) - 1)
            known = keys[place] >> np.uint64(BITS) == asked >> np.uint64(BITS)
            found = held.table(_IN)[place[known]]
            answer["n"][known] = found["n"]
            answer["root"][known] = found["arrived"] - t.parent_discount * found["parent_tables"]
        place, hit = _found(keys, asked)
        answer["kept"][hit] = held.table(_IN)["kept"][place[hit]]
        return answer

    answer = {_PAIR: of_pairs, _BEFORE: of_contexts, _WORD: of_words}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, _Held()
        for to, kind, part in _runs(batches):
            if to != at:
                # Tables come first in a bucket, so what asks need not be held.
                at, held = to, _Held()
            if kind in _TABLES:
                held.parts.setdefault(kind, []).append(part)
            else:
                asked, sizes = part.records(_KEY)
                yield _packed(part.sources, kind, to, np.cumsum(sizes), answer[kind](held, asked))

    return _exchanged(rows, buckets).mapInArrow(run, _DDL)


def score(docs: DataFrame, model: Model, doc: str = "doc_id", text: str = "text", smooth: float = 0.1) -> DataFrame:
    """Per row: id, ``n_tokens``, ``n_known``, ``base_score`` and ``score``, both log10 of the probability of the text."""
    t, spark = model.totals, docs.sparkSession
    # A corpus much larger than what the model learned from divides its buckets.
    parts = max(_bytes_of(docs, text) // (2 * model.buckets * _BUCKET), 1)
    buckets = model.buckets * parts
    base_total = model.tokens + smooth * (t.words + 1)

    # The most frequent words, as whole buckets of counts, of which there are few hundred.
    sizes = sorted(((r["b"], r["n"]) for r in model.words.groupBy(_bucket(F.col("c")).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    least, held = 1 << 30, 0
    for bucket, n in sizes:
        if held + n > FREQUENT:
            break
        least, held = bucket, held + n
    often = model.words.filter(_bucket(F.col("c")) >= least).select("w", "c", "contexts", "kept", (F.col("arrived") - t.parent_discount * F.col("parent_tables")).alias("root")).toArrow().combine_chunks()
    w, c = (often[k].to_numpy() for k in ("w", "c"))
    kept = np.zeros((len(w), CONTEXTS))
    if len(w):
        contexts = often["contexts"].combine_chunks()
        row = np.repeat(np.arange(len(w)), np.diff(contexts.offsets.to_numpy()))
        kept[row, contexts.flatten().to_numpy()] = often["kept"].combine_chunks().flatten().to_numpy()
    chance = t.class_chance(np.arange(CONTEXTS), kept, often["root"].to_numpy()[:, None]).astype(np.float32)
    order = np.argsort(w)
    shared = spark.sparkContext.broadcast((w[order].astype(np.uint64), chance[order], np.log10((c[order] + smooth) / base_total)))

    def contexts_and_words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        _, before, word = _keys(batch)
        return _once(before), _once(_in_class(before, word))

    def ask(batches: Iterable[pa.RecordBatch], pairs: bool) -> Iterator[pa.RecordBatch]:
        for source, _, part in _runs(batches):
            for i in range(len(part.n)):
                texts = _bytes(part.data.slice(i, 1))[0]
                if pairs:
                    keys = _once(np.concatenate([_pair(*_keys(x)[1:]) for x in _texts(texts)]))
                    yield from _dealt(_PAIR, source, buckets, keys, keys)
                else:
                    before, word = (_once(np.concatenate(x)) for x in zip(*map(contexts_and_words, _texts(texts)), strict=True))
                    yield from _dealt(_BEFORE, source, buckets, before, before)
                    word = word[~_found(shared.value[0], word >> np.uint64(BITS))[1]]
                    yield from _dealt(_WORD, source, buckets, word, word)

    def tell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, chances, bases = shared.value
        for _, held in _grouped(batches):
            texts = list(_texts(held.records(_CHUNKS, _BYTE)))
            asked, ids = _asked(texts), [x.column(0) for x in texts]
            n = sum(map(len, ids))
            place, hit = _found(often, asked.words >> np.uint64(BITS))
            rare, seen, kept = held.records(_WORD, _KNOWN), held.records(_BEFORE, _SEEN), held.records(_PAIR, np.dtype("f4"))
            if (len(kept), len(seen), len(rare)) != (asked.pairs, len(asked.contexts), (~hit).sum()):
                raise RuntimeError("a chunk has not got all its answers")
            classes = _class(asked.words)
            of_class, base, known = np.empty(len(hit)), np.empty(len(hit)), hit.copy()
            of_class[hit], base[hit] = chances[place[hit], classes[hit]], bases[place[hit]]
            of_class[~hit] = t.class_chance(classes[~hit], rare["kept"].astype(float), rare["root"].astype(float))
            base[~hit], known[~hit] = np.log10((rare["n"] + smooth) / base_total), rare["n"] > 0
            # What a context keeps of the word, if it was seen there, and what comes from the class.
            new = STRENGTH + t.word_discount * seen["tables"].astype(float)
            chance = (kept + new[asked.context] * of_class[asked.word]) / (STRENGTH + seen["n"])[asked.context]
            per_token = lambda x: np.bincount(asked.rows, np.repeat(x, asked.times), n)  # noqa: E731, B023
            columns = [pa.array(np.bincount(asked.rows, minlength=n)), pa.array(np.rint(per_token(known[asked.word])).astype(np.int64))]
            columns += [pa.array(per_token(base[asked.word])), pa.array(per_token(np.log10(chance)))]
            yield pa.record_batch([pa.concat_arrays(ids), *columns], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    texts = docs.select(F.col(f"`{doc}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    numbers = [StructField(x, LongType()) for x in ("n_tokens", "n_known")] + [StructField(x, DoubleType()) for x in ("base_score", "score")]
    schema = StructType([StructField("doc_id", texts.schema["doc_id"].dataType), *numbers])
    with _temporary(spark, buckets):
        # The numbers of chunks are those of their tasks, which must not be joined.
        with in_parts(0):
            chunks = materialise(_chunks(texts), "chunks")
        told = chunks
        # Pairs first and the others then, so that fewer rows are on disk at once.
        for kinds in ((_SINGLE, _KEPT), (_ROOMS, _IN)):
            with _temporary(spark, buckets):
                rows = chunks.mapInArrow(partial(ask, pairs=_KEPT in kinds), _DDL)
                answers = _answers(_tables(model, kinds, parts).union(rows), buckets, t)
                told = told.union(materialise(answers, "answers", lasting=True))
        scored = materialise(_exchanged(told, buckets).mapInArrow(tell, schema), "scored", lasting=True)
    return scored
