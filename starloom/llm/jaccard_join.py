"""An exact similarity join on sets of word n-grams, by prefix trees.

All n-grams are put in one global order, rare ones first. Of two sets with a Jaccard similarity of at least ``T`` each has
one of the other's among its first few n-grams, its prefix; sets that share an n-gram there are compared. Against one set,
many others are compared in one walk over their prefix tree: sets are sorted by their ordered n-grams, so that those
with a common beginning share the overlap counted for it, and a branch is left as soon as what remains of the sets
is too short to reach the overlap they need.

The order needs no exact counts, only the same ones everywhere: it comes from a table of ``CELLS`` counters over all n-grams
of all documents. Equal sets are one class from the start. Of the classes that share a prefix n-gram, the one with the most
company is a pivot and compared with the others. Then all pairs of others that share one, but no component yet, and have
enough prefix n-grams in common are compared. So a group of near copies costs about one comparison each, and no pair is
left out that could connect two components.

Before sets are compared, lengths and the number of common prefix n-grams have to allow the similarity. Texts of fewer
than ``N`` words are one n-gram as a whole. Null and empty texts have an empty set and are linked with nothing, not
even with each other. Rows without id take part; a component without any id has none.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import connected
from starloom.llm.textops import begins_run, blocks, buffers, from_six_bytes, mix, rows_of, six_bytes, word_hashes
from starloom.llm.tables import few_files, in_parts, joined, materialise, release, temporary

N, T = 5, 75
CELLS, RANGES = 1 << 21, 64
HELD = 1 << 19  # n-grams that a task gathers before it counts or sends them
MANY = 8  # classes of an n-gram that a task sends to its bucket
BITS, _BUCKET = 1 << 25, 1 << 15  # of a filter of rows, and of one of Spark's bitmaps
LIST, BLOCK = 4096, 1 << 14  # members of a list, and n-grams asked for in a block
SHARE = 1 << 22  # n-grams for which a table gets a file, 32 MB of them
_48 = np.uint64((1 << 48) - 1)
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def gram_sets(batch: pa.RecordBatch, n: int = N) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of the n-grams of each text in the column ``text``."""
    data, offsets = buffers(batch.column(batch.schema.get_field_index("text")))
    hashes, places = word_hashes(data, offsets, lower=True)
    first = np.searchsorted(rows_of(places, offsets), np.arange(batch.num_rows + 1))
    with np.errstate(over="ignore"):
        grams = hashes.copy()
        for k in range(1, n):
            grams[: len(grams) - k] = mix(grams[: len(grams) - k] * _FACTOR + hashes[k:]) if k < len(grams) else 0
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= n:
                yield np.unique(grams[a : b - n + 1])
            elif b > a:
                whole = np.uint64(b - a)
                for h in hashes[a:b]:
                    whole = mix(whole * _FACTOR + h)
                yield np.array([whole], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def class_of(grams: np.ndarray) -> int:
    """A number for a set, the same for equal sets."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(mix(grams + np.uint64(1))) if len(grams) else np.uint64(0)
        return int(mix(np.array([total ^ mix(np.uint64(len(grams)) * _FACTOR)], np.uint64)).view(np.int64)[0])


def ordered(grams: np.ndarray, magnitudes: np.ndarray) -> np.ndarray:
    """The n-grams as numbers in the global order: the magnitude of their counter, then their hash."""
    magnitude = magnitudes[(grams >> np.uint64(43)).astype(np.int64)].astype(np.uint64)
    return np.sort((magnitude << np.uint64(57)) | (grams >> np.uint64(7)))


def prefix_size(n: np.ndarray | int, t: int = T):
    """How many of ``n`` ordered n-grams contain one of every set similar enough."""
    return n - (t * n + 99) // 100 + 1


def _needed(n: Column, m: Column, t: int = T) -> Column:
    """The overlap of sets of these sizes at the least similarity."""
    return F.ceil(t * (n + m) / (100 + t))


def classes(docs: DataFrame, text: str) -> tuple[DataFrame, np.ndarray]:
    """Per row ``rid``, class and size; and the table of counters, as the binary digits that each has."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, seen, names = np.zeros(CELLS, np.uint32), set(), ["rid", "cls", "n", "part", "blob"]
        held: list[np.ndarray] = []

        def add_up() -> None:
            cells[:] += np.bincount((np.concatenate(held) >> np.uint64(43)).astype(np.int64), minlength=CELLS).astype(np.uint32)
            held.clear()

        for whole in batches:
            for batch in blocks(whole):
                out = []
                for grams in gram_sets(batch):
                    cls = class_of(grams)
                    out.append((cls, len(grams)))
                    if cls not in seen:
                        seen.add(cls)
                        held.append(grams)
                if sum(map(len, held)) >= HELD:
                    add_up()
                if len(seen) > 1 << 17:
                    seen.clear()
                found = np.array(out, np.int64).reshape(-1, 2)
                none = [pa.nulls(len(found), pa.int32()), pa.nulls(len(found), pa.binary())]
                yield pa.record_batch([batch.column(0), pa.array(found[:, 0]), pa.array(found[:, 1]), *none], names)
        if held:
            add_up()
        if cells.any():
            packed = [zlib.compress(x.tobytes(), 1) for x in cells.reshape(RANGES, -1)]
            empty = pa.nulls(RANGES, pa.int64())
            yield pa.record_batch([empty, empty, empty, pa.array(range(RANGES), pa.int32()), pa.array(packed, pa.binary())], names)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = np.frombuffer(zlib.decompress(blob.as_py()), np.uint32).astype(np.uint64)
                sums[part] = sums[part] + counts if part in sums else counts
        for part, counts in sums.items():
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())], ["part", "blob"])

    rows = docs.select(_rid(docs), F.col(f"`{text}`").alias("text"))
    both = materialise(few_files(rows).mapInArrow(run, "rid bigint, cls bigint, n bigint, part int, blob binary"), "classes")
    # RANGES rows in all: more tasks than can run at once only start more Python.
    parts = both.filter("blob is not null").select("part", "blob").repartition("part").coalesce(docs.sparkSession.sparkContext.defaultParallelism)
    cells = np.zeros((RANGES, CELLS // RANGES), np.uint64)
    for r in parts.mapInArrow(add, "part int, blob binary").collect():  # CELLS counters in all, whatever the input
        cells[r["part"]] = np.frombuffer(zlib.decompress(r["blob"]), np.uint64)
    magnitudes = np.log2(1 + cells.ravel().astype(np.float64)).astype(np.uint8)
    return both.filter("blob is null").select("rid", "cls", "n"), magnitudes


def _rid(docs: DataFrame) -> Column:
    """A number for the row; rows that agree in all columns share it."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("rid")


def _files(sizes: DataFrame) -> int:
    """How many files hold a table of all n-grams, of rows with sets of ``n`` of them; as many at least as tasks run at once."""
    total = sizes.agg(F.sum("n")).first()[0] or 0
    return max(sizes.sparkSession.sparkContext.defaultParallelism, 1 + total // SHARE)


def shared_prefixes(docs: DataFrame, text: str, cells, buckets: int) -> DataFrame:
    """Class and n-gram (``t``, a number that names it) for the n-grams that stand in the prefix of two classes or more.

    All prefixes are dealt to ``buckets`` by n-gram once, packed. An n-gram that a task sees in many classes is known to be
    shared there: its rows go through as they are, and its bucket gets one of them only.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = cells.value, set()
        held_t: list[np.ndarray] = []
        held_c: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held_t:
                return
            t, c = np.concatenate(held_t), np.concatenate(held_c)
            held_t.clear()
            held_c.clear()
            bucket = (t % np.uint64(buckets)).astype(np.int64)
            t &= _48
            order = np.lexsort((c, t, bucket))
            t, c, bucket = t[order], c[order], bucket[order]
            group = np.cumsum(begins_run(bucket, t)) - 1
            many = (np.bincount(group) > MANY)[group]
            out = []
            for known, keep in ((False, ~many | begins_run(bucket, t)), (True, many)):
                at = np.flatnonzero(keep)
                for part in np.split(at, np.flatnonzero(np.diff(bucket[at])) + 1):
                    if len(part):
                        out.append((int(bucket[part[0]]), known, six_bytes(t[part]), c[part].tobytes()))
            kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
            yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], ["bucket", "known", "t", "c"])

        for whole in batches:
            for batch in blocks(whole):
                for grams in gram_sets(batch):
                    cls = class_of(grams)
                    if len(grams) and cls not in seen:
                        seen.add(cls)
                        held_t.append(ordered(grams, table)[: prefix_size(len(grams))])
                        held_c.append(np.full(len(held_t[-1]), cls))
                if len(seen) > 1 << 17:
                    seen.clear()
                if sum(map(len, held_t)) >= HELD:
                    yield from flush()
        yield from flush()

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        passed: list[np.ndarray] = []  # the n-grams of the bucket of which rows went through
        now = None

        def emit(bucket: int, t: np.ndarray, c: np.ndarray, again: np.ndarray) -> Iterator[pa.RecordBatch]:
            name = mix(t ^ (np.uint64(bucket) << np.uint64(48))).view(np.int64)
            for i in range(0, len(c), 1 << 16):
                yield pa.record_batch([pa.array(x[i : i + (1 << 16)]) for x in (name, c, again)], ["t", "cls", "again"])

        def flush(bucket: int) -> Iterator[pa.RecordBatch]:
            if held:
                t, c = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                order = np.lexsort((c, t))
                t, c = t[order], c[order]
                once = begins_run(t, c)
                t, c = t[once], c[once]
                group = np.cumsum(begins_run(t)) - 1
                shared = (np.bincount(group) > 1)[group]
                t, c = t[shared], c[shared]
                yield from emit(bucket, t, c, np.isin(t, np.concatenate(passed)) if passed else np.zeros(len(t), bool))
            passed.clear()

        for batch in batches:
            for bucket, known, t, c in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                if bucket != now:
                    if now is not None:
                        yield from flush(now)
                    now = bucket
                rows = from_six_bytes(t), np.frombuffer(c, np.int64)
                if known:
                    passed.append(np.unique(rows[0]))
                    yield from emit(bucket, *rows, np.ones(len(rows[0]), bool))
                else:
                    held.append(rows)
        if now is not None:
            yield from flush(now)

    packed = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "bucket int, known boolean, t binary, c binary")
    dealt = packed.repartition("bucket").sortWithinPartitions("bucket")
    met = materialise(joined(dealt).mapInArrow(meet, "t bigint, cls bigint, again boolean"), "met")
    # A bucket tells each row once, but for n-grams of which rows went through: only these are shuffled again.
    again = materialise(met.filter("again").select("t", "cls").distinct(), "again")
    return met.filter("not again").select("t", "cls").unionByName(again)


def row_filter(rows: DataFrame) -> np.ndarray:
    """A bit for every remainder of ``rid`` modulo ``BITS``, set where one of the rows has it; of fixed size, whatever the input."""
    cell = (F.pmod("rid", F.lit(BITS)) + 1).alias("cell")  # buckets of Spark's bitmaps begin at 1
    parts = rows.select(cell).groupBy(F.bitmap_bucket_number("cell").alias("part"))
    bits = np.zeros((BITS // _BUCKET, _BUCKET // 8), np.uint8)
    for r in parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")).collect():
        bits[r["part"] - 1] = np.frombuffer(r["bits"], np.uint8)
    return bits.ravel()


def may_have(bits: np.ndarray, rid: np.ndarray) -> np.ndarray:
    """Whether the rows of the filter can include these: none that they include is missed."""
    cell = rid % BITS
    return bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1 == 1


def fetch_sets(docs: DataFrame, text: str, wanted: DataFrame, cells) -> DataFrame:
    """The ordered n-grams of the ``wanted`` classes (``cls`` and the ``rid`` of a row that has it).

    Only texts that the filter lets through, the wanted and a few by chance, are shuffled.
    """
    bits = docs.sparkSession.sparkContext.broadcast(row_filter(wanted))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            batch = batch.filter(pa.array(may_have(bits.value, batch.column(0).to_numpy())))
            packed = [packer.compress((x.as_py() or "").encode()) for x in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(packed, pa.binary())], ["rid", "z"])

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, opener = cells.value, zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                few = batch.slice(i, 256)
                texts = [opener.decompress(x.as_py()) for x in few.column(1)]
                for part in blocks(pa.record_batch([few.column(0), pa.array(texts, pa.binary())], ["cls", "text"])):
                    sets = [ordered(g, table).astype(">u8").tobytes() for g in gram_sets(part)]
                    yield pa.record_batch([part.column(0), pa.array(sets, pa.binary())], ["cls", "grams"])

    rows = docs.select(_rid(docs), F.col(f"`{text}`").alias("text")).mapInArrow(pack, "rid bigint, z binary")
    # Of rows that agree in all columns one is enough; they are together already, and sets are larger than texts.
    found = rows.join(wanted, "rid").dropDuplicates(["rid"])
    return joined(found.select("cls", "z")).mapInArrow(unpack, "cls bigint, grams binary")


def tree_overlaps(pivot: np.ndarray, sets: list[np.ndarray], t: int = T, step: int = 64) -> Iterator[tuple[int, int]]:
    """Index and overlap with ``pivot`` of those ``sets`` that are similar enough; all are in the global order.

    The sets are sorted as sequences, which is a walk over their prefix tree: the overlap up to the node that a set
    branches off at is taken over from the set before.
    """
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    # Overlap after each n-gram of the set before, as far as it was walked.
    path, counts = np.zeros(0, np.uint64), np.zeros(1, np.int64)
    size = len(pivot)
    for i in order:
        grams = sets[i]
        n = len(grams)
        need = -(-t * (n + size) // (100 + t))
        common = min(len(path), n, len(counts) - 1)
        differ = np.flatnonzero(path[:common] != grams[:common])
        at = int(differ[0]) if len(differ) else common
        walked = [counts[: at + 1]]
        overlap = int(counts[at])
        path = grams
        while True:
            behind = int(np.searchsorted(pivot, grams[at - 1], "right")) if at else 0
            if overlap + min(n - at, size - behind) < need:
                break
            if at == n:
                yield i, overlap
                break
            edge = grams[at : at + step]
            place = np.minimum(np.searchsorted(pivot, edge), size - 1)
            walked.append(overlap + np.cumsum(pivot[place] == edge))
            overlap = int(walked[-1][-1])
            at += len(edge)
        counts = np.concatenate(walked)


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (``a``, ``b``) of classes that are similar enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            out: list[int] = []
            order = np.argsort(a, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(a[order])) + 1):
                if len(part):
                    read = lambda col, i: np.frombuffer(batch.column(col)[int(i)].as_py(), ">u8").astype(np.uint64)  # noqa: B023, E731
                    similar = tree_overlaps(read(2, part[0]), [read(3, i) for i in part])
                    out.extend(int(part[k]) for k, _ in similar)
            yield pa.record_batch([pa.array(a[out]), pa.array(b[out])], ["u", "v"])

    left = pairs.join(sets.select(F.col("cls").alias("b"), F.col("grams").alias("of_b")), "b")
    right = left.join(sets.select(F.col("cls").alias("a"), F.col("grams").alias("of_a")), "a")
    return joined(right.select("a", "b", "of_a", "of_b")).mapInArrow(run, "u bigint, v bigint")


def _slim(docs: DataFrame, doc: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))


class _Search:
    """The links found so far, and the n-grams fetched to find them."""

    def __init__(self, docs: DataFrame, cells, sized: DataFrame, profiles: DataFrame) -> None:
        self.docs, self.cells, self.sized, self.profiles = docs, cells, sized, profiles
        self.sets: DataFrame | None = None
        self.links: DataFrame | None = None
        self.member: DataFrame | None = None

    def possible(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose lengths and common prefix n-grams allow the similarity."""
        side = lambda x: self.profiles.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("common").alias(f"common_{x}"))
        met = pairs.distinct().join(side("b"), "b").join(side("a"), "a")
        n, m = F.col("n_a"), F.col("n_b")
        fits = 100 * F.least(n, m) >= T * F.greatest(n, m)
        # What lies behind the prefix of the set whose prefix ends first can overlap as a whole.
        behind = F.ceil(T * F.greatest(n, m) / 100) - 1
        enough = F.size(F.array_intersect("common_a", "common_b")) >= _needed(n, m) - behind
        return met.filter(fits & enough).select("a", "b")

    def verified(self, pairs: DataFrame) -> DataFrame | None:
        """Compares the pairs; the components of all links so far, None without any."""
        pairs = materialise(pairs, "pairs")
        if pairs.isEmpty():
            return self.member
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
        wanted = wanted if self.sets is None else wanted.join(self.sets, "cls", "left_anti")
        wanted = materialise(wanted.join(self.sized, "cls").select("cls", "rid"), "wanted")
        new = materialise(fetch_sets(self.docs, "text", wanted, self.cells), "sets")
        release(self.docs.sparkSession)
        self.sets = new if self.sets is None else self.sets.unionByName(new)
        found = materialise(verify(pairs, self.sets), "links")
        self.links = found if self.links is None else self.links.unionByName(found)
        self.member = connected(self.links)
        return self.member


def _unconnected(groups: DataFrame, member: DataFrame | None, sized: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of classes that share an n-gram ``t`` but no component, and whose lengths and number of common n-grams
    allow the similarity; with the component ``of_b`` and how far the number exceeds the least (``spare``).

    In every group the classes outside its largest component are the ones to ask for. They are gathered in blocks by the
    component they have most to do with, and each block gets the members of all their groups, in pieces of about ``LIST``
    where a group is large. What is counted inside a block are numbers in arrays; only pairs that can be similar come out.
    """
    if member is None:
        labelled = groups.withColumn("component", F.col("cls"))
    else:
        known = groups.join(member.withColumnRenamed("node", "cls"), "cls", "left")
        labelled = known.select("t", "cls", F.coalesce("component", "cls").alias("component"))
    labelled = materialise(labelled, "labelled")
    parts = labelled.groupBy("t", "component").agg(F.count(F.lit(1)).alias("n"))
    open_ = parts.groupBy("t").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"), F.sum("n").alias("m"), F.count(F.lit(1)).alias("k")
    )
    pieces = F.greatest(F.lit(0), F.ceil(F.log2(F.col("m") / LIST))).cast("int").alias("bits")
    open_ = materialise(open_.filter("k > 1").select("t", "largest", "m", pieces), "open")
    alive = materialise(labelled.join(open_, "t").join(sized.select("cls", "n"), "cls"), "alive")

    asking = alive.filter("component <> largest").select("cls").distinct()
    asked = alive.join(materialise(asking, "asking"), "cls").groupBy("cls").agg(
        F.collect_list("t").alias("ts"),
        F.first("component").alias("component"),
        F.first("n").alias("n"),
        F.max_by("largest", F.struct("m", "largest")).alias("home"),
        F.max("bits").alias("bits"),
    )
    asked = materialise(asked, "asked")
    homes = asked.groupBy("home").agg(F.sum(F.size("ts")).alias("load"), F.max("bits").alias("home_bits"))
    block = F.pmod(F.xxhash64("cls"), F.ceil(F.col("load") / BLOCK)).alias("block")
    asked = asked.join(materialise(homes, "homes"), "home").select("home", block, "home_bits", "cls", "component", "n", "ts")
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.expr("shiftleft(1L, home_bits) - 1"))).alias("cut")
    asked = materialise(asked.select("*", cut), "asked-blocks")

    low = F.expr("shiftleft(1L, bits) - 1")
    lists = alive.groupBy("t", "bits", F.col("cls").bitwiseAND(low).alias("piece")).agg(
        F.collect_list(F.struct("cls", "n", "component")).alias("members")
    )
    lists = materialise(lists, "lists")
    needs = asked.select("home", "block", "home_bits", "cut", F.explode("ts").alias("t")).distinct().join(open_.select("t", "bits"), "t")
    needs = needs.withColumn("piece", F.col("cut").bitwiseAND(low)).drop("bits")
    given = needs.join(lists, ["t", "piece"]).select(
        *[F.col(c).alias(f"to_{c}") for c in ("home", "block", "cut")],
        "t",
        *[F.col(f"members.{c}").alias(c) for c in ("cls", "n", "component")],
    )

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            held = {
                t: [x.values.to_numpy() for x in lists_]
                for t, *lists_ in zip(right["t"].to_pylist(), right["cls"], right["n"], right["component"], strict=True)
            }
            mask, cut_ = (1 << left["home_bits"][0].as_py()) - 1, left["cut"][0].as_py()
            for cls, own, n, ts in zip(*[left[c].to_pylist() for c in ("cls", "component", "n")], left["ts"], strict=True):
                # A list that is cut into pieces can have none here.
                found = [held[t] for t in ts.values.to_pylist() if t in held]
                if not found:
                    continue
                other, m, component = (np.concatenate(x) for x in zip(*found, strict=True))
                here = ((other & mask) == cut_) & (component != own) & (100 * np.minimum(n, m) >= T * np.maximum(n, m))
                other, at, common = np.unique(other[here], return_index=True, return_counts=True)
                m, component = m[here][at], component[here][at]
                least = -(-T * (n + m) // (100 + T)) - (-(-T * np.maximum(n, m) // 100) - 1)
                fits = common >= least
                for column, x in zip(out, (np.full(fits.sum(), cls), other[fits], component[fits], (common - least)[fits]), strict=True):
                    column.append(x)
        columns = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in out]
        return pa.table(columns, names=["a", "b", "of_b", "spare"])

    met = asked.groupBy("home", "block", "cut").cogroup(given.groupBy("to_home", "to_block", "to_cut"))
    return met.applyInArrow(count, "a bigint, b bigint, of_b bigint, spare bigint")


def label(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``rid`` (a number for id and text), ``doc_id``, the size ``n`` of its set, its class ``cls`` and ``component``, the
    smallest class that is reached by links."""
    with temporary(docs.sparkSession):
        slim = _slim(docs, doc, text)
        by_row, counters = classes(slim, "text")
        with in_parts(_files(by_row)):
            labelled = _labelled(slim, by_row, counters)
        return materialise(few_files(labelled), "rows", lasting=True)


def _labelled(slim: DataFrame, by_row: DataFrame, counters: np.ndarray) -> DataFrame:
    cells = slim.sparkSession.sparkContext.broadcast(counters)
    sized = by_row.filter("n > 0").groupBy("cls").agg(F.min("n").alias("n"), F.min("rid").alias("rid"))
    sized = materialise(sized, "sizes")

    buckets = 8 * int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = shared_prefixes(slim, "text", cells, buckets)
    release(slim.sparkSession)
    sizes = materialise(groups.groupBy("t").agg(F.count(F.lit(1)).alias("m")), "group-sizes")
    weighed = groups.join(sizes, "t").groupBy("cls").agg(F.collect_list("t").alias("common"), F.sum("m").alias("weight"))
    profiles = materialise(weighed.join(sized, "cls"), "profiles")
    search = _Search(slim, cells, sized, profiles)

    # The class with the most company is the pivot of its groups: of near copies mostly the text that they come from.
    heaviest = F.max(F.struct("weight", "cls"))["cls"].alias("pivot")
    pivots = materialise(groups.join(profiles.select("cls", "weight"), "cls").groupBy("t").agg(heaviest), "pivots")
    rest = materialise(groups.join(pivots, "t").filter("cls <> pivot"), "rest")
    member = search.verified(search.possible(rest.select(F.col("pivot").alias("a"), F.col("cls").alias("b"))))

    # Pairs of others that share an n-gram and are not connected yet: the most promising one per class and component
    # first, then what is still not connected.
    others = materialise(_unconnected(rest.select("t", "cls"), member, sized), "others")
    best = others.groupBy("a", "of_b").agg(F.max_by("b", F.struct("spare", "b")).alias("b")).select("a", "b")
    member = search.verified(best)
    if member is not None:
        left = others.select("a", "b").join(best, ["a", "b"], "left_anti")
        for side in ("a", "b"):
            known = member.select(F.col("node").alias(side), F.col("component").alias(f"in_{side}"))
            left = left.join(known, side, "left").withColumn(f"in_{side}", F.coalesce(f"in_{side}", side))
        others = left.filter("in_a <> in_b").select("a", "b")
    member = search.verified(others.select("a", "b"))

    rows = slim.select("doc_id", _rid(slim)).join(by_row.dropDuplicates(["rid"]), "rid")
    if member is None:
        rows = rows.withColumn("component", F.col("cls"))
    else:
        rows = rows.join(member.withColumnRenamed("node", "cls"), "cls", "left")
    return rows.select("rid", "doc_id", "n", "cls", F.coalesce("component", "cls").alias("component"))


def link(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, ``n_shingles``, the class (``cls``, null for an empty set) and ``component_id``: the smallest id that is
    reached by links."""
    rows = label(docs, doc, text)
    least = rows.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    files = _files(rows)
    with in_parts(files):
        least = materialise(least, "least")
    out = rows.join(least, "component", "left").coalesce(files)
    empty = F.col("n") == 0
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        F.when(~empty, F.col("cls")).alias("cls"),
    )


def keep_one(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The row with the smallest id of every component, with its columns. Rows with an empty set all stay; rows that repeat id and text
    are one document."""
    with temporary(docs.sparkSession):
        rows = label(docs, doc, text)
        first = F.min_by("rid", F.struct(F.col("doc_id").isNull(), "doc_id", "rid"))
        with in_parts(_files(rows)):
            kept = rows.filter("n > 0").groupBy("component").agg(first.alias("rid")).select("rid")
            kept = materialise(kept.unionByName(rows.filter("n = 0").select("rid")).distinct(), "kept")
            times = materialise(rows.groupBy("rid").agg(F.count(F.lit(1)).alias("times")), "times")
            gone = materialise(times.join(kept, "rid", "left_anti").select("rid"), "gone", lasting=True)
            twice = materialise(times.filter("times > 1").join(kept, "rid", "left_semi").select("rid"), "twice", lasting=True)
    # What goes is the shorter list; only rows that repeat have to meet.
    rid = F.xxhash64(f"`{doc}`", f"`{text}`").alias("rid")
    left = docs.select(F.struct("*").alias("row"), rid).join(gone, "rid", "left_anti")
    once, more = left.join(twice, "rid", "left_anti"), left.join(twice, "rid", "left_semi")
    return once.unionByName(more.dropDuplicates(["rid"])).select("row.*")
