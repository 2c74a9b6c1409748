"""A factorisation machine that scores the quality of texts.

Features are hashed words, statistics of the structure of the text in bins, and metadata in bins. Each feature has a
weight and a short vector; every pair of features adds the product of their vectors, which costs linear time because the
sum over pairs is half of the square of the sum less the sum of the squares.

Weights are fitted on a bounded sample of about ``max_rows`` labelled rows, chosen by a hash of the id; scores cover all
rows and whole texts. Null and empty texts are scored from their structure and metadata alone. Rows without id or label are
never learned from; a repeated id is learned from once, with the smallest of its labels. Without labels all
scores are one half.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.textops import SPACE, blocks, buffers, per_row, rows_of, word_hashes

WORDS, RANK, BINS = 1 << 15, 8, 32
STATS = 11
WIDTH = WORDS + STATS * BINS

_CLASSES = {
    "capital": np.isin(np.arange(256), np.arange(65, 91)),
    "digit": np.isin(np.arange(256), np.arange(48, 58)),
    "symbol": np.isin(np.arange(256), list(b"#*$%&|<>")),
    "stop": np.isin(np.arange(256), list(b".!?")),
    "shout": np.isin(np.arange(256), list(b"!")),
}


def _share(part: np.ndarray, whole: np.ndarray, times: float) -> np.ndarray:
    """``part`` per ``whole`` in bins that widen; 0 is a bin of its own."""
    value = part / np.maximum(whole, 1)
    return np.where(part == 0, 0, 1 + np.clip(np.log2(1 + value * times) * 3, 0, BINS - 2)).astype(np.int64)


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines, and lines equal to an earlier one, of each text."""
    total, equal = [], []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        lines = [x for x in data[a:b].tobytes().split(b"\n") if x.strip()]
        total.append(len(lines))
        equal.append(len(lines) - len(set(lines)))
    return np.array(total, np.int64), np.array(equal, np.int64)


def vectors(batch: pa.RecordBatch, text: str, meta: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of all features of a batch, sorted by row."""
    n = batch.num_rows
    data, offsets = buffers(batch.column(batch.schema.get_field_index(text)))
    hashes, places = word_hashes(data, offsets, lower=True)
    keys, counts = np.unique(rows_of(places, offsets) * WORDS + (hashes >> np.uint64(49)).astype(np.int64), return_counts=True)
    row, word = keys // WORDS, keys % WORDS
    value = np.log1p(counts).astype(np.float32)
    norm = np.sqrt(np.bincount(row, value * value, n))
    value = value / np.maximum(norm, 1e-9)[row]

    n_words = np.bincount(rows_of(places, offsets), minlength=n)
    chars = per_row(~SPACE[data], offsets)
    lines, equal = _lines(data, offsets)
    kinds = {k: per_row(table[data], offsets) for k, table in _CLASSES.items()}
    declared = np.zeros(n)
    if meta is not None:
        declared = np.nan_to_num(np.array(batch.column(batch.schema.get_field_index(meta)).cast(pa.float64()).to_numpy(zero_copy_only=False), float), nan=-1.0)
    stats = [
        np.clip(np.log2(1 + n_words) * 2, 0, BINS - 1),
        np.clip(chars / np.maximum(n_words, 1) * 2, 0, BINS - 1),
        _share(kinds["symbol"], n_words, 30),
        _share(kinds["capital"], chars, 30),
        _share(kinds["digit"], chars, 30),
        _share(kinds["stop"], n_words, 30),
        _share(kinds["shout"], n_words, 30),
        _share(equal, lines, 30),
        np.clip(np.bincount(row, minlength=n) / np.maximum(n_words, 1) * 16, 0, 16) + (n_words >= 50) * 15,
        np.clip(np.log2(1 + lines) * 3, 0, BINS - 1),
        np.where(declared < 0, 0, 1 + np.clip(np.log2(1 + np.maximum(declared, 0)), 0, BINS - 2)),
    ]
    bins = np.stack([s.astype(np.int64) for s in stats], 1) + WORDS + np.arange(STATS) * BINS
    rows = np.concatenate([row, np.repeat(np.arange(n), STATS)])
    order = np.argsort(rows, kind="stable")
    ones = np.full(n * STATS, 0.5, np.float32)
    return rows[order], np.concatenate([word, bins.ravel()])[order], np.concatenate([value.astype(np.float32), ones])[order]


class Machine:
    """Weights of the machine; ``margins`` scores many rows at once."""

    def __init__(self, bias: float = 0.0, weight: np.ndarray | None = None, factor: np.ndarray | None = None) -> None:
        small = np.random.default_rng(5).normal(0, 0.02, (WIDTH, RANK)).astype(np.float32)
        self.bias = np.float32(bias)
        self.weight = np.zeros(WIDTH, np.float32) if weight is None else weight
        self.factor = small if factor is None else factor

    def margins(self, n: int, row: np.ndarray, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Linear part plus, per factor, half of (the square of the sum less the sum of the squares)."""
        if not len(row):
            return np.full(n, self.bias, float)
        begin = np.searchsorted(row, np.arange(n))  # every row has its statistics, so none is empty
        scaled = self.factor[feature] * value[:, None]
        sums, squares = np.add.reduceat(scaled, begin), np.add.reduceat(scaled * scaled, begin)
        return self.bias + np.add.reduceat(self.weight[feature] * value, begin) + 0.5 * (sums * sums - squares).sum(1)

    def fit(self, rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 5, rate: float = 0.1) -> None:
        """Logistic loss, one row at a time, each weight with its own falling step."""
        seen_w, seen_v = np.full(WIDTH, 1e-2, np.float32), np.full((WIDTH, RANK), 1e-2, np.float32)
        seen_b, random = np.float32(1e-2), np.random.default_rng(13)
        for _ in range(epochs):
            for i in random.permutation(len(rows)):
                label, f, x = rows[i]
                v = self.factor[f]
                sums = x @ v
                margin = self.bias + self.weight[f] @ x + 0.5 * (sums @ sums - ((v * x[:, None]) ** 2).sum())
                slope = np.float32(1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label)
                step_w = slope * x + 1e-5 * self.weight[f]
                step_v = slope * (x[:, None] * sums - v * (x * x)[:, None]) + 1e-5 * v
                seen_w[f] += step_w * step_w
                seen_v[f] += step_v * step_v
                seen_b += slope * slope
                self.weight[f] -= rate * step_w / np.sqrt(seen_w[f])
                self.factor[f] -= rate * step_v / np.sqrt(seen_v[f])
                self.bias -= rate * slope / np.sqrt(seen_b)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, doc: str = "doc_id", text: str = "text", meta: str | None = None, label: str = "quality", max_rows: int = 6000) -> Machine | None:
    """A machine from the rows of ``docs`` where ``learn`` holds and that are labelled 0 or 1."""
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit("quality"), "id"), 11) * F.lit(2.0**-53)
    known = labels.select(F.col(f"`{doc}`").alias("id"), F.col(f"`{label}`").alias("label")).filter("id is not null and label in (0, 1)")
    n = known.count()
    if not n:
        return None
    # About max_rows rows of an id and a label, so small enough to broadcast.
    picked = known.filter(drawn < min(1.0, max_rows / n)).groupBy("id").agg(F.min("label").alias("label"))
    columns = [F.col(f"`{doc}`").alias("id"), F.col(f"`{text}`").alias("text"), (F.col(f"`{meta}`") if meta else F.lit(0)).alias("meta")]
    sample = docs.filter(learn).select(*columns).join(F.broadcast(picked), "id").dropDuplicates(["id"])

    def sparse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                row, feature, value = vectors(batch, "text", "meta")
                begin = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
                lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(begin), pa.array(x, kind))
                yield pa.record_batch([batch.column(0), lists(feature, pa.int32()), lists(value, pa.float32())], ["label", "features", "vals"])

    got = sample.select(F.col("label").cast("int").alias("label"), "text", "meta").mapInArrow(sparse, "label int, features array<int>, vals array<float>").toArrow()
    rows = [(y, f.values.to_numpy(), x.values.to_numpy()) for y, f, x in zip(got["label"].to_pylist(), got["features"], got["vals"], strict=True)]
    machine = Machine()
    machine.fit(sorted(rows, key=lambda r: (r[0], len(r[1]), r[1].tobytes())))
    return machine


def score(docs: DataFrame, machine: Machine | None, keep: list[str], text: str = "text", meta: str | None = None) -> DataFrame:
    """The columns ``keep`` as a struct ``row``, with the ``score`` from 0 to 1."""
    # Plain arrays, WIDTH by RANK.
    shared = docs.sparkSession.sparkContext.broadcast(None if machine is None else vars(machine))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = None if shared.value is None else Machine(**shared.value)
        for whole in batches:
            for batch in blocks(whole):
                n = batch.num_rows
                margins = np.zeros(n) if m is None else m.margins(n, *vectors(batch, "text", "meta"))
                scores = 1 / (1 + np.exp(-np.clip(margins.astype(float), -30, 30)))
                yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64())], ["row", "score"])

    columns = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("text")]
    rows = docs.select(*columns, (F.col(f"`{meta}`") if meta else F.lit(0)).alias("meta"))
    return rows.mapInArrow(run, T.StructType([rows.schema["row"]]).add("score", "double"))
