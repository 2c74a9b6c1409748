"""Language identification by error-correcting output codes.

Every language has a codeword. One binary classifier per bit, logistic on the character n-grams of a text, predicts
that bit; decoding takes the language whose codeword loses least against all predictions, each bit weighted by
how often its classifier was right on that language. Two codewords almost as near make the text ambiguous.

The classifiers are fitted on a bounded sample of labelled rows: about ``max_rows`` in all, shared out evenly over the
languages, chosen by a hash of the id. Everything else covers all rows and whole texts. Null texts, and texts without a
letter, are ``und`` with score 0, as are all texts if nothing was labelled. Rows without id or language are never
learned from; all rows are predicted, repeated ones alike.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
WIDTH, LONGEST = 1 << 14, 4
_PIECE = 1 << 20  # characters worked on at once
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of 1 to 4 characters of a text, words set apart; None without a letter."""
    counts = None
    with np.errstate(over="ignore"):
        for at in range(0, len(text or ""), _PIECE):
            codes = np.frombuffer(text[max(0, at - LONGEST) : at + _PIECE].lower().encode("utf-32-le", "replace"), np.uint32)
            letter = _letter_table()[codes]
            if not letter.any():
                continue
            keep = letter.copy()
            keep[1:] |= letter[:-1]
            codes = np.where(letter, codes, 32)[keep].astype(np.uint32)
            codes = np.concatenate([[np.uint32(32)], codes, [np.uint32(32)]])
            counts = np.zeros(WIDTH, np.int64) if counts is None else counts
            hashed = np.zeros(len(codes), np.uint32)
            for n in range(1, min(LONGEST, len(codes)) + 1):
                hashed = (hashed[: len(codes) - n + 1] + codes[n - 1 :]) * np.uint32(0x9E3779B1)
                hashed ^= hashed >> np.uint32(15)
                counts += np.bincount((hashed * np.uint32(0x85EBCA77)) >> np.uint32(18), minlength=WIDTH)
    return counts


def features(counts: np.ndarray) -> np.ndarray:
    """Square roots of the shares: a vector of length 1 whatever the length of the text."""
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A row of -1 and 1 for each of ``n`` languages: all splits of few languages, else the best of random codes."""
    if n <= 6:
        columns = [c for c in itertools.product((-1, 1), repeat=n) if c[0] == 1 and min(c) < 0]
        return np.array(columns, np.float32).reshape(-1, n).T
    random, best, found = np.random.default_rng(seed), -1, None
    for _ in range(200):
        code = random.choice(np.array([-1, 1], np.float32), (n, max(15, int(np.ceil(10 * np.log2(n))))))
        code = code[:, np.abs(code.sum(0)) < n]
        apart = min((code[i] != code[j]).sum() for i, j in itertools.combinations(range(n), 2))
        if apart > best:
            best, found = apart, code
    return found


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # language by bit
    weights: np.ndarray  # n-gram by bit
    bias: np.ndarray
    trust: np.ndarray  # language by bit, rows sum to 1

    def losses(self, x: np.ndarray) -> np.ndarray:
        """The weighted logistic loss of each language's codeword against the predicted bits."""
        bits = x @ self.weights + self.bias
        return (self.trust * np.logaddexp(0, -self.code * bits)).sum(1)


def fit_model(rows: list[tuple[str, np.ndarray, np.ndarray]], epochs: int = 6, rate: float = 0.5) -> Model | None:
    """From (language, n-grams, values) of each sampled text. A fifth of them only tells how far to trust a bit."""
    languages = sorted({r[0] for r in rows})
    if not languages:
        return None
    code = codewords(len(languages))
    bits, of = code.shape[1], {lang: i for i, lang in enumerate(languages)}
    weights, bias = np.zeros((WIDTH, bits), np.float32), np.zeros(bits, np.float32)
    seen, seen_bias = np.full((WIDTH, bits), 1e-3, np.float32), np.full(bits, 1e-3, np.float32)
    order = np.random.default_rng(11).permutation(len(rows))
    learn = [i for k, i in enumerate(order) if k % 5 or len(rows) < 50]
    for _ in range(epochs):
        for i in learn:
            lang, grams, values = rows[i]
            want = code[of[lang]]
            margin = np.clip(want * (values @ weights[grams] + bias), -30, 30)
            slope = -want / (1 + np.exp(margin))
            step = values[:, None] * slope + 1e-5 * weights[grams]
            seen[grams] += step * step
            weights[grams] -= rate * step / np.sqrt(seen[grams])
            seen_bias += slope * slope
            bias -= rate * slope / np.sqrt(seen_bias)
    right = np.ones((len(languages), bits), np.float32)
    cast = np.ones((len(languages), 1), np.float32)
    for lang, grams, values in (rows[i] for i in (order if len(rows) < 50 else order[::5])):
        right[of[lang]] += code[of[lang]] * (values @ weights[grams] + bias) > 0
        cast[of[lang]] += 1
    trust = right / cast
    return Model(languages, code, weights, bias, trust / np.maximum(trust.sum(1, keepdims=True), 1e-9))


def fit(docs: DataFrame, learn: Column, doc: str = "doc_id", lang: str = "lang", text: str = "text", max_rows: int = 3000):
    """A model from the rows of ``docs`` where ``learn`` holds and the language is known."""
    labelled = docs.filter(learn).select(
        F.col(f"`{doc}`").alias("id"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")
    )
    labelled = labelled.filter("id is not null and lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return None
    share = max_rows / len(counts)
    rates = F.create_map(*[F.lit(x) for lang_, n in counts.items() for x in (lang_, min(1.0, share / n))])
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit("language"), "id"), 11) * F.lit(2.0**-53)
    sample = labelled.filter(drawn < F.element_at(rates, F.col("lang"))).dropDuplicates(["id"])

    def sparse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counted = gram_counts(value.as_py())
                if counted is not None:
                    grams = np.flatnonzero(counted)
                    out.append((name, grams.astype(np.int32), features(counted)[grams]))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.record_batch(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.list_(pa.int32())), pa.array(columns[2], pa.list_(pa.float32()))],
                ["lang", "grams", "vals"],
            )

    got = sample.select("lang", "text").mapInArrow(sparse, "lang string, grams array<int>, vals array<float>").toArrow()
    rows = [
        (name, grams.values.to_numpy(), vals.values.to_numpy())
        for name, grams, vals in zip(got["lang"].to_pylist(), got["grams"], got["vals"], strict=True)
    ]
    return fit_model(sorted(rows, key=lambda r: (r[0], len(r[1]), r[2].tobytes())))


def predict(docs: DataFrame, model: Model | None, keep: list[str], text: str = "text", near: float = 0.1) -> DataFrame:
    """The columns ``keep`` with ``lang_pred``, ``score``, ``second`` (the next language) and ``ambiguous`` (whether its
    codeword loses less than ``near`` more)."""
    # Plain arrays, of languages by bits and n-grams by bits.
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else vars(model))

    def decode(m: Model | None, value: str | None) -> tuple:
        counted = gram_counts(value)
        if m is None or counted is None:
            return UNKNOWN, 0.0, None, False
        losses = m.losses(features(counted))
        order = np.argsort(losses, kind="stable")
        odds = np.exp(-8 * (losses - losses[order[0]]))
        second = int(order[1]) if len(order) > 1 else None
        return (
            m.languages[order[0]],
            float(1 / odds.sum()),
            None if second is None else m.languages[second],
            second is not None and bool(losses[second] - losses[order[0]] < near),
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = None if shared.value is None else Model(**shared.value)
        for batch in batches:
            out = [decode(m, value.as_py()) for value in batch.column(1)]
            lang, score, second, unsure = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.record_batch(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(second, pa.string()), pa.array(unsure, pa.bool_())],
                ["row", "lang_pred", "score", "second", "ambiguous"],
            )

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([rows.schema["row"]]).add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, schema.add("second", "string").add("ambiguous", "boolean"))
