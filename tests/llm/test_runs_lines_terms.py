"""Periodic runs, repeated lines and divergences of sources, against plain versions."""

import hashlib
import random

import brute
import numpy as np
import pytest
from test_edges import EDGE, documents, got, same

import __spark_entry__
from starloom.llm import divergence, line_dedup, periodic_runs

FOLDER = "/root/testdata/sf0.001"
QUERIES = __spark_entry__.queries()


def table(spark, name="documents"):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet").collect()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Periodic runs


def random_words(rng):
    n = rng.choice([0, 1, 5, 8, 30, 100, 300])
    w = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(n)]
    if n > 20 and rng.random() < 0.7:
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 3))
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        if rng.random() < 0.3:
            w[rng.randrange(n)] = 77
    return w


@pytest.mark.parametrize(("exponent", "least"), [(2, 1), (2, 6), (3, 1), (4, 6)])
def test_runs_of_random_words(exponent, least):
    rng = random.Random(exponent * 10 + least)
    for _ in range(250):
        texts = [random_words(rng) for _ in range(rng.randint(1, 4))]
        counts = np.array([len(t) for t in texts])
        found = periodic_runs.find_runs(np.array([x for t in texts for x in t], np.int64), counts, exponent, least)
        expected = [(d, *r) for d, t in enumerate(texts) for r in brute.runs(t, exponent, least)]
        assert sorted(map(tuple, found.tolist())) == sorted(expected)


def test_runs_of_long_texts():
    """One word a million times, all texts without runs between, and two words that never overlap themselves."""
    one = periodic_runs.find_runs(np.zeros(10**6, np.int64), np.array([10**6]))
    assert one.tolist() == [[0, 0, 10**6, 1]]
    cycle = periodic_runs.find_runs(np.arange(300_000) % 1000, np.array([1000, 299_000]))
    assert cycle.tolist() == [[1, 0, 299_000, 1000]]
    thue_morse = np.array([bin(i).count("1") % 2 for i in range(1 << 16)])
    assert not len(periodic_runs.find_runs(thue_morse, np.array([1 << 16]), exponent=3, least=1))
    rng = np.random.default_rng(1)
    assert not len(periodic_runs.find_runs(rng.integers(0, 30000, 10**6), np.array([10**6])))


def test_runs_of_edges(spark):
    shorter = [(d, t and t[:20000]) for d, t in EDGE]
    rows = [*shorter, (12, "a b " * 3), (13, "a b\n" * 4 + "c"), (14, "a a a a a b"), (15, "\x1ca \x1ca \x1ca \x1ca \x1ca \x1ca")]
    found = periodic_runs.runs_of(documents(spark, rows))
    plain = [(d, w, brute.runs(w)) for d, t in rows for w in [brute.words(t)]]
    same(
        [(r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in got(found, "row.doc_id", "n_words", "runs", "collapsed")],
        [(d, len(w), f, brute.collapsed(w, f)) for d, w, f in plain],
    )
    assert found.select("row.*").columns == documents(spark, []).columns
    assert periodic_runs.runs_of(documents(spark, [])).collect() == []
    with pytest.raises(ValueError, match="two periods"):
        periodic_runs.runs_of(documents(spark, []), exponent=1)


def test_op11(spark):
    docs = table(spark)
    found = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, FOLDER).collect()}
    assert len(found) == len(docs) and sum(r.n_runs > 0 for r in found.values()) > 5
    for r in docs:
        w = brute.planted_words(r.doc_id, r.text)
        runs = brute.runs(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        f = found[r.doc_id]
        told = sha("".join(f"{s},{n},{p}\n" for s, n, p in runs))
        assert (f.n_runs, f.start, f.length, f.period) == (len(runs), *best)
        assert f.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert (f.runs_sha256, f.collapsed_sha256) == (told, sha(brute.collapsed(w, runs)))


# Repeated lines


def test_lines_of_edges(spark):
    long, other = "This line is long enough to count", "ÀÉ long line beyond ASCII, ÀÉÎ"
    rows = [
        *EDGE,
        (21, f"{long}\nshort\n{long.upper()}  \n\t{other}"),
        (22, f" {long}\r\nshort\n\n"),
        (23, f"{long.lower()}\nshort\n{other.lower()}"),  # beyond ASCII capitals are other letters
        (24, f"a\n{long}x\n"),
        (24, f"{long}x\nb"),  # one document in two rows, so two documents hold this line
        (25, f"{long}x"),
        (None, f"{long}\n{other}"),
        (26, "x" * 19 + "\n" + "é" * 10),
        (27, "x" * 19 + "\n" + "é" * 10),
        (28, "x" * 19 + "\n" + "é" * 10),
        (29, "\n".join(f"line {i % 7} of a very long text that repeats" for i in range(20000))),
        (30, "\n".join(f"line {i} of a very long text that repeats" for i in range(7))),
        (31, "line 6 of a very long text that repeats\n \n"),
    ]
    found = line_dedup.dedup_lines(documents(spark, rows))
    same(got(found, "row.doc_id", "n_lines", "n_dropped", "kept"), brute.dedup_lines(rows))
    assert found.select("row.*").columns == documents(spark, []).columns
    twice = line_dedup.dedup_lines(documents(spark, rows), least=5, documents=2)
    same(got(twice, "row.doc_id", "n_lines", "n_dropped", "kept"), brute.dedup_lines(rows, 5, 2))
    assert line_dedup.dedup_lines(documents(spark, [])).collect() == []
    with pytest.raises(ValueError, match="no repeat"):
        line_dedup.dedup_lines(documents(spark, []), documents=1)


def test_hot_lines_in_many_blocks(spark, monkeypatch):
    """A line of a third of all documents, in small blocks and segments, is found wherever it is."""
    monkeypatch.setattr(line_dedup, "BLOCK", 50)
    monkeypatch.setattr(line_dedup, "SEGMENT", 16)
    rows = [(i, "\n".join([f"own line of the document number {i}"] + ["the line that many documents share"] * (i % 3 == 0))) for i in range(600)]
    found = line_dedup.dedup_lines(documents(spark, rows).repartition(5))
    same(got(found, "row.doc_id", "n_lines", "n_dropped", "kept"), brute.dedup_lines(rows))
    assert found.filter("n_dropped = 1").count() == 199


def test_filters_miss_no_repeat():
    """Whatever the order and the pieces, each hash that is there twice is suspected, and few others are."""
    rng = np.random.default_rng(3)
    single = rng.integers(0, 1 << 63, 50_000, dtype=np.uint64)
    hashes = rng.permutation(np.concatenate([single, single[:500], single[:100]]))
    for at_once in (7_000, 1 << 16):
        flags = line_dedup.suspected(hashes, at_once)
        assert flags[np.isin(hashes, single[:500])].all()
        assert flags.sum() < 1100 + 50


def test_only_suspects_are_counted(spark, monkeypatch):
    written = {}
    kept = line_dedup.materialise
    monkeypatch.setattr(line_dedup, "materialise", lambda df, name, **k: written.setdefault(name, kept(df, name, **k)))
    counts = {}
    monkeypatch.setattr(line_dedup, "temporary", lambda spark: _Counting(written, counts))
    rows = [(i, f"own line of the document number {i}\n" + "a line of some documents" * (i < 5)) for i in range(300)]
    line_dedup.dedup_lines(documents(spark, rows)).collect()
    assert counts["line-suspects"] < 15 and counts["line-lost"] == 4


class _Counting:
    """In place of the scope: counts what was written when it ends."""

    def __init__(self, written, counts):
        self.written, self.counts = written, counts

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.counts.update({k: v.count() for k, v in self.written.items()})


# Divergences of sources

TEXTS = [
    ("en", "a", "the cat and the dog"),
    ("en", "a", "the cat sat"),
    ("en", "b", "The dog, the cat! the the"),
    ("en", "b", "x9y Über-über ÜBER_über"),
    ("en", None, "über the cat"),
    ("en", "empty", ""),
    ("en", "empty", None),
    (None, "a", "le chat"),
    (None, "a", "le chat"),
    ("", None, "le chien"),
    ("de", "a", "nur hier"),
    ("de", "c", "und hier"),
    ("fr", "a", None),
]


def rows_of(spark, texts):
    return spark.createDataFrame([(None, t, lang, s, 0, "r", 1, 2) for lang, s, t in texts], "doc_id long, text string, lang string, source string, n_chars long, term string, item int, rank int")


def test_divergences_of_edges(spark):
    for docs in (TEXTS, TEXTS * 3, TEXTS + [("en", "long", "the very long text " * 30000)]):
        same(got(divergence.audit(rows_of(spark, docs)), *"lang source part item value rank".split()), brute.divergences(docs))
    assert divergence.audit(rows_of(spark, [])).collect() == []
    few = divergence.audit(rows_of(spark, TEXTS * 2), min_docs=5, top=1)
    same(got(few, *"lang source part item value rank".split()), brute.divergences(TEXTS * 2, 5, 1))


def test_stripes_spill(spark, monkeypatch):
    """The same result when tables of stripes and of sums are written out again and again."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4))) for _ in range(200)]
    docs = [("en", f"s{min(i % 30, 9)}", " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    monkeypatch.setattr(divergence, "CELLS", 100)
    monkeypatch.setattr(divergence, "DENSE", 50)
    found = divergence.audit(rows_of(spark, docs).repartition(4), top=7)
    same(got(found, *"lang source part item value rank".split()), brute.divergences(docs, top=7))


def test_shares_of_large_counts():
    counts = np.array([0, 5, 10**10, 8 * 10**15], np.int64)
    total = 9 * 10**15
    assert divergence.shares(counts, total).tolist() == [1 + 10**9 * (int(c) + 1) // total for c in counts]


def test_op12_and_op13(spark):
    docs = table(spark)
    lines = QUERIES["op12_line_dedup"](spark, FOLDER).collect()
    assert sorted(map(tuple, lines)) == sorted((*x[:3], sha(x[3])) for x in brute.dedup_lines([(r.doc_id, r.text) for r in docs]))
    found = QUERIES["op13_divergence"](spark, FOLDER).collect()
    assert sorted(map(tuple, found)) == sorted(brute.divergences([(r.lang, r.source, r.text) for r in docs]))
