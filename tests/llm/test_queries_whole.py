"""The registered queries over whole tables, against plain versions, round trips and held-out rows."""

import base64
import collections
import hashlib
import math
import zlib

import brute
import pytest

import __spark_entry__
from starloom.llm import quality_rules

FOLDER = "/root/testdata/sf0.001"
QUERIES = __spark_entry__.queries()


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet").collect()


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, "documents")


def run(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_all_are_registered():
    numbers = [int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op") and n[2].isdigit()]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in QUERIES


def test_op1(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op1_language_id")}
    assert len(got) == len(docs)
    held = [r for r in docs if crc(r.doc_id) % 3 == 1]
    assert all(got[r.doc_id].held_out == (crc(r.doc_id) % 3 == 1) for r in docs)
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_op2(spark):
    pages = table(spark, "pages")
    got = {r.page_id: r for r in run(spark, "op2_warc")}
    first = {}
    for r in pages:
        first[r.html or ""] = min(r.page_id, first.get(r.html or "", r.page_id))
    assert len(got) == len(pages)
    for r in pages:
        payload, response = (r.html or "").encode(), first[r.html or ""]
        revisit = response != r.page_id
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        expected = (len(payload), digest, "revisit" if revisit else "response", response if revisit else None)
        g = got[r.page_id]
        assert (g.payload_bytes, g.payload_digest, g.record_type, g.refers_to) == expected


def test_op3(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op3_quality_fm")}
    assert len(got) == len(docs)
    quality = {r.doc_id: r.quality for r in table(spark, "labels")}
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in got.values())
    assert all(r.predicted == (r.score >= 0.7) for r in got.values())
    held = [(r.score, quality[r.doc_id]) for r in got.values() if r.held_out and quality.get(r.doc_id) is not None]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    pairs = [(g > b) + (g == b) / 2 for g in good for b in bad]
    assert not pairs or sum(pairs) / len(pairs) > 0.8


def test_op4(spark):
    urls = {r.page_id: r.url for r in table(spark, "pages")}
    got = run(spark, "op4_url_filter")
    assert len(got) == len(urls)
    for r in got:
        host, path = brute.host_path(urls[r.page_id])
        rule, verdict = brute.url_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


def test_op5(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op5_pitman_yor")}
    tokens = {r.doc_id: brute.lower(r.text or "").encode().split() + [b"\n"] for r in docs}
    counts = collections.Counter(t for d, ts in tokens.items() if crc(d) % 10 for t in ts)
    n, v = sum(counts.values()), len(counts)
    held = [0.0, 0.0]
    for d, ts in tokens.items():
        g, base = got[d], sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(ts), sum(t in counts for t in ts), n)
        assert g.held_out == (crc(d) % 10 == 0) and g.base_score == pytest.approx(base) and g.score < 0
        if g.held_out:
            held = [held[0] + g.base_score, held[1] + g.score]
    assert held[1] > held[0]


def test_op6(spark, docs):
    texts = {r.doc_id: r.text for r in docs}
    got = run(spark, "op6_quality_rules")
    assert len(got) == len(docs)
    for r in got:
        counts = brute.text_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (r.base_failed and r.kept)
    quality = {r.doc_id: r.quality for r in table(spark, "labels")}
    good = [r for r in got if quality.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.95 * len(good)
    # The verdict is Bayes' rule on the votes, with what fits the votes of the texts that pass the base.
    judged = quality_rules.judge(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    votes = {r.doc_id: r.votes.asDict() for r in judged.select("row.doc_id", "votes").collect()}
    passed = [votes[r.doc_id] for r in got if not r.base_failed]
    names = list(passed[0])
    cast = spark.createDataFrame([tuple(v.values()) for v in passed], ", ".join(f"{n} int" for n in names))
    model = quality_rules.fit(cast, names, quality_rules.KINDS)
    for r in got:
        p = brute.posterior(votes[r.doc_id], model.shares, model.votes)
        assert r.quality == pytest.approx(p) and r.kept == (not r.base_failed and p >= 0.5)


def test_op7(spark, docs):
    expected = brute.removed_bytes([(r.doc_id, r.text) for r in docs])
    assert sorted(tuple(r) for r in run(spark, "op7_suffix_dedup")) == sorted(expected)


def test_op8(spark, docs):
    got = run(spark, "op8_mixing")
    assert {tuple(r) for r in got} == {tuple(r) for r in run(spark, "op8_mixing")}
    source = {r.doc_id: r.source for r in docs}
    sizes, taken, target, largest = collections.Counter(), collections.Counter(), {}, collections.Counter()
    words = {r.doc_id: len(brute.words(r.text)) for r in docs}
    for r in got:
        s = source[r.doc_id]
        assert r.size == words[r.doc_id] and 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        sizes[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        largest[s] = max(largest[s], r.size)
    assert target == pytest.approx(brute.mix_targets(sizes))
    assert all(r.source_size == sizes[source[r.doc_id]] for r in got)
    assert all(abs(taken[s] - target[s]) <= 0.51 * largest[s] for s in sizes)


def test_op9(spark, docs):
    items = [(r.item_id, r.text) for r in table(spark, "benchmark")]
    expected = brute.hit_items([(r.doc_id, r.text) for r in docs], items)
    assert any(x[5] for x in expected)
    assert sorted(tuple(r) for r in run(spark, "op9_winnowing")) == sorted(expected)


def test_op10(spark, docs):
    expected = brute.components([(r.doc_id, r.text) for r in docs])
    assert any(x[0] != x[2] for x in expected)
    assert sorted(tuple(r)[:3] for r in run(spark, "op10_jaccard_join")) == sorted(expected)


def test_pipeline(spark, docs):
    """Each stage against a plain version of what it has to do to its own input."""
    import corpus_pipeline

    now = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = now.columns
    items = [(r.item_id, r.text) for r in table(spark, "benchmark")]
    for name, stage in corpus_pipeline.STAGES:
        before = now.collect()
        after = stage(spark, now, FOLDER)
        rows = after.collect()
        pairs = [(r.doc_id, r.text) for r in before]
        if name != "mixing":
            assert after.columns == columns
        ids = [r.doc_id for r in rows]
        if name == "quality_rules":
            assert 0 < len(rows) < len(before) and {tuple(r) for r in rows} <= {tuple(r) for r in before}
        elif name == "jaccard_join":
            assert sorted(ids) == sorted(d for d, _, c in brute.components(pairs) if d == c)
        elif name == "suffix_dedup":
            gone = {x[0]: x for x in brute.removed_bytes(pairs)}
            text = dict(pairs)
            assert set(ids) <= set(text)
            for r in rows:
                assert (r.text == text[r.doc_id]) == (gone[r.doc_id][2] == 0)
                assert len(r.text.encode()) <= gone[r.doc_id][1] - gone[r.doc_id][2]
        elif name == "winnowing":
            assert sorted(ids) == sorted(x[0] for x in brute.hit_items(pairs, items) if not x[5])
        else:
            assert after.columns == [*columns, "copy"] and max(collections.Counter(ids).values()) <= 3
        now = spark.createDataFrame(rows, after.schema)
    assert rows and run(spark, "pipeline")
