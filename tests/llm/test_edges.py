"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names, and hot groups, in small tables."""

import collections
import itertools
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import (
    components,
    jaccard_join,
    language_id,
    mixing,
    pitman_yor,
    quality_fm,
    quality_rules,
    suffix_dedup,
    tables,
    textops,
    url_filter,
    warc,
    winnowing,
)

DDL = "doc_id long, text string, lang string, source string, n_chars long, row string, h long, copy string"
SENTENCE = "The quick brown fox jumps over the lazy dog and runs far away into the deep dark forest near the river. "


def documents(spark, rows):
    """(id, text) or (id, text, lang, source) as documents with further columns."""
    full = [(r[0], r[1], *(r[2:4] or ("en", "s")), len(r[1] or ""), "r", 1, "c") for r in rows]
    return spark.createDataFrame(full, DDL)


EDGE = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, SENTENCE * 3),
    (4, SENTENCE * 3),
    (5, SENTENCE * 3),
    (None, SENTENCE * 3),
    (None, None),
    (6, "ÉCOLE Über ñandú " * 8),
    (7, "x" * 60 + SENTENCE),
    (8, "one two"),
    (9, "one two"),
    (10, "word " * 40000),
    (11, "\x00\x01 ''\"\\ \r\n 漢字 😀 e\u0301"),
]


def got(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)


def same(found, expected):
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, expected), key=repr)


@pytest.fixture()
def edge(spark):
    return documents(spark, EDGE)


@pytest.fixture()
def empty(spark):
    return documents(spark, [])


def test_rules(spark, edge, empty):
    judged = quality_rules.judge(edge)
    stats = [f"stats.{n}" for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    same(got(judged, "row.doc_id", *stats), [(d, *brute.text_counts(t)) for d, t in EDGE])
    kept = quality_rules.keep_good(edge)
    assert kept.columns == edge.columns and kept.filter("doc_id in (1, 2, 3)").count() == 0
    assert quality_rules.keep_good(empty).collect() == []


def drawn_votes(rng, shares, tables, n):
    """Rows of votes of the given classes; every tenth vote is withheld."""
    classes, rows = list(shares), []
    for _ in range(n):
        table = tables[rng.choices(classes, [shares[c] for c in classes])[0]]
        rows.append(tuple(None if rng.random() < 0.1 else rng.choices([1, 0, -1], odds)[0] for odds in table.values()))
    return rows


def test_what_votes_are_worth_is_recovered(spark):
    """Two kinds of bad texts with rules that overlap, and a rule that votes at random in every class."""
    clean, noise = (0.97, 0.025, 0.005), (0.5, 0.3, 0.2)
    own, sure = (0.1, 0.5, 0.4), (0.05, 0.25, 0.7)
    shares = {"good": 0.6, "x": 0.2, "y": 0.2}
    tables = {
        "good": dict.fromkeys("abcd", clean) | {"noise": noise},
        "x": {"a": own, "b": sure, "c": clean, "d": clean, "noise": noise},
        "y": {"a": clean, "b": clean, "c": own, "d": sure, "noise": noise},
    }
    rows = drawn_votes(random.Random(4), shares, tables, 20000)
    kinds = {"x": ("a", "b"), "y": ("c", "d")}
    model = quality_rules.fit(spark.createDataFrame(rows, "a int, b int, c int, d int, noise int"), [*"abcd", "noise"], kinds)
    for c, table in tables.items():
        assert model.shares[c] == pytest.approx(shares[c], abs=0.06)
        for rule, odds in table.items():
            # The beginnings are worth 400 rows, beside some 4,000 of a class, and 6,000 beside 12,000 good ones.
            assert model.votes[c][rule] == pytest.approx(odds, abs=0.2 if rule == "noise" else 0.1)


def test_posterior_is_the_plain_one(spark):
    kinds = {"x": ("a", "b"), "y": ("b", "c")}
    model = quality_rules.fit(spark.createDataFrame([(1, 1, 1)] * 90 + [(0, -1, 1)] * 8 + [(1, None, 0)] * 2, "a int, b int, c int"), list("abc"), kinds)
    every = list(itertools.product([1, 0, -1, None], repeat=3))
    rows = spark.createDataFrame(every, "a int, b int, c int").withColumn("p", model.posterior()).collect()
    for r in rows:
        assert r.p == pytest.approx(brute.posterior({n: r[n] for n in "abc"}, model.shares, model.votes))
    nothing = quality_rules.fit(spark.createDataFrame([], "a int, b int, c int"), list("abc"), kinds)
    assert nothing == quality_rules.begin(list("abc"), kinds)


def test_one_weak_blame_is_outvoted_and_two_are_not(spark):
    """On a table of mostly good texts, of which rules blame one in thirty for no reason."""
    rng = random.Random(6)
    names = ["a", "b", "c", "d", "e"]
    kinds = {"x": ("a", "b"), "y": ("c", "d")}
    rows = [tuple(rng.choices([1, 0], [29, 1])[0] for _ in names) for _ in range(2000)]
    rows += [(0, -1, 1, 1, 1), (-1, 0, 1, 1, 1), (-1, -1, 1, 1, 1), (1, 1, -1, -1, 1)] * 30
    model = quality_rules.fit(spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names)), names, kinds)
    judge = lambda *votes: brute.posterior(dict(zip(names, votes, strict=True)), model.shares, model.votes)
    assert judge(1, 1, 1, 1, 1) > 0.9
    assert judge(0, 1, 1, 1, 1) > 0.5 and judge(1, 1, 1, 0, 1) > 0.5
    assert judge(0, 0, 1, 1, 1) < 0.5 and judge(1, 1, 0, 0, 1) < 0.5
    assert judge(-1, None, 1, 1, 1) < 0.5


@pytest.mark.parametrize("n", [240, 1200])
def test_each_trouble_is_enough(spark, n):
    """Shouting, repeated lines and low variety are rejected beside much symbol junk, however many rows there are."""
    rng = random.Random(n)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 7))) for _ in range(2000)]
    prose = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    lines = lambda words: "\n".join(" ".join(words[i : i + 12]) for i in range(0, len(words), 12)) + "."
    good = [lines(prose(rng.randint(40, 80))) for _ in range(n)]
    symbols = [lines([w + rng.choice(["###", "***", " |", "%%%"]) for w in prose(60)]) for _ in range(n // 12)]
    few, cheers = prose(9), ["Yes!", "Oh no", "Go on", "Wow", "Really?"]
    bad = {
        "capitals": lines(prose(60)).upper(),
        "exclamations": lines([w + "!" for w in prose(60)]),
        "shouting": lines([w.upper() + "!!" for w in prose(60)]),
        "lines": "\n".join(x for i in range(30) for x in (cheers[i % 5], " ".join(prose(8)))),
        "variety": lines([rng.choice(few) for _ in range(100)]),
        "doubled": lines([w for w in prose(40) for _ in range(2)]),
        "numbers": lines([str(rng.randint(1, 99999)) if i % 2 else w for i, w in enumerate(prose(60))]),
    }
    texts = [*good, *symbols, *bad.values()]
    df = documents(spark, list(enumerate(texts)))
    kept = {r.doc_id for r in quality_rules.keep_good(df).collect()}
    assert [k for i, k in enumerate(bad, n + n // 12) if i in kept] == []
    assert not kept & set(range(n, n + n // 12)) and len(kept) >= 0.99 * n
    base = quality_rules.judge(df).select("row.doc_id", quality_rules.base_failed().alias("failed"), "votes").collect()
    assert not any(r.failed for r in base)
    blamed = {r.doc_id: {k for k, v in r.votes.asDict().items() if v is not None and v < 1} for r in base}
    assert blamed[n + n // 12] == {"capitals"} and "variety" in blamed[n + n // 12 + 4]


URLS = [None, "", "no scheme", "http://", "https://A.Example.ORG/es/x?y#z", "http://example.org/es", "ftp://notexample.org/en/1",
        "http://example.org/en/17", "http://com/de/", "http://x.com/fr/a/b", "http://org/", "http://org", "http://a.b.org?/es/",
        "http://spam-farm.net/x", "http://a//b://c/d", "http://org:80/", "http://É.com/de/ü"]


def test_urls(spark):
    pages = spark.createDataFrame([(i % 5 or None, u, "h", "p") for i, u in enumerate([*URLS, *URLS])], "page_id long, url string, host string, path string")
    rules = [url_filter.host_rule(r.split()[0], *r.split()[1].replace("/", " /", 1).split()) for r in brute.URL_RULES]
    judged = url_filter.judge_urls(pages, rules)
    expected = []
    for u in [*URLS, *URLS]:
        host, path = brute.host_path(u)
        rule, verdict = brute.url_rule(host, path)
        expected.append((u, host, path, rule, verdict or ("block" if u and "spam-farm" in u else "allow")))
    same(got(judged, "row.url", "host", "path", "rule", "verdict"), expected)
    assert url_filter.judge_urls(pages.limit(0), rules).collect() == []


def test_rules_are_filed_under_the_rarest_token(spark):
    targets = spark.createDataFrame([("a.b/x/",), ("a.c/x/",), ("a.d/y/",)], "target string")
    rules = url_filter.rule_table(spark, [("r", "block", "a.*/y/", ["a", "y"], 1), ("any", "allow", ".*", [], 0)])
    assert got(url_filter.index_rules(rules, targets), "rule", "token") == [("any", ""), ("r", "y")]
    same(got(url_filter.first_rules(targets, rules), "target", "rule"), [("a.b/x/", "any"), ("a.c/x/", "any"), ("a.d/y/", "r")])


def test_winnowing(spark, edge, empty):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 4, 9, 10, 11, 30]))) for i in range(12)] + [(3, "one two"), (None, "ÉCOLE über"), (50, None), (51, "")]
    items += [(i, SENTENCE) for i in (60, 61)]
    docs = EDGE + [(100 + i, " ... ".join([text(40), rng.choice(items)[1] or "", text(5).upper()])) for i in range(25)]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("h", F.lit(1))
    found = winnowing.find_hits(documents(spark, docs), bench)
    expected = [(d, n, hit, k) for d, n, hit, k, _, _ in brute.hit_items(docs, items)]
    same(got(found, "row.doc_id", "n_words", "n_hit", F.size("items")), expected)
    assert winnowing.find_hits(empty, bench).collect() == []
    assert winnowing.find_hits(edge, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert winnowing.keep_clean(edge, bench).columns == edge.columns


def test_mixing(spark, edge, empty):
    rng = random.Random(3)
    docs = [(i, "w " * rng.randint(0, 60), "en", rng.choice(["hot"] * 6 + ["b", "é", None])) for i in range(600)]
    docs += [(i, t, "en", "hot") for i, t in EDGE]
    mixed = mixing.mix(documents(spark, docs)).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()
    assert len(mixed) == len(docs)
    sizes, taken, largest = {}, {}, {}
    for r in mixed:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        largest[r.source] = max(largest.get(r.source, 0), r.size)
        assert 0 <= r.copies <= 3
    targets = brute.mix_targets(sizes)
    assert {r.source: r.target for r in mixed} == pytest.approx(targets)
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in sizes)
    assert mixing.mix(empty).collect() == []
    assert mixing.copied(edge).columns == [*edge.columns, "mix_copy"]
    bare = documents(spark, [(1, None), (2, "")])
    assert {r.copies for r in mixing.mix(bare).collect()} == {0}


def test_repeated_rows_weigh_what_they_are(spark):
    """Fifty copies of one row, a third of a source beside single rows of another: every source meets its target."""
    docs = [(1, "w " * 100, "en", "s1")] * 50 + [(i, "w " * 100, "en", "s1") for i in range(2, 52)]
    docs += [(i, "w " * 90, "en", "s2") for i in range(100, 150)] + [(200, "v " * 70, "en", None)] * 7 + [(None, "w " * 10, "en", "s2")] * 5
    for mixed in (mixing.mix(documents(spark, docs)), mixing.mix(documents(spark, docs).repartition(3))):
        rows = mixed.select("row.source", "size", "target", "copies").collect()
        assert len(rows) == len(docs)
        for source in ("s1", "s2", None):
            own = [r for r in rows if r.source == source]
            assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own) / 2 + 1e-6
    copies = mixing.copied(documents(spark, docs))
    assert copies.columns[-1] == "mix_copy"
    taken = copies.groupBy("source").agg(F.sum(F.size(F.split("text", " ")) - 1).alias("n"))
    assert {r["source"]: r["n"] for r in taken.collect()} == {s: sum(r["size"] * r["copies"] for r in rows if r.source == s) for s in ("s1", "s2", None)}
    clashing = documents(spark, docs[:3]).withColumnRenamed("copy", "Copy").withColumnRenamed("h", "MIX_copy")
    assert mixing.copied(clashing).columns == [*clashing.columns, "mix_copy_2"]


def test_pivotal_rounding_keeps_the_words(spark):
    rows = [("s", (str(i), "s", 5 + i % 7), 0.3) for i in range(2000)]
    units = spark.createDataFrame(rows, "source string, id struct<doc:string,source:string,size:bigint>, p double")
    up = [r.id for r in mixing.round_up(units, block=16).collect()]
    assert len({x.doc for x in up}) == len(up)
    assert abs(sum(x.size for x in up) - 0.3 * sum(r[1][2] for r in rows)) <= 6


def test_hashes_of_words_in_pieces(monkeypatch):
    data = "".join(random.Random(2).choice(["ab", "C", " ", "\n", "é"]) for _ in range(5000)).encode()
    arrow = __import__("pyarrow").array([data[:1000], None, b"", data[1000:]])
    buffer, offsets = textops.buffers(arrow)
    whole = textops.word_hashes(buffer, offsets, lower=True)
    monkeypatch.setattr(textops, "PIECE", 64)
    pieces = textops.word_hashes(buffer, offsets, lower=True)
    assert all(np.array_equal(x, y) for x, y in zip(whole, pieces, strict=True))
    assert len(whole[0]) == len(data[:1000].split()) + len(data[1000:].split())


def near_copies(rng, n, edits):
    words = [f"v{i}" for i in range(2000)]
    base = [rng.choice(words) for _ in range(70)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        out.append(" ".join(copy[: rng.randint(60, 70)]))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_links(spark, empty, monkeypatch, small):
    """Families of near copies around the least similarity, passages that many share, and tiny sets. The small settings cut
    groups and lists into many pieces."""
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [t for edits in (2, 4, 6) for t in near_copies(rng, 25, edits)]
    texts += [passage + " " + " ".join(f"u{rng.randrange(9999)}" for _ in range(rng.choice([5, 12, 20, 60]))) for _ in range(30)]
    texts += ["a b", "A  B", "a b c", "c b a"]
    docs = [(i * 7 % 1000, t) for i, t in enumerate(texts)] + EDGE
    if small:
        for name, value in (("MANY", 1), ("LIST", 4), ("BLOCK", 16)):
            monkeypatch.setattr(jaccard_join, name, value)
    linked = got(jaccard_join.link(documents(spark, docs)), "doc_id", "n_shingles", "component_id")
    same(linked, brute.components(docs))
    kept = jaccard_join.keep_one(documents(spark, docs))
    assert kept.columns == empty.columns
    first = {(d, n, c) for d, n, c in brute.components(docs) if d == c or n == 0}
    same(got(kept, "doc_id"), [(d,) for d, _, _ in first])
    assert jaccard_join.link(empty).collect() == [] and jaccard_join.keep_one(empty).collect() == []


def test_tree_counts_like_sets():
    rng = random.Random(4)
    pivot = np.array(sorted(rng.sample(range(300), 100)), np.uint64)
    sets = [np.array(sorted({*rng.sample(pivot.tolist(), rng.randint(60, 100)), *rng.sample(range(300), rng.randint(0, 40))}), np.uint64) for _ in range(80)]
    expected = {}
    for i, s in enumerate(sets):
        common = len(set(s.tolist()) & set(pivot.tolist()))
        if 100 * common >= 75 * (len(s) + 100 - common):
            expected[i] = common
    assert 0 < len(expected) < 80 and dict(jaccard_join.tree_overlaps(pivot, sets, step=7)) == expected


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (99, 98), (5, 5)], "u long, v long")
    expected = [(i, 0) for i in range(41)] + [(i, 98) for i in (98, 99, 100)]
    assert got(components.connected(edges), "node", "component") == sorted(expected, key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_repeats(spark, empty, monkeypatch, small):
    rng = random.Random(9)
    texts = [t for t in near_copies(rng, 12, 6)]
    shared = "This passage of words is in many documents, with ñ and é, and everyone has it as it is. "
    texts += [f"{rng.random()} {shared} {rng.random()}" for _ in range(15)] + ["ab" * 200, "ab" * 90, "é" * 70, "xé" * 60]
    docs = [(i * 3 % 100, t) for i, t in enumerate(texts)] + EDGE
    if small:
        monkeypatch.setattr(suffix_dedup, "MANY", 1)
        monkeypatch.setattr(suffix_dedup, "PIECE", 100)
        monkeypatch.setattr(suffix_dedup, "_HELD", 50)
    columns = ["row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    expected = brute.removed_bytes(docs)
    assert any(x[2] for x in expected)
    same(got(suffix_dedup.repeats(documents(spark, docs)), *columns), expected)
    cleaned = suffix_dedup.cleaned(documents(spark, docs))
    assert cleaned.columns == empty.columns and cleaned.filter("n_chars <> length(text)").count() == 0
    assert suffix_dedup.repeats(empty).collect() == []


def test_languages(spark, edge, empty):
    rng = random.Random(6)
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(4)) for _ in range(rng.randint(2, 30)))
    docs = [(i, make("abcdef" if i % 2 else "ghijkl"), "aa" if i % 2 else "gg", "s") for i in range(120)]
    model = language_id.fit(documents(spark, docs), F.col("doc_id") % 3 != 0)
    found = {r.doc_id: r.lang_pred for r in language_id.predict(documents(spark, docs), model, ["doc_id"]).select("row.doc_id", "lang_pred").collect()}
    assert sum(found[d] == lang for d, _, lang, _ in docs) >= 118
    rows = language_id.predict(edge, model, edge.columns).select("row.*", "lang_pred", "score").collect()
    assert len(rows) == len(EDGE)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1 for r in rows)
    nothing = language_id.fit(empty, F.lit(True))
    assert {r.lang_pred for r in language_id.predict(edge, nothing, ["doc_id"]).collect()} == {"und"}
    one = language_id.fit(documents(spark, [(1, "abc", "x", "s"), (2, "abc", None, "s")]), F.lit(True))
    assert "x" in {r.lang_pred for r in language_id.predict(edge, one, ["doc_id"]).collect()}
    assert language_id.predict(empty, one, ["doc_id"]).collect() == []


def test_codewords_are_apart():
    for n in (1, 2, 3, 4, 6, 9, 40):
        code = language_id.codewords(n)
        assert code.shape[0] == n and len({tuple(r) for r in code.tolist()}) == n


def test_quality(spark, edge, empty):
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choice(["fine", "good", "text"] if i % 2 else ["junk***", "spam!!"]) for _ in range(30))) for i in range(100)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(None, 1), (5, None), (7, 1), (7, 0)], "doc_id long, quality int")
    machine = quality_fm.fit(documents(spark, docs), labels, F.col("doc_id") % 4 != 2, meta="n_chars")
    found = quality_fm.score(documents(spark, docs), machine, ["doc_id"], meta="n_chars").select("row.doc_id", "score").collect()
    held = [(r.score, r.doc_id % 2) for r in found if r.doc_id % 4 == 2 or r.doc_id % 2]
    assert min(s for s, q in held if q) > max(s for s, q in held if not q)
    scores = quality_fm.score(edge.withColumn("n_chars", F.lit(None).cast("long")), machine, edge.columns, meta="n_chars").collect()
    assert len(scores) == len(EDGE) and all(0 <= r.score <= 1 for r in scores)
    assert quality_fm.fit(empty, labels, F.lit(True)) is not None and quality_fm.fit(edge, labels.limit(0), F.lit(True)) is None
    assert {r.score for r in quality_fm.score(edge, None, ["doc_id"]).collect()} == {0.5}
    assert quality_fm.score(empty, machine, ["doc_id"]).collect() == []


def test_pairs_in_linear_time():
    machine = quality_fm.Machine(factor=np.random.default_rng(1).normal(0, 1, (quality_fm.WIDTH, quality_fm.RANK)).astype(np.float32))
    features, values = np.array([3, 7, 40000 % quality_fm.WIDTH]), np.array([0.5, 1.0, 2.0], np.float32)
    plain = sum(float(machine.factor[features[i]] @ machine.factor[features[j]]) * values[i] * values[j] for i in range(3) for j in range(i))
    assert machine.margins(1, np.zeros(3, int), features, values)[0] == pytest.approx(plain, rel=1e-4)


def test_shared_prefixes_are_shuffled_again_only_where_rows_went_through(spark, monkeypatch):
    """A bucket tells each row once; what several tasks sent past it is made distinct."""
    rng, written, plain = random.Random(5), {}, jaccard_join.materialise

    def kept(df, name, *rest, **options):
        written[name] = plain(df, name, *rest, **options)
        return written[name]

    monkeypatch.setattr(jaccard_join, "materialise", kept)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(40)) for _ in range(6)]
    docs = documents(spark, [(i, texts[i % 6] + f" tail{i % 12}") for i in range(48)]).repartition(4)
    counters = jaccard_join.classes(docs, "text")[1]
    cells, found = spark.sparkContext.broadcast(counters), {}
    for many in (1 << 20, 1):
        monkeypatch.setattr(jaccard_join, "MANY", many)
        rows = [tuple(r) for r in jaccard_join.shared_prefixes(docs, "text", cells, 5).collect()]
        assert rows and len(rows) == len(set(rows))
        found[many] = sorted(rows), written["again"].count()
    assert found[1][0] == found[1 << 20][0] and found[1 << 20][1] == 0 < found[1][1]


def test_texts_that_are_not_asked_for_stay_where_they_are(spark, monkeypatch):
    """Sets of asked classes, from rows that repeat too; the filter of rows misses none, lets few others through, and sets are not dealt again."""
    docs = documents(spark, [(i % 300, f"{SENTENCE} tail{i % 300}") for i in range(400)]).select("doc_id", "text")
    rows, counters = jaccard_join.classes(docs, "text")
    wanted = rows.dropDuplicates(["cls"]).orderBy("cls").limit(20).select("cls", "rid").localCheckpoint()
    asked = {r.rid for r in wanted.collect()}
    rids = np.array(sorted({r.rid for r in rows.collect()}))
    passed = set(rids[jaccard_join.may_have(jaccard_join.row_filter(wanted), rids)].tolist())
    assert len(rids) == 300 and asked <= passed and len(passed) < 30
    assert jaccard_join.may_have(jaccard_join.row_filter(wanted.limit(0)), rids).sum() == 0
    cells, found = spark.sparkContext.broadcast(counters), []
    for bits in (1 << 25, 1 << 15):
        monkeypatch.setattr(jaccard_join, "BITS", bits)
        sets = jaccard_join.fetch_sets(docs, "text", wanted, cells)
        assert "hashpartitioning(cls" not in sets._jdf.queryExecution().toString()
        found.append(sorted((r.cls, bytes(r.grams)) for r in sets.collect()))
    assert found[0] == found[1] and [c for c, _ in found[0]] == sorted(r.cls for r in wanted.collect())


def test_small_tables_of_the_similarity_join_have_few_files(spark, monkeypatch):
    """Not one per shuffle partition, where these are many more than the rows need: each file costs processes on a local path."""
    docs = [(i, f"{SENTENCE} {SENTENCE} group{i % 20} more{i % 20}" + f" tail{i}" * (i % 3)) for i in range(120)]
    few = got(jaccard_join.link(documents(spark, docs)), "doc_id", "n_shingles", "component_id")
    files, many = {}, 40

    def counted(module):
        def kept(df, name, *rest, plain=module.materialise, **options):
            table = plain(df, name, *rest, **options)
            files.setdefault(name, []).append(len(table.inputFiles()))
            return table

        monkeypatch.setattr(module, "materialise", kept)

    counted(jaccard_join)
    counted(components)
    settings = {"spark.sql.shuffle.partitions": str(many), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        cores = spark.sparkContext.defaultParallelism
        assert many >= 8 * cores
        linked = jaccard_join.link(documents(spark, docs))
        assert got(linked, "doc_id", "n_shingles", "component_id") == few
        written = {"sizes", "met", "profiles", "pairs", "sets", "links", "components", "others", "least"}
        assert written <= set(files) and linked.rdd.getNumPartitions() <= cores
        assert max(max(n) for name, n in files.items() if name not in ("classes", "rows")) <= cores
        assert max(files["large"] + files["small"]) == 1 and max(files["classes"] + files["rows"]) <= many // 2
        assert min(max(files[name]) for name in ("sizes", "met", "sets")) > 1
        monkeypatch.setattr(jaccard_join, "SHARE", 500)  # more rows, more files
        files.clear()
        assert got(jaccard_join.link(documents(spark, docs)), "doc_id", "n_shingles", "component_id") == few
        assert max(files["sizes"]) > cores
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_repeats_are_written_to_fewer_files_than_shuffle_partitions(spark):
    """Where partitions are many more than cores, several go into one file."""
    rng = random.Random(3)
    docs = [(i, f"{rng.random()} {SENTENCE if i % 2 else SENTENCE.upper()} {rng.random()}") for i in range(200)]
    many, before = 32 * spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", many)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = suffix_dedup.repeats(documents(spark, docs))
        files = collections.Counter(f.split("/")[-2].split("-")[0] for f in found.inputFiles())
        assert set(files) == {"second", "hits"} and max(files.values()) <= many // tables.JOINED
        same(got(found, "row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), brute.removed_bytes(docs))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_language_model(spark, edge, empty):
    rng = random.Random(12)
    words = ["the", "a", "cat", "dog", "sat", "ran", *[f"r{i}" for i in range(50)]]
    docs = [(i, " ".join(rng.choice(words[: rng.choice([6, 56])]) for _ in range(20))) for i in range(150)]
    model = pitman_yor.fit(documents(spark, docs))
    rows = {}
    for r in model.words.collect():
        rows[r.w] = r
    t = model.totals
    for u in range(pitman_yor.CONTEXTS):
        if not t.customers[u]:
            continue
        room, new, total = pitman_yor.STRENGTH + t.customers[u], pitman_yor.STRENGTH + t.discount * t.tables[u], 0.0
        for r in rows.values():
            kept = r.kept[r.contexts.index(u)] if u in r.contexts else 0.0
            total += (kept + new * t.parent_chance(r.arrived - t.parent_discount * r.parent_tables)) / room
        # What is left over is the word never seen.
        assert total + new * t.parent_chance(0.0) / room == pytest.approx(1, abs=1e-4)
    scored = pitman_yor.score(edge, model)
    assert sorted(scored.columns) == sorted(["doc_id", "n_tokens", "n_known", "base_score", "score"])
    tokens = sorted(len((t or "").encode().split()) + 1 for _, t in EDGE)
    assert sorted(r.n_tokens for r in scored.collect()) == tokens
    nothing = pitman_yor.score(edge, pitman_yor.fit(empty)).collect()
    assert len(nothing) == len(EDGE) and all(r.score == pytest.approx(0) and r.n_known == 0 for r in nothing)
    assert pitman_yor.score(empty, model).collect() == []


def test_frequent_and_rare_words_score_alike(spark, monkeypatch):
    """The broadcast table and the join say the same."""
    docs = documents(spark, [(i, SENTENCE + f" unique{i} twice{i // 2}") for i in range(20)])
    model = pitman_yor.fit(docs.filter("doc_id < 15"))
    whole = {r.doc_id: r for r in pitman_yor.score(docs, model).collect()}
    monkeypatch.setattr(pitman_yor, "FREQUENT", 3)
    for r in pitman_yor.score(docs, model).collect():
        assert r.score == pytest.approx(whole[r.doc_id].score, rel=1e-5) and r.base_score == pytest.approx(whole[r.doc_id].base_score)
        assert (r.n_known, r.n_tokens) == (whole[r.doc_id].n_known, whole[r.doc_id].n_tokens)


def test_words_of_one_class_are_contexts_of_their_own(spark):
    """What follows a word is learned of that word, not only of those that end alike."""
    docs = [(i, f"caab one daab two daab two caab one x{i}") for i in range(60)]
    model = pitman_yor.fit(documents(spark, docs))
    got = {r.doc_id: r for r in pitman_yor.score(documents(spark, [(1, "caab one"), (2, "caab two"), (3, "daab two"), (4, "daab one")]), model).collect()}
    # The texts have the same words, classes and ends.
    assert got[1].base_score == pytest.approx(got[2].base_score) and got[3].base_score == pytest.approx(got[4].base_score)
    assert got[1].score > got[2].score + 1 and got[3].score > got[4].score + 1


def test_language_model_is_the_plain_one(spark, monkeypatch):
    """Counts of pairs, probabilities that sum to one in every context, and scores, through several buckets and chunks."""
    for name, n in (("_BUCKET", 700), ("_HELD", 200), ("_CHUNK", 600), ("_SMALL", 5), ("FREQUENT", 9)):
        monkeypatch.setattr(pitman_yor, name, n)
    rng = random.Random(7)
    words = ["the", "a", "Cat", "dog", "hog", "ran", *[f"r{i}" for i in range(40)]]
    docs = [(i, " ".join(rng.choice(words[: rng.choice([6, 46])]) for _ in range(12))) for i in range(120)]
    model = pitman_yor.fit(documents(spark, docs))
    t, told = model.totals, pitman_yor._TABLES

    def tokens(text):
        import pyarrow as pa

        _, before, word = pitman_yor._keys(pa.record_batch([pa.array([text])], ["text"]))
        return list(zip(before.tolist(), word.tolist(), strict=True))

    tables = {kind: [] for kind in told}
    for r in model.state.union(model.single).collect():
        data = np.frombuffer(r.data, np.uint8)
        records = pitman_yor._from_planes(data, r.n, told[r.kind]) if r.n else data.view(told[r.kind])
        assert len(set(pitman_yor._place(records if r.kind == pitman_yor._SINGLE else records["key"], model.buckets).tolist())) == 1
        tables[r.kind] += records.tolist()
    pairs = collections.Counter(x for _, text in docs for x in tokens(text))
    assert model.buckets > 5 and model.tokens == pairs.total()
    key = lambda u, w: int(pitman_yor._pair(np.array([u], np.uint64), np.array([w], np.uint64))[0])
    kept = dict(tables[pitman_yor._KEPT]) | {k: 1 - t.word_discount for k in tables[pitman_yor._SINGLE]}
    assert set(kept) == {key(*x) for x in pairs} and set(tables[pitman_yor._SINGLE]) == {key(*x) for x, n in pairs.items() if n == 1}
    rooms = {k: (n, seats) for k, n, seats in tables[pitman_yor._ROOMS]}
    followers = collections.Counter()
    for (u, _), n in pairs.items():
        followers[u] += n
    assert {u: n for u, (n, _) in rooms.items()} == followers
    of_word = {r.w: r for r in model.words.collect()}

    def chance(u, w):
        k, r = u % pitman_yor.CONTEXTS, of_word.get(w)
        own = r.kept[r.contexts.index(k)] if r and k in r.contexts else 0.0
        root = r.arrived - t.parent_discount * r.parent_tables if r else 0.0
        n, seats = rooms.get(u, (0, 0.0))
        return (kept.get(key(u, w), 0.0) + (pitman_yor.STRENGTH + t.word_discount * seats) * t.class_chance(k, own, root)) / (pitman_yor.STRENGTH + n)

    for u in rooms:
        assert sum(chance(u, w) for w in of_word) + chance(u, 0) == pytest.approx(1, abs=1e-4)
    asked = [*docs[:20], (500, "a Dog ran UNSEEN the hog"), (501, "unseen unseen r1 R2"), (502, None), (503, ""), *docs[:2]]
    rows = pitman_yor.score(documents(spark, asked), model).collect()
    plain = lambda x: sum(np.log10(chance(*y)) for y in tokens(x or ""))
    found, expected = sorted((r.doc_id, r.score) for r in rows), sorted((i, plain(x)) for i, x in asked)
    assert [i for i, _ in found] == [i for i, _ in expected]
    assert [x for _, x in found] == pytest.approx([x for _, x in expected], rel=1e-5)


def test_seating_follows_the_restaurant():
    random_ = np.random.default_rng(3)
    customers = np.full(4000, 500)
    tables, _ = pitman_yor.seat(customers, np.full(4000, 5.0), 0.5, random_)
    plain = []
    for _ in range(300):
        t = 1
        for k in range(1, 500):
            t += random_.random() < 5.0 / (5.0 + k - 0.5 * t)
        plain.append(t)
    assert tables.mean() == pytest.approx(np.mean(plain), rel=0.05)


def test_tables_go_with_their_operator(spark, tmp_path):
    from starloom.llm.tables import materialise, temporary

    here = lambda df: [f for f in df.inputFiles()]
    gone = lambda files: not any(__import__("pathlib").Path(f.removeprefix("file://").removeprefix("file:")).exists() for f in files)
    rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    outside = materialise(spark.range(3), "outside")
    with temporary(spark):
        own = here(materialise(spark.range(3), "own"))
        with pytest.raises(ValueError), temporary(spark):
            inner = here(materialise(spark.range(3), "inner"))
            middle = materialise(spark.range(3), "middle", lasting=True)
            raise ValueError
        assert gone(inner) and middle.count() == 3 and not gone(own)
        result = materialise(spark.range(5), "result", lasting=True)
    assert gone(own) and gone(here(middle)) and result.count() == 5 and outside.count() == 3
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == rows


def test_archives(spark):
    payload = b"line\nHTTP/1.1 in the text\r\n\r\nWARC/1.1\n\x00\xff"
    data = [("1", "http://a/x y", payload), ("2", None, payload), ("3", "http://b\n", b""), ("4", "-", b""), (None, "u", payload), (None, "v", b"alone"), ("1", "http://a/x y", payload)]
    df = spark.createDataFrame(data, "id string, url string, payload binary")
    for version in (1, 2):
        found = got(warc.round_trip(df, version=version), "id", "record_type", "payload_bytes", "payload_digest", "refers_to")
        n, digest = len(payload), warc.sha1(payload)
        expected = [("1", "response", n, digest, None)] * 2 + [("2", "revisit", n, digest, "1"), (None, "revisit", n, digest, "1")]
        expected += [("3", "response", 0, warc.sha1(b""), None), ("4", "revisit", 0, warc.sha1(b""), "3"), (None, "response", 5, warc.sha1(b"alone"), None)]
        same(found, expected)
    assert warc.round_trip(df.limit(0)).collect() == []


def test_arc_versions_and_broken_records():
    import io

    v1 = b"filedesc://x 0.0.0.0 19970101000000 text/plain 76\n1 0 Org\nURL IP-address Archive-date Content-type Archive-length\n\n12345678901\n"
    body = b"plain body\nwith lines"
    record = b"http://h/a b 1.2.3.4 199702 text/plain %d\n%s\n" % (len(body), body)
    block = b"1 0 Org\nURL IP-address Archive-date Content-type Archive-length\n\n"
    head = b"filedesc://x 0.0.0.0 19970101000000 text/plain %d\n%s\n" % (len(block), block)
    rows = list(warc.parse_arc(warc.open_archive(head + record + record)))
    assert [(r["url"], r["ip"], r["payload"], r["header"]) for r in rows] == [("http://h/a b", "1.2.3.4", body, b"")] * 2
    assert warc.iso_date(rows[0]["date"]) == "1997-02-01T00:00:00Z"
    for broken in (head + record[:-5], head + b"http://h 1\n", v1[:20], b"http://x 1.2.3.4 1997 text/plain 3\nabc\n"):
        with pytest.raises((ValueError, IndexError)):
            list(warc.parse_arc(io.BufferedReader(io.BytesIO(broken))))
