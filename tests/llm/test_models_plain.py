"""Decoding and scoring with fitted models against sums written out."""

import itertools
import math

import numpy as np
import pytest

from starloom.llm import language_id, quality_fm
from starloom.llm.queries import remainder

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").filter("doc_id < 60")


def plain_language(model, text):
    """The nearest codeword by trust-weighted logistic loss, its share of exp(-8 * loss), and whether the next is near."""
    counts = language_id.gram_counts(text)
    if counts is None:
        return "und", 0.0, False
    total = sum(map(int, counts))
    grams = [(g, math.sqrt(n / total)) for g, n in enumerate(counts.tolist()) if n]
    losses = {}
    for i, lang in enumerate(model.languages):
        losses[lang] = 0.0
        for b in range(model.code.shape[1]):
            bit = model.bias[b] + sum(x * float(model.weights[g, b]) for g, x in grams)
            losses[lang] += float(model.trust[i, b]) * math.log1p(math.exp(-float(model.code[i, b]) * bit))
    order = sorted(losses, key=losses.get)
    share = 1 / sum(math.exp(-8 * (losses[x] - losses[order[0]])) for x in losses)
    return order[0], share, losses[order[1]] - losses[order[0]] < 0.1


def test_languages_are_decoded_as_the_losses_say(spark, docs):
    model = language_id.fit(docs.select("doc_id", "lang", "text"), learn=remainder(3) != 1)
    odd = spark.createDataFrame([(1000, None), (1001, "123 !?"), (1002, "the les der"), (1003, "")], "doc_id long, text string")
    texts = docs.filter("doc_id < 25").select("doc_id", "text").unionByName(odd)
    found = language_id.predict(texts, model, keep=["doc_id"]).select("row.doc_id", "lang_pred", "score", "ambiguous").collect()
    text = {r.doc_id: r.text for r in texts.collect()}
    assert len(found) == len(text)
    for r in found:
        lang, share, near = plain_language(model, text[r.doc_id])
        assert (r.lang_pred, r.ambiguous) == (lang, near) and r.score == pytest.approx(share, abs=1e-3)


def test_the_machine_sums_all_pairs():
    """The identity against every pair of features, each once."""
    rng = np.random.default_rng(1)
    machine = quality_fm.Machine(0.3, rng.normal(0, 1, quality_fm.WIDTH).astype(np.float32), rng.normal(0, 1, (quality_fm.WIDTH, quality_fm.RANK)).astype(np.float32))
    row = np.repeat([0, 1, 2], [5, 1, 12])
    feature, value = rng.choice(quality_fm.WIDTH, len(row), replace=False), rng.normal(0, 1, len(row)).astype(np.float32)
    margins = machine.margins(3, row, feature, value)
    for i in range(3):
        own = [(int(f), float(x)) for f, x in zip(feature[row == i], value[row == i], strict=True)]
        plain = 0.3 + sum(float(machine.weight[f]) * x for f, x in own)
        for (f, x), (g, y) in itertools.combinations(own, 2):
            plain += float(machine.factor[f] @ machine.factor[g]) * x * y
        assert margins[i] == pytest.approx(plain, rel=1e-3, abs=1e-3)


def test_scores_are_those_of_the_fitted_machine(spark, docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    machine = quality_fm.fit(docs.select("doc_id", "text", "n_chars"), labels, learn=remainder(4) != 2, meta="n_chars")
    rows = docs.filter("doc_id < 12").select("doc_id", "text", "n_chars")
    found = {r.doc_id: r.score for r in quality_fm.score(rows, machine, keep=["doc_id"], meta="n_chars").select("row.doc_id", "score").collect()}
    for r in rows.collect():
        batch = __import__("pyarrow").record_batch([[r.text], [r.n_chars]], ["text", "meta"])
        _, feature, value = quality_fm.vectors(batch, "text", "meta")
        plain = float(machine.bias) + sum(float(machine.weight[f]) * float(x) for f, x in zip(feature, value, strict=True))
        for i, j in itertools.combinations(range(min(len(feature), 400)), 2):
            plain += float(machine.factor[feature[i]] @ machine.factor[feature[j]]) * float(value[i]) * float(value[j])
        if len(feature) <= 400:
            assert found[r.doc_id] == pytest.approx(1 / (1 + math.exp(-plain)), abs=1e-3)
    assert set(found) == {r.doc_id for r in rows.collect()}
