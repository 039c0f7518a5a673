import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from epispan.llm import langid as g

SYLLABLES = {"aa": ["the", "ing", "on", "er", "th"], "bb": ["éau", "que", "ou", "tre", "ç"], "cc": ["sch", "ung", "ein", "ü", "ß"]}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for i in range(900):
        lang = rng.choice(list(SYLLABLES))
        text = " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(3, 60)))
        out.append((i, text, lang))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, k, 0.5) for i, t, k in rows], "doc_id bigint, text string, lang string, score double").repartition(3)


def test_held_out_accuracy_and_calibration(rows, docs):
    truth = {i: k for i, _, k in rows}
    got = g.predict_held_out(docs).collect()
    assert len(got) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    right = np.array([r.lang_pred == truth[r.doc_id] for r in got if r.held_out])
    score = np.array([r.score for r in got if r.held_out])
    assert right.mean() > 0.98 and abs(right.mean() - score.mean()) < 0.03


def test_counts_match_brute_force():
    text = "Été—the ÑU 12 THE\nthe"
    letters = " " + re.sub(r"[\W\d_]+", " ", text.lower()).strip() + " "
    want = sum(len(letters) - n + 1 for n in (1, 2, 3))
    counts = g.ngram_counts(text)
    assert counts.sum() == want
    grams = Counter(letters[i:i + n] for n in (1, 2, 3) for i in range(len(letters) - n + 1))
    assert sorted(counts[counts > 0].tolist(), reverse=True)[0] >= max(grams.values())
    assert (g.ngram_counts("THE x") == g.ngram_counts("the, x!")).all()
    block, g.BLOCK_CHARS = g.BLOCK_CHARS, 7
    try:
        assert (g.ngram_counts(text) == counts).all()
    finally:
        g.BLOCK_CHARS = block


def test_document_frequencies_cover_all_rows(rows, docs):
    frequency, total = g.document_frequencies(docs)
    want = sum((g.ngram_counts(t) > 0).astype(int) for _, t, _ in rows)
    assert total == len(rows) and (frequency == want).all()


def test_weights_are_sparse(rows):
    values = [(b := np.flatnonzero(c), g.tf_idf(b, c[b], np.ones(g.BUCKETS)), sorted(SYLLABLES).index(k)) for _, t, k in rows for c in [g.ngram_counts(t)]]
    model = g.train(values, sorted(SYLLABLES), np.ones(g.BUCKETS))
    assert 0 < (model.weights != 0).mean() < 0.1


def test_temperature_recovers_a_known_scale():
    rng = np.random.default_rng(0)
    logits = rng.normal(0, 2, (4000, 3))
    truth = np.array([rng.choice(3, p=p) for p in g.softmax(logits)])
    assert abs(g.calibrate(logits * 3, truth) - 3) < 0.4 and g.calibrate(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_odd_rows(spark, docs):
    odd = spark.createDataFrame([(None, "the ing", None, None), (5000, None, "aa", None), (5001, "", "bb", None), (5002, "12 !! 😀", "cc", None), (5003, "tre que " * 60_000, None, None), (5004, "the", "aa", None), (5004, "the", "aa", None)], docs.schema)
    got = {r.doc_id: r for r in g.predict_held_out(docs.unionAll(odd)).collect()}
    assert [got[i].lang_pred for i in (5000, 5001, 5002, 5003)] == ["und", "und", "und", "bb"] and got[5000].score == 0 and not got[None].held_out
    assert g.predict_held_out(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in g.predict_held_out(odd.where("lang is null")).collect()} == {"und"}
    kept = g.keep_identified(docs.unionAll(odd))
    assert kept.columns == docs.columns and kept.where("doc_id in (5000, 5001, 5002)").count() == 0 and kept.count() > 890


def test_training_follows_the_regularised_leader_step_by_step():
    """Every coordinate on its own, in plain numbers, in the order the fit takes the rows."""
    pick = np.random.default_rng(3)
    rows = [(np.sort(pick.choice(30, 5, replace=False)), pick.uniform(0.1, 1, 5), int(pick.integers(0, 3))) for _ in range(40)]
    z, n = {}, {}

    def weight(at):
        held = z.get(at, 0.0)
        if abs(held) <= g.L1:
            return 0.0
        return ((g.L1 if held > 0 else -g.L1) - held) / ((g.BETA + n.get(at, 0.0) ** 0.5) / g.ALPHA + g.L2)

    order = np.random.default_rng(11)
    for _ in range(g.EPOCHS):
        for i in order.permutation(len(rows)):
            buckets, values, truth = rows[i]
            inputs = [*zip(buckets.tolist(), values.tolist(), strict=True), (g.BUCKETS, 1.0)]
            w = {(b, k): weight((b, k)) for b, _ in inputs for k in range(3)}
            out = [sum(w[b, k] * x for b, x in inputs) for k in range(3)]
            odds = [np.exp(o - max(out)) for o in out]
            for k in range(3):
                error = odds[k] / sum(odds) - (k == truth)
                for b, x in inputs:
                    slope, before = error * x, n.get((b, k), 0.0)
                    n[b, k] = before + slope * slope
                    z[b, k] = z.get((b, k), 0.0) + slope - (n[b, k] ** 0.5 - before**0.5) / g.ALPHA * w[b, k]
    model = g.train(rows, ["a", "b", "c"], np.ones(g.BUCKETS))
    for b in range(30):
        assert model.weights[b] == pytest.approx([weight((b, k)) for k in range(3)], abs=1e-9)
    assert model.bias == pytest.approx([weight((g.BUCKETS, k)) for k in range(3)], abs=1e-9)
    assert (model.weights[30:] == 0).all() and (model.weights[:30] == 0).any() and (model.weights[:30] != 0).any()


def test_temperature_has_the_least_loss():
    pick = np.random.default_rng(6)
    logits = 4 * pick.normal(size=(300, 4))
    truth = np.array([pick.choice(4, p=p) for p in g.softmax(logits / 2.5)])
    loss = lambda t: -np.log(g.softmax(logits / t)[np.arange(300), truth]).mean()
    best = g.calibrate(logits, truth)
    assert loss(best) <= min(loss(t) for t in np.geomspace(0.05, 40, 400)) + 1e-9 and 1.5 < best < 4


def test_texts_of_no_learned_language_are_undetermined(spark, docs):
    """Another script meets buckets by chance: a language is named for it, but nothing speaks for that language."""
    pick = random.Random(5)
    others = ["абвгдежзиклмно", "αβγδεζηθικλμν", "日月火水木金土人口山川田"]
    foreign = [(6000 + i, " ".join("".join(pick.choices(others[i % 3], k=pick.randint(1, 6))) for _ in range(pick.randint(4, 200))), None, 0.5) for i in range(60)]
    # Short, mixed and half foreign texts speak for a language.
    known = [(7000, "the", None, 0.5), (7001, "éau", None, 0.5), (7002, "thing sch ung éau", None, 0.5), (7003, "the thing on er абв где", None, 0.5)]
    odd = spark.createDataFrame(foreign + known, docs.schema)
    named = g.predict(odd, g.fit(docs)).collect()
    assert len(named) == 64 and all(r.lang_pred in SYLLABLES for r in named)
    kept = {r.doc_id for r in g.keep_identified(docs.unionAll(odd)).collect()}
    assert kept == {*range(900), 7000, 7001, 7002, 7003}


def test_evidence_of_chance_has_unit_deviation(rows, docs):
    model = g.fit(docs)
    mean, deviation = g.chance(model)
    pick = np.random.default_rng(4)
    texts = pick.multinomial(400, np.full(g.BUCKETS, 1 / g.BUCKETS), 300)
    drawn = np.array([[(x @ model.weights[b])[k] - mean[k] * x.sum() for k in range(3)] for c in texts for b in [np.flatnonzero(c)] for x in [g.tf_idf(b, c[b], np.ones(g.BUCKETS))]])
    assert drawn.std(axis=0) / deviation == pytest.approx(np.ones(3), abs=0.15) and np.abs(drawn.mean(axis=0) / deviation).max() < 0.2
    b = np.flatnonzero(c := g.ngram_counts(rows[0][1]))
    x = g.tf_idf(b, c[b], model.idf)
    best = int((x @ model.weights[b] + model.bias).argmax())
    want = (sum(v * model.weights[a, best] for a, v in zip(b, x, strict=True)) - mean[best] * sum(x)) / deviation[best]
    assert g.evidence(model, c, mean, deviation) == pytest.approx(want) and want > g.LEAST_EVIDENCE
