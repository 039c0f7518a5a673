import random
import zlib

import numpy as np
import pytest

from epispan.llm import pu_quality as q


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices("aeiourstln", k=rng.randint(2, 9))) for _ in range(800)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(words, k=rng.randint(5, 120))).capitalize() + "."
        good = rng.random() < 0.8
        if not good:
            kind = rng.randrange(3)
            text = text.upper() + "!!" if kind == 0 else " ".join(w + rng.choice(["###", "%%%"]) for w in text.split()) if kind == 1 else (text.split()[0] + " ") * 40
        rows.append((i, text, int(good)))
    return rows


@pytest.fixture(scope="module")
def frames(spark):
    rows = corpus(1500)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id bigint, text string, score string").repartition(3)
    labels = spark.createDataFrame([(i, g) for i, _, g in rows if i % 2], "doc_id bigint, quality int")
    return rows, docs, labels


def test_held_out_accuracy(frames):
    rows, docs, labels = frames
    truth = {i: g for i, _, g in rows}
    got = q.score_held_out(docs, labels).collect()
    assert len(got) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for r in got)
    held = [r.predicted == truth[r.doc_id] for r in got if r.held_out]
    assert np.mean(held) > 0.97


def test_prior_is_estimated(frames):
    rows, _, _ = frames
    x = np.array([q.text_features(t) for _, t, _ in rows])
    good = np.array([g == 1 and i % 2 == 1 for i, _, g in rows])
    assert abs(q.estimate_prior(x[good], x) - 0.8) < 0.08


def test_held_out_labels_change_nothing(frames, spark):
    rows, docs, labels = frames
    flipped = spark.createDataFrame(
        [(r.doc_id, 1 - r.quality if zlib.crc32(str(r.doc_id).encode()) % 3 == 1 else r.quality) for r in labels.collect()], "doc_id bigint, quality int",
    )
    a, b = (sorted((r.doc_id, r.score) for r in q.score_held_out(docs, x).collect()) for x in (labels, flipped))
    assert a == b


def test_odd_rows(spark, frames):
    _, docs, labels = frames
    odd = spark.createDataFrame([(None, "some text here", None), (5000, None, None), (5001, "", None), (5002, "x " * 200_000, None), (7, "again", None), (7, "again", None)], docs.schema)
    got = {(r.doc_id, r.predicted) for r in q.score_held_out(docs.unionAll(odd), labels).collect() if r.doc_id is None or r.doc_id >= 5000}
    assert {i for i, _ in got} == {None, 5000, 5001, 5002} and (5002, 0) in got
    assert q.score_held_out(docs.limit(0), labels).count() == 0
    assert {r.score for r in q.score_held_out(odd, labels.limit(0)).collect()} == {0.5}
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns and 1000 < kept.count() < 1400


def test_features_are_finite():
    for text in (None, "", "\n\n", "a", "a b", "!!!", "é" * 1000, "\ud800"):
        x = q.text_features(text)
        assert len(x) == q.N_FEATURES and np.isfinite(x).all()


def test_a_bounded_sample_is_the_same_every_time(frames):
    _, docs, labels = frames
    nets = [q.fit(docs.repartition(n), labels, sample_docs=400) for n in (2, 5)]
    assert all(np.array_equal(a, b) for a, b in zip(nets[0].weights, nets[1].weights, strict=True))


def test_good_documents_are_found_before_the_sample_is_bounded(frames, spark, monkeypatch):
    rows, docs, _ = frames
    seen = []
    fitted = q.fit_network
    monkeypatch.setattr(q, "fit_network", lambda good, all_, prior: seen.append((len(good), len(all_), prior)) or fitted(good, all_, prior))
    few = [i for i, _, g in rows if g][:60]
    labels = spark.createDataFrame([(i, 1) for i in few] + [(i, 0) for i, _, g in rows if not g], "doc_id bigint, quality int")
    assert q.fit(docs, labels, sample_docs=80) is not None
    # The whole set is sampled, its 60 good documents are all there and the prior is estimated from them.
    assert seen[-1][:2] == (60, 80) and seen[-1][2] not in (None, 0.5)
    assert q.fit(docs, labels.where(f"doc_id = {few[0]}"), sample_docs=5) is not None
    assert seen[-1] == (1, 5, 0.5)
    assert q.fit(docs, labels.where("quality = 0"), sample_docs=80) is None


@pytest.mark.parametrize("shift", [3.0, -3.0])
def test_risk_slopes_against_differences(shift):
    """Slopes of the non-negative risk, on both sides of the point where its second part turns negative."""
    rng = np.random.default_rng(4)
    gp, gu, prior = rng.normal(size=7), rng.normal(size=11) + shift, 0.4
    loss = lambda g: np.log1p(np.exp(-g))

    def parts(p, u):
        return prior * loss(p).mean(), loss(-u).mean() - prior * loss(-p).mean()

    def objective(p, u):
        positive, negative = parts(p, u)
        return positive + negative if negative >= 0 else -negative

    assert (parts(gp, gu)[1] >= 0) == (shift > 0)
    slope_p, slope_u = q.risk_slopes(gp, gu, prior)
    for slopes, at in ((slope_p, 0), (slope_u, 1)):
        for i in range(len(slopes)):
            step = [np.zeros(7), np.zeros(11)]
            step[at][i] = 1e-6
            rise = objective(gp + step[0], gu + step[1]) - objective(gp - step[0], gu - step[1])
            assert slopes[i] == pytest.approx(rise / 2e-6, abs=1e-7)


def test_prior_is_drawn_to_one_half_by_scarcity():
    rng = np.random.default_rng(5)
    junk, fine = rng.normal(4, 1, (4000, q.N_FEATURES)), rng.normal(0, 1, (1000, q.N_FEATURES))
    everything = rng.permutation(np.concatenate([junk, fine]))
    full = q.shrunk_prior(fine, everything)
    assert full == pytest.approx((1000 * q.estimate_prior(fine, everything) + 25) / 1050) and abs(full - 0.2) < 0.06
    assert 0.35 < q.shrunk_prior(fine[:10], everything) < 0.55 and q.shrunk_prior(fine[:1], everything) == 0.5
