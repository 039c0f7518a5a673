import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as hnp

from epispan.llm import katz as k


def words(text):
    return [*re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


class Brute:
    """The same model from plain dictionaries; a history reaches back to the start mark 0 at most."""

    def __init__(self, texts, order=2):
        self.order = order
        self.grams = {n: Counter() for n in range(1, order + 1)}
        self.after = defaultdict(set)
        for text in texts:
            run = [0, *words(text)]
            for i in range(1, len(run)):
                for n in range(1, min(order, i + 1) + 1):
                    gram = tuple(run[i + 1 - n:i + 1])
                    self.grams[n][gram] += 1
                    self.after[gram[:-1]].add(gram[-1])
        self.uni = Counter({w: n for (w,), n in self.grams[1].items()})
        self.total = sum(self.uni.values())
        self.context = Counter()
        for n in range(2, order + 1):
            for gram, times in self.grams[n].items():
                self.context[gram[:-1]] += times
        repeats = lambda c: [sum(1 for n in c.values() if n == r) for r in range(1, k.DISCOUNTED_TO + 2)]
        self.d = {n: k.Discounts(sum(c.values()), len(c), repeats(c)).d for n, c in self.grams.items()}
        self.freed = sum(n - self.kept((w,)) for w, n in self.uni.items())

    def kept(self, gram):
        n = self.grams[len(gram)][gram]
        return n * self.d[len(gram)][min(n, k.DISCOUNTED_TO + 1)]

    def p(self, history, w):
        if not history:
            size = self.total if self.freed else self.total + 1
            return self.kept((w,)) / size if self.uni[w] else (self.freed or 1.0) / size
        if not self.context[history]:
            return self.p(history[1:], w)
        freed = sum(self.grams[len(history) + 1][*history, x] - self.kept((*history, x)) for x in self.after[history])
        size = self.context[history] + (0 if freed else 1)
        if self.grams[len(history) + 1][*history, w]:
            return self.kept((*history, w)) / size
        return (freed or 1.0) / size / (1 - sum(self.p(history[1:], x) for x in self.after[history])) * self.p(history[1:], w)

    def score(self, text):
        run = [0, *words(text)]
        return sum(math.log10(self.p(tuple(run[max(0, i + 1 - self.order):i]), run[i])) for i in range(1, len(run)))


def corpus(n, seed):
    rng = random.Random(seed)
    vocab = [f"W{i}" if i % 7 else f"é{i}" for i in range(120)]
    rows = [(i, " ".join(rng.choices(vocab, [1 / (j + 1) for j in range(120)], k=rng.randint(0, 30)))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, "hot pair " * 400), (n + 3, "never seen words here"), (n + 3, "never seen words here"), (n + 4, "a\x1cb\tc\x85d")]


@pytest.mark.parametrize("n, chunk, order", [(150, 200, 2), (40, 1 << 20, 2), (150, 200, 3), (40, 1 << 20, 3), (60, 90, 4)])
def test_scores_match_brute_force(spark, monkeypatch, n, chunk, order):
    monkeypatch.setattr(k, "CHUNK_TOKENS", chunk)
    rows = corpus(n, chunk)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows] + [(None, "w1 w2 odd", "x")], "doc_id bigint, text string, chunk string").repartition(3)
    fold = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    brute = Brute([t for i, t in rows if not fold(i)], order)
    got = k.score_held_out(docs, order=order).collect()
    texts = {**dict(rows), None: "w1 w2 odd"}
    assert len(got) == len(rows) + 1
    size = brute.total + 0.1 * (len(brute.uni) + 1)
    for r in got:
        tokens = words(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (fold(r.doc_id), len(tokens), brute.total)
        assert r.n_known == sum(brute.uni[w] > 0 for w in tokens)
        assert math.isclose(r.base_score, sum(math.log10((brute.uni[w] + 0.1) / size) for w in tokens), rel_tol=1e-9)
        assert math.isclose(r.score, brute.score(texts[r.doc_id]), rel_tol=1e-9, abs_tol=1e-9), r.doc_id
    for h in [(0,), ("w1",), ("pair",), ("hot",), ("nothere",), ("hot", "pair"), (0, "hot"), ("pair", "hot", "pair")]:
        h = h[1 - order:]
        assert math.isclose(sum(brute.p(h, w) for w in brute.uni) + brute.p(h, "unknown"), 1, rel_tol=1e-9)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b", False, True), (2, None, None, None)], "doc_id bigint, text string, train boolean, held_out boolean")
    got = {r.doc_id: r for r in k.score_documents(docs).collect()}
    assert got[1].score == 0 and got[1].n_tokens == 3 and got[2].n_tokens == 1 and got[2].held_out is False and abs(got[1].base_score) < 1e-12
    assert k.score_documents(docs.limit(0)).count() == 0


@settings(max_examples=50, deadline=None)
@given(hnp.arrays(np.uint64, st.integers(0, 50)), st.integers(1, 40))
def test_packing_and_buckets(keys, buckets):
    keys = np.unique(keys)
    back = k.undelta(k.unpack(k.pack(k.deltas(keys), keys.astype(np.float64)))[0])
    assert (back == keys).all()
    cuts = k.bucket_cuts(keys, buckets)
    for b in range(buckets):
        assert all(int(x) * buckets >> 64 == b for x in keys[cuts[b]:cuts[b + 1]])


@pytest.mark.parametrize("chunk, per_bucket, order", [(60, 1, 2), (1 << 20, 3, 2), (60, 1, 3)])
def test_a_stored_model_scores_other_texts(spark, monkeypatch, tmp_path, chunk, per_bucket, order):
    monkeypatch.setattr(k, "CHUNK_TOKENS", chunk)
    learnt, rows = corpus(60, 5), corpus(200, 6) + [(None, "hot pair w1 \x00 odd")]
    known = spark.createDataFrame(learnt, "doc_id bigint, text string").repartition(2)
    folder = k.train_model(known, f"{tmp_path}/model", order)
    monkeypatch.setattr(k, "CHUNKS_PER_BUCKET", per_bucket)
    brute, texts = Brute([t for _, t in learnt], order), dict(rows)
    others = spark.createDataFrame([(i, t, True) for i, t in rows], "doc_id bigint, text string, train boolean").repartition(3)
    got = k.score_with_model(others, folder).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    size = brute.total + 0.1 * (len(brute.uni) + 1)
    for r in got:
        tokens = words(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (True, len(tokens), brute.total)
        assert r.n_known == sum(brute.uni[w] > 0 for w in tokens)
        assert math.isclose(r.base_score, sum(math.log10((brute.uni[w] + 0.1) / size) for w in tokens), rel_tol=1e-9)
        assert math.isclose(r.score, brute.score(texts[r.doc_id]), rel_tol=1e-9, abs_tol=1e-9), r.doc_id
    assert k.score_with_model(others.limit(0), folder).count() == 0


def test_a_stored_model_of_nothing(spark, tmp_path):
    folder = k.train_model(spark.createDataFrame([], "text string, bucket string"), f"{tmp_path}/model")
    got = k.score_with_model(spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None)], "doc_id bigint, text string"), folder).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in got) == [(1, 3, 0, 0), (1, 3, 0, 0), (2, 1, 0, 0)]
    assert all(r.score == 0 for r in got)


@pytest.mark.parametrize("order", [3, 5])
def test_longer_orders_of_little_or_nothing(spark, tmp_path, order):
    docs = spark.createDataFrame([(1, "a b", False, True), (2, None, None, None), (3, "", False, False)], "doc_id bigint, text string, train boolean, held_out boolean")
    assert sorted((r.doc_id, r.n_tokens, r.score) for r in k.score_documents(docs, order).collect()) == [(1, 3, 0), (2, 1, 0), (3, 1, 0)]
    assert k.score_documents(docs.limit(0), order).count() == 0
    # Learnt from texts without words, so no sequence is longer than two.
    folder = k.train_model(docs.where("doc_id > 1"), f"{tmp_path}/model", order)
    brute = Brute([None, ""], order)
    got = {r.doc_id: r.score for r in k.score_with_model(docs, folder).collect()}
    assert all(math.isclose(got[i], brute.score(t), rel_tol=1e-9, abs_tol=1e-9) for i, t in [(1, "a b"), (2, None), (3, "")])
    with pytest.raises(ValueError, match="order two or more"):
        k.train_model(docs, f"{tmp_path}/none", 1)
