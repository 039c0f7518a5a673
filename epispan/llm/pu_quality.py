"""Document quality by positive-unlabelled learning.

Only documents labelled good are trusted; everything else, labelled bad or not at all, is
unlabelled. A small network over surface statistics of the whole text minimises the
non-negative unbiased risk

    pi * E_good[loss(+)] + max(0, E_all[loss(-)] - pi * E_good[loss(-)])

where pi, the share of good documents, is itself estimated from good and unlabelled documents:
the smallest ratio of unlabelled to good mass over the regions where a first classifier finds
good documents dense. With the logistic loss the trained score estimates the probability that
a document is good.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, map_arrow

#: Bound on the good documents, and on the documents of any kind, a fit looks at, chosen by the hash of their ids.
SAMPLE_DOCS = 40_000
#: Good documents that a prior of one half counts for beside the estimate.
PRIOR_WEIGHT = 50
HIDDEN = 24
EPOCHS = 60
BATCH = 1024
RATE = 0.01
SEED = 7
CLIP = 4.0
_SYMBOLS = b"#$%&*!|<>{}[]=+@^~_/\\`"
_POINTS = b".,;:?'\"()-"
_DIGITS = b"0123456789"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_WHITE = b" \t\n\r\x0b\x0c"
_SYMBOL_END = re.compile(rb"[#$%&*!|<>{}\[\]=+@^~_/\\`](?=\s|$)")


def text_features(text: str | None) -> list[float]:
    """Surface statistics of a whole text; a null or empty text gives zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * N_FEATURES
    size, n = len(raw), len(words)
    without = lambda drop: size - len(raw.translate(None, drop))
    upper, lower = without(_UPPER), without(_LOWER)
    trigrams = n - 2
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return [
        np.log1p(50 * without(_SYMBOLS) / size),
        np.log1p(10 * upper / max(1, upper + lower)),
        np.log1p(20 * sum(map(bytes.__eq__, words, words[1:])) / n),
        np.log1p(10 * (1 - len(set(zip(words, words[1:], words[2:]))) / trigrams)) if trigrams > 0 else 0.0,
        len(set(words)) / n**0.8,
        np.log1p(50 * without(_DIGITS) / size),
        np.log1p(size / n),
        np.log1p(20 * without(_POINTS) / size),
        np.log1p(10 * len(_SYMBOL_END.findall(raw)) / n),
        1 - len(set(lines)) / len(lines),
        without(_WHITE) / size,
        np.log1p(max(map(len, words))),
    ]


N_FEATURES = 12


def document_features(docs: DataFrame) -> DataFrame:
    """doc_id and ``x``, the statistics of its text; ids may be null or repeated."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield {"doc_id": batch.column(0), "x": [text_features(t.as_py()) for t in batch.column(1)]}

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id bigint, x array<double>")


@dataclass
class Network:
    """One hidden layer over standardised, clipped inputs."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    @classmethod
    def start(cls, x: np.ndarray) -> Network:
        rng = np.random.default_rng(SEED)
        scale = x.std(axis=0)
        return cls(x.mean(axis=0), np.where(scale > 1e-9, scale, 1.0), [
            rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN), np.zeros(1),
        ])

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -CLIP, CLIP)

    def forward(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(z @ self.weights[0] + self.weights[1])
        return hidden, hidden @ self.weights[2] + self.weights[3][0]

    def gradients(self, z: np.ndarray, hidden: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        back = slope[:, None] * self.weights[2] * (1 - hidden**2)
        return [z.T @ back, back.sum(axis=0), hidden.T @ slope, np.array([slope.sum()])]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.forward(self.inputs(x))[1])


def sigmoid(g: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * g))


def risk_slopes(gp: np.ndarray, gu: np.ndarray, prior: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the risk with respect to the outputs for good and for unlabelled rows.

    The risk is prior * E_good[loss(+)] + max(0, E_all[loss(-)] - prior * E_good[loss(-)]) with logistic
    losses; where the second part, the risk of the unseen class, falls below zero, it alone is
    pushed back up. Without a prior, good rows are told from unlabelled ones.
    """
    good_up, good_down, all_down = (sigmoid(gp) - 1) / len(gp), sigmoid(gp) / len(gp), sigmoid(gu) / len(gu)
    if prior is None:
        return 0.5 * good_up, 0.5 * all_down
    negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
    return (prior * good_up - prior * good_down, all_down) if negative >= 0 else (prior * good_down, -all_down)


def fit_network(good: np.ndarray, all_: np.ndarray, prior: float | None) -> Network:
    """Minimise the non-negative risk at ``prior``; without one, tell good from unlabelled rows."""
    net = Network.start(np.concatenate([good, all_]))
    zp, zu = net.inputs(good), net.inputs(all_)
    rng = np.random.default_rng(SEED)
    first = [np.zeros_like(w) for w in net.weights]
    second = [np.zeros_like(w) for w in net.weights]
    steps = max(1, len(zu) // BATCH)
    for t in range(1, EPOCHS * steps + 1):
        p = zp[rng.integers(0, len(zp), min(BATCH, len(zp)))]
        u = zu[rng.integers(0, len(zu), min(BATCH, len(zu)))]
        (hp, gp), (hu, gu) = net.forward(p), net.forward(u)
        slope_p, slope_u = risk_slopes(gp, gu, prior)
        grads = [a + b for a, b in zip(net.gradients(p, hp, slope_p), net.gradients(u, hu, slope_u), strict=True)]
        rate = RATE * (0.1 + 0.9 * (1 - t / (EPOCHS * steps)))
        for w, g, m, v in zip(net.weights, grads, first, second, strict=True):
            g = g + 1e-4 * w
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return net


def estimate_prior(good: np.ndarray, all_: np.ndarray) -> float:
    """Share of good rows in ``all_``: the least unlabelled-to-good mass ratio of a score's upper regions.

    Halves of both sets train the score and measure the ratios, so chance does not lower them;
    regions with less than a fifth of the good rows are too small to judge.
    """
    half_p, half_u = len(good) // 2, len(all_) // 2
    net = fit_network(good[:half_p], all_[:half_u], None)
    p, u = np.sort(net.score(good[half_p:])), np.sort(net.score(all_[half_u:]))
    cuts = np.quantile(p, np.linspace(0, 0.8, 33))
    ratio = (1 - np.searchsorted(u, cuts) / len(u)) / np.maximum(1 - np.searchsorted(p, cuts) / len(p), 1e-9)
    return float(np.clip(ratio.min(), 0.05, 0.98))


def shrunk_prior(good: np.ndarray, all_: np.ndarray) -> float:
    """The estimated prior, drawn towards one half as if by ``PRIOR_WEIGHT`` further good documents."""
    estimate = estimate_prior(good, all_) if len(good) > 1 else 0.5
    return (len(good) * estimate + PRIOR_WEIGHT * 0.5) / (len(good) + PRIOR_WEIGHT)


def in_fold(folds: int, fold: int) -> Column:
    """Whether crc32 of the id's decimal text leaves ``fold``; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def _place() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))


def _share(wanted: int, total: int) -> int:
    """End of a range of the ids' hashes that holds a few more than wanted; the smallest hashes of it are taken."""
    return int((1.05 * wanted + 6 * wanted**0.5 + 20) / total * 1_000_000) + 20


def _sample(docs: DataFrame, sample_docs: int) -> np.ndarray:
    """Statistics of at most ``sample_docs`` documents, those with the smallest hashes, in a fixed order."""
    rows = document_features(docs).orderBy(_place(), "doc_id", "x").limit(sample_docs).select("x", F.xxhash64("doc_id", F.lit(1)).alias("h")).toPandas()
    x = np.array(rows["x"].tolist()).reshape(-1, N_FEATURES)
    return x[np.lexsort((*x.T, rows["h"].to_numpy()))]


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Network | None:
    """Fit on two hash samples of documents of known id; None where no document at all is labelled good.

    The good documents are found first and only then bounded at ``sample_docs``, so however large
    the rest grows they stay as many; the unlabelled set is a sample of at most as many from all
    documents. The fewer the good documents, the more the prior is drawn towards one half.
    """
    known = docs.where(F.col("doc_id").isNotNull())
    labelled = known.select("doc_id").join(labels.where("quality = 1").select("doc_id").distinct(), "doc_id", "left_semi")
    # Ids alone are joined and ranked; the bounded list then goes to the texts.
    ids = labelled.distinct()
    marked = ids.count()
    if marked > sample_docs:
        ids = ids.where(_place() < _share(sample_docs, marked))
    ids = ids.orderBy(_place(), "doc_id").limit(sample_docs)
    good = _sample(known.join(F.broadcast(ids), "doc_id", "left_semi"), sample_docs)
    if not len(good):
        return None
    total = known.count()
    chosen = known
    if total > sample_docs:
        chosen = known.where(_place() < _share(sample_docs, total))
    x = _sample(chosen, sample_docs)
    return fit_network(good, x, shrunk_prior(good, x))


def score(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5 up) of every row, empty texts included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            x = np.array([text_features(t.as_py()) for t in batch.column(1)]).reshape(-1, N_FEATURES)
            found = net.score(x) if net else np.full(len(x), 0.5)
            yield {"doc_id": batch.column(0), "score": found, "predicted": (found >= 0.5).astype(np.int32)}

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id bigint, score double, predicted int")


def score_held_out(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """Learn from the rows outside one fold, score all rows: doc_id, held_out, score, predicted.

    Labels repeated for an id count as good if one of them is. Null ids are not learned from.
    With no good document to learn from every score is 0.5.
    """
    net = fit(docs.where(~in_fold(folds, fold)), labels.where(~in_fold(folds, fold)))
    return score(docs, net).select("doc_id", in_fold(folds, fold).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents whose score is at least 0.5, all columns kept; with no document labelled good, all of them."""
    net = fit(docs, labels)
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            x = np.array([text_features(t.as_py()) for t in texts]).reshape(-1, N_FEATURES)
            yield batch.filter(pa.array(net.score(x) >= 0.5)) if net else batch

    return docs.mapInArrow(run, docs.schema)
