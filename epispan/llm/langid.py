"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Texts are lower-cased and everything but letters becomes one blank. Character 1- to 3-grams
are hashed to ``BUCKETS`` columns; document frequencies are counted over all training
documents. Weights are trained with follow-the-regularised-leader and elastic-net penalties,
which leaves most of them exactly zero. A temperature fitted on rows kept back from training
then scales the logits so that scores are calibrated.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, map_arrow
from .pu_quality import in_fold

BUCKETS = 1 << 14
#: Bound on the documents a fit looks at, in all and for each language, chosen by the hash of their ids.
SAMPLE_DOCS, SAMPLE_PER_LANGUAGE = 12_000, 1_200
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.5, 0.1
UNDETERMINED = "und"
#: How many standard deviations the n-grams of a text must say more for its language than n-grams that meet buckets by
#: chance, or ``keep_identified`` takes the language for undetermined.
LEAST_EVIDENCE = 2.0
#: Characters turned into n-grams at once.
BLOCK_CHARS = 1 << 20
_BLANK = 32


def _letter_table() -> np.ndarray:
    """Per code point its lower-case letter, or a blank for what is no letter."""
    table = np.full(sys.maxunicode + 1, _BLANK, np.uint32)
    for code in range(sys.maxunicode + 1):
        if (c := chr(code)).isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


_TABLE: list[np.ndarray] = []


def letters_of(text: str | None) -> np.ndarray:
    """Lower-case letters and single blanks of a text, as code points with a blank at either end."""
    if not _TABLE:
        _TABLE.append(_letter_table())
    text = text or ""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    codes = _TABLE[0].take(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))
    codes = np.concatenate([[_BLANK], codes, [_BLANK]]).astype(np.uint32)
    blank = codes == _BLANK
    return codes[~(blank & np.concatenate([[False], blank[:-1]]))]


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Count per bucket over the whole text; None for a text without letters."""
    codes = letters_of(text)
    if len(codes) < 3:
        return None
    counts = np.zeros(BUCKETS, np.int64)
    with np.errstate(over="ignore"):
        for start in range(0, len(codes), BLOCK_CHARS):
            c = codes[start:start + BLOCK_CHARS + 2]
            own = min(BLOCK_CHARS, len(codes) - start)
            one = c * np.uint32(0x9E3779B1)
            two = (one[:-1] ^ (c[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
            three = (two[:-1] ^ (c[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
            for grams in (one[:own], two[:own], three[:own]):
                counts += np.bincount(grams >> np.uint32(18), minlength=BUCKETS)
    return counts


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each bucket occurs, over all of ``docs``, and how many have letters.

    Each task sends at most one row per bucket; what reaches the driver is one number per bucket.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for value in batch.column(0):
                counts = ngram_counts(value.as_py())
                if counts is not None:
                    seen += counts > 0
                    n += 1
        hit = np.flatnonzero(seen)
        yield {"bucket": np.concatenate([[-1], hit]), "n": np.concatenate([[n], seen[hit]])}

    rows = map_arrow(docs.select("text"), run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    frequency = np.zeros(BUCKETS)
    total = 0
    for bucket, n in rows:
        if bucket < 0:
            total = n
        else:
            frequency[bucket] = n
    return frequency, total


def tf_idf(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf.take(buckets)
    size = np.sqrt(values @ values)
    return values / size if size > 0 else values


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, counts: np.ndarray) -> np.ndarray:
        buckets = np.flatnonzero(counts)
        return tf_idf(buckets, counts.take(buckets), self.idf) @ self.weights[buckets] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = ngram_counts(text)
        if counts is None or not self.languages:
            return UNDETERMINED, 0.0
        p = softmax(self.logits(counts) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def chance(model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation per language of the weight of a bucket met by chance."""
    return model.weights.mean(axis=0), model.weights.std(axis=0)


def evidence(model: LanguageModel, counts: np.ndarray, mean: np.ndarray, deviation: np.ndarray) -> float:
    """How far what the n-grams say for the likeliest language lies above chance, in standard deviations.

    A text of unit length in buckets met by chance adds up to the mean weight times its sum, give or take one deviation
    whatever its length. N-grams of no learned language meet buckets by chance, so a text in another script stays near
    zero, where its probabilities say only which language is the least unlikely.
    """
    buckets = np.flatnonzero(counts)
    x = tf_idf(buckets, counts.take(buckets), model.idf)
    said = x @ model.weights[buckets]
    best = int((said + model.bias).argmax())
    above = said[best] - mean[best] * x.sum()
    return float(above / deviation[best]) if deviation[best] > 0 else 0.0


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], languages: list[str], idf: np.ndarray) -> LanguageModel:
    """Follow the regularised leader over sparse rows (buckets, TF-IDF values, language number)."""
    k = len(languages)
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        zs = z[at]
        return np.where(np.abs(zs) <= L1, 0.0, (np.sign(zs) * L1 - zs) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    rng = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            buckets, values, language = rows[i]
            at, x = np.append(buckets, BUCKETS), np.append(values, 1.0)
            w = weights(at)
            error = softmax(x @ w)
            error[language] -= 1
            g = x[:, None] * error
            held = n[at]
            grown = held + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(held)) / ALPHA * w
            n[at] = grown
    w = weights(slice(None))
    return LanguageModel(languages, idf, w[:-1], w[-1])


def calibrate(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature with the least negative log likelihood, by golden-section search on its logarithm."""
    if not len(truth):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return float(-np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-300)).mean())

    low, high, ratio = np.log(0.02), np.log(50.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _sample(docs: DataFrame) -> tuple[list, list[str]]:
    """Sparse counts of a bounded, hash-chosen set of documents of each language.

    Of more than ``SAMPLE_DOCS`` languages the most frequent are learnt, which bounds the model too.
    """
    spark = docs.sparkSession
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    rows_of = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(SAMPLE_DOCS).collect()}
    languages = sorted(rows_of)
    if not languages:
        return [], []
    each = max(1, min(SAMPLE_PER_LANGUAGE, SAMPLE_DOCS // len(languages)))
    # A language's share of the hash range that holds half as many again; only those few rows are ranked.
    whole = 1 << 40
    shares = spark.createDataFrame([(k, min(whole, int(whole * (1.5 * each + 20) / n) + 1)) for k, n in rows_of.items()], "lang string, share bigint")
    near = labelled.select("doc_id", "lang").join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(whole)) < F.col("share"))
    order = Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(whole)), "doc_id")
    ids = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each).select("doc_id").distinct()
    chosen = labelled.select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            found = [ngram_counts(t.as_py()) for t in batch.column(1)]
            at = [np.flatnonzero(c) if c is not None else np.zeros(0, np.int64) for c in found]
            yield {
                "doc_id": batch.column(0), "lang": batch.column(2), "buckets": [a.astype("<u2").tobytes() for a in at],
                "counts": [c[a].astype("<u4").tobytes() if c is not None else b"" for a, c in zip(at, found, strict=True)],
            }

    found = map_arrow(chosen, run, "doc_id bigint, lang string, buckets binary, counts binary")
    # Repeated ids may make more rows than ids; those behind the bound are told by their order, not by chance.
    rows = found.orderBy("doc_id", "lang", "buckets").limit(SAMPLE_DOCS).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["lang"], bytes(r["buckets"])))
    return [(np.frombuffer(r["buckets"], "<u2").astype(np.int64), np.frombuffer(r["counts"], "<u4"), languages.index(r["lang"])) for r in rows if r["buckets"]], languages


def fit(docs: DataFrame) -> LanguageModel:
    """Learn from text and non-null lang of documents with an id; with none, everything is undetermined."""
    rows, languages = _sample(docs)
    if not rows:
        return LanguageModel([], np.ones(BUCKETS), np.zeros((BUCKETS, 0)), np.zeros(0))
    frequency, total = document_frequencies(docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()))
    idf = np.log((1 + total) / (1 + frequency)) + 1
    values = [(b, tf_idf(b, c, idf), k) for b, c, k in rows]
    kept_back = [v for i, v in enumerate(values) if i % 5 == 4]
    model = train([v for i, v in enumerate(values) if i % 5 != 4], languages, idf)
    logits = np.array([v @ model.weights[b] + model.bias for b, v, _ in kept_back]).reshape(-1, len(languages))
    model.temperature = calibrate(logits, np.array([k for *_, k in kept_back], int))
    return model


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score of every row; ``und`` with score 0 for texts that are null or have no letter."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(1)]
            yield {"doc_id": batch.column(0), "lang_pred": [a for a, _ in found], "score": [b for _, b in found]}

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id bigint, lang_pred string, score double")


def predict_held_out(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """Learn from the rows outside one fold, predict all rows: doc_id, held_out, lang_pred, score."""
    held: Column = in_fold(folds, fold)
    return predict(docs, fit(docs.where(~held))).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least_evidence: float = LEAST_EVIDENCE) -> DataFrame:
    """Documents whose language is determined: their n-grams speak for a learned language; all columns kept.

    Texts without a letter go, and so do those whose evidence is not above ``least_evidence``. Where no row names a
    language, or all name one and the weights are zero, there is nothing to tell, and only texts without a letter go.
    """
    model = fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast((model, *chance(model)) if model.weights.any() else None)
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (ngram_counts(t.as_py()) for t in batch.column(batch.schema.get_field_index("text")))
            keep = [c is not None and (shared.value is None or evidence(shared.value[0], c, *shared.value[1:]) > least_evidence) for c in found]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
