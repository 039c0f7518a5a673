"""Spelling variants grouped by one-edit neighbourhoods over a reduced alphabet.

Letters are hashed to ``SYMBOLS`` symbols, so a word becomes a reduced word. Two words one edit
apart have reduced words that are equal or one edit apart. Each distinct reduced word generates
its neighbourhood: itself, every deletion, every replacement by a smaller symbol. Insertions and
replacements by larger symbols are the same pairs seen from the other side, so each pair of
reduced words is met once. The neighbourhood joins the reduced vocabulary by a 64-bit key; the
words behind the two keys are then compared letter by letter, so a clash of keys or symbols
costs a comparison and never a wrong or missing pair.

Nothing is broadcast or collected: the vocabulary, the neighbourhoods and the pairs are tables.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epispan.session import materialize

from .common import lower_ascii, map_arrow, mix64, text_slices

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS = 7
LEAST_COUNT = 2
#: A form occurs at least so many times as often as its variant.
LEAST_RATIO = 10
SYMBOLS = 8
#: Letters of reduced words, times symbols, generated at once.
BLOCK_CELLS = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def count_words(docs: DataFrame, least_letters: int = LEAST_LETTERS, slip: int | None = None) -> DataFrame:
    """word and n, its occurrences in all whole texts; words are maximal runs of ``LETTERS``, A-Z lower-cased.

    With ``slip``, an occurrence loses one letter if ``slip`` divides the unsigned crc32 of
    ``<doc_id>:<word>`` (a null id is empty there): position crc32 modulo its length, from 0.
    Shorter results do not count. Null texts have no words; an empty table gives none.
    """
    pattern = re.compile(f"[{LETTERS}]{{{least_letters},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for ids, texts in text_slices(batches):
            counts: Counter[str] = Counter()
            for key, text in zip(ids, texts, strict=True):
                words = Counter(pattern.findall(lower_ascii(text or "")))
                if slip is None:
                    counts.update(words)
                    continue
                begun = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in words.items():
                    h = zlib.crc32(word.encode(), begun)
                    if h % slip == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    if len(word) >= least_letters:
                        counts[word] += n
            yield {"word": list(counts), "n": list(counts.values())}

    found = map_arrow(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text"), run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def reduce_letters(codes: np.ndarray, symbols: int = SYMBOLS) -> np.ndarray:
    """Symbol (from 1) of each code point, by a multiplicative hash."""
    return ((codes.astype(np.uint64) * np.uint64(0x9E3779B1)) >> np.uint64(13)) % np.uint64(symbols) + np.uint64(1)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of words of one length with their code points, in blocks of bounded size."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths[lengths > 0]).tolist():
        places = np.flatnonzero(lengths == length)
        step = max(1, BLOCK_CELLS // length)
        for i in range(0, len(places), step):
            block = places[i:i + step]
            joined = "".join([words[k] for k in block.tolist()]).encode("utf-32-le")
            yield block, np.frombuffer(joined, "<u4").reshape(len(block), length)


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, _BASE, np.uint64)]))


def reduced_words(words: list[str], symbols: int = SYMBOLS) -> tuple[list[str], np.ndarray]:
    """Each word's reduced word, as letters from ``a`` on, and its key."""
    out, keys = [""] * len(words), np.zeros(len(words), np.uint64)
    for block, codes in _by_length(words):
        reduced = reduce_letters(codes, symbols)
        with np.errstate(over="ignore"):
            keys[block] = mix64((reduced * _powers(reduced.shape[1])).sum(axis=1, dtype=np.uint64))
        text = (reduced + np.uint64(96)).astype(np.uint8).tobytes().decode("latin-1")
        width = reduced.shape[1]
        for k, place in enumerate(block.tolist()):
            out[place] = text[k * width:(k + 1) * width]
    return out, keys


def neighbourhood(reduced: list[str], symbols: int = SYMBOLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of each reduced word's neighbours, with the key of the word, in blocks.

    Neighbours are the word itself, its distinct deletions and its replacements by smaller symbols.
    """
    one = np.uint64(1)
    for _, codes in _by_length(reduced):
        sym = codes.astype(np.uint64) - np.uint64(96)
        width = sym.shape[1]
        power = _powers(width)
        with np.errstate(over="ignore"):
            placed = sym * power
            whole = placed.sum(axis=1, dtype=np.uint64)
            own = mix64(whole)
            yield own, own
            moved = np.zeros_like(placed)
            moved[:, 1:] = sym[:, 1:] * power[:-1]
            before = np.cumsum(placed, axis=1, dtype=np.uint64) - placed
            after = moved.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(moved, axis=1, dtype=np.uint64)
            kept = np.ones(sym.shape, bool)
            kept[:, 1:] = sym[:, 1:] != sym[:, :-1]
            rows, _ = np.nonzero(kept)
            yield mix64((before + after)[kept]), own[rows]
            for symbol in range(1, symbols):
                larger = sym > np.uint64(symbol)
                rows, places = np.nonzero(larger)
                yield mix64(whole[rows] - (sym[larger] - np.uint64(symbol) * one) * power[places]), own[rows]


def near_pairs(vocabulary: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """Every pair (a, n_a, b, n_b) of words of ``vocabulary`` (word, n) one inserted, deleted or replaced letter apart, once."""
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            reduced, keys = reduced_words(batch.column(0).to_pylist(), symbols)
            yield {"word": batch.column(0), "n": batch.column(1), "reduced": reduced, "key": pa.array(keys.view(np.int64))}

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for near, own in neighbourhood(batch.column(0).to_pylist(), symbols):
                yield {"near": pa.array(near.view(np.int64)), "own": pa.array(own.view(np.int64))}

    words = materialize(map_arrow(vocabulary.select("word", "n"), reduce, "word string, n bigint, reduced string, key bigint"), "reduced-words")
    near = map_arrow(words.select("reduced").distinct(), generate, "near bigint, own bigint")
    right = words.select(F.col("key").alias("near"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    left = words.select(F.col("key").alias("own"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    met = near.join(right, "near").select("own", "b", "n_b", (F.col("own") == F.col("near")).alias("same"))
    apart = (F.abs(F.char_length("a") - F.char_length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1)
    found = left.join(met, (left["own"] == met["own"]) & (~F.col("same") | (F.col("a") < F.col("b"))) & apart)
    return found.select("a", "n_a", "b", "n_b").distinct()


def follow(steps: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of steps (word, form) that begins at each word; chains must not close.

    Each round doubles the length of chain that is covered.
    """
    reached = materialize(steps.select("word", F.col("form").alias("root")), "form-steps")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(
            reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "form-roots",
        )
        reached = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return reached


def group_variants(counts: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, least_ratio: int = LEAST_RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of ``counts`` (word, n).

    Words below ``least_letters`` or ``least_count`` do not take part. A word's form is the word
    nearby of largest n (of equals the first in code-point order) if it occurs ``least_ratio``
    times as often or more, else null. The root is where forms lead in the end, the word itself
    without a form; n grows along a chain, so it ends. Rows of one word are added up, null words
    and counts go, an empty table gives an empty result, and other columns are ignored.
    """
    if least_ratio < 2:
        raise ValueError("least_ratio must be 2 or more, or chains of forms could close")
    summed = counts.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))
    words = materialize(summed.where((F.col("n") >= least_count) & (F.char_length("word") >= least_letters)), "variant-words")
    pairs = materialize(near_pairs(words), "near-words")
    sides = pairs.select(F.col("a").alias("word"), F.col("b").alias("form"), F.col("n_b").alias("form_n")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("form"), F.col("n_a").alias("form_n"))
    )
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("rarity"), "form")).alias("best"))
    held = F.when(-F.col("best")["rarity"] >= least_ratio * F.col("n"), F.col("best")["form"])
    judged = words.join(best, "word", "left").select(
        "word", held.alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(held.isNotNull(), -F.col("best")["rarity"]).alias("form_n"),
    )
    judged = materialize(judged, "word-forms")
    roots = follow(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
