import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from epispan.llm import spelling_variants as sv
from epispan.llm.queries import LLM_QUERIES, SLIP
from epispan.session import table


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    """The grouping by comparing every word with every word."""
    words = {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def brute_counts(docs, slip):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if slip and h % slip == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= 7:
                counts[word] += 1
    return counts


def test_query_matches_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    got = LLM_QUERIES["op11_spelling_variants"](spark, folder)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute(brute_counts(docs, SLIP))
    assert any(r[1] for r in rows) and any(r[4] > 1 for r in rows)


@pytest.mark.parametrize("symbols", [2, 8])
def test_random_words_with_chains(spark, symbols):
    pick = random.Random(3)
    counts = {}
    for _ in range(60):
        word = "".join(pick.choice("abcdé") for _ in range(pick.randint(7, 12)))
        counts[word] = pick.choice([2, 5, 3000, 40000])
        for _ in range(10):
            at, how = pick.randrange(len(word)), pick.randrange(3)
            word = [word[:at] + word[at + 1:], word[:at] + pick.choice("abcdé") + word[at:], word[:at] + pick.choice("abcdé") + word[at + 1:]][how]
            counts[word] = pick.choice([1, 2, 4, 30, 400])
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    pairs = {tuple(r) for r in sv.near_pairs(frame, symbols).select("a", "b").collect()}
    assert {frozenset(p) for p in pairs} == {frozenset((a, b)) for a in counts for b in counts if one_apart(a, b)}
    got = {tuple(r) for r in sv.group_variants(frame).collect()}
    assert got == brute(counts) and any(r[1] and r[2] != r[1] for r in got)


def test_odd_rows(spark):
    docs = [
        (None, None, 1), (1, "", 1), (2, "x" * 100_000 + " Seventh SEVENTH sevenths ÀÉÎÕÜßÿ ÀÉÎÕÜßÿ 1seventh2", 1), (2, "y" * 99_999 + "é" + " " + "x" * 100_001, 1),
        (None, "x" * 100_000 + " " + "x" * 100_001, 1),
    ]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, word int")
    counts = {r.word: r.n for r in sv.count_words(frame).collect()}
    assert counts == brute_counts([d[:2] for d in docs], None)
    assert {r.word: r.n for r in sv.count_words(frame, slip=3).collect()} == brute_counts([d[:2] for d in docs], 3)
    got = {r.word: (r.form, r.n_near) for r in sv.group_variants(sv.count_words(frame)).collect()}
    assert got["x" * 100_000] == (None, 1) and got["seventh"] == (None, 0) and "sevenths" not in got


def test_ties_repeats_nulls_and_nothing(spark):
    rows = [("letters", 30, 0), ("letterz", 2, 0), ("lettera", 30, 0), ("letterz", 1, 0), (None, 9, 0), ("aaaaaaa", 2, 0), ("aaaaaaaa", 20, 0)]
    got = {r.word: tuple(r)[1:] for r in sv.group_variants(spark.createDataFrame(rows, "word string, n bigint, form int")).collect()}
    assert got == {
        "letters": (None, "letters", 30, 2, None), "lettera": (None, "lettera", 30, 2, None), "letterz": ("lettera", "lettera", 3, 2, 30),
        "aaaaaaa": ("aaaaaaaa", "aaaaaaaa", 2, 1, 20), "aaaaaaaa": (None, "aaaaaaaa", 20, 1, None),
    }
    assert sv.group_variants(spark.createDataFrame([], "word string, n bigint")).collect() == []
    with pytest.raises(ValueError):
        sv.group_variants(spark.createDataFrame(rows, "word string, n bigint, form int"), least_ratio=1)


def test_neighbourhood_is_whole():
    """Every word one symbol apart is reached from one of the two sides, exactly once."""
    def key(w):
        return sv.mix64(np.array([sum((ord(c) - 96) * pow(sv._BASE, i, 2**64) for i, c in enumerate(w)) % 2**64], np.uint64))[0]

    for word in ("abca", "aab", "c"):
        reached = Counter(int(k) for near, _ in sv.neighbourhood([word], 3) for k in near)
        deleted = {word[:i] + word[i + 1:] for i in range(len(word))} if len(word) > 1 else {""}
        smaller = {word[:i] + s + word[i + 1:] for i in range(len(word)) for s in "abc" if s < word[i]}
        assert reached == Counter(int(key(w)) if w else int(sv.mix64(np.zeros(1, np.uint64))[0]) for w in {word} | deleted | smaller)
