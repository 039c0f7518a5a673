import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from epispan.llm import suffix_repeats as sr

SCHEMA = "source string, doc_id bigint, text string, n_bytes int, key int"


def brute(texts, length):
    """Removed stretches of each text, by a table of all strings."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        out.append((len(r), int(gone.sum()), spans, bytes(np.frombuffer(r, np.uint8)[~gone])))
    return out


def check(spark, texts, length=sr.LENGTH, **more):
    frame = spark.createDataFrame([("s", i, t, 0, 1) for i, t in enumerate(texts)], SCHEMA)
    got = sr.remove_repeats(frame, length, **more).orderBy("doc_id").collect()
    want = brute(texts, length)
    assert [(r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in got] == want
    return want


def mosaic(seed, n, length, words=400):
    """Texts that share stretches around and above the length, at varying offsets."""
    pick = random.Random(seed)
    made = ["".join(pick.choice("abcdefgh é") for _ in range(pick.randint(2, 9))) for _ in range(words)]
    prose = lambda k: " ".join(pick.choice(made) for _ in range(k))
    passages = [prose(pick.randint(length // 8, length)) for _ in range(8)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(pick.randint(1, 4)):
            parts.append(prose(pick.randint(1, 60)))
            passage = pick.choice(passages)
            a = pick.randint(0, len(passage) // 2)
            parts.append(passage[a:a + pick.randint(length - 20, 3 * length)])
        out.append(pick.choice(["", " "]).join(parts))
    return out


@pytest.mark.parametrize("limit", [2, sr.GROUP_LIMIT])
def test_matches_brute_force(spark, limit):
    want = check(spark, [*mosaic(1, 40, 60), *mosaic(2, 20, 60)], 60, lead=16, group_limit=limit)
    assert sum(n for _, n, _, _ in want) > 0 and any(0 < n < size for size, n, _, _ in want)


def test_contract_length_and_blocks(spark, monkeypatch):
    check(spark, mosaic(3, 25, sr.LENGTH))
    monkeypatch.setattr(sr, "BLOCK_STRINGS", 97)
    texts = mosaic(4, 10, 60)
    runs = sr.Runs(texts[0].encode(), 60, 16)
    assert runs.start[0] == 0 and (runs.stop[:-1] == runs.start[1:]).all() and runs.stop[-1] == len(texts[0].encode()) - 59


def test_odd_rows(spark):
    same = "the same words " * 30
    texts = [None, "", "short", same, same, "a" * 1000, "ab" * 400, "x" * 199, "y" * 200, "z" * 201, "\0" * 260, "é" * 150, "é" * 90 + "tail" + "é" * 120]
    want = check(spark, texts)
    assert want[8][1] == 0 and want[9][1] == 201 and want[3][1] == len(same)


def test_two_texts_that_share_the_least_and_one_byte_less(spark):
    pick = random.Random(5)
    prose = ["".join(pick.choice("abcdefghij ") for _ in range(900)) for _ in range(4)]
    shared = "".join(pick.choice("klmnop") for _ in range(200))
    texts = [prose[0] + "Q" + shared + "R" + prose[1], prose[2] + "S" + shared + "T", "U" + shared[1:] + "V" + prose[3], "W" + shared[:199]]
    assert [n for _, n, _, _ in check(spark, texts)] == [200, 200, 0, 0]


def test_one_passage_in_very_many_texts(spark):
    pick = random.Random(6)
    passage = "".join(pick.choice("abcdefghij ") for _ in range(320))
    texts = [f"{i} {pick.random()} " * 12 + passage + f" {pick.random()} {i}" * 12 for i in range(150)]
    want = check(spark, texts, group_limit=20)
    assert all(n == 320 or n > 320 for _, n, _, _ in want)


def test_empty_and_repeated_ids(spark):
    assert sr.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
    text = "".join(random.Random(7).choice("abcdef ") for _ in range(300))
    frame = spark.createDataFrame([("s", None, text, 0, 0), ("s", 3, text, 0, 0), ("s", 3, "unlike", 0, 0)], SCHEMA)
    assert sorted((str(r.doc_id), r.n_removed, bytes(r.kept)) for r in sr.remove_repeats(frame).collect()) == [("3", 0, b"unlike"), ("3", 300, b""), ("None", 300, b"")]


def test_suffixes_are_sorted_with_their_common_prefixes():
    pick = random.Random(8)
    strings = ["".join(pick.choice("ab\0") for _ in range(pick.randint(0, 25))).encode() for _ in range(400)]
    groups = np.sort(np.array([pick.randint(0, 5) for _ in strings]))
    order, common = sr.suffix_order(strings, groups)
    assert [(groups[i], strings[i]) for i in order.tolist()] == sorted(zip(groups.tolist(), strings, strict=True))
    for k in range(1, len(order)):
        a, b = strings[order[k - 1]], strings[order[k]]
        want = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert common[k] == (want if groups[order[k]] == groups[order[k - 1]] else -1)


def test_query_matches_brute_force(spark):
    from epispan.llm.queries import LLM_QUERIES
    from epispan.session import table

    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    want = [
        (d.doc_id, n_bytes, n_removed, len(spans), hashlib.sha256(kept).hexdigest())
        for d, (n_bytes, n_removed, spans, kept) in zip(docs, brute([d.text for d in docs], sr.LENGTH), strict=True)
    ]
    got = [tuple(r) for r in LLM_QUERIES["op12_suffix_dedup"](spark, folder).orderBy("doc_id").collect()]
    assert got == want and any(w[2] for w in want)
