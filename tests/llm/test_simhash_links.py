import itertools
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from epispan.llm import simhash_links as s
from epispan.llm.components import connected_components


def brute_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(prints):
    ids = list(prints)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(ids, 2):
        if bin(prints[i] ^ prints[j]).count("1") <= 2:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return {i: root(i) for i in ids}


TEXTS = [None, "", " \t", "One", "one two", "A b C", "été\x1cx y\x85z w", "a b c d e f " * 50, "A B c d e f " * 50, "x " * 200_000, "one two three four"]


def test_fingerprints_match_spark_and_brute_force(spark):
    assert [s.simhash(t) for t in TEXTS] == [brute_print(t) for t in TEXTS]
    row = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first()
    assert s.simhash("A b C") == row.h % 2**64


@pytest.mark.parametrize("limit", [1, 4, 1000])
def test_components_match_brute_force(spark, limit):
    rng = random.Random(limit)
    prints = {}
    for i in range(260):
        value = rng.choice(list(prints.values())) if prints and rng.random() < 0.75 else rng.getrandbits(64)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3])):
            value ^= 1 << rng.randrange(64)
        prints[1000 - i] = value
    frame = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in set(prints.values())], "fp bigint")
    roots = {r.node: r.root for r in connected_components(s.fingerprint_links(frame, limit)).collect()}
    signed = {i: v - 2**64 if v >= 2**63 else v for i, v in prints.items()}
    got = {}
    for i, v in signed.items():
        got.setdefault(roots.get(v, v), []).append(i)
    want = {}
    for i, r in brute_components(prints).items():
        want.setdefault(r, []).append(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_long_chain_settles(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in connected_components(links).collect()} == {0}
    assert connected_components(links.limit(0)).count() == 0


def test_documents(spark):
    rows = [(50 - i, t, "f") for i, t in enumerate(TEXTS)] + [(7, "a b c", "f"), (7, "a b c", "f"), (None, "a b c", "f"), (None, "only here now", "f")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fingerprint string").repartition(4)
    got = sorted((r.doc_id or -1, r.fingerprint, r.component_id or -1) for r in s.near_duplicates(docs).collect())
    prints = {i: brute_print(t) for i, t, _ in rows if i is not None}
    roots = brute_components(prints)
    by_print = {f"{prints[i]:016x}": roots[i] for i in prints}
    want = sorted((i or -1, f"{brute_print(t):016x}", by_print.get(f"{brute_print(t):016x}", -1)) for i, t, _ in rows)
    assert got == want
    kept = s.keep_one_of_each(docs).collect()
    assert sorted(r.doc_id or -1 for r in kept) == sorted([*set(roots.values()), -1, -1]) and kept[0].asDict().keys() == {"doc_id", "text", "fingerprint"}
    assert s.near_duplicates(docs.limit(0)).count() == 0


def test_an_id_with_two_texts_keeps_and_loses_by_text(spark):
    one, two = "alpha beta gamma delta epsilon zeta", "one two three four five six seven"
    rows = [(3, one, "b"), (7, one, "a"), (7, two, "a"), (7, two, "b"), (9, two, "c"), (None, one, "n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _place string").repartition(3)
    kept = sorted((r.doc_id or -1, r.text, r["_place"]) for r in s.keep_one_of_each(docs).collect())
    assert kept == [(-1, one, "n"), (3, one, "b"), (7, two, "a")]
    # One id that names two groups keeps a text of each.
    both = spark.createDataFrame([(1, one), (1, two), (2, one), (2, two)], "doc_id bigint, text string")
    assert sorted(tuple(r) for r in s.keep_one_of_each(both).collect()) == [(1, one), (1, two)]
