import re

import pytest

from epispan.llm import decontaminate as d


def brute(docs, items, window):
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, text in items:
        w = split(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[i:i + window]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        w = split(text)
        hit, found = set(), set()
        for key, who in windows.items():
            for i in range(len(w) - len(key) + 1):
                if tuple(w[i:i + len(key)]) == key:
                    hit |= set(range(i, i + len(key)))
                    found |= who
        out[doc] = (len(w), len(hit), sorted(found))
    return out


DOCS = [
    (1, "Zero ONE two, three four! five six"), (2, None), (3, ""), (4, "été Über x the été über x"),
    (5, "one two three one two three four"), (6, "!!! ..."), (7, "tiny"), (8, "one two three " * 2000), (9, "a tiny thing"),
]
ITEMS = [(10, "one two three four"), (2, "Été ÜBER x"), (3, "tiny"), (4, None), (5, "??"), (6, "two three four"), (7, "one two three four")]


@pytest.fixture
def frames(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in DOCS], "doc_id bigint, text string, items string, n_chars int")
    return docs, spark.createDataFrame(ITEMS, "item_id bigint, text string")


def test_matches_brute_force(frames):
    docs, items = frames
    want = brute(DOCS, ITEMS, 3)
    rows = d.find_benchmark_passages(docs, items, 3).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in rows} == want
    assert all(r.contaminated == (r.n_hit > 0) for r in rows)


def test_spans_point_into_the_original(frames):
    docs, items = frames
    text = dict(DOCS)
    spans = {r.doc_id: [text[r.doc_id][s.start:s.end] for s in r.spans] for r in d.find_benchmark_passages(docs, items, 3).collect()}
    assert spans[1] == ["ONE two, three four"]
    assert spans[9] == ["tiny"] and spans[2] == []


def test_removal_keeps_the_rest(frames):
    docs, items = frames
    rows = {r.doc_id: r for r in d.cut_passages(docs, items, 3).collect()}
    assert rows[1].text == "Zero ! five six" and rows[1].n_chars == len(rows[1].text)
    assert 7 not in rows and rows[2].text is None and rows[6].text == "!!! ..." and rows[1]["items"] == "x"
    clean = d.keep_clean(docs, items, 3)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [2, 3, 4, 6]


def test_empty_tables_and_bound(spark, frames):
    docs, items = frames
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert {r.n_hit for r in d.find_benchmark_passages(docs, none).collect()} == {0}
    assert d.find_benchmark_passages(docs.limit(0), items).count() == 0
    with pytest.raises(ValueError):
        d.benchmark_items(items, 5)


def test_a_benchmark_above_the_bound_is_scanned_in_groups(spark, frames, monkeypatch):
    docs, items = frames
    assert len(d.benchmark_groups(items, 3)) == 1
    # Item 10 has 18 characters, so at 15 its two windows lie in different pieces.
    groups = d.benchmark_groups(items, 3, 15)
    assert len(groups) > 4 and [t for g in groups for i, t in g if i == "10"] == ["one two three", "two three four"]
    want = brute(DOCS, ITEMS, 3)
    for run_bytes in (1, 1 << 20):
        monkeypatch.setattr(d, "RUN_BYTES", run_bytes)
        rows = d.find_benchmark_passages(docs, items, 3, max_chars=15).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in rows} == want
    whole, grouped = (d.cut_passages(docs, items, 3, n).orderBy("doc_id").collect() for n in (4_000_000, 15))
    assert whole == grouped
    assert sorted(r.doc_id for r in d.keep_clean(docs, items, 3, max_chars=15).collect()) == [2, 3, 4, 6]


def test_more_than_an_automaton_holds_is_not_refused(spark):
    # Long words: 5 million characters, few windows.
    texts = [" ".join(f"w{k}x{i}" + "y" * 10_000 for i in range(20)) for k in range(25)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    part = lambda k: " ".join(texts[k].split()[3:13])
    asked = spark.createDataFrame([(1, f"x {part(0)} y {part(24)}"), (2, "x y")], "doc_id bigint, text string")
    rows = {r.doc_id: (r.n_hit, r["items"], r.contaminated) for r in d.find_benchmark_passages(asked, items).collect()}
    assert rows == {1: (20, ["0", "24"], True), 2: (0, [], False)}
