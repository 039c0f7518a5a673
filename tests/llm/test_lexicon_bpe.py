import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from epispan.llm import lexicon_bpe as b

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
TEXTS = [
    "Hello wörld's <|endoftext|> x\x1cy  don't 12", None, "", "   ", "ΣΑΣ İstanbul été ÀÉ äb", "a\x85b c d​e᠎f",
    "word " * 3000, "naïve—café…ﬁ ½ ٣ 漢字 😀👍🏽 \x00nul\x00", "it'S we'LL <|startoftext|><|endoftext|>x <|ENDOFTEXT|>", "́lead mark",
    "thandthe" * 400, "!?" * 500, "hello", "hello", "Å Å ｆｕｌｌ 'Tis 'S's",
]


@pytest.fixture(scope="module")
def lexicon(tmp_path_factory):
    def make(words):
        tokenizer = b.tokenizer_file(PATH)
        path = tmp_path_factory.mktemp("lexicon") / "l.mat"
        path.write_bytes(b.compile_lexicon(dict(zip(words, tokenizer.merge(words), strict=True))))
        return b.Lexicon(str(path))

    return make


def check(encoder, texts):
    for text, ids, shown in zip(texts, *encoder.encode(texts), strict=True):
        want = WHOLE.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert shown.decode() == WHOLE.decode(want, skip_special_tokens=False)


def test_ids_do_not_depend_on_the_lexicon(lexicon):
    for words in ([], [b"hello"], [b"hello", b"word", "été".encode(), b"!?", b"don", b"donuts", b"word's", b"nuts"]):
        check(b.LexiconEncoder(b.tokenizer_file(PATH), lexicon(words)), TEXTS)
    check(b.LexiconEncoder(b.tokenizer_file(PATH), None), TEXTS)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("abthein 'sé1.,<|>\n"), st.characters(codec="utf-8")), max_size=40), max_size=5))
def test_random_texts(texts):
    check(b.LexiconEncoder(b.tokenizer_file(PATH), None), texts)


def test_automaton_is_minimal_and_numbers_words(lexicon):
    words = [b"tap", b"taps", b"top", b"tops", b"s", b"zebras", b"zebra"]
    held = lexicon(words)
    assert held.places(sorted(words)).tolist() == list(range(7))
    assert held.places([b"", b"ta", b"tapss", b"q", b"x" * 200]).tolist() == [-1] * 5
    endings = [{w[len(p):] for w in words if w.startswith(p)} for p in {w[:i] for w in words for i in range(len(w) + 1)}]
    assert len(held.final) == len({frozenset(e) for e in endings})


def test_documents(spark):
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, n_tokens int").repartition(3)
    encoded = b.encode_documents(docs, PATH)
    rows = {r.doc_id: r for r in encoded.collect()}
    back = {r.doc_id: r.text for r in b.decode_documents(encoded, PATH).collect()}
    for i, text in enumerate(TEXTS):
        ids = WHOLE.encode(text or "", add_special_tokens=False).ids
        shown = WHOLE.decode(ids, skip_special_tokens=False)
        assert (rows[i].ids, rows[i].n_tokens, back[i]) == (ids, len(ids), shown)
        assert rows[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(shown.encode()).hexdigest()
    assert b.encode_documents(docs.limit(0), PATH).count() == 0


def test_lexicon_words_are_counted_over_all_partitions(spark):
    """Words too rare in each slice are frequent in the corpus, and a cut among equals takes as many as asked for."""
    rows = [(i, "common " + " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)) + (" rare" if i < 2 else "")) for i in range(12)]
    docs = spark.createDataFrame(rows * 1, "doc_id bigint, text string").repartition(12)
    all_ = b.frequent_words(docs, PATH)
    assert len(all_) == 61 and "common" in all_ and "rare" not in all_
    few = b.frequent_words(docs.unionAll(docs.selectExpr("doc_id", "'common'")), PATH, 10)
    assert len(few) == 10 and few[0] == "common" and set(few) <= set(all_)
    assert few == b.frequent_words(docs.repartition(3).unionAll(docs.selectExpr("doc_id", "'common'")), PATH, 10)
    assert b.frequent_words(docs.limit(0), PATH) == []


def test_words_are_counted_in_slices_of_any_size(spark):
    """How much text a worker counts at once bounds its memory and changes no word."""
    docs = spark.createDataFrame([(i, f"one two{chr(97 + i % 5)} three " * (i + 1)) for i in range(30)], "doc_id bigint, text string").repartition(2)
    whole = b.frequent_words(docs, PATH, 4)
    assert len(whole) == 4 and b.frequent_words(docs, PATH, 4, slice_chars=10) == whole
    assert b.COUNTED_CHARS < b.TOGETHER_CHARS
