import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from epispan.llm import token_alignment as ta
from epispan.llm.queries import LLM_QUERIES
from epispan.session import table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, chunk int, links string"


def brute(docs):
    """Whole texts through both libraries, ends compared one by one."""
    a_tok, b_tok = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_tok.encode_special_tokens = True
    alphabet = ta.byte_alphabet()
    found, counts = [], Counter()
    for key, text in docs:
        groups, links, a, b = [], [], [], []
        if text:
            a = a_tok.encode(f" {text}", add_special_tokens=False).ids
            b = b_tok.encode(text)
            a_raw = [bytes(alphabet[c] for c in a_tok.id_to_token(i)) for i in a]
            b_raw = [bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(a_raw) != f" {text}".encode() or b"".join(b_raw) != f" {text}".encode():
                a, b = [], []
            else:
                a_ends, b_ends = np.cumsum([len(x) for x in a_raw]).tolist(), np.cumsum([len(x) for x in b_raw]).tolist()
                i = j = 0
                for end in sorted(set(a_ends) & set(b_ends)):
                    x, y = a_ends.index(end, i) + 1, b_ends.index(end, j) + 1
                    groups.append(f"{','.join(map(str, a[i:x]))}|{','.join(map(str, b[j:y]))}")
                    links.append((a[x - 1], b[y - 1]))
                    i, j = x, y
        counts.update(links)
        found.append((key, len(a), len(b), groups, links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return sorted(
        (repr(key), n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
        for key, n_a, n_b, groups, links in found
    )


def rows(frame):
    return sorted((repr(r[0]), *tuple(r)[1:]) for r in frame.collect())


def test_query_matches_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    got = LLM_QUERIES["op13_token_alignment"](spark, folder)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows(got) == brute(docs)


ODD = [
    None, "", " ", "a", " lead", "trail ", "two  blanks   three\n\n lines\t tab", "a▁b wörd", "plain ▁ mark", "<|endoftext|> x <s>y</s><0x41><unk>", "naïve Ünïcode — “quotes” 漢字 かな 🙂🏽 ﬁ ａｂ",
    "don't we'll THEY'RE 12345 3.14", "x" * 5000, "é  nbsp ​zero \x00nul \x1c sep \x85", "word " * 3000, "the cat. the cat! (the) cat", "▁", "a　b  c",
]


@pytest.mark.parametrize("chunk", [20, ta.CHUNK_CHARS])
def test_odd_texts(spark, chunk):
    docs = [(i if i % 5 else None, t) for i, t in enumerate([*ODD, *ODD[:4]])]
    frame = spark.createDataFrame([(k, t, 7, "x") for k, t in docs], SCHEMA)
    assert rows(ta.align_documents(frame, A, B, chunk)) == brute(docs)


def test_groups_on_request_and_nothing(spark):
    frame = spark.createDataFrame([(1, "hello world", 7, "x"), (2, None, 7, "x")], SCHEMA)
    got = {r.doc_id: r.groups for r in ta.align_documents(frame, A, B, with_groups=True).collect()}
    assert got[2] == "" and hashlib.sha256(got[1].encode()).hexdigest() == brute([(1, "hello world")])[0][-1]
    assert ta.align_documents(spark.createDataFrame([], SCHEMA), A, B).collect() == []


def test_forgetting_worker_gives_the_same():
    own, bare = ta.Aligner(A, B), ta.Aligner(A, B, memo_pieces=0)
    bare.cuts = False
    for _ in range(2):
        assert list(own.align(ODD)) == list(bare.align(ODD))


def test_coalescing_and_overlaps():
    a_ends, b_ends = np.array([2, 5, 6, 9]), np.array([1, 2, 6, 7, 8, 9])
    a_starts, b_starts = np.r_[0, a_ends[:-1]], np.r_[0, b_ends[:-1]]
    groups = ta.coalesce(np.r_[a_starts, b_starts], np.r_[a_ends, b_ends])
    assert groups.tolist() == [0, 1, 1, 2, 0, 0, 1, 2, 2, 2]
    x, y = ta.overlaps(a_starts, a_ends, b_starts, b_ends)
    assert list(zip(x.tolist(), y.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 2), (2, 2), (3, 3), (3, 4), (3, 5)]
