import re
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from tokenizers import Tokenizer

from epispan.llm import id_coder as c
from epispan.llm.public_bpe import LETTERS, WHITE, ChunkEncoder, chunks_of

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello wörld's <|endoftext|> x\x1cy  don't 12", None, "", "   ", "ΣΑΣ İstanbul été ÀÉ äb", "a\x85b c",
    "word " * 3000, "naïve—café…ﬁ ½ ٣ 漢字 😀👍🏽", "it'S we'LL <|startoftext|><|endoftext|>x", "́lead mark", "hello", "hello",
]


def test_chunked_encoding_is_the_library_encoding():
    whole = Tokenizer.from_file(PATH)
    for memo in (0, 3, 1000):
        encoder = ChunkEncoder(PATH, memo)
        for _ in range(2):
            for text, raw in zip(TEXTS, encoder.encode(TEXTS), strict=True):
                assert np.frombuffer(raw, "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids, text
    assert chunks_of("a\x1cb c") == ["a\x1cb", "c"]


def test_letters_of_words_stand_alone():
    letters = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000 and re.fullmatch(f"[{LETTERS}]", chr(i))]
    lower = pc.utf8_lower(pa.array(letters)).to_pylist()
    assert len(letters) > 30_000
    for a, b in zip(letters, lower, strict=True):
        assert a.isalpha() and b.isalpha() and a.lower() == b and unicodedata.normalize("NFC", a) == a and unicodedata.normalize("NFC", b) == b, a
    white = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000 and re.fullmatch(f"[{WHITE}\x1c-\x1f]", chr(i))]
    assert pc.list_value_length(pc.utf8_split_whitespace(pa.array([f"a{w}b" for w in white]))).to_pylist() == [2] * len(white)


def test_few_calls_for_many_chunks():
    """Words among marks and other chunks go many to a call; a chunk that holds the token between them does not mix them up."""
    words = [f"{a}{b}{c}" for a in "kLé" for b in "oui" for c in ("n", "Σ", "st", "漢")]
    chunks = [f"{h}{w}{t}" for w in words for h in ("", "(", '"#') for t in ("", ".", "&&&", ",***")] + [f"{i}-{w}'s" for i, w in enumerate(words)]
    whole, encoder, handed = Tokenizer.from_file(PATH), ChunkEncoder(PATH), []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            handed.extend(texts)
            return whole.encode_batch_fast(texts, **options)

    encoder.tokenizer = Counting()
    texts = [" ".join(chunks), "...", " \n", "x\x1fy " + chunks[7]]
    ids = lambda t: np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    assert encoder.encode(texts) == [ids(t) for t in texts] and len(handed) < 10
    assert encoder.encode(texts) == [ids(t) for t in texts]
    odd = ["a1 <|endoftext|> b2<|endoftext|>c3 <|startoftext|>d4 <|endof text|>"]
    assert encoder.encode(odd) == [ids(odd[0])] and encoder.encode([]) == []


def test_bytes_of_the_format_stay():
    ids = (np.arange(9000, dtype="<u4") ** 2 % 251 * (np.arange(9000, dtype="<u4") % 3)).astype("<u4")
    data = c.encode_segment(ids, np.array([1]), np.array([9000]), np.array([True]), 100)
    assert (len(data), zlib.crc32(data)) == (9234, 2818028758)


@pytest.mark.parametrize("n, top, block", [(0, 5, 16), (1, 5, 16), (16, 5, 16), (17, 2**32 - 1, 16), (5000, 49408, 128), (5000, 3, 64), (3000, 1, 2048), (40000, 300, 512)])
def test_round_trip(n, top, block):
    rng = np.random.default_rng(n + top)
    ids = (top * rng.random(n) ** 3).astype("<u4")
    if n == 40000:
        ids[:] = np.resize(ids[:97], n)
    lengths = np.array([n // 3, n - n // 3, 0])
    data = c.encode_segment(ids, np.array([-7, 0, 2**62]), lengths, np.array([True, False, True]), block)
    back, docs, sizes, known = c.decode_segment(data)
    assert (back == ids).all() and docs.tolist() == [-7, 0, 2**62] and sizes.tolist() == lengths.tolist() and known.tolist() == [True, False, True]
    if n == 40000:
        assert len(data) < n * 0.5


def test_damage_is_noticed():
    ids = np.arange(1000, dtype="<u4") % 37
    data = bytearray(c.encode_segment(ids, np.array([1]), np.array([1000]), np.array([True]), 100))
    data[-5] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        c.decode_segment(bytes(data))


def test_store_in_order(spark, tmp_path):
    rows = [(i * 7 % 12 - 3 if i else None, t, "clash") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start string").repartition(3)
    c.write_ids(docs, PATH, str(tmp_path / "ids"), segment_ids=20)
    got = {r.doc_id: r for r in c.read_ids(spark, str(tmp_path / "ids")).collect()}
    digests = {r.doc_id: r for r in c.read_digests(spark, str(tmp_path / "ids")).collect()}
    whole, start = Tokenizer.from_file(PATH), 0
    for key, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        assert (got[key].start, got[key].n_tokens, got[key].ids) == (start, len(ids), ids)
        assert digests[key].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and digests[key].start == start
        start += len(ids)
    assert c.store_and_digest(docs.limit(0), PATH).count() == 0


def test_a_segment_closes_where_its_table_is_full(monkeypatch, spark, tmp_path):
    monkeypatch.setattr(c, "MAX_DISTINCT", 6)
    rng = np.random.default_rng(2)
    parts = [rng.integers(0, 40, 3).astype("<u4").tobytes() for _ in range(30)] + [b""]
    keys = list(range(31))
    runs = list(c._within_table(keys, parts, 6))
    assert [k for own, _ in runs for k in own] == keys and [p for _, own in runs for p in own] == parts
    assert len(runs) > 1 and all(len(np.unique(np.frombuffer(b"".join(own), "<u4"))) <= 6 for _, own in runs)


def test_many_rows_of_one_id_are_shared_out(spark, tmp_path):
    docs = spark.range(400).selectExpr("7L AS doc_id", "concat('word ', id) AS text").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        c.write_ids(docs, PATH, str(tmp_path / "hot"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(str(tmp_path / "hot")).select("file_no").distinct().count() > 1
    got = c.read_ids(spark, str(tmp_path / "hot")).orderBy("start").collect()
    assert len(got) == 400 and got[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
