import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from epispan.llm import chat as c

ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi <|im_end|>"), (1, 2, "assistant", "a<b|c <\\|x"), (1, 3, "user", None), (1, 4, "assistant", ""),
    (2, 0, "assistant", "first"), (3, 0, "user", "no answer"), (4, 1, "assistant", "late\nline"), (4, 0, "user", "early"),
    (5, 0, None, "no role"), (5, 1, "a\nb\\c<|", "odd role"), (None, 0, "user", "x"), (None, 1, "assistant", "😀é"), (6, None, "user", "null turn"), (6, 0, "assistant", "y"),
    (7, 0, "user", "same"), (7, 0, "user", "same"), (8, 0, "user", "long " * 100_000), (8, 1, "assistant", "|<" * 50_000), (9, 0, "user", "t"), (9, 1, "assistant", "t"), (9, 2, "tool", "t"), (9, 3, "assistant", "u"),
]
VALID = {1, 4, None, 6, 8, 9}


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("<|\\>ax\n"), max_size=30))
def test_escaping_is_reversible(text):
    assert c.unescape(c.escape(text)) == text and "<|" not in c.escape(text)
    assert c._unescape_role(c._escape_role(text)) == text and "\n" not in c._escape_role(text)


def test_read_back(spark):
    shuffled = random.Random(1).sample(ROWS, len(ROWS))
    turns = spark.createDataFrame([(*r, "clash") for r in shuffled], "conv_id bigint, turn bigint, role string, text string, place string").repartition(5)
    formatted = c.format_conversations(turns)
    got = {r.conv_id: r for r in c.digest_conversations(formatted).collect()}
    whole = {}
    for r in sorted(c.formatted_text(formatted).collect(), key=lambda r: r.place):
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.text
    convs = {}
    for conv, turn, role, text in ROWS:
        convs.setdefault(conv, []).append((turn if turn is not None else -1, role or "", text or ""))
    assert got.keys() == convs.keys()
    for conv, rows in convs.items():
        rows.sort()
        loss = "".join(t for _, r, t in rows if r == "assistant")
        assert got[conv].n_turns == len(rows)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in rows).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv].formatted_chars == len(whole[conv]) and got[conv].valid == (conv in VALID), conv
        assert whole[conv].count("<|im_start|>") == len(rows) == whole[conv].count("<|im_end|>")
    assert c.digest_conversations(c.format_conversations(turns.limit(0))).count() == 0
