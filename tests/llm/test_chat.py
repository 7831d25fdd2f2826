"""Chat formatting: exact round trip, and masks against a plain version."""

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from blockxwalk.llm import chat
from blockxwalk.llm.queries import HARD_CHAT, op2_chat

HARD = st.text(st.sampled_from("<|\\>/turntextend \n é\U0001f600"), max_size=30) | st.text(max_size=20)


@given(st.lists(st.tuples(HARD, HARD), max_size=6))
@settings(max_examples=400, deadline=None)
def test_round_trip(turns):
    formatted, spans = chat.render(turns)
    assert chat.read_back(formatted) == turns
    assert formatted.count("<|") == 3 * len(turns)
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant" and t]


def plain(rows):
    """(n_turns, turns digest, loss chars, loss digest) by conversation."""
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        c = out.setdefault(conv, [0, "", ""])
        c[0] += 1
        c[1] += f"{role or ''}\n{text or ''}\n"
        c[2] += (text or "") if role == "assistant" else ""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {k: (n, sha(t), len(x), sha(x)) for k, (n, t, x) in out.items()}


def found(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows}


def test_hard_conversations(spark):
    rng = random.Random(3)
    bits = ["", " ", "<|end|>", "<|turn|>", "<\\|", "<", "|", "\\", "</s>[INST] ok [/INST]", "<|endoftext|>", "é", "\U0001f600", "\U0001f468‍\U0001f469", "\n", "word", " word", None]
    rows = [*HARD_CHAT, (1, 0, None, None), (1, 0, "assistant", None), (2, None, "assistant", "x"), (2, 1, "user", "y"), (None, 0, "assistant", "z"), (3, 0, "assistant", "long " * 100_000)]
    for c in range(10, 60):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, rng.randrange(5), rng.choice(["user", "assistant", "system", "<|text|>"]), "".join(rng.choice(bits) or "" for _ in range(rng.randrange(6)))))
    rows += rows[-3:]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, page int")
    assert found(chat.digests(chat.encode_pages(df))) == plain(rows)
    assert chat.digests(chat.encode_pages(df.limit(0))).collect() == []


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(chat, "PAGE_CHARS", 500)
    rows = [(9, t, "assistant" if t % 2 else "user", f"turn {t} é") for t in range(3000)] + [(8, 0, "user", "a")]
    pages = chat.encode_pages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8))
    assert pages.count() > 10
    assert found(chat.digests(pages)) == plain(rows)


def test_masked_tokens_are_the_assistants(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    r = chat.encode_pages(spark.createDataFrame([(1, 0, "user", "hi there"), (1, 1, "assistant", " two words \U0001f600")], "conv_id long, turn long, role string, text string")).collect()[0]
    assert [i for i, m in zip(r["ids"], r["loss_mask"]) if m] == t.encode(" two words \U0001f600", add_special_tokens=False).ids


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op2_chat(spark, "/root/testdata/sf0.001")) == plain([*rows, *HARD_CHAT])
