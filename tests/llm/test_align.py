"""Token groups against a plain version."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from blockxwalk.llm import align
from blockxwalk.llm.queries import op13_align

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
OWN = align.Tokenizers(align.read_vocabularies())
TEXTS = [None, "", " ", "hello world", "hello world", "a ▁ b", "<|endoftext|> <s> </s> <unk>", "naïve 肑 é \U0001f600\n\n\tx  y", "zzqxjk" * 40, "long words here. " * 30_000, "肑é" * 300]


def byte_list(tokens, side):
    if side == "a":
        table = align.byte_symbols()
        return [bytes(table[c] for c in A.id_to_token(i)) for i in tokens]
    return [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in tokens]


def plain_groups(text):
    """[(A ids, B ids)] by walking through the ends one after the other."""
    a, b = A.encode(" " + (text or ""), add_special_tokens=False).ids, B.encode(text or "")
    x, y = byte_list(a, "a"), byte_list(b, "b")
    if not text or b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
        return []
    out, own_a, own_b, at_a, at_b, j = [], [], [], 0, 0, 0
    for i, t in zip(a, x):
        own_a.append(i)
        at_a += len(t)
        while j < len(b) and at_b + len(y[j]) <= at_a:
            at_b += len(y[j])
            own_b.append(b[j])
            j += 1
        if at_a == at_b:
            out.append((own_a, own_b))
            own_a, own_b = [], []
        elif j < len(b) and at_b < at_a:
            at_b += len(y[j])
            own_b.append(b[j])
            j += 1
            if at_b == at_a:
                out.append((own_a, own_b))
                own_a, own_b = [], []
    return out


def plain(texts):
    """Rows of the contract, by the plainest means."""
    found = [plain_groups(t) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in found]
    count = Counter(p for c in links for p in c)
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    rows = []
    for g, c in zip(found, links):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        rows.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()), sum(n for p, n in c.items() if count[p] == best[p[0]]),
                     sum(n * count[p] for p, n in c.items()), hashlib.sha256(said.encode()).hexdigest() if g else ""))
    return rows


def result(df):
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in df.collect())


@given(st.lists(st.integers(1, 60), unique=True), st.lists(st.integers(1, 60), unique=True), st.integers(1, 9))
@settings(max_examples=400, deadline=None)
def test_pieces_of_any_size_give_the_groups(a, b, work):
    a, b = np.array(sorted(a), np.int64), np.array(sorted(b), np.int64)
    got = align.groups(a, b, work)
    cuts = np.intersect1d(a, b)
    assert got[0].tolist() == np.searchsorted(cuts, a).tolist() and got[1].tolist() == np.searchsorted(cuts, b).tolist()


def test_pieces_have_equal_work():
    rng = np.random.default_rng(1)
    a, b = np.unique(rng.integers(0, 10**6, 5000)), np.unique(rng.integers(9 * 10**5, 10**6, 9000))  # very uneven
    i = align.diagonals(a, b, 100)
    steps = np.diff(np.minimum(np.arange(len(i)) * 100, len(a) + len(b)))
    assert (steps[:-1] == 100).all() and steps.sum() == len(a) + len(b) and (np.diff(i) >= 0).all() and (np.diff(i) <= 100).all()


@given(st.lists(st.text(max_size=60) | st.text(st.sampled_from(" \nabé肑▁<s>|\U0001f600"), max_size=40), max_size=5))
@settings(max_examples=100, deadline=None)
def test_any_texts(texts):
    got = align.align_texts(OWN, texts)
    for k, t in enumerate(texts):
        g = plain_groups(t)
        assert got["groups"][k].as_py() == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        want = Counter(x << 32 | y for a, b in g for x in a for y in b)
        assert dict(zip(got["pairs"][k].as_py(), got["times"][k].as_py())) == want and got["n_links"][k].as_py() == sum(want.values())


def test_the_quick_encoder_is_the_library(monkeypatch):
    """On every code point, in places that tell letters, numbers, spaces and the rest apart."""
    texts = [f"a{chr(c)}1{chr(c)}. {chr(c)}{chr(c)} {chr(c)}'s  {chr(c)}  x" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(texts), 50_000):
        some = texts[i:i + 50_000]
        assert list(OWN.a(some)) == [e.ids for e in A.encode_batch_fast(some, add_special_tokens=False)]
    monkeypatch.setattr(align.Tokenizers, "_ranked", staticmethod(lambda spec, strings: None))
    other = align.Tokenizers(align.read_vocabularies())
    texts = [t or "" for t in TEXTS]
    assert align.align_texts(other, texts) == align.align_texts(OWN, texts)


def test_large_groups_are_counted_by_ids(monkeypatch):
    texts = [t or "" for t in TEXTS[:9]] + ["肑é" * 50]
    usual = align.align_texts(OWN, texts)
    monkeypatch.setattr(align, "WRITTEN_OUT", 1)
    assert align.align_texts(OWN, texts) == usual


def test_rows(spark, monkeypatch):
    df = spark.createDataFrame([(i if i != 4 else 3, t, [1], 7) for i, t in enumerate(TEXTS)], "doc_id long, text string, pairs array<int>, n_a int")
    want = sorted((True, i if i != 4 else 3, *r) for i, r in enumerate(plain(TEXTS)))
    assert result(align.scored(df)) == want
    monkeypatch.setattr(align, "HOT_PAIRS", 40)  # most pairs go by the shuffle
    assert result(align.scored(df)) == want
    assert align.scored(df.limit(0)).collect() == []
    odd = spark.createDataFrame([(None, "same text"), (None, "same text"), (None, None)], "doc_id long, text string")
    assert result(align.scored(odd)) == sorted((False, 0, *r) for r in plain(["same text", "same text", None]))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = sorted((True, d["doc_id"], *r) for d, r in zip(docs, plain([d["text"] for d in docs])))
    assert result(op13_align(spark, sf)) == want
