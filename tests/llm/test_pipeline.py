"""The pipeline against plain steps over the same documents."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from blockxwalk.llm import pii, toxicity
from blockxwalk.session import written_tables

from .test_mixing import plain_copies
from .test_neardup import plain_classes

SF = "/root/testdata/sf0.001"


def test_run_equals_plain_steps(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "pii", "mixing", "bpe"]
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r["doc_id"]: r for r in frame.collect()}
    model = toxicity.fit(frame, spark.read.parquet(f"{SF}/labels.parquet"))
    weigh = toxicity.Weights(model)
    clean = sorted(i for i, r in docs.items() if weigh.document(weigh.sentences(r["text"] or "")[1]) < 0.5)
    assert 0 < len(clean) < len(docs)
    kept = sorted(set(plain_classes([(i, docs[i]["text"]) for i in clean])))
    trees = pii.fit(frame.where(frame.doc_id.isin(kept)))
    texts = dict(zip(kept, [pii.cover(docs[i]["text"], s) for i, s in zip(kept, pii.all_spans([docs[i]["text"] for i in kept], trees))]))
    volume = Counter()
    for i in kept:
        volume[docs[i]["source"]] += len(texts[i]) + 1
    w = {s: np.sqrt(v) for s, v in volume.items()}
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i in kept:
        s = docs[i]["source"]
        ids = t.encode(texts[i], add_special_tokens=False).ids
        row = (i, len(ids), tuple(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(texts[i].encode()).hexdigest())
        want[row] += plain_copies(1, i, texts[i], sum(volume.values()) * w[s] / sum(w.values()) / volume[s])
    got = Counter((*r[:2], tuple(r["ids"]), *r[3:]) for r in __spark_entry__.queries()["pipeline"](spark, SF).collect())
    assert got == +want


def test_a_stage_drops_the_tables_of_the_one_before(spark, tmp_path):
    docs, left = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = set(written_tables(spark))
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert not left or not set(left) & set(written_tables(spark))
        left = [p for p in written_tables(spark) if p not in before]
    many = spark.createDataFrame([(i, "very long text " * 40_000 if i < 2 else f"text {i} a b c", "en", "s", 1) for i in range(4)], "doc_id long, text string, lang string, source string, n_chars long")
    deduped = corpus_pipeline.drop_near_duplicates(spark, many, SF)
    covered = corpus_pipeline.cover_personal_data(spark, deduped, SF)  # reads tables of the stage before
    assert sorted(r["doc_id"] for r in covered.collect()) == [0, 2, 3]
    out = corpus_pipeline.encode(spark, covered, SF).collect()
    assert sorted(r["n_tokens"] > 100_000 for r in out) == [False, False, True]


def test_stages_on_odd_rows(spark):
    """Nulls in all columns, empty texts, repeated rows, further columns of clashing names; and no rows at all."""
    odd = [(None, None, None, None, None, 1, "x")] * 2 + [(1, "", "en", "a", 0, 2, "y"), (2, "a b c d e f +1 (668) 555-2281", "en", None, 29, 3, "z"), (2, "a b c d e f +1 (668) 555-2281", "en", None, 29, 3, "z")]
    df = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long, copy int, node string")
    for rows in (df, df.limit(0)):
        docs = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == df.columns
        out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert out == []
    deduped = corpus_pipeline.drop_near_duplicates(spark, df, SF).collect()
    assert sorted((r["doc_id"] for r in deduped), key=str) == [1, 2]
    assert corpus_pipeline.cover_personal_data(spark, df, SF).where("text like '%[PHONE]%'").count() == 2
