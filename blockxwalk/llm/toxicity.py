"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's probability is logistic in the
sum of its distinct words' weights (each word carries a hashed feature for itself and
for its first 4, 5 and 6 letters); a document's is the noisy-or of its
sentences', P = 1 - prod(1 - p_s).  Weights are learned from document labels
alone by gradient steps through the noisy-or, so that the sentences which make
a document toxic are found without sentence labels.  The model is fitted on a
bounded sample of labelled rows, at most ``SAMPLE`` of each class in the order
of a hash of the id; a fold of it calibrates the score (a monotone logistic map,
whose 0.5 lies where the fold's errors are fewest).

Defined results: null text reads as empty; an empty text has no sentence and
the lowest score; without labels of both classes every score is 0; several
labels of one id count as toxic if any is; a repeated row gives a repeated
result; an empty table an empty one; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, column, kept, normal_text

#: Labelled documents of each class that the model is fitted on, at most.
SAMPLE = 4000
#: Characters of them that the driver takes at most, all classes together: whole texts, up to the first that doesn't fit.
SAMPLE_CHARS = 40_000_000
BITS, EPOCHS, RATE, LASSO, LEAST_DOCS = 18, 30, 0.2, 0.01, 5
#: Words that a worker remembers, with their weight or their features.
CACHE_WORDS, CACHE_FEATURES = 200_000, 40_000

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")


def held_out(id_col: str = "doc_id") -> Column:
    """True where labels may not be learned from: crc32(id as text) mod 5 is 0, or no id."""
    return F.coalesce(F.crc32(column(id_col).cast("string")) % 5 == 0, F.lit(True))


def features(token: str) -> list[int]:
    """Hashed features of a white-space separated token."""
    found = []
    for w in WORD.findall(token):
        found += [xxhash.xxh32_intdigest(f"{k}{w[:k] if k < 9 else w}") & ((1 << BITS) - 1) for k in (4, 5, 6, 9) if len(w) >= min(k, 4)]
    return found


class _Features(dict):
    def __missing__(self, token: str) -> list[int]:
        if len(self) >= CACHE_FEATURES:
            self.clear()
        self[token] = found = features(token)
        return found


class Weights(dict):
    """token -> sum of its features' weights; remembers a bounded number of tokens."""

    def __init__(self, model: dict):
        super().__init__()
        self.w, self.bias, self.scale, self.shift = model["w"], model["bias"], model["scale"], model["shift"]

    def __missing__(self, token: str) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[token] = total = float(sum(self.w[f] for f in features(token)))
        return total

    def sentences(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Spans and log-odds of the sentences."""
        spans, odds, get = [], [], self.__getitem__
        for m in SENTENCE.finditer(text):
            if words := sorted(set(m.group().lower().split())):
                spans.append(m.span())
                odds.append(sum(map(get, words)))
        return spans, np.array(odds) + self.bias

    def document(self, odds: np.ndarray) -> float:
        """Calibrated noisy-or of sentences' log-odds."""
        clean = float(-np.logaddexp(0, odds).sum()) if len(odds) else 0.0  # log prod(1 - p_s)
        clean = min(clean, -1e-9)
        log_odds = float(np.log(-np.expm1(clean)) - clean)
        return float(1 / (1 + np.exp(-np.clip(self.scale * log_odds + self.shift, -500, 500))))


def _usable(flat: np.ndarray, ends: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sentences' features (their last places in ``ends``, the documents' last sentences in ``docs``) that LEAST_DOCS documents have; moved within ``flat``."""
    n = 1 << BITS
    seen = np.zeros(n, np.int32)
    bounds = np.concatenate([[0], ends[docs - 1] if len(docs) else []]).astype(np.int64)
    bounds = np.maximum.accumulate(bounds)  # documents without sentences
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        seen[np.unique(flat[lo:hi])] += 1
    usable = seen >= LEAST_DOCS
    at, kept_ends = 0, np.zeros(len(ends), np.int64)
    for k, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
        keep = usable[flat[lo:hi]]
        first = docs[k - 1] if k else 0
        kept_ends[first:docs[k]] = at + np.cumsum(keep)[ends[first:docs[k]] - lo - 1]
        own = flat[lo:hi][keep]
        flat[at:at + len(own)] = own
        at += len(own)
    return flat[:at], kept_ends


def _train(flat: np.ndarray, ends: np.ndarray, docs: np.ndarray, y: np.ndarray, fold: np.ndarray) -> dict:
    """Noisy-or weights by mini-batch Adagrad over the bags that aren't in the fold; scale and shift from the fold.

    flat: the sentences' features one after the other; ends: each sentence's end in
    it (no sentence is empty); docs: each document's end among the sentences.
    """
    n = 1 << BITS
    flat, ends = _usable(flat, ends, docs)
    ends, first = np.concatenate([[0], ends]), np.concatenate([[0], docs])
    w, bias = np.zeros(n), -6.0
    g2, b2 = np.full(n, 1e-3), 1e-3
    rng = np.random.default_rng(7)

    def odds(lo: int, hi: int) -> np.ndarray:  # of the sentences lo to hi
        a, b = ends[lo], ends[hi]
        sums = np.concatenate([[0.0], np.cumsum(w[flat[a:b]])])
        return sums[ends[lo + 1:hi + 1] - a] - sums[ends[lo:hi] - a] + bias

    learn = np.flatnonzero(~fold)
    for _ in range(EPOCHS):
        rng.shuffle(learn)
        for i in range(0, len(learn), 64):
            at, grads, gb = [], [], 0.0
            for d in learn[i:i + 64]:
                lo, hi = first[d], first[d + 1]
                if lo == hi:
                    continue
                z = np.clip(odds(lo, hi), -30, 30)
                p = 1 / (1 + np.exp(-z))
                clean = np.exp(-np.logaddexp(0, z).sum())
                g = -p if y[d] == 0 else p * clean / max(1 - clean, 1e-12)
                at.append(flat[ends[lo]:ends[hi]])
                grads.append(np.repeat(g, np.diff(ends[lo:hi + 1])))
                gb += g.sum()
            if not at:
                continue
            ids, where = np.unique(np.concatenate(at), return_inverse=True)
            g = np.bincount(where, np.concatenate(grads))
            g2[ids] += g * g
            step = RATE / np.sqrt(g2[ids])
            moved = w[ids] + step * g
            w[ids] = np.sign(moved) * np.maximum(np.abs(moved) - step * LASSO, 0)
            b2 += gb * gb
            bias += RATE * gb / np.sqrt(b2)
    model = {"w": w, "bias": bias, "scale": 1.0, "shift": 0.0}
    get = Weights(model)
    raw = []
    for d in range(len(docs)):
        z = odds(first[d], first[d + 1])
        q = get.document(z)
        raw.append(np.log(max(q, 1e-12) / max(1 - q, 1e-12)))
    return model | _calibrate(np.array(raw)[fold], y[fold])


def _calibrate(raw: np.ndarray, y: np.ndarray) -> dict:
    """The cut with the fewest errors, in the middle of the gap it lies in, goes to 0.5."""
    if not (y == 1).any() or not (y == 0).any():
        return {"scale": 1.0, "shift": 0.0}
    order = np.argsort(raw, kind="stable")
    x, t = raw[order], y[order]
    wrong = np.concatenate([[0], np.cumsum(t == 1)]) + np.concatenate([np.cumsum((t == 0)[::-1])[::-1], [0]])  # cut before each
    edges = np.concatenate([[x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]])
    best = np.flatnonzero(wrong == wrong.min())
    cut = float(edges[best[len(best) // 2]])
    return {"scale": 1.0, "shift": -cut}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> dict | None:
    """The model, learned only from labels of rows that aren't held out; None without both classes."""
    known = (labels.select(column(id_col).alias("id"), column(label_col).cast("int").alias("y"))
             .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("id")))
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    texts = docs.select(column(id_col).alias("id"), normal_text(text_col).alias("t")).where("id is not null")
    here = known.join(texts.select("id").distinct(), "id", "left_semi")
    picks = [here.where(f"y = {y}").orderBy(F.xxhash64("id"), "id").limit(sample) for y in (0, 1)]
    rows = texts.join(F.broadcast(picks[0].unionAll(picks[1])), "id")  # 2 x sample ids at most

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Features()
        for b in batches:
            for part in chunks(b):
                flat, ends, sizes = [], [], []
                for t in part.column(1).to_pylist():
                    bag, stops = [], []
                    for m in SENTENCE.finditer(t):
                        before = len(bag)
                        for w in set(m.group().lower().split()):
                            bag += known[w]
                        if len(bag) > before:
                            stops.append(len(bag))
                    flat.append(np.array(bag, np.int32).tobytes())
                    ends.append(np.array(stops, np.int32).tobytes())
                    sizes.append(len(t))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(sizes, pa.int64()), pa.array(flat, pa.binary()), pa.array(ends, pa.binary())], ["id", "y", "n", "bag", "ends"])

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.select("id", "t", "y").mapInArrow(extract, f"id {kind}, y int, n long, bag binary, ends binary")
    # whole documents in the hash's order, until the next one would take the characters out of bounds
    found = found.withColumn("h", F.xxhash64("id"))
    flat, ends, docs_, y, fold, chars, sentences = bytearray(), [], [], [], [], 0, 0
    for r in found.orderBy("h", "id", "n").select("y", "h", "n", "bag", "ends").toLocalIterator():
        chars += r["n"]
        if chars > SAMPLE_CHARS:
            break
        own = np.frombuffer(r["ends"], np.int32)
        ends.append(own.astype(np.int64) + len(flat) // 4)
        flat += r["bag"]
        sentences += len(own)
        docs_.append(sentences)
        y.append(r["y"])
        fold.append(r["h"] % 7 == 0)
    y, fold = np.array(y, int), np.array(fold, bool)
    if not ((y == 1).any() and (y == 0).any()):
        return None
    if not ((y[~fold] == 1).any() and (y[~fold] == 0).any()):
        fold[:] = False
    return _train(np.frombuffer(flat, np.int32), np.concatenate(ends), np.array(docs_, np.int64), y, fold)


def _weights(shared) -> Weights | None:
    return None if shared.value is None else kept(shared.value, Weights)


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score double, sentences array<struct<start, end, p>>): spans (code points) of the offending sentences."""
    rows = docs.select(column(id_col).alias("id"), normal_text(text_col).alias("t"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights: 2 MB
    kind = rows.schema["id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _weights(shared)
        for b in batches:
            for part in chunks(b):
                scores, found = [], []
                for t in part.column(1).to_pylist():
                    if weights is None:
                        scores.append(0.0)
                        found.append([])
                        continue
                    spans, odds = weights.sentences(t)
                    scores.append(weights.document(odds))
                    found.append([{"start": spans[k][0], "end": spans[k][1], "p": float(1 / (1 + np.exp(-odds[k])))} for k in np.flatnonzero(odds > 0)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64()), pa.array(found, span)], ["id", "score", "sentences"])

    return rows.mapInArrow(run, f"id {kind}, score double, sentences array<struct<start:int,end:int,p:double>>").withColumnRenamed("id", id_col)


def keep_clean(docs: DataFrame, model: dict | None, text_col: str = "text", cut: float = 0.5) -> DataFrame:
    """The rows, all columns as they were, whose score is below the cut."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _weights(shared)
        for b in batches:
            if weights is None:
                yield b
                continue
            for part in chunks(b):
                yield part.filter(pa.array([weights.document(weights.sentences(t or "")[1]) < cut for t in part.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
