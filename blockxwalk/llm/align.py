"""Token groups of two tokenizers, aligned by merge-path partitioning.

A text is encoded as a space and the text by tokenizer A (byte-level BPE) and as the
text by tokenizer B (pieces with byte fallback, which adds the space).  Where an A
token and a B token end at the same byte, the text is cut; between two cuts lies a
group, and every A token of a group is linked with every B token of it.

The ends of A and B tokens of a batch of texts are two ascending sequences.  Binary
searches along their merge's diagonals, ``WORK`` steps apart, divide the merge into
pieces of equal work however long the texts are.  Each piece is merged on its own: it
emits its tokens' overlaps with the cuts before them, counted from its own start; a
tie that a diagonal divides is seen by looking one A end back.  The pieces' groups are
stitched by adding the cuts of all pieces before; a group that goes over a boundary gets
the same number on both sides.  A text's tokens are made by one task, so its pieces
are merged by that task too; memory follows a batch of about 1 MB and the longest text.

An id pair's count says in how many texts it is linked.  Texts hold their distinct pairs
with multiplicities, so no group's pairs of occurrences are written out.  Pairs that
make up more than 1 / ``HOT_PAIRS`` of all are broadcast (fewer than that many), the
others are joined by a shuffle, in which none can fill a task.

Defined results: texts that are null, empty, or whose joined token bytes differ from
space and text have no tokens, zeros and empty groups; special tokens' strings in texts are
plain text; a repeated row counts as a text of its own, also one with a null id; an
empty table gives an empty one; other columns are ignored; texts of any length are
taken whole.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import MAX_VOCAB_BYTES, SPLIT, byte_symbols
from .common import column, kept, materialize, normal_text

#: Steps of the merge in a piece; pairs of occurrences of a group that are written out in memory, at most (else ids are counted first).
WORK, WRITTEN_OUT = 65_536, 256
#: Texts that a worker takes up together: rows, and characters, about.
TOGETHER_ROWS, TOGETHER_CHARS = 512, 1_000_000
#: A pair with more than 1 / HOT_PAIRS of all pairs' texts is joined by broadcast.
HOT_PAIRS = 200_000


# --- the merge of two sequences of ends ------------------------------------------

def diagonals(a: np.ndarray, b: np.ndarray, work: int) -> np.ndarray:
    """How many ends of a come before each piece's start: where the merge path (a first on ties) meets every work-th diagonal."""
    total = len(a) + len(b)
    d = np.minimum(np.arange(0, total + work, work), total)
    lo, hi = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        before = np.zeros(len(d), bool)
        before[open_] = a[mid[open_]] <= b[d[open_] - 1 - mid[open_]]
        lo, hi = np.where(open_ & before, mid + 1, lo), np.where(open_ & ~before, mid, hi)
    return lo


def merge_piece(a: np.ndarray, b: np.ndarray, before: int | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Of a piece's A and B ends: the cuts before each token, and all its cuts. before: the A end ahead of the piece."""
    ends = np.concatenate([a, b])
    order = np.argsort(ends, kind="stable")  # two ascending runs: a merge, a first on ties
    ends, is_b = ends[order], order >= len(a)
    last = np.empty(len(ends), ends.dtype)
    last[1:] = ends[:-1]
    if len(ends):
        last[0] = -1 if before is None else before
    # ends ascend strictly in each sequence: an equal end just ahead of a B token is an A token's
    cut = is_b & (last == ends)
    seen = np.cumsum(cut) - cut
    return seen[~is_b], seen[is_b], int(cut.sum())


def groups(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """The group's number of each token of two sequences of ascending ends."""
    at = diagonals(a, b, work)
    to = np.minimum(np.arange(0, len(at) * work, work), len(a) + len(b)) - at
    of_a, of_b, cuts = [], [], 0
    for k in range(len(at) - 1):
        i, j = at[k], to[k]
        x, y, n = merge_piece(a[i:at[k + 1]], b[j:to[k + 1]], int(a[i - 1]) if i else None)
        of_a.append(x + cuts)
        of_b.append(y + cuts)
        cuts += n
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *of_a]), np.concatenate([none, *of_b])


# --- tokenizers ----------------------------------------------------------------

def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def read_vocabularies(a: str | None = None, b: str | None = None) -> tuple[bytes, bytes]:
    """The two files, to be broadcast; their sizes are checked."""
    found = []
    for path, usual in zip((a, b), default_vocabularies()):
        path = path or usual
        if os.path.getsize(path) > MAX_VOCAB_BYTES:
            raise ValueError(f"{path} is larger than {MAX_VOCAB_BYTES} bytes")
        with open(path, "rb") as f:
            found.append(f.read())
    return found[0], found[1]


class Tokenizers:
    """Both tokenizers, their entries' bytes, and each id's text in a group by whether more of its side follow."""

    def __init__(self, files: tuple[bytes, bytes]):
        import sentencepiece

        self.b = sentencepiece.SentencePieceProcessor(model_proto=files[1])
        symbols = byte_symbols()
        spec = json.loads(files[0])
        ids = spec["model"]["vocab"]
        a_bytes = [b""] * (1 + max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]))
        for s, i in ids.items():
            a_bytes[i] = bytes(symbols[c] for c in s)
        for t in spec["added_tokens"]:
            a_bytes[t["id"]] = t["content"].encode()
        self.bytes_a, self.bytes_b = a_bytes, [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a = self._ranked(spec, a_bytes) or self._library(files[0])
        self.len_a, self.len_b = (np.array([len(x) for x in v], np.int64) for v in (self.bytes_a, self.bytes_b))
        na, nb = len(self.bytes_a), len(self.bytes_b)
        self.text = [f"{i}," for i in range(na)] + [f"{i}|" for i in range(na)] + [f"{i}," for i in range(nb)] + [f"{i};" for i in range(nb)]

    @staticmethod
    def _ranked(spec: dict, strings: list[bytes]):
        """A quick encoder of the same ids (tested on every code point), where ids ascend with the ranks of merges; else None."""
        ids, merges = spec["model"]["vocab"], [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = [ids[a + b] for a, b in merges]
        step = spec.get("pre_tokenizer") or {}
        plain = spec.get("normalizer") is None and step.get("type") == "ByteLevel" and not step.get("add_prefix_space") and step.get("use_regex", True)
        if not plain or made != sorted(set(made)) or len(ids) != 256 + len(made):
            return None
        import tiktoken

        encode = tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks={strings[i]: i for i in ids.values()}, special_tokens={}).encode_ordinary
        return lambda texts: map(encode, texts)

    @staticmethod
    def _library(file: bytes):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        known = Tokenizer.from_str(file.decode())
        known.encode_special_tokens = True
        known.no_truncation()
        known.no_padding()
        return lambda texts: (e.ids for e in known.encode_batch_fast(list(texts), add_special_tokens=False))

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both by text; none where the joined bytes differ from space and text."""
        found = []
        for t, a, b in zip(texts, self.a([" " + t for t in texts]), self.b.encode(texts, num_threads=1)):
            want = (" " + t).encode()
            same = t and b"".join(map(self.bytes_a.__getitem__, a)) == want and b"".join(map(self.bytes_b.__getitem__, b)) == want
            found.append((a, b) if same else ([], []))
        return found


def _linked(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair, times) of distinct id pairs by text; a, b: ids in order; na, nb, text: of the groups."""
    ends_a, ends_b, size = np.cumsum(na), np.cumsum(nb), na * nb
    few = size <= WRITTEN_OUT
    g = np.repeat(np.flatnonzero(few), size[few])
    k = np.arange(len(g)) - np.repeat(np.cumsum(size[few]) - size[few], size[few])
    x, y = a[(ends_a - na)[g] + k // nb[g]], b[(ends_b - nb)[g] + k % nb[g]]
    texts, pairs, times = [text[g]], [x << 32 | y], [np.ones(len(g), np.int64)]
    for h in np.flatnonzero(~few):
        u, n = np.unique(a[ends_a[h] - na[h]:ends_a[h]], return_counts=True)
        v, m = np.unique(b[ends_b[h] - nb[h]:ends_b[h]], return_counts=True)
        pairs.append((u[:, None] << 32 | v).ravel())
        times.append((n[:, None] * m).ravel())
        texts.append(np.full(len(pairs[-1]), text[h]))
    text, pair, time = np.concatenate(texts), np.concatenate(pairs), np.concatenate(times)
    order = np.lexsort((pair, text))
    text, pair, time = text[order], pair[order], time[order]
    new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])])) if len(text) else np.zeros(0, int)
    return text[new], pair[new], np.add.reduceat(time, new) if len(new) else time


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


def align_texts(t: Tokenizers, texts: list[str]) -> dict[str, pa.Array]:
    """Columns n_a, n_b, n_groups, n_links, groups, pairs, times of some texts."""
    ids = t.encode(texts)
    n_a, n_b = (np.array([len(x[k]) for x in ids], np.int64) for k in (0, 1))
    a, b = (np.concatenate([np.zeros(0, np.int64), *(x[k] for x in ids)]).astype(np.int64) for k in (0, 1))
    of_a, of_b = groups(np.cumsum(t.len_a[a]), np.cumsum(t.len_b[b]))  # a text's end is a cut: both have its bytes
    n = int(of_a[-1]) + 1 if len(of_a) else 0
    na, nb = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
    first_group = np.concatenate([of_a, [n]])[_starts(n_a)]  # of each text
    n_groups = np.diff(first_group)
    text_of = np.repeat(np.arange(len(texts)), n_groups)
    # each group's A tokens, then its B tokens
    v_a, v_b = len(t.bytes_a), len(t.bytes_b)
    parts = np.empty(len(a) + len(b), np.int64)
    is_last = lambda g: np.concatenate([g[1:] != g[:-1], [True]]) if len(g) else np.zeros(0, bool)
    parts[np.arange(len(a)) + _starts(nb)[of_a]] = a + v_a * is_last(of_a)
    parts[np.arange(len(b)) + _starts(na)[of_b + 1]] = 2 * v_a + b + v_b * is_last(of_b)
    ends = _starts(n_a + n_b)
    text, pair, times = _linked(a, b, na, nb, text_of)
    at = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32))
    links = np.bincount(text_of, (na * nb).astype(np.float64), len(texts)).astype(np.int64) if n else np.zeros(len(texts), np.int64)
    said = ["".join(map(t.text.__getitem__, parts[i:j].tolist()))[:-1] for i, j in zip(ends[:-1], ends[1:])]
    return {"n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(n_groups.astype(np.int64)), "n_links": pa.array(links), "groups": pa.array(said, pa.string()),
            "pairs": pa.ListArray.from_arrays(at, pa.array(pair)), "times": pa.ListArray.from_arrays(at, pa.array(times))}


# --- tables -------------------------------------------------------------------

def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str | None = None, b: str | None = None) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups, pairs, times) of every row's whole text.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: ids in order; ``pairs``: the distinct linked id
    pairs (A's id << 32 | B's), ``times`` how many occurrences each links.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabularies(a, b))
    rows = docs.select(column(id_col).alias("id"), normal_text(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = kept(shared.value, Tokenizers)
        for batch in batches:
            size = np.cumsum(pc.utf8_length(batch.column(1)).to_numpy(zero_copy_only=False))
            i = 0
            while i < batch.num_rows:
                taken = int(np.searchsorted(size, (size[i - 1] if i else 0) + TOGETHER_CHARS, "right"))
                j = min(max(taken, i + 1), i + TOGETHER_ROWS, batch.num_rows)
                part = batch.slice(i, j - i)
                found = align_texts(t, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *found.values()], ["id", *found])
                i = j

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>").withColumnRenamed("id", id_col)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, n, best): in how many texts (rows with an array of distinct ``pairs``) each pair is linked; best: no pair of its A id in more."""
    counts = materialize(pairs.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    counts = counts.withColumn("a", F.shiftright("pair", 32))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def score(aligned: DataFrame, row: str) -> DataFrame:
    """(row, n_best, count_sum) of a written table of ``pairs`` and ``times``, by its key ``row``; texts without links are left out."""
    counts = materialize(pair_counts(aligned), "pair-table")
    total = counts.agg(F.sum("n")).first()[0] or 0
    bound = total / HOT_PAIRS
    hot = counts.where(F.col("n") > bound)  # fewer than HOT_PAIRS rows
    links = aligned.select(row, F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(row, F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    often = links.join(F.broadcast(hot), "pair")
    seldom = links.join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(counts.where(F.col("n") <= bound), "pair")
    sums = lambda rows: rows.groupBy(row).agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    both = sums(often).unionByName(sums(seldom))
    return both.groupBy(row).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str | None = None, b: str | None = None) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    rows = align(docs, id_col, text_col, a, b).select(column(id_col).alias("id"), "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"), "pairs", "times", F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows, "aligned")  # the row's number is written with it
    found = rows.drop("pairs", "times").join(score(rows, "row"), "row", "left")
    none = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return found.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", none("n_best"), none("count_sum"), "groups_sha256")
