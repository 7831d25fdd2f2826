"""Byte-level BPE encoding and decoding.

Each piece of the split pattern is encoded on its own: its bytes form a doubly
linked list of symbols, a heap holds the mergeable neighbours by (rank,
position), and an entry whose symbols have changed since it was pushed is
skipped when popped.  Decoding concatenates the vocabulary's byte strings.
The vocabulary file is read on the driver and broadcast; its size is checked.

Defined results: null text reads as empty; an empty text has no ids and decodes
to the empty text; a special token's string in a text is that token; texts of
any length are encoded whole; a repeated row gives a repeated result; an empty
table an empty one; other columns of the input are ignored.
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, column, kept, normal_text

#: A larger vocabulary file is refused: it is broadcast to every executor.
MAX_VOCAB_BYTES = 64 << 20
#: Encoded pieces that a worker remembers, and the longest piece it remembers.
CACHE_PIECES, CACHE_CHARS = 300_000, 64

#: The split pattern of byte-level BPE (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Code points that a newer Unicode version counts as letters or numbers and the
#: split pattern, by Unicode 16, doesn't (fixed values).
NOT_YET_LETTERS = (
    "\\u0558\\u058b-\\u058c\\u088f\\u0c5c\\u0cdc\\u208f\\u209d-\\u209f\\ua7ce-\\ua7cf\\ua7d2\\ua7d4\\ua7dd\\ua7e2\\ua7f1\\uab6c-\\uab6d"
    "\\U000107bb-\\U000107bf\\U00010940-\\U00010959\\U00010ec5-\\U00010ec7\\U00010ed9-\\U00010eee\\U00011b0a\\U00011db0-\\U00011ddb\\U00011df1"
    "\\U00016ea0-\\U00016eb8\\U00016ebb-\\U00016ed3\\U00016ff2-\\U00016ff3\\U000187f8-\\U000187ff\\U00018cd6-\\U00018cda\\U00018d09-\\U00018d20"
    "\\U00018d80-\\U00018df2\\U00018e00-\\U00019191\\U000191a0-\\U000191d2\\U0001b123-\\U0001b128\\U0001b168\\U0001d6a6\\U0001df1f-\\U0001df24"
    "\\U0001df2b-\\U0001df81\\U0001df90-\\U0001df96\\U0001dfcd-\\U0001dfff\\U0001e6c0-\\U0001e6de\\U0001e6e0-\\U0001e6e2\\U0001e6e4-\\U0001e6e5"
    "\\U0001e6e7-\\U0001e6ed\\U0001e6f0-\\U0001e6f4\\U0001e6fe-\\U0001e6ff\\U0002b73a-\\U0002b73f\\U0002b81e\\U0002cea2-\\U0002cead"
    "\\U000323b0-\\U00033479\\U0003d000-\\U0003fc3f"
)
NOT_YET_NUMBERS = "\\U00011de0-\\U00011de9\\U0001246f\\U00012475-\\U0001247f\\U00012550-\\U00012686\\U00016ff4-\\U00016ff6"


def splitter():
    """A function that splits a text into the pattern's pieces, by Unicode 16 whatever the version of ``regex``."""
    usual = regex.compile(SPLIT).findall
    letter, number = rf"(?![{NOT_YET_LETTERS}])\p{{L}}", rf"(?![{NOT_YET_NUMBERS}])\p{{N}}"
    other = rf"(?:[^\s\p{{L}}\p{{N}}]|[{NOT_YET_LETTERS}{NOT_YET_NUMBERS}])"
    exact = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?(?:{letter})+| ?(?:{number})+| ?{other}+|\s+(?!\S)|\s+").findall
    odd = regex.compile(f"[{NOT_YET_LETTERS}{NOT_YET_NUMBERS}]").search

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")  # a quick way to see that nothing odd is in it
        except UnicodeEncodeError:
            return exact(text) if odd(text) else usual(text)
        return usual(text)

    return split


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_symbols() -> dict[str, int]:
    """Vocabulary character -> byte: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """What the workers need of a tokenizer file, as plain picklable tables."""

    def __init__(self, path: str):
        if os.path.getsize(path) > MAX_VOCAB_BYTES:
            raise ValueError(f"{path} is larger than {MAX_VOCAB_BYTES} bytes")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, symbols = spec["model"]["vocab"], byte_symbols()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.first = [ids[c] for c, _ in sorted(symbols.items(), key=lambda x: x[1])]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        self.strings = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for s, i in ids.items():
            self.strings[i] = bytes(symbols[c] for c in s)
        for s, i in self.special.items():
            self.strings[i] = s.encode()


def merge(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge neighbours, lowest rank first and leftmost first, until no pair has a rank."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(*found, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (found := merges.get((symbols[i], symbols[i + 1])))]
    heap = [(rank, i, new, a, b) for rank, new, i, a, b in heap]
    heapq.heapify(heap)
    while heap:
        _, i, new, a, b = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != a or j >= n or symbols[j] != b:
            continue  # stale: one of the two has been merged since
        symbols[i], symbols[j] = new, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if found := merges.get((new, symbols[k])):
                heapq.heappush(heap, (found[0], i, found[1], new, symbols[k]))
        h = before[i]
        if h >= 0 and (found := merges.get((symbols[h], new))):
            heapq.heappush(heap, (found[0], h, found[1], symbols[h], new))
    return [s for s in symbols if s >= 0]


class Encoder(dict):
    """piece -> its ids as int32 bytes; remembers short pieces up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.pieces = splitter()
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None

    def __missing__(self, piece: str) -> bytes:
        first = self.vocabulary.first
        ids = np.array(merge([first[b] for b in piece.encode("utf-8", "surrogatepass")], self.vocabulary.merges), np.int32).tobytes()
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if self.special is None or not self.special.search(text):
            return b"".join(map(self.__getitem__, self.pieces(text)))
        out = []
        for part in self.special.split(text):
            if part in self.vocabulary.special:
                out.append(np.int32(self.vocabulary.special[part]).tobytes())
            else:
                out.extend(map(self.__getitem__, self.pieces(part)))
        return b"".join(out)


def share(spark: SparkSession, vocabulary: str | None = None):
    """The vocabulary as a broadcast variable, for several calls of ``encode`` and ``decode``."""
    return spark.sparkContext.broadcast(Vocabulary(vocabulary or default_vocabulary()))


def text_of(ids: np.ndarray, strings: list[bytes]) -> str:
    """The vocabulary's strings concatenated; unknown ids add nothing."""
    if len(ids) and (ids.min() < 0 or ids.max() >= len(strings)):
        ids = ids[(ids >= 0) & (ids < len(strings))]
    return b"".join(map(strings.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _lists(found: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), np.int32)))


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shared=None) -> DataFrame:
    """(id, ids array<int>) of every row's whole text."""
    shared = shared or share(df.sparkSession)
    rows = df.select(column(id_col).alias("id"), normal_text(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(shared.value, Encoder)
        for b in batches:
            for part in chunks(b):
                found = [encoder.encode(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(found)], ["id", "ids"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", shared=None) -> DataFrame:
    """(id, ids, decoded string): vocabulary strings concatenated; bytes that are no UTF-8 become U+FFFD; null ids read as none; unknown ids add nothing."""
    shared = shared or share(df.sparkSession)
    rows = df.select(column(id_col).alias("id"), F.coalesce(column(ids_col), F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = shared.value.strings
        for b in batches:
            for part in chunks(b):
                ids = part.column(1)
                values = ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                ends = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False))])
                texts = [text_of(values[i:j], strings) for i, j in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), ids, pa.array(texts, pa.string())], ["id", "ids", "decoded"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shared=None) -> DataFrame:
    """(id, ids, decoded): ``encode`` and ``decode`` in one pass, by one worker a task."""
    shared = shared or share(df.sparkSession)
    rows = df.select(column(id_col).alias("id"), normal_text(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, strings = kept(shared.value, Encoder), shared.value.strings
        for b in batches:
            for part in chunks(b):
                found = [encoder.encode(t) for t in part.column(1).to_pylist()]
                texts = [text_of(np.frombuffer(x, np.int32), strings) for x in found]
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(found), pa.array(texts, pa.string())], ["id", "ids", "decoded"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def joined(ids: Column) -> Column:
    """The decimal ids joined by commas: one string a row, no array of strings."""
    text = F.to_json(ids)
    return F.substring(text, F.lit(2), F.length(text) - 2)
