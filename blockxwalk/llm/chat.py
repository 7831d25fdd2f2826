"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole: every turn as ``TURN`` role ``TEXT`` text
``END``.  Inside roles and texts the control strings' opening ``<|`` is escaped
(``<\\|``, and one backslash more for what already looks so), reversibly.  The
rendered text is encoded once, with character offsets; the markers are single
tokens, so no token crosses a text's edge.  The sorted spans of the assistant's
texts are intersected with the sorted token spans by binary search, which gives
each token's loss mask; the text under the mask is read back from it.

Rows are dealt by ranges of (conversation, turn), so that a conversation with a
large part of all rows is encoded by many tasks, in pages of whole turns of
bounded length: encoding page by page equals encoding the whole, as every
page starts and ends with a marker.  A second step reads each conversation's
pages in order and streams them through its digests, one page at a time.

Defined results: null text or role reads as empty; rows of one conversation with
equal turns follow by role, then text; repeated rows are turns of their own; a
null conversation id is a conversation, a null turn comes first; an empty table
gives an empty one; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, kept

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Rendered characters after which a page ends, at the end of a turn.
PAGE_CHARS = 200_000
MAX_TOKENIZER_BYTES = 64 << 20
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_READ = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]], loss_role: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of (role, text) turns, and the spans of the texts that count for the loss."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = TURN + escape(role) + TEXT, escape(text)
        if role == loss_role and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    return [(unescape(r), unescape(t)) for r, t in _READ.findall(formatted)]


def mask(tokens: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """By token (rows of sorted offsets start, end): whether it lies in one of the sorted spans."""
    if not spans or not len(tokens):
        return np.zeros(len(tokens), bool)
    starts, ends = np.array(spans).T
    at = np.searchsorted(starts, tokens[:, 0], "right") - 1  # the last span that starts no later
    return (at >= 0) & (tokens[:, 1] <= ends[np.maximum(at, 0)]) & (tokens[:, 1] > tokens[:, 0])


def masked_texts(formatted: str, tokens: np.ndarray, masked: np.ndarray) -> list[str]:
    """The stretches of text under the mask: runs of masked tokens that touch or overlap."""
    own = tokens[masked]
    if not len(own):
        return []
    ends = np.maximum.accumulate(own[:, 1])
    new = np.concatenate([[True], own[1:, 0] > ends[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(own)]]) - 1
    return [formatted[own[a, 0]:ends[b]] for a, b in zip(first, last)]


def _tokenizer(spec: str):
    from tokenizers import AddedToken, Tokenizer

    t = Tokenizer.from_str(spec)
    t.add_special_tokens([AddedToken(x, normalized=False, special=True) for x in (TURN, TEXT, END)])
    return t


def encode_pages(conversations: DataFrame, tokenizer: str | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """Pages of the formatted conversations: (conv, page, formatted, n_turns, ids, loss_mask, loss_texts).

    ``page`` orders a conversation's pages; their texts, ids and masks in that
    order make up the conversation.
    """
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    if os.path.getsize(tokenizer) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{tokenizer} is larger than {MAX_TOKENIZER_BYTES} bytes")
    with open(tokenizer, encoding="utf-8") as f:
        shared = conversations.sparkSession.sparkContext.broadcast(f.read())
    rows = conversations.select(column(conv_col).alias("conv"), column(turn_col).alias("turn"),
                                F.coalesce(column(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))
    order = ["conv", "turn", "role", "text"]
    rows = rows.repartitionByRange("conv", "turn").sortWithinPartitions(*order)
    rows = rows.withColumn("task", F.spark_partition_id().cast("long"))
    kind = rows.schema["conv"].dataType
    rest = pa.schema([("page", pa.int64()), ("formatted", pa.string()), ("n_turns", pa.int64()),
                      ("ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.bool_())), ("loss_texts", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = kept(shared.value, _tokenizer)
        state = {"conv": None, "turns": [], "chars": 0, "page": -1, "waiting": 0}
        done: list[dict] = []

        def close() -> None:
            formatted, spans = render(state["turns"], loss_role)
            found = t.encode(formatted, add_special_tokens=False)
            tokens = np.array(found.offsets, np.int64).reshape(-1, 2)
            masked = mask(tokens, spans)
            done.append({"conv": state["conv"], "page": state["page"], "formatted": formatted, "n_turns": len(state["turns"]), "ids": found.ids,
                         "loss_mask": masked.tolist(), "loss_texts": [unescape(x) for x in masked_texts(formatted, tokens, masked)]})
            state.update(turns=[], chars=0, page=state["page"] + 1, waiting=state["waiting"] + len(formatted))

        schema = None
        for b in batches:
            schema = pa.schema([b.schema.field(0), *rest])
            for r in b.to_pylist():
                if state["turns"] and (r["conv"] != state["conv"] or state["chars"] > PAGE_CHARS):
                    close()
                    if state["waiting"] > 10 * PAGE_CHARS:
                        yield pa.RecordBatch.from_pylist(done, schema)
                        done.clear()
                        state["waiting"] = 0
                if state["page"] < 0:
                    state["page"] = r["task"] << 40  # tasks hold ascending ranges
                state["conv"] = r["conv"]
                state["turns"].append((r["role"], r["text"]))
                state["chars"] += len(r["role"]) + len(r["text"])
        if state["turns"]:
            close()
            yield pa.RecordBatch.from_pylist(done, schema)

    return rows.mapInArrow(run, f"conv {kind.simpleString()}, page long, formatted string, n_turns long, ids array<int>, loss_mask array<boolean>, loss_texts array<string>")


def digests(pages: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens, n_loss_tokens), read back from the pages."""
    rows = pages.select("conv", "page", "formatted", "loss_texts", F.size("ids").cast("long").alias("n_tokens"), F.size(F.filter("loss_mask", lambda x: x)).cast("long").alias("n_loss_tokens"))
    rows = rows.repartition("conv").sortWithinPartitions("conv", "page")
    kind = rows.schema["conv"].dataType.simpleString()
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, kind_of = None, [], None

        def ended() -> dict:
            return {k: v.hexdigest() if k.endswith("sha256") else v for k, v in now.items()}

        for b in batches:
            kind_of = b.schema.field(0).type
            schema = pa.schema([("conv", kind_of)] + [(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in names[1:]])
            for conv, formatted, losses, tokens, loss_tokens in zip(*(b.column(c).to_pylist() for c in ("conv", "formatted", "loss_texts", "n_tokens", "n_loss_tokens"))):
                if now is None or now["conv"] != conv:
                    if now is not None:
                        out.append(ended())
                    now = {"conv": conv} | dict.fromkeys(names[1:], 0) | {"turns_sha256": hashlib.sha256(), "loss_sha256": hashlib.sha256()}
                for role, text in read_back(formatted):
                    now["n_turns"] += 1
                    now["turns_sha256"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for x in losses:
                    now["loss_chars"] += len(x)
                    now["loss_sha256"].update(x.encode("utf-8", "surrogatepass"))
                now["formatted_chars"] += len(formatted)
                now["n_tokens"] += tokens
                now["n_loss_tokens"] += loss_tokens
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([ended()], schema)

    long_or_text = ", ".join(f"{n} {'string' if n.endswith('sha256') else 'long'}" for n in names[1:])
    return rows.mapInArrow(run, f"conv {kind}, {long_or_text}").withColumnRenamed("conv", conv_col)


#: DuckDB: the rows of the registered query, from the turns themselves.
CHAT_SQL = r"""
WITH hard AS (SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) AS h(conv_id, turn, role, text)),
turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM
  (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM hard))
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  sum(length('<|turn|><|text|><|end|>') + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
