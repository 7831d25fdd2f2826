"""Personal data by candidate gradient boosting.

Base kinds are fixed rules.  For the rest, generators of high recall propose
overlapping spans (whole runs of digits and separators, their parts, tokens
around an ``@`` or a spelled-out one, account-like tokens); boosted trees score
each by its format and its context; a threshold for each kind of proposal,
calibrated on held-out proposals to ``PRECISION``, selects redactions.  Selected
spans never overlap base spans, and of overlapping ones the likeliest stays.

No table labels personal data, so positives are made: in a copy of each sampled
text the base spans are rewritten, in their own context, to forms that no rule finds
(several copies) -- addresses spelled out, phone numbers without the country's code, cards of 15
digits or grouped otherwise, account numbers with valid check digits -- and a
proposal there is positive if it covers a rewritten span and little else.  What the
generators propose in the texts as they are, clear of base spans, is negative.  The
sample is bounded: at most ``SAMPLE_DOCS`` documents that hold a digit or ``@``, in
the order of a hash of the id, and ``SAMPLE`` of the proposals.

Every search is linear in the text: runs are cut once, from left to right, and
the rules are applied to the runs.

Defined results: null text reads as empty; an empty text has no spans; without
proposals of both classes only base spans are found; a repeated row gives a
repeated result; an empty table an empty one; other columns are ignored.
"""

from __future__ import annotations

import bisect
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, column, normal_text

BASE = ("email", "ip", "card", "phone")
EXTRA = ("contact", "number", "account")
KINDS = BASE + EXTRA
SAMPLE_DOCS, SAMPLE, PRECISION = 6000, 20_000, 0.98
TREES, DEPTH, RATE, BINS = 40, 3, 0.2, 32
#: Rewritten copies of a sampled text that holds base spans.
COPIES = 4

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]+")
_ANY = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(kind's place in KINDS, start, end) of the base kinds, by kind, then start."""
    out, last = [], 0
    at = t.find("@")
    while at >= 0:
        s = at
        while s > last and t[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(t, at) if s < at else None
        if m:
            out.append((0, s, m.end()))
            last = m.end()
        else:
            last = at + 1  # no local part goes over an @
        at = t.find("@", max(last, at + 1))
    for m in _DOTTED.finditer(t):
        if m[0].count(".") >= 3:
            parts, s = m[0].split("."), m.start()
            for i in range(0, len(parts) - 3, 4):
                own = ".".join(parts[i:i + 4])
                if all(map(_octet, parts[i:i + 4])):
                    out.append((1, s, s + len(own)))
                s += len(own) + 1
    for m in _CARD.finditer(t):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in t:
        for m in _PHONE.finditer(t):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


# --- proposals ------------------------------------------------------------------

_RUN = re.compile(r"[+(]{0,3}[0-9](?:[ ()./-]{0,3}[0-9])*")
_PART = re.compile(r"[0-9](?:[./-]?[0-9])*")
_TOKEN = re.compile(r"\S+")
_AT = re.compile(r" ?[\[(] ?at ?[\])] ?", re.I)
_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| ?[\[(] ?dot ?[\])] ?)[A-Za-z0-9-]+)*", re.I)
_ACCOUNT = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{2,4}){3,8}\b")
_HINT = re.compile(r"(?i)\b(?:tel|phone|call|mail|contact|card|visa|ip|host|server|account|iban|ssn|fax|mobile|address)")


def proposals(t: str) -> list[tuple[int, int, int]]:
    """(place in EXTRA, start, end), overlapping."""
    out = []
    if "@" in t:
        for m in _TOKEN.finditer(t):
            if "@" not in m[0]:
                continue
            out.append((0, m.start(), m.end()))
            own = m[0].strip(".,;:!?()[]<>\"'")
            if own and len(own) < len(m[0]):
                s = m.start() + m[0].find(own)
                out.append((0, s, s + len(own)))
    if "(" in t or "[" in t:
        last = 0
        for m in _AT.finditer(t):
            s, host = m.start(), _HOST.match(t, m.end())
            while s > last and t[s - 1] in _LOCAL:
                s -= 1
            last = m.end()
            if s < m.start() and host:
                out.append((0, s, host.end()))
    for m in _RUN.finditer(t):
        if m.end() - m.start() < 7:
            continue
        if sum(map(str.isdigit, m[0])) >= 7:
            out.append((1, m.start(), m.end()))
        out += [(1, m.start() + p.start(), m.start() + p.end()) for p in _PART.finditer(m[0]) if p.end() - p.start() >= 7 and p.span() != (0, len(m[0]))]
    out += [(2, *m.span()) for m in _ACCOUNT.finditer(t)]
    return sorted(set(out))


def features(t: str, kind: int, s: int, e: int) -> list[float]:
    """Format and context of a proposal."""
    own = t[s:e]
    digits = "".join(filter(str.isdigit, own))
    ascii_digits = digits if digits.isascii() else ""
    groups = [len(g) for g in _DIGIT.findall(own)] or [0]
    dots = own.split(".")
    before, after = t[max(0, s - 1):s], t[e:e + 1]
    left = t[max(0, s - 40):s]
    host = own.rpartition("@")[2]
    return [
        kind, e - s, len(digits), sum(map(str.isalpha, own)), own.count(" "), own.count("-"), own.count("."), own.count("(") + own.count(")"), own.count("/"),
        own.startswith("+"), own.count("@"), "." in host.strip("."), len(host), len(own) - len(host), len(groups), max(groups), min(groups), groups[0], groups[-1],
        bool(ascii_digits) and luhn(ascii_digits), len(dots) == 4 and all(x.isascii() and x.isdigit() and _octet(x) for x in dots),
        before.isspace() or not before, before.isalnum(), after.isalnum(), after in ("", " ", "\n", ".", ","), bool(_HINT.search(left)),
        _checked(own), bool(_AT.search(own)), int(ascii_digits[:2] or -1),
    ]


def _checked(account: str) -> bool:
    """Whether an account number's check digits are right (remainder 1 by 97)."""
    own = account.replace(" ", "").upper()
    return own.isascii() and own.isalnum() and 15 <= len(own) <= 34 and own[:2].isalpha() and int("".join(str(int(c, 36)) for c in own[4:] + own[:4])) % 97 == 1


# --- positives -------------------------------------------------------------------

def _rewritten(kind: int, own: str, rng: random.Random) -> str:
    """A base span in a form that isn't one."""
    digits = "".join(c for c in own if c.isascii() and c.isdigit())
    if kind == 0 and rng.random() < 0.8:
        at, dot = rng.choice([" (at) ", "(at)", " [at] ", "[at]", " (AT) "]), rng.choice([".", ".", " (dot) ", "[dot]"])
        local, _, host = own.partition("@")
        return local + at + host.replace(".", dot)
    if kind == 3 and rng.random() < 0.8 or kind == 1 and rng.random() < 0.5:
        d = (digits + "".join(rng.choice("0123456789") for _ in range(10)))[-10:] if kind == 3 else "".join(rng.choice("0123456789") for _ in range(10))
        d = rng.choice("23456789") + d[1:]
        return rng.choice([f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"{d[:3]} {d[3:6]} {d[6:]}", f"{d[:3]} {d[3:6]} {d[6:]}", f"(0{d[:2]}) {d[2:6]} {d[6:]}", f"0{d[:3]} {d[3:]}", f"0{d[:2]}/{d[2:]}"])
    if kind == 2 and rng.random() < 0.8:
        if rng.random() < 0.4:
            return rng.choice([".", "/"]).join(digits[i:i + 4] for i in range(0, len(digits), 4))
        d = rng.choice(["34", "37", "30", "36"]) + "".join(rng.choice("0123456789") for _ in range(12))
        d = next(d + c for c in "0123456789" if luhn(d + c))
        return rng.choice([d, f"{d[:4]} {d[4:10]} {d[10:]}", f"{d[:4]}-{d[4:10]}-{d[10:]}"])
    country, n, letters = rng.choice([("GB", 22, 4), ("DE", 22, 0), ("FR", 27, 0), ("ES", 24, 0), ("NL", 18, 4), ("IT", 27, 1), ("PL", 28, 0), ("AT", 20, 0)])
    body = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(letters)) + "".join(rng.choice("0123456789") for _ in range(n - 4 - letters))
    check = 98 - int("".join(str(int(c, 36)) for c in body + country) + "00") % 97
    own = f"{country}{check:02d}{body}"
    return own if rng.random() < 0.4 else " ".join(own[i:i + 4] for i in range(0, n, 4))


def rewrite(t: str, base: list[tuple[int, int, int]], seed: int) -> tuple[str, list[tuple[int, int]]]:
    """The text with its base spans (of overlapping ones the first) rewritten, and where they are."""
    rng, out, spans, at, size = random.Random(seed), [], [], 0, 0
    for k, s, e in sorted(base, key=lambda x: x[1]):
        if s < at:
            continue
        new = _rewritten(k, t[s:e], rng)
        out += [t[at:s], new]
        size += s - at
        spans.append((size, size + len(new)))
        size += len(new)
        at = e
    return "".join([*out, t[at:]]), spans


# --- boosted trees -----------------------------------------------------------------

def boost(x: np.ndarray, y: np.ndarray) -> dict:
    """Trees of fixed depth on binned features, by gradient and curvature of the logistic loss."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    z, trees = np.full(len(y), start), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        node, split = np.zeros(len(y), int), np.zeros((2**DEPTH - 1, 2), int)
        for level in range(DEPTH):
            n, first = 2**level, 2**level - 1
            best = np.full(n, 1e-9)
            split[first:first + n] = [0, BINS]  # all to the left unless a split gains
            for f in range(x.shape[1]):
                key = node * BINS + binned[:, f]
                gl, hl = (np.bincount(key, w, n * BINS).reshape(n, BINS).cumsum(axis=1) for w in (g, h))
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = (gl**2 / (hl + 1) + (gt - gl)**2 / (ht - hl + 1) - gt**2 / (ht + 1))[:, :-1]
                at = gain.argmax(axis=1)
                value = gain[np.arange(n), at]
                better = value > best
                best[better] = value[better]
                split[first:first + n][better] = np.stack([np.full(n, f), at], axis=1)[better]
            own = split[first + node]
            node = 2 * node + (binned[np.arange(len(y)), own[:, 0]] > own[:, 1])
        leaves = RATE * np.bincount(node, g, 2**DEPTH) / (np.bincount(node, h, 2**DEPTH) + 1)
        z += leaves[node]
        trees.append((split, leaves))
    return {"edges": edges, "trees": trees, "start": start}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(model["edges"])], axis=1)
    z, rows = np.full(len(x), model["start"]), np.arange(len(x))
    for split, leaves in model["trees"]:
        node = np.zeros(len(x), int)
        for level in range(DEPTH):
            own = split[2**level - 1 + node]
            node = 2 * node + (binned[rows, own[:, 0]] > own[:, 1])
        z += leaves[node]
    return 1 / (1 + np.exp(-z))


def _taught(spans: list[tuple[int, int]], s: int, e: int) -> bool:
    """Whether a proposal covers one of the spans (disjoint, in order) and little else."""
    k = bisect.bisect_left(spans, (s, s))
    return any(min(e, b) - max(s, a) >= 0.8 * (max(e, b) - min(s, a)) for a, b in spans[max(0, k - 1):k + 2])


def examples(t: str, seed: int) -> list[tuple[int, int, bool, list[float]]]:
    """(start, end, positive, features) of a text's proposals: those clear of base spans, and those in its rewritten copies."""
    base = base_spans(t)
    taken = _merged(base)
    found = [(s, e, False, features(t, k, s, e)) for k, s, e in proposals(t) if _free(taken, s, e)]
    for copy in range(COPIES if base else 0):
        new, spans = rewrite(t, base, seed + copy)
        others = _merged(base_spans(new))  # a rewritten form may hold a base span after all
        for k, s, e in proposals(new):
            if _free(others, s, e):
                near = _taught(spans, s, e)
                if near or not _free([[0, a, b] for a, b in spans], s, e):  # else it has been taken from the text as it is
                    found.append((s, e, near, features(new, k, s, e)))
    return found


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict | None:
    """Trees and thresholds (by kind of proposal) learned from rewritten spans on a bounded sample; None without both classes."""
    rows = docs.select(column(id_col).alias("id"), normal_text(text_col).alias("t")).where(F.col("t").rlike("[0-9@]"))
    picked = rows.select(F.xxhash64("id", "t").alias("h")).distinct().orderBy("h").limit(SAMPLE_DOCS)
    rows = rows.withColumn("h", F.xxhash64("id", "t")).join(F.broadcast(picked), "h", "left_semi")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, t in zip(b.column("h").to_pylist(), b.column("t").to_pylist()):
                found = examples(t, h)
                if found:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([h] * len(found), pa.int64()), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                        pa.array([f[2] for f in found]), pa.array([[float(v) for v in f[3]] for f in found], pa.list_(pa.float32()))], ["h", "s", "e", "y", "x"])

    found = rows.select("h", "t").distinct().mapInArrow(extract, "h long, s long, e long, y boolean, x array<float>").distinct()
    taken = found.orderBy(F.xxhash64("h", "s", "e", "y"), "h", "s", "e", "y", "x").limit(SAMPLE).toArrow()
    if not taken.num_rows:
        return None
    x = np.array(taken.column("x").to_pylist(), np.float64)
    y = taken.column("y").to_numpy(zero_copy_only=False).astype(float)
    fold = np.array([h % 4 == 0 for h in taken.column("h").to_pylist()])
    if not 0 < y[~fold].mean() < 1:
        return None
    model = boost(x[~fold], y[~fold])
    p, limits = predict(model, x[fold]), []
    for kind in range(len(EXTRA)):
        own = x[fold][:, 0] == kind
        order = np.argsort(-p[own], kind="stable")
        right = np.cumsum(y[fold][own][order]) / (np.arange(own.sum()) + 2)  # one miss is always expected
        good, sure = np.flatnonzero(right >= PRECISION), p[own][order]
        # between the last good proposal and the next one
        limits.append(max(0.5, float(sure[good[-1]:good[-1] + 2].mean()) if good[-1] + 1 < len(sure) else 0.5) if len(good) else 2.0)
    return model | {"limits": np.array(limits)}


def all_spans(texts: list[str], model: dict | None) -> list[list[tuple[int, int, int]]]:
    """(place in KINDS, start, end) of base and selected spans of each text, by kind, then start."""
    out, waiting = [], []
    for i, t in enumerate(texts):
        if not _ANY.search(t) and "(" not in t and "[" not in t:  # no proposal without one of these
            out.append([])
            continue
        base = base_spans(t)
        out.append(base)
        if model is not None:
            taken = _merged(base)
            waiting += [(i, p) for p in proposals(t) if _free(taken, p[1], p[2])]
    if waiting:
        p = predict(model, np.array([features(texts[i], *c) for i, c in waiting], np.float32).astype(np.float64))
        chosen = [(-q, i, c) for q, (i, c) in zip(p, waiting) if q >= model["limits"][c[0]]]
        kept: dict[int, list[tuple[int, int, int]]] = {}
        for _, i, (kind, s, e) in sorted(chosen):
            own = kept.setdefault(i, [])
            if not any(a < e and s < b for _, a, b in own):
                own.append((len(BASE) + kind, s, e))
        for i, own in kept.items():
            out[i] = out[i] + sorted(own)
    return out


def _merged(spans: list[tuple[int, int, int]]) -> list[list[int]]:
    """[first kind, start, end] of the stretches that the spans cover together, by start."""
    out: list[list[int]] = []
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if out and s < out[-1][2]:
            out[-1][2] = max(out[-1][2], e)
        else:
            out.append([k, s, e])
    return out


def _free(taken: list[list[int]], s: int, e: int) -> bool:
    """Whether no stretch (disjoint, by start) meets [s, e)."""
    at = bisect.bisect_left(taken, e, key=lambda x: x[1])
    return at == 0 or taken[at - 1][2] <= s


def find(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<k, kind, start, end>>) of every row's whole text, by kind, then start."""
    rows = docs.select(column(id_col).alias("id"), normal_text(text_col).alias("t"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("k", pa.int32()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in chunks(b):
                found = [[{"k": k, "kind": KINDS[k], "start": s, "end": e} for k, s, e in own] for own in all_spans(part.column(1).to_pylist(), shared.value)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, span)], ["id", "spans"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, spans array<struct<k:int,kind:string,start:int,end:int>>").withColumnRenamed("id", id_col)


def cover(t: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each stretch of spans replaced by the kind of the first of them."""
    out, at = [], 0
    for k, s, e in _merged(spans):
        out += [t[at:s], f"[{KINDS[k].upper()}]"]
        at = e
    return "".join([*out, t[at:]])


def redact(docs: DataFrame, model: dict | None, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The rows with personal data covered in the text; where it has changed, the length column (if there is one) follows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    length = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in chunks(b):
                texts, columns = part.column(at).to_pylist(), list(part.columns)
                found = all_spans([t or "" for t in texts], shared.value)
                new = [cover(t, s) if s else t for t, s in zip(texts, found)]
                columns[at] = pa.array(new, part.schema.field(at).type)
                if length is not None:
                    old = columns[length].to_pylist()
                    columns[length] = pa.array([len(t) if s else n for t, s, n in zip(new, found, old)], part.schema.field(length).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
