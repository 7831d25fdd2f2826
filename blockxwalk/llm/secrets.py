"""Secret scans with DataFrame functions only.

Base kinds are matches of fixed patterns.  The method adds spans: in every
candidate (a maximal run of a character class, ``window`` characters or more) a
window slides along, and the Shannon entropy of its characters follows from
incremental counts: the count of the entering and of the leaving character
change, and with them the sum of c log2 c, held in whole millionths, so that no
rounding adds up.  Windows whose entropy reaches the class's threshold are
merged into spans.  What allow-list patterns match is cut out of a candidate, and
what is left of it on either side is scanned by itself; base spans stay.

Positions come without any Python: a text is split by a pattern, and the
lengths of the pieces and of the matches add up to code-point offsets.

Defined results: null text reads as empty; an empty text has no spans; texts of
any length are scanned whole; a repeated row gives a repeated result; an empty
table an empty one; other columns of the input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, let, normal_text

#: Base kinds in their order (fixed patterns of the contract).
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Only whole runs can be long enough, so the least length stands in the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_SECRET = 8

#: Character classes of the entropy windows: name, characters as a pattern,
#: alphabet, window, least entropy in bits, and what a candidate must hold.
CLASSES = (
    ("entropy_hex", "0-9a-f", "0123456789abcdef", 16, 3.0, ("[0-9]", "[a-f]")),
    ("entropy_base64", "A-Za-z0-9+/_-", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 20, 3.7, ("[0-9]", "[A-Za-z]")),
)
#: Upper-case hexadecimal keys, whose 16 symbols rarely reach the threshold of the base64 class.
UPPER_HEX = ("entropy_upper_hex", "0-9A-F", "0123456789ABCDEF", 16, 3.0, ("[0-9]", "[A-F]"))
SCANNED = (*CLASSES, UPPER_HEX)
#: What these patterns find is no secret: UUIDs, rows of the alphabet, dummies, paths of words.
ALLOW = (
    r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
    r"(?i)0123456789abcdef|abcdefghijklmnop|qrstuvwxyz",
    r"(?i)example|placeholder|changeme|dummy|xxxxxxxx|test[_-]?(key|token)",
    r"^[A-Za-z]*([/_-]+[A-Za-z]+)+[/_-]*[0-9]{0,4}$",
)


#: Items, or places of a candidate, that one aggregate goes through: it copies what it holds at every step.
RUN = 128


def _runs(n: Column) -> Column:
    """array<int>: the numbers of the runs of n items (one at least)."""
    return F.sequence(F.lit(0), F.floor(F.greatest(n - 1, F.lit(0)) / RUN).cast("int"))


def _place(pairs: Column) -> Column:
    """Start and end of each match, of pairs of the piece before it and the match: sums over runs first, then inside each run."""
    none, item = F.array().cast("array<struct<s:int,e:int,m:string>>"), lambda k: F.slice(pairs, k * RUN + 1, F.lit(RUN))
    long = F.transform(_runs(F.size(pairs)), lambda k: F.aggregate(item(k), F.lit(0), lambda n, x: n + F.length(x["p"]) + F.length(x["m"])))
    # a number for each run: where it starts
    starts = let(long, lambda own: F.aggregate(own, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")), lambda st, n: F.struct(
        (st["at"] + n).alias("at"), F.concat(st["all"], F.array(st["at"])).alias("all")), lambda st: st["all"]))

    def place(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["p"])
        end = start + F.length(pair["m"])
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(F.struct(start.alias("s"), end.alias("e"), pair["m"].alias("m")))).alias("out"))

    return let(starts, lambda at: F.flatten(F.transform(at, lambda first, k: F.aggregate(
        item(k), F.struct(first.alias("at"), none.alias("out")), place, lambda st: st["out"]))))


def spans_of(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m>>: start, end (code points, end exclusive) and text of the leftmost non-overlapping matches."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<s:int,e:int,m:string>>")
    pairs = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.struct(p.alias("p"), m.alias("m")))
    # the second pass over the text only where the first has found something
    return F.when(F.size(matches) > 0, let(pairs, _place)).otherwise(none)


def _weights(window: int) -> Column:
    """round(1e6 c log2 c) for a count c, as a literal array from 0 on."""
    return F.array(*[F.lit(round(1e6 * c * math.log2(c)) if c else 0) for c in range(window + 1)]).cast("array<long>")


def high_entropy(candidate: Column, alphabet: str, window: int, bits: float) -> Column:
    """array<struct<s, e>>: merged windows of the candidate whose entropy is at least ``bits``.

    Entropy = log2(W) - sum(c log2 c) / W, so a window counts if the sum is at
    most W (log2(W) - bits).
    """
    weigh = _weights(window)
    most = round(1e6 * window * (math.log2(window) - bits))
    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(alphabet), c))
    # a character for each symbol's count, from "0" on
    zero = F.lit("0" * len(alphabet))
    none = F.array().cast("array<struct<s:int,e:int>>")

    def count(counts: Column, at: Column) -> Column:
        return F.ascii(F.substring(counts, at, F.lit(1))) - 48

    def put(counts: Column, at: Column, n: Column) -> Column:
        return F.overlay(counts, F.char(n + 48), at, F.lit(1))

    def step(state: Column, new: Column, old: Column) -> Column:
        """One character enters and one (0: none) leaves behind the window: two counts change, if they aren't the same symbol."""
        enters, leaves = count(state["counts"], new), count(state["counts"], old)
        enter = F.element_at(weigh, enters + 2) - F.element_at(weigh, enters + 1)
        leave = F.element_at(weigh, leaves) - F.element_at(weigh, leaves + 1)
        entered = put(state["counts"], new, enters + 1)
        counts = F.when(old == new, state["counts"]).when(old > 0, put(entered, old, leaves - 1)).otherwise(entered)
        delta = F.when(old == new, F.lit(0).cast("long")).when(old > 0, enter + leave).otherwise(enter)
        return F.struct(counts.alias("counts"), (state["sum"] + delta).alias("sum"), state["hits"].alias("hits"))

    def mark(state: Column, start: Column, counts: Column) -> Column:
        """A window that counts prolongs the last span, or opens one."""
        last = F.element_at(state["hits"], -1)
        here = F.struct(start.alias("s"), (start + window).alias("e"))
        longer = F.concat(F.slice(state["hits"], 1, F.size(state["hits"]) - 1), F.array(F.struct(last["s"].alias("s"), here["e"].alias("e"))))
        joined = F.when(F.size(state["hits"]) == 0, F.array(here)).when(last["e"] >= start, longer).otherwise(F.concat(state["hits"], F.array(here)))
        return F.struct(state["counts"].alias("counts"), state["sum"].alias("sum"), F.when(counts & (state["sum"] <= most), joined).otherwise(state["hits"]).alias("hits"))

    empty = F.struct(zero.alias("counts"), F.lit(0).cast("long").alias("sum"), none.alias("hits"))

    def run(all_: Column, k: Column) -> Column:
        """The spans of the windows that end in one run of places; the counts start with the window before it."""
        first = F.greatest(k * RUN - (window - 1), F.lit(0))

        def at(state: Column, i: Column) -> Column:
            old = F.when(i - window >= first, F.element_at(all_, F.greatest(i - window + 1, F.lit(1)))).otherwise(F.lit(0))
            entered = let(old, lambda o: step(state, F.element_at(all_, i + 1), o))
            return let(entered, lambda st: mark(st, i + 1 - window, (i >= k * RUN) & (i + 1 >= window)))

        return F.aggregate(F.sequence(first, F.least((k + 1) * RUN, F.size(all_)) - 1), empty, at, lambda st: st["hits"])

    def merged(hits: Column) -> Column:
        """Spans of different runs that meet are one; all ascend."""
        opens = F.filter(hits, lambda x, i: (i == 0) | (F.get(hits, i - 1)["e"] < x["s"]))
        ends = F.filter(hits, lambda x, i: (i == F.size(hits) - 1) | (F.get(hits, i + 1)["s"] > x["e"]))
        return F.zip_with(opens, ends, lambda a, b: F.struct(a["s"].alias("s"), b["e"].alias("e")))

    return let(let(codes, lambda all_: F.flatten(F.transform(_runs(F.size(all_)), lambda k: run(all_, k)))), merged)


def _rest(run: Column, pattern: str) -> Column:
    """array<struct<s, e, m>>: what is left of a run (struct s, e, m) before, between and after the pattern's matches."""
    def piece(cut: Column) -> Column:
        def at(i: Column) -> Column:
            return run["s"] + F.coalesce(F.get(cut, i - 1)["e"], F.lit(0))

        return F.transform(F.split(run["m"], pattern, -1), lambda p, i: F.struct(at(i).alias("s"), (at(i) + F.length(p)).alias("e"), p.alias("m")))

    return let(spans_of(run["m"], pattern), piece)


def _entropy_spans(found: Column, kind: tuple, allow: tuple[str, ...]) -> Column:
    """Spans of one class in its candidates (structs s, e, m), as array<struct<s, e>>."""
    _, _, alphabet, window, bits, needs = kind
    def holds(x: Column) -> Column:
        test = F.length(x["m"]) >= window
        for need in needs:
            test = test & x["m"].rlike(need)
        return test

    def suspicious(x: Column) -> Column:
        test = holds(x)
        for pattern in allow:  # anchored ones can match what is left, too
            test = test & ~x["m"].rlike(pattern)
        return test

    keep = F.filter(found, holds)
    if allow:
        harmless = "|".join(f"(?:{pattern})" for pattern in allow)
        keep = F.filter(F.flatten(F.transform(keep, lambda x: F.when(x["m"].rlike(harmless), _rest(x, harmless)).otherwise(F.array(x)))), suspicious)
    return F.flatten(F.transform(keep, lambda x: F.transform(
        high_entropy(x["m"], alphabet, window, bits), lambda h: F.struct((x["s"] + h["s"]).alias("s"), (x["s"] + h["e"]).alias("e")))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """(id, spans array<struct<start, k, kind, end>>) by start, then kind: k < 3 are the base kinds, the rest the method's."""
    rows = docs.select(column(id_col).alias("id"), normal_text(text_col).alias("t"))
    found = rows.select(
        "id",
        F.filter(spans_of(F.col("t"), ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= LEAST_SECRET).alias("f0"),
        spans_of(F.col("t"), ACCESS).alias("f1"),
        *[spans_of(F.col("t"), f"[{c[1]}]{{{c[3]},}}").alias(f"f{2 + i}") for i, c in enumerate(SCANNED)])
    # hex runs of 16 and more hold the base kind's of 32 and more
    named = [("assign", F.col("f0")), ("access", F.col("f1")), ("hex", F.filter("f2", lambda x: x["e"] - x["s"] >= 32))]
    named += [(c[0], _entropy_spans(F.col(f"f{2 + i}"), c, allow)) for i, c in enumerate(SCANNED)]

    def labelled(k: int, kind: str, a: Column) -> Column:
        return F.transform(a, lambda x: F.struct(x["s"].alias("start"), F.lit(k).alias("k"), F.lit(kind).alias("kind"), x["e"].alias("end")))

    spans = [labelled(k, kind, a) for k, (kind, a) in enumerate(named)]
    return found.select(F.col("id").alias(id_col), F.array_sort(F.concat(*spans)).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan_sql() -> str:
    """DuckDB: the rows of the registered query; every window's characters are counted anew."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    space = lambda s: s.replace(r"\x20", " ")
    kinds = [(0, "assign", space(ASSIGN)), (1, "access", ACCESS), (2, "hex", HEX)] + [(3 + i, c[0], f"[{c[1]}]{{{c[3]},}}") for i, c in enumerate(SCANNED)]
    found = " UNION ALL ".join(
        f"SELECT n, t, {k} AS k, {q(kind)} AS kind, regexp_extract_all(t, {q(p)}) AS ms, string_split_regex(t, {q(p)}) AS ps FROM d" for k, kind, p in kinds)
    holds = " OR ".join(f"(k = {3 + i} AND length(m) >= {c[3]} AND " + " AND ".join(f"regexp_matches(m, {q(n)})" for n in c[5]) + ")" for i, c in enumerate(SCANNED))
    harmless = q("|".join(f"(?:{a})" for a in ALLOW))
    none = " AND ".join(f"NOT regexp_matches(m, {q(a)})" for a in ALLOW)
    window = "CASE k " + " ".join(f"WHEN {3 + i} THEN {c[3]}" for i, c in enumerate(SCANNED)) + " END"
    most = "CASE k " + " ".join(f"WHEN {3 + i} THEN {round(1e6 * c[3] * (math.log2(c[3]) - c[4]))}" for i, c in enumerate(SCANNED)) + " END"
    return f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM documents),
found AS (SELECT * FROM ({found}) WHERE len(ms) > 0),
numbered AS (SELECT n, k, kind, ms, ps, unnest(range(1, len(ms) + 1)) AS i FROM found),
placed AS (SELECT n, k, kind, ms[i] AS m,
  list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s FROM numbered),
base AS (SELECT n, k, kind, s, s + length(m) AS e FROM placed WHERE k IN (1, 2) OR k = 0 AND length(regexp_extract(m, {q(space(ASSIGN))}, 2)) >= {LEAST_SECRET}),
run AS (SELECT n, k, kind, s, m FROM placed WHERE {holds}),
cut AS (SELECT n, k, kind, s, string_split_regex(m, {harmless}) AS ps, regexp_extract_all(m, {harmless}) AS ms FROM run WHERE regexp_matches(m, {harmless})),
piece AS (SELECT n, k, kind, s, ps, ms, unnest(range(1, len(ps) + 1)) AS i FROM cut),
part AS (SELECT n, k, kind, s, m FROM run WHERE NOT regexp_matches(m, {harmless}) UNION ALL
  SELECT n, k, kind, s + coalesce(list_sum(list_transform(ps[1:i - 1], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0), ps[i] FROM piece),
candidate AS (SELECT n, k, kind, s, m, {window} AS w, {most} AS most FROM part WHERE ({holds}) AND {none}),
windows AS (SELECT *, unnest(range(0, length(m) - w + 1)) AS j FROM candidate),
letters AS (SELECT n, k, kind, s, w, most, j, unnest(string_split(substr(m, (j + 1)::BIGINT, w), '')) AS letter FROM windows),
counted AS (SELECT n, k, kind, s, w, most, j, letter, count(*) AS c FROM letters GROUP BY ALL),
hit AS (SELECT n, k, kind, s, w, j FROM counted GROUP BY ALL HAVING sum(round(1e6 * c * log2(c))) <= any_value(most)),
marked AS (SELECT *, CASE WHEN j <= lag(j) OVER (PARTITION BY n, k, s ORDER BY j) + w THEN 0 ELSE 1 END AS fresh FROM hit),
island AS (SELECT *, sum(fresh) OVER (PARTITION BY n, k, s ORDER BY j) AS island FROM marked),
spans AS (SELECT n, k, kind, s, e FROM base UNION ALL SELECT n, k, kind, s + min(j), s + max(j) + w FROM island GROUP BY n, k, kind, s, w, island),
joined AS (SELECT n, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, k) FILTER (k < 3) AS base, string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, k) AS spans
  FROM spans GROUP BY n)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN joined USING (n)
"""
