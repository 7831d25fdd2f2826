"""Document fingerprints as invertible Bloom lookup sketches, DataFrame functions only.

A text's distinct non-empty paragraphs (lines) are hashed to 64-bit digests.
Each digest is added to one cell in each of three subtables; a cell holds the
number of its digests, their xor and the xor of their checks.  Two versions'
cells subtract; peeling then takes digests from cells that hold a single one,
until the difference is empty and all differing digests are recovered.  If
peeling gets stuck, a sketch of four times the cells is tried: digests are
dealt into four blocks by two of their bits, each block a sketch of its own; blocks
that can't be peeled are dealt again, by the next bits, until all are.  That ends at
any size: by their 64 bits different digests come to lie in different blocks.

Likeness = shared / all paragraph digests = (a + b - d) / (a + b + d) for a and b
digests and d recovered differences; 1 for two texts without paragraphs.

Defined results: null text reads as empty; equal texts have equal fingerprints;
documents with equal ids follow one another by a hash of their texts, so a
repeated row's next document may be its copy; a null id comes before all others;
a single document is its own next one; an empty table gives an empty one; other
columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, let, normal_text

#: Cells of each of the three subtables; larger sketches that are tried in turn, by two bits of a digest each; rounds of peeling.
CELLS, LEVELS, ROUNDS = 8, 32, 14
#: Rows of a range of neighbouring ids, about; ranges at most (their bounds go through the driver).
RANGE_ROWS, MAX_RANGES = 256, 1 << 16
LOWEST = -(1 << 63)


def paragraphs(text: Column) -> Column:
    """array<bigint>: digests of the distinct non-empty lines."""
    return F.array_distinct(F.transform(F.filter(F.split(text, "\n", -1), lambda p: p != ""), lambda p: F.xxhash64(p)))


def _entries(digests: Column) -> Column:
    """The digests with their check and their cells, a bit for each."""
    def entry(d: Column) -> Column:
        check = F.xxhash64(d, F.lit(1))
        return let(check, lambda c: F.struct(d.alias("k"), c.alias("c"), places(c).alias("at")))
    return F.transform(digests, entry)


def places(check: Column) -> Column:
    """The bits of the three cells, one in each subtable."""
    bits = [F.call_function("shiftleft", F.lit(1 << (j * CELLS)), (F.shiftrightunsigned(check, 20 * j + 3).bitwiseAND(F.lit(CELLS - 1).cast("long"))).cast("int")) for j in range(3)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def _holds(e: Column, i: Column) -> Column:
    return F.getbit(e["at"], i) == 1


def _zero() -> Column:
    return F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("c"))


def _cells(entries: Column) -> Column:
    """array<struct<n, k, c>>: the sketch of the entries."""
    return F.transform(F.sequence(F.lit(0), F.lit(3 * CELLS - 1)), lambda i: F.aggregate(
        F.filter(entries, lambda e: _holds(e, i)), _zero(),
        lambda a, e: F.struct((a["n"] + 1).alias("n"), a["k"].bitwiseXOR(e["k"]).alias("k"), a["c"].bitwiseXOR(e["c"]).alias("c"))))


def sketch(digests: Column) -> Column:
    return let(_entries(digests), _cells)


def text_of(cells: Column, n: Column) -> Column:
    """A sketch as text: number of digests, then the cells that aren't empty as place:count:xor:check."""
    full = F.filter(F.transform(cells, lambda c, i: F.struct(i.alias("i"), c["n"].alias("n"), c["k"].alias("k"), c["c"].alias("c"))), lambda c: c["n"] != 0)
    return F.concat(n.cast("string"), F.lit("|"), F.array_join(F.transform(full, lambda c: F.concat_ws(":", c["i"].cast("string"), c["n"].cast("string"), F.hex(c["k"]), F.hex(c["c"]))), ";"))


def _subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["c"].bitwiseXOR(y["c"]).alias("c")))


def _peel(difference: Column) -> Column:
    """The recovered digests (array<bigint>), or null if some can't be."""
    def look(cells: Column, got: Column) -> Column:
        alone = F.filter(cells, lambda c: (F.abs(c["n"]) == 1) & (c["c"] == F.xxhash64(c["k"], F.lit(1))))
        found = F.array_distinct(F.transform(alone, lambda c: F.struct(c["k"].alias("k"), c["c"].alias("c"), c["n"].alias("n"), places(c["c"]).alias("at"))))
        return F.struct(cells.alias("cells"), got.alias("got"), found.alias("found"))

    def take(state: Column) -> Column:
        # found: the digests that the round before has seen alone in a cell
        cells = F.transform(state["cells"], lambda c, i: F.aggregate(F.filter(state["found"], lambda e: _holds(e, i)), c, lambda a, e: F.struct(
            (a["n"] - e["n"]).alias("n"), a["k"].bitwiseXOR(e["k"]).alias("k"), a["c"].bitwiseXOR(e["c"]).alias("c"))))
        return let(cells, lambda x: look(x, F.concat(state["got"], state["found"]["k"])))

    start = let(difference, lambda x: look(x, F.array().cast("array<bigint>")))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda s, i: F.when(F.size(s["found"]) == 0, s).otherwise(take(s)), lambda s: F.when(
        F.forall(s["cells"], lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["c"] == 0)), s["got"]))


def _deal(block: Column, level: Column) -> Column:
    """A block (struct a, b) dealt into four by two bits of the digests."""
    def own(side: Column, q: Column) -> Column:
        return F.filter(side, lambda d: F.call_function("shiftrightunsigned", d, level * 2).bitwiseAND(F.lit(3).cast("long")) == q)

    fourths = F.array(*[F.lit(q).cast("long") for q in range(4)])
    return F.transform(fourths, lambda q: F.struct(own(block["a"], q).alias("a"), own(block["b"], q).alias("b")))


def _larger(state: Column, level: Column) -> Column:
    """One retry: each block that couldn't be peeled (todo) as four blocks, each a sketch of its own."""
    blocks = F.flatten(F.transform(state["todo"], lambda x: _deal(x, level)))
    # a difference that is larger than the cells can't be peeled: such a block need not be tried
    tried = F.transform(blocks, lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), F.when(
        F.abs(F.size(x["a"]) - F.size(x["b"])) <= 3 * CELLS, _peel(_subtract(sketch(x["a"]), sketch(x["b"])))).alias("got")))
    return let(tried, lambda t: F.struct(
        F.transform(F.filter(t, lambda x: x["got"].isNull()), lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"))).alias("todo"),
        F.concat(state["got"], F.flatten(F.transform(F.filter(t, lambda x: x["got"].isNotNull()), lambda x: x["got"]))).alias("got")))


def recovered(a: Column, b: Column) -> Column:
    """The digests of one list but not the other, peeled from ever larger sketches; those parts grow that couldn't be peeled."""
    start = F.struct(F.array(F.struct(a.alias("a"), b.alias("b"))).alias("todo"), F.array().cast("array<bigint>").alias("got"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS - 1)), start, lambda s, level: F.when(F.size(s["todo"]) == 0, s).otherwise(_larger(s, level)), lambda s: s["got"])


def differing(a: Column, b: Column, cells_a: Column, cells_b: Column) -> Column:
    """The digests of one text but not the other: their fingerprints' difference peeled, larger sketches on failure."""
    gap = F.abs(F.size(a) - F.size(b))
    return F.coalesce(F.when(gap <= 3 * CELLS, _peel(_subtract(cells_a, cells_b))), recovered(a, b))


def likeness(a: Column, b: Column, d: Column) -> Column:
    both, apart = (F.size(a) + F.size(b)).cast("double"), F.size(d)
    return F.when(both == 0, F.lit(1.0)).otherwise((both - apart) / (both + apart))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t, next): every row's text and that of the next row by id; after the last comes the first.

    Rows are dealt by ranges of ids, whose bounds are quantiles; the first rows
    of a range are also sent to the range before it.  So one shuffle of the
    texts serves, and no task gets more than a few ranges.
    """
    key = F.coalesce(column(id_col).cast("long"), F.lit(LOWEST))
    ids = docs.select(key.alias("key"))
    n = ids.count()
    ranges = max(1, min(MAX_RANGES, n // RANGE_ROWS))
    found = ids.agg(F.min("key").alias("least"), F.percentile_approx("key", [i / ranges for i in range(1, ranges)] or [0.5], max(10_000, 4 * ranges)).alias("q")).first()
    bounds = sorted({found["least"], *(found["q"] if ranges > 1 else [])}) if n else [LOWEST]  # MAX_RANGES at most
    first = F.array(*[F.lit(b).cast("long") for b in bounds]) if len(bounds) <= 64 else F.from_json(F.lit(str(bounds)), "array<bigint>")
    bits = max(1, len(bounds).bit_length())

    # the last range whose bound isn't above the key, by binary search (1-based)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(bits))])

    def halve(at: Column, step: Column) -> Column:
        to = at + step
        return F.when(F.when(to <= len(bounds), F.element_at(first, F.least(to, F.lit(len(bounds)))) <= F.col("key")).otherwise(False), to).otherwise(at)

    rows = docs.select(column(id_col).alias("id"), key.alias("key"), normal_text(text_col).alias("t"))
    rows = rows.withColumn("b", F.aggregate(steps, F.lit(0), halve))
    before = F.when(F.col("b") == 1, F.lit(len(bounds))).otherwise(F.col("b") - 1)
    own = F.struct(F.col("b").alias("range"), F.lit(0).alias("guest"))
    sent = F.when(F.element_at(first, F.greatest("b", F.lit(1))) == F.col("key"), F.array(own, F.struct(before.alias("range"), F.lit(1).alias("guest")))).otherwise(F.array(own))
    rows = rows.select("id", "key", "t", F.inline(sent))
    by_id = Window.partitionBy("range").orderBy("guest", "key", F.xxhash64("t"))
    return rows.select("id", "t", "guest", F.lead("t").over(by_id).alias("next")).where("guest = 0").select("id", "t", "next")


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, n_digests, cells, fingerprint) of every row's whole text."""
    rows = docs.select(column(id_col).alias("id"), normal_text(text_col).alias("t"))
    rows = rows.select("id", F.length("t").cast("long").alias("n_chars"), paragraphs(F.col("t")).alias("d"))
    rows = rows.select("id", "n_chars", F.size("d").alias("n_digests"), sketch(F.col("d")).alias("cells"))
    return rows.select(F.col("id").alias(id_col), "n_chars", "n_digests", "cells", text_of(F.col("cells"), F.col("n_digests")).alias("fingerprint"))


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t, e, next): with e, the text whose last half is replaced by the start of the next one's."""
    half = F.floor(F.length("t") / 2).cast("int")
    return with_next(docs, id_col, text_col).select(
        "id", "t", F.concat(F.substring("t", F.lit(1), F.length("t") - half), F.substring("next", F.lit(1), half)).alias("e"), "next")


def compare(pairs: DataFrame) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of rows (id, t, e, next)."""
    d = pairs.select("id", F.length("t").cast("long").alias("n_chars"), F.sha2("e", 256).alias("edited_sha256"), *[paragraphs(F.col(c)).alias(f"d_{c}") for c in ("t", "e", "next")])
    d = d.select("*", *[sketch(F.col(f"d_{c}")).alias(f"s_{c}") for c in ("t", "e", "next")])

    def near(other: str) -> Column:
        a, b = F.col("d_t"), F.col(f"d_{other}")
        return likeness(a, b, differing(a, b, F.col("s_t"), F.col(f"s_{other}")))

    return d.select("id", "n_chars", "edited_sha256", text_of(F.col("s_t"), F.size("d_t")).alias("fingerprint"),
                    text_of(F.col("s_e"), F.size("d_e")).alias("edited_fingerprint"), near("e").alias("near_edited"), near("next").alias("near_next"))
