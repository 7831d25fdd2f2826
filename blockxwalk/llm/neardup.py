"""Near-duplicate classes by ProbMinHash.

A text is its lower-cased words (runs of letters and digits) in shingles of
five; a shorter text is one shingle.  Texts of equal words are one node, so that
exact copies cost a row each and no comparison.  A node's signature has
``REGISTERS`` registers: each shingle emits arrivals of a Poisson process whose rate
is its weight; an arrival falls into a hashed register, which keeps the element
of its earliest arrival; a shingle stops once its next arrival is later than all
the registers' (early termination).  Two nodes agree in a register with their
probability Jaccard similarity.  A shingle that occurs n times weighs 1 + ln n.

Bands of ``ROWS`` registers make buckets.  Candidates pass the signature's
estimate, then the exact probability Jaccard similarity of the weighted shingles

    J(x, y) = sum over shared i of 1 / sum over j of max(x_j / x_i, y_j / y_i):

``SIMILARITY`` or more is a link.  Classes are the connected components of the links.
Where no shingle occurs twice, J is the Jaccard similarity of the sets.

Only a bucket of ``SMALL`` nodes at most is compared pair by pair, and of these
only nodes of different components.  The nodes of larger ones are grouped by the
node with most neighbours that they meet.  A group's reference R is the set of
the shingles that most of a sample of its nodes have (any set would be right); all
its nodes are compared with R, and with the node that is most like R.  With weights
that add up to 1 in each node, let s and t be the parts of u's and v's weight inside R.
Which pairs u, v of the group can still be links follows from them:

* if they share no shingle outside R, J <= 1 / (1/s + 1/t - 1), as each summand of J
  is at most p q / (q + (1 - t) p), which is concave; and s can be no more than the
  shingles of v in R, weighed as in u, are of u's weight, so that sizes must fit; the
  pairs for which that is enough are joined by size;
* else, as J is at most the sum of the lesser weights, the shared shingles outside R
  hold 0.8 - s of u's weight or more, and so one of them is among the first ones
  of u outside R, those after which less than that is left (prefix filter), and the
  same of v: those shingles make the buckets of the next round, for nodes of
  different components alone.

Rounds end when no bucket holds several components.  From round ``DEPTH`` on all
nodes of a large bucket are compared with one after the other.  Nothing is capped or sampled.

Texts are never shuffled: a row's place (its file and its number in it) goes with its
digest, and the rows that are needed again, or kept, are read by bitmaps of their places
(a bit for each row of the input, broadcast file by file in bounded portions).

Defined results: null text reads as empty; texts without words are copies if
they are equal; repeated rows are copies; a class's id is its least document id
(null if all its ids are null); an empty table gives an empty one; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, materialize, normal_text, pick, place, placed

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 4
REGISTERS = BANDS * ROWS
#: Agreeing registers that a candidate needs; a pair of similarity 0.8 agrees in 64 of 80, fewer than 44 are 5.6 deviations off.
LEAST_AGREEING = 44
SMALL, DEPTH = 64, 8
#: A bin of sizes reaches so far.
BIN = 1.05
#: Nodes of a group that its reference is made of, about.
REFERENCE_NODES = 48
#: Most that rounding moves a similarity or a sum of weights.
ROUNDING = 1e-9
#: A key with more than this part of a table's rows (and these rows) is joined by broadcast: there are fewer than 1 / HOT such keys.
HOT, HOT_ROWS = 1 / 500, 2000
#: Words that a worker takes up together, about.
WORDS_TOGETHER = 400_000


# --- signatures ---------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_PLACE = [np.uint64(0x9E3779B97F4A7C15 * (2 * i + 1) % (1 << 64) | 1) for i in range(SHINGLE)]


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of all five-word shingles of one text's word hashes, in order."""
    words = words.view(np.uint64)
    n = max(1, len(words) - SHINGLE + 1) if len(words) else 0
    total = np.full(n, min(len(words), SHINGLE), np.uint64)
    for i in range(min(SHINGLE, len(words))):
        total = _mix(total + words[i:i + n] * _PLACE[i]) if i % 2 else total + words[i:i + n] * _PLACE[i]
    return _mix(total)


def prob_min_hash(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """Registers (n x m, the element of the earliest arrival; 0: none) of n weighted sets; ``owner`` ascends."""
    first, best = np.full(n * m, np.inf), np.zeros(n * m, np.uint64)
    slow, at, state, k = 1 / weights, np.zeros(len(elements)), elements, 0
    e = elements
    while len(e):
        k += 1
        state = _mix(state + np.uint64(0x9E3779B97F4A7C15))
        at = at - np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) * slow
        slot = owner * m + (_mix(state ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(33)).astype(np.int64) % m
        np.minimum.at(first, slot, at)
        won = first[slot] == at
        best[slot[won]] = e[won]
        # the latest register of the sets that still have arrivals
        new = np.concatenate([[True], owner[1:] != owner[:-1]])
        sets = owner[new]
        latest = first.reshape(n, m)[sets].max(axis=1)
        go = at < latest[np.cumsum(new) - 1]
        e, slow, at, state, owner = e[go], slow[go], at[go], state[go], owner[go]
    return best.reshape(n, m)


def _words() -> Column:
    return F.regexp_extract_all(F.lower(F.col("t")), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _node() -> Column:
    """Digest of the column w of words; without words, of the text t."""
    return F.unhex(F.md5(F.when(F.size("w") > 0, F.array_join("w", " ")).otherwise(F.concat(F.lit("\n"), F.col("t")))))


def nodes_of(texts: DataFrame) -> DataFrame:
    """(id, file, at, node, words) of rows (id, file, at, t): the digest of the words of t, and the words' hashes."""
    rows = texts.select("id", "file", "at", "t", _words().alias("w"))
    return rows.select("id", "file", "at", _node().alias("node"), F.transform("w", lambda w: F.xxhash64(w)).alias("words"))


def weights(counts: np.ndarray) -> np.ndarray:
    return 1 + np.log(counts)


def _sliced(b: pa.RecordBatch, name: str) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Slices of a batch of about WORDS_TOGETHER words: from, to, the rows' word hashes."""
    words = b.column(b.schema.get_field_index(name))
    values, ends = words.values.to_numpy(zero_copy_only=False), words.offsets.to_numpy()
    i = 0
    while i < b.num_rows:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + WORDS_TOGETHER, "right")) - 1)
        j = min(j, b.num_rows)
        yield i, j, [values[ends[r]:ends[r + 1]] for r in range(i, j)]
        i = j


def signatures(rows: DataFrame) -> DataFrame:
    """(id, file, at, node, bands array<long>, sig binary): of rows (id, file, at, node, words)."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = (np.arange(BANDS, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        for b in batches:
            for i, j, words in _sliced(b, "words"):
                found = [np.unique(shingles(w), return_counts=True) for w in words]
                sizes = [len(x) for x, _ in found]
                registers = prob_min_hash(np.concatenate([x for x, _ in found]), weights(np.concatenate([n for _, n in found])), np.repeat(np.arange(j - i), sizes), j - i)
                hashed = np.tile(salt, (j - i, 1))
                for r in range(ROWS):
                    hashed = _mix(hashed + registers[:, r::ROWS])
                short = (_mix(registers) >> np.uint64(48)).astype(np.uint16)
                empty = np.array(sizes) == 0
                ends = np.concatenate([[0], np.cumsum(np.where(empty, 0, BANDS))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    *(b.column(k).slice(i, j - i) for k in range(4)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(hashed[~empty].view(np.int64).ravel())),
                    pa.array([x.tobytes() for x in short], pa.binary())], ["id", "file", "at", "node", "bands", "sig"])

    return rows.mapInArrow(run, f"id {kind}, file long, at long, node binary, bands array<long>, sig binary")


# --- weighted sets -------------------------------------------------------------

def pack(elements: np.ndarray) -> bytes:
    """A multiset of shingles (32 bits each): their number, the distinct ones in order, then places and counts of those that occur more than once."""
    x, n = np.unique(elements, return_counts=True)
    often = np.flatnonzero(n > 1)
    return np.concatenate([[len(x)], x, often, n[often]]).astype(np.uint32).tobytes()


def unpack(packed) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in order, and their weights."""
    a = np.frombuffer(packed, np.uint32)
    n = int(a[0])
    often, counts = a[n + 1:].reshape(2, -1)
    w = np.ones(n)
    w[often] = weights(counts)
    return a[1:n + 1], w


def shared(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common elements in both of two ascending arrays."""
    if not len(x) or not len(y):
        return np.zeros(0, int), np.zeros(0, int)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    here = np.flatnonzero(y[at] == x)
    return here, at[here]


def probability_jaccard(x: np.ndarray, wx: np.ndarray, y: np.ndarray, wy: np.ndarray) -> float:
    """The exact probability Jaccard similarity of two weighted sets (elements ascending); 0 if one is empty."""
    i, j = shared(x, y)
    if not len(i):
        return 0.0
    a, b = wx[i], wy[j]
    order = np.argsort(-a / b, kind="stable")  # those first in which x has more
    a, b = a[order], b[order]
    # an element's sum: x's weights where x has at least as much, measured by it, and y's where y has more
    more = np.cumsum(a) + (wx.sum() - a.sum())
    less = b.sum() - np.cumsum(b) + (wy.sum() - b.sum())
    return float((1 / (more / a + less / b)).sum())


# --- joins that a hot key doesn't hold up ----------------------------------------

def _tasks(df: DataFrame) -> DataFrame:
    """The rows in fewer partitions, for tables of a few columns of the nodes that have neighbours: a quarter of a
    shuffle's, and enough to keep the cores busy twice."""
    spark = df.sparkSession
    return df.coalesce(max(1, 2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4))


def _table(df: DataFrame, name: str) -> DataFrame:
    return materialize(_tasks(df), name)


def attach(rows: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` joined with a table of one row a key, whose column ``count`` says how many of the rows have that key.

    The few keys with a large part of all rows are broadcast; the others go by a
    shuffle, in which none of them can fill a task.
    """
    sizes = table.agg(F.sum(count).alias("total"), F.max(count).alias("most")).first()
    bound = max(HOT_ROWS, (sizes["total"] or 0) * HOT)
    if (sizes["most"] or 0) <= bound:
        return rows.join(table.drop(count), key)
    hot = table.where(F.col(count) > bound)  # fewer than 1 / HOT rows
    marked = rows.join(F.broadcast(hot.select(key).withColumn("is_hot", F.lit(True))), key, "left")
    a = marked.where("is_hot").drop("is_hot").join(F.broadcast(hot.drop(count)), key)
    b = marked.where("is_hot is null").drop("is_hot").join(table.where(F.col(count) <= bound).drop(count), key)
    return a.unionByName(b)


# --- candidates, links, components ------------------------------------------------

def _cut(pairs: DataFrame) -> DataFrame:
    """Distinct pairs a < b."""
    return pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _most(pairs: DataFrame, x: str) -> int:
    """The most rows that one value of a column has."""
    return _tasks(pairs.groupBy(x).agg(F.count("*").alias("n"))).agg(F.max("n")).first()[0] or 0


def _estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose signatures agree in enough registers."""
    rows = pairs
    for x in "ab":
        sig = nodes.select(F.col("node").alias(x), F.col("sig").alias(f"s{x}"))
        if _most(pairs, x) <= HOT_ROWS:
            rows = rows.join(sig, x)
        else:
            rows = attach(rows, _table(pairs.groupBy(x).agg(F.count("*").alias("n")).join(sig, x), "partners"), x, "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("sa", "sb"))
            keep = (x == y).sum(axis=1) >= LEAST_AGREEING
            yield b.select(["a", "b"]).filter(pa.array(keep))

    return rows.select("a", "b", "sa", "sb").mapInArrow(run, "a binary, b binary")


def _joined(pairs: DataFrame, sets: DataFrame, others: DataFrame) -> DataFrame:
    """(a, b, sa, sb): the pairs (written, distinct) with the packed sets, a's in sets, b's in others.

    A set with many partners is sent once for each 256 of them, to as many tasks.
    """
    rows = pairs
    for x, y, table in (("a", "b", sets), ("b", "a", others)):
        own = table.withColumnRenamed("node", x).withColumnRenamed("set", f"s{x}")
        if _most(pairs, x) <= 256:
            rows = rows.join(own, x)
            continue
        degree = _table(pairs.groupBy(x).agg(F.count("*").alias("n")).select(x, F.ceil(F.col("n") / 256).cast("int").alias("parts"), "n"), "degrees")
        dealt = own.join(degree.select(x, "parts"), x).select(x, f"s{x}", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("k"))
        rows = attach(rows, degree, x, "n").withColumn("k", F.pmod(F.xxhash64(y), F.col("parts")).cast("int")).drop("parts")
        rows = rows.join(dealt, [x, "k"]).drop("k")
    return rows.select("a", "b", "sa", "sb")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, jaccard) of the pairs (written, distinct) that are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([probability_jaccard(*unpack(x.as_buffer()), *unpack(y.as_buffer())) for x, y in zip(b.column("sa"), b.column("sb"))])
            keep = np.flatnonzero(found >= SIMILARITY - ROUNDING) if len(found) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([*b.select(["a", "b"]).take(pa.array(keep)).columns, pa.array(found[keep], pa.float64())], ["a", "b", "jaccard"])

    return _joined(pairs, sets, sets).mapInArrow(run, "a binary, b binary, jaccard double")


def _inside(groups: DataFrame, sets: DataFrame, references: DataFrame) -> DataFrame:
    """(a, b, likeness, inside, total, held, extra, added) of a node a and its group's reference: the similarity of the plain
    sets; the part of a's weight in the reference; its whole weight, the number of its shingles in the reference, and how
    much more than that they weigh; and the first shingles outside of which a partner shares one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            like, inside, total, held, extra, added = [], [], [], [], [], []
            for x, y in zip(b.column("sa"), b.column("sb")):
                (x, w), (y, _) = unpack(x.as_buffer()), unpack(y.as_buffer())
                here, _ = shared(x, y)
                outside = np.ones(len(x), bool)
                outside[here] = False
                p = w / w.sum() if len(w) else w
                like.append(len(here) / max(1, len(x) + len(y) - len(here)))
                inside.append(float(p[here].sum()))
                total.append(float(w.sum()))
                held.append(len(here))
                extra.append(float(w[here].sum()) - len(here))
                left = np.cumsum(p[outside][::-1])[::-1]  # from each shingle on
                added.append(x[outside][left >= SIMILARITY - inside[-1] - ROUNDING].view(np.int32))
            ends = np.cumsum([0, *map(len, added)]).astype(np.int32)
            values = np.concatenate(added) if added else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([*b.select(["a", "b"]).columns, *(pa.array(v, pa.float64()) for v in (like, inside, total, held, extra)),
                                              pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], ["a", "b", "likeness", "inside", "total", "held", "extra", "added"])

    return _joined(groups, sets, references).mapInArrow(run, "a binary, b binary, likeness double, inside double, total double, held double, extra double, added array<int>")


def _sets(docs: DataFrame, places: DataFrame, text_col: str) -> DataFrame:
    """(node, set): the packed shingles of the texts at the places (file, at), one for each node."""
    rows = nodes_of(pick(docs, places, F.lit(None).cast("long").alias("id"), normal_text(text_col).alias("t")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, words in _sliced(b, "words"):
                yield pa.RecordBatch.from_arrays([b.column(3).slice(i, j - i), pa.array([pack((shingles(w) >> np.uint64(32)).astype(np.uint32)) for w in words], pa.binary())], ["node", "set"])

    return rows.mapInArrow(run, "node binary, set binary")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of all nodes of the links (a, b): the least node of each connected component.

    Every round a node takes the least label among its own and its neighbours',
    then, from the third round on, its label's label; it ends when no label has changed.
    """
    edges = _table(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = _table(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("comp"), F.count("*").alias("n")).withColumnRenamed("a", "node"), "labels")
    turn = 0
    while True:
        turn += 1
        seen = attach(edges, labels.select(F.col("node").alias("b"), "comp", "n"), "b", "n")
        least = seen.groupBy("a").agg(F.min("comp").alias("near")).withColumnRenamed("a", "node")
        new = labels.join(least, "node").select("node", F.least("comp", "near").alias("comp"), "n", F.col("comp").alias("old"))
        new = _table(new, "labels")
        if turn > 2:  # long chains: the label of the label
            sizes = new.groupBy("comp").agg(F.count("*").alias("m"))
            jump = new.select(F.col("node").alias("comp"), F.col("comp").alias("to")).join(sizes, "comp")
            new = _table(attach(new, jump, "comp", "m").select("node", F.least("comp", "to").alias("comp"), "n", "old"), "labels")
        labels = new.drop("old")
        if new.where("comp != old").isEmpty():
            return labels.select("node", "comp")


def _with_components(rows: DataFrame, comps: DataFrame | None) -> DataFrame:
    """The rows (.., node) with the column comp."""
    if comps is None:
        return rows.withColumn("comp", F.col("node"))
    return rows.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _unsettled(rows: DataFrame) -> DataFrame:
    """(key, node, comp, size) of the buckets with several components."""
    mixed = rows.groupBy("key").agg(F.count("*").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi")
    mixed = _table(mixed.select("key", "size", F.col("size").alias("n")), "unsettled")
    return _table(attach(rows.select("key", "node", "comp"), mixed, "key", "n"), "rows")


def _shared(rows: DataFrame) -> DataFrame:
    """The rows whose key isn't theirs alone."""
    keys = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return attach(rows, materialize(keys, "shared-keys"), "key", "n")


def _small_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of nodes of different components in small buckets."""
    own = rows.where(F.col("size") <= SMALL).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("node", "comp"))).alias("all"))  # SMALL at most
    others = own.select("all", F.explode("all").alias("x"))
    others = others.select("x", F.explode(F.filter("all", lambda y: (y["node"] > F.col("x.node")) & (y["comp"] != F.col("x.comp")))).alias("y"))
    return others.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _groups(large: DataFrame) -> DataFrame:
    """(a, b): the nodes of the large buckets, each with the node b that names its buckets' groups."""
    degree = _table(large.groupBy("node").agg(F.sum("size").alias("degree")), "degree")
    large = large.join(degree, "node")
    top = _table(large.groupBy("key").agg(F.first("size").alias("n"), F.max(F.struct("degree", "node")).alias("top")), "tops")
    own = attach(large.select("key", "node"), top, "key", "n").groupBy("node").agg(F.max("top").alias("ref"))
    main = large.select("key", "node", "size").join(own, "node").groupBy("key", "ref").agg(F.count("*").alias("m"), F.first("size").alias("n"))
    main = main.groupBy("key").agg(F.first("n").alias("n"), F.max(F.struct("m", "ref")).alias("main"))
    main = _table(main.select("key", "n", F.col("main.ref.node").alias("b")), "group-names")
    return attach(large.select("key", F.col("node").alias("a")), main, "key", "n").select("a", "b").distinct()


def _references(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, set): by group b the shingles that most of a sample of its nodes have."""
    size = _table(groups.groupBy("b").agg(F.count("*").alias("n"), F.ceil(F.count("*") / REFERENCE_NODES).cast("int").alias("every"), F.min(F.xxhash64("a", F.lit(9))).alias("first")), "group-sizes")
    taken = attach(groups, size, "b", "n")
    h = F.xxhash64("a", F.lit(9))
    taken = taken.where((F.pmod(h, F.col("every")) == 0) | (h == F.col("first"))).select("b", F.col("a").alias("node")).join(sets, "node")

    def most(b: pa.Table) -> pa.Table:
        members = [unpack(x.as_buffer())[0] for x in b.column("set").combine_chunks()]
        found, n = np.unique(np.concatenate(members), return_counts=True)
        return pa.table({"node": b.column("b").slice(0, 1), "set": pa.array([pack(found[2 * n > len(members)])], pa.binary())})

    return taken.select("b", "set").groupBy("b").applyInArrow(most, "node binary, set binary")


def _near_reference(star: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Pairs of different components that can be links though they share nothing outside their group's reference.

    That needs 1/s + 1/t - 1 <= 1 / SIMILARITY, where the shared part s of u's weight is
    at most what lies in the reference, and at most that of as many of its shingles
    there as v has (each weighs 1, and all of them together ``extra`` more); the same
    for t.  So v's ``held`` is 0.8 of u's ``total`` less its ``extra`` at least, and 0.8 of v's
    ``total`` at most u's ``held`` and v's ``extra``: ranges of sizes, joined in bins.
    Nodes in the largest component of a group meet the others only.
    """
    rows = _with_components(star.withColumnRenamed("a", "node"), comps)
    sizes = _table(rows.groupBy("b", "comp").agg(F.count("*").alias("m")).groupBy("b").agg(F.sum("m").alias("n"), F.max(F.struct("m", "comp")).alias("main")), "group-components")
    rows = attach(rows, sizes.select("b", "n", F.col("main.comp").alias("main")), "b", "n")
    rows = rows.where(F.col("inside") >= SIMILARITY - ROUNDING)
    rows = _table(rows.select("b", "node", "inside", "total", "held", "extra", "comp", (F.col("comp") == F.col("main")).alias("main")), "near-reference")

    def bins(least: Column, most: Column) -> Column:
        at = lambda x: F.floor(F.log(x) / F.log(F.lit(BIN))).cast("int")
        return F.explode(F.sequence(at(F.greatest(least * (1 - ROUNDING), F.lit(1.0))), at(F.greatest(most * (1 + ROUNDING), least, F.lit(1.0)))))

    names = ("node", "comp", "inside", "total", "held", "extra")
    u = rows.where(~F.col("main")).select("b", *[F.col(c).alias(f"u_{c}") for c in names], bins(SIMILARITY * F.col("total") - F.col("extra"), F.col("held") / SIMILARITY).alias("bin"))
    v = rows.select("b", *[F.col(c).alias(f"v_{c}") for c in names], bins(F.col("held") - (1 / SIMILARITY - 1) * F.col("extra"), F.col("held")).alias("bin"))
    part = lambda x, y: F.least(F.col(f"{x}_inside"), (F.col(f"{y}_held") + F.col(f"{x}_extra")) / F.col(f"{x}_total"))
    fits = 1 / part("u", "v") + 1 / part("v", "u") - 1 <= 1 / SIMILARITY + 8 * ROUNDING
    found = u.join(v, ["b", "bin"]).where((F.col("u_comp") != F.col("v_comp")) & fits)
    return found.select(F.col("u_node").alias("a"), F.col("v_node").alias("b"))


def link(nodes: DataFrame, sets_of) -> tuple[DataFrame | None, DataFrame | None]:
    """All links (a, b, jaccard) that join components, of nodes (node, bands, sig); and the components of the linked nodes."""
    buckets = materialize(_shared(nodes.select("node", F.explode("bands").alias("key"))), "buckets")
    if buckets.isEmpty():
        return None, None
    sets = materialize(sets_of(buckets.select("node").distinct()), "sets")
    links = comps = None
    depth = 0

    def extend(new: DataFrame) -> None:
        nonlocal links, comps
        new = _table(new, "links")
        if new.isEmpty():
            return
        links = new if links is None else links.unionByName(new)
        comps = components(links)

    def compared(pairs: DataFrame) -> DataFrame:
        """The links among pairs, which the signatures' estimate goes through first."""
        pairs = _table(_cut(pairs), "pairs")
        return _links(_table(_estimated(pairs, nodes), "candidates"), sets)

    while True:
        depth += 1
        rows = _unsettled(_with_components(buckets, comps))
        if rows.isEmpty():
            return links, comps
        found = compared(_small_pairs(rows))
        large = rows.where(F.col("size") > SMALL)
        if large.isEmpty():
            extend(found)
            return links, comps
        if depth >= DEPTH:  # one node after the other, until the bucket is settled
            pivot = _table(large.groupBy("key").agg(F.first("size").alias("n"), F.min("node").alias("b")), "pivots")
            left = _table(attach(large, pivot, "key", "n").select("key", "node", "b"), "pivot-rows").where("node != b")
            star = _table(left.select(F.col("node").alias("a"), "b").distinct(), "star-pairs")
            extend(found.unionByName(_links(star, sets)))
            buckets = left.select("key", "node")
            continue
        groups = _table(_groups(large), "groups")
        references = _table(_references(groups, sets), "references")
        star = materialize(_inside(groups, sets, references), "star")
        centre = _table(star.groupBy("b").agg(F.count("*").alias("n"), F.max(F.struct("likeness", "a")).alias("c")), "centres")
        pairs = attach(star.select("a", "b"), centre.select("b", "n", F.col("c.a").alias("centre")), "b", "n")
        pairs = _table(pairs.select("a", F.col("centre").alias("b")).where("a != b").distinct(), "centre-pairs")
        extend(found.unionByName(_links(pairs, sets)))
        extend(compared(_near_reference(star, comps)))
        buckets = materialize(_shared(star.select(F.col("a").alias("node"), F.explode("added").alias("s"), "b").select("node", F.xxhash64("b", "s").alias("key"))), "buckets")


def _found(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """Signed rows; nodes (node, first, copies) with the component comp; (comp, class_id, file, at, size) of the classes; links.

    ``first`` and the classes' file and at are those of the row with the least id, nulls last.
    """
    texts = docs.select(column(id_col).alias("id"), *place(docs), normal_text(text_col).alias("t"))
    rows = materialize(signatures(nodes_of(texts)), "signatures")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "file", "at")).alias("first")
    nodes = materialize(rows.groupBy("node").agg(first, F.first("bands").alias("bands"), F.first("sig").alias("sig"), F.count("*").alias("copies")), "nodes")
    links, comps = link(nodes, lambda wanted: _sets(docs, nodes.join(wanted, "node", "left_semi").select("first.file", "first.at"), text_col))
    labelled = _with_components(nodes.select("node", "first", "copies"), comps)
    labelled = _table(labelled, "labelled")
    # the least id, nulls last; of equal ids the first place
    least = labelled.groupBy("comp").agg(F.min("first").alias("l"), F.count("*").alias("size"))
    return rows, labelled, _table(least.select("comp", F.col("l.id").alias("class_id"), "l.file", "l.at", "size"), "classes"), links


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame | None]:
    """Rows (id, node, class_id), and links (a, b, jaccard) between nodes (None: no link)."""
    rows, labelled, found, links = _found(placed(docs), id_col, text_col)
    table = attach(labelled.select("node", "comp", "copies"), found.select("comp", "class_id", "size"), "comp", "size").select("node", "class_id", "copies")
    return attach(rows.select("id", "node"), _table(table, "node-classes"), "node", "copies"), links


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class, all columns as they were: that of the least id (nulls last), of equal ids the first in the input."""
    docs = placed(docs)
    _, _, found, _ = _found(docs, id_col, text_col)
    return pick(docs, found.select("file", "at"))
