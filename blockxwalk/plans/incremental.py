"""Matching again after a change of the inputs: finished waves are kept, changed keys are matched anew.

``IncrementalMatch(x, state)`` runs the five waves of a ``BlockCrosswalk`` and keeps each
wave's matches in a folder named after a digest of all that the wave reads (an
order-independent content digest: one aggregate over each input).

* A wave whose digest is there is read, not computed: a second run, or one that
  goes on after a failure, starts behind the finished waves.
* The equi-join waves (directory, application BBL, billing) are computed again as a
  whole if what they read has changed.
* The distance waves keep the matches of all keys that the change can't touch: keys
  with the same parcels as before, not within the wave's radius of a line that has
  come, gone or moved.  Only the other keys go through the distance join; their
  matches are put beside the kept ones.

The state's folder must be one that all executors see.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_keys, remaining, restrict
from ..operators.spatial import within_distance
from . import match as M
from .pipeline import BlockCrosswalk


def _row_hash(df: DataFrame, seed: int):
    # the text form of nested values tells their nesting, and nulls apart
    return F.xxhash64(F.lit(seed), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))


def content_digest(df: DataFrame) -> str:
    """A digest of the rows in any order, repeated ones counted."""
    r = df.select(_row_hash(df, 1).alias("a"), _row_hash(df, 2).alias("b")).agg(
        F.count(F.lit(1)), F.sum(F.col("a").cast("decimal(38,0)")), F.bit_xor("b"), F.sum((F.col("b") % 1_000_003).cast("decimal(38,0)"))).first()
    return hashlib.md5(repr(tuple(map(str, r))).encode()).hexdigest()


def _combined(*digests: str) -> str:
    return hashlib.md5(":".join(digests).encode()).hexdigest()


class IncrementalMatch:
    def __init__(self, x: BlockCrosswalk, state: str):
        self.x, self.state, self.spark = x, state.rstrip("/"), x.parcels_keyed.sparkSession
        #: What was done for each wave: "kept", "whole", or "changed keys".
        self.done: dict[str, str] = {}

    # --- the state's tables -----------------------------------------------------
    def _exists(self, name: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.state}/{name}/_SUCCESS")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.state}/{name}")

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        if not self._exists(name):
            df.write.mode("overwrite").parquet(f"{self.state}/{name}")
        return self._read(name)

    def _last(self, wave: str) -> list[str]:
        """The digests of the wave's last run: of all it read, and of the lines."""
        return self.spark.read.text(f"{self.state}/last-{wave}").first()[0].split() if self._exists(f"last-{wave}") else []

    def _note(self, wave: str, *digests: str) -> None:
        self.spark.createDataFrame([(" ".join(digests),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.state}/last-{wave}")

    # --- waves --------------------------------------------------------------------
    def _tagged(self, wave: str, matches: DataFrame) -> DataFrame:
        return matches.select(*M.MATCH_COLS).distinct().withColumn("source", F.lit(wave))

    def _whole(self, wave: str, digest: str, compute: Callable[[], DataFrame]) -> DataFrame:
        name = f"{wave}-{digest}"
        self.done[wave] = "kept" if self._exists(name) else "whole"
        return self._read(name) if self._exists(name) else self._keep(name, self._tagged(wave, compute()))

    def _near(self, wave: str, rem: DataFrame, radius: float, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A distance wave over the keys that are left."""
        polys = M.remaining_parcels(self.x.parcels_keyed, rem)
        # one digest a key over its parcels; keys without any have no matches
        own = polys.select("bbl_chr", _row_hash(polys, 3).alias("h"))
        keys = own.groupBy("bbl_chr").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.bit_xor("h").alias("x"))
        lines = self.x.lines
        d_lines = content_digest(lines)
        digest = _combined(content_digest(keys), d_lines, repr(radius))
        name = f"{wave}-{digest}"
        if self._exists(name):
            self.done[wave] = "kept"
            return self._read(name)
        keys = self._keep(f"{wave}-{digest}-keys", keys)
        lines = self._keep(f"lines-{d_lines}", lines)
        last = self._last(wave)
        if len(last) == 2 and all(map(self._exists, (f"{wave}-{last[0]}", f"{wave}-{last[0]}-keys", f"lines-{last[1]}"))):
            self.done[wave] = "changed keys"
            same = join_keys(keys, self._read(f"{wave}-{last[0]}-keys"), ["bbl_chr", "n", "s", "x"], "left_semi").select("bbl_chr")
            if last[1] != d_lines:
                hashed = lambda df: df.withColumn("_h", _row_hash(df, 4)).withColumn("_k", _row_hash(df, 5))
                a, b = hashed(lines), hashed(self._read(f"lines-{last[1]}"))
                moved = a.join(b, ["_h", "_k"], "left_anti").unionByName(b.join(a, ["_h", "_k"], "left_anti")).drop("_h", "_k")
                touched = within_distance(restrict(polys, same, "bbl_chr"), moved, radius).select("bbl_chr").distinct()
                same = remaining(same, touched, "bbl_chr")
            same = self._keep(f"{wave}-{digest}-same", same)
            kept = restrict(self._read(f"{wave}-{last[0]}"), same, "bbl_chr").select(*M.MATCH_COLS)
            found = kept.unionByName(compute(remaining(keys.select("bbl_chr"), same, "bbl_chr")).select(*M.MATCH_COLS))
        else:
            self.done[wave] = "whole"
            found = compute(keys.select("bbl_chr"))
        out = self._keep(name, self._tagged(wave, found))
        self._note(wave, digest, d_lines)
        return out

    def matches(self) -> dict[str, DataFrame]:
        """All waves' matches, as the cascade's."""
        x, keyed = self.x, self.x.parcels_keyed
        keys, pad, lookup = M.all_bbls(keyed), M.pad_keys(x.pad_addr), x.segment_lookup
        d_pad, d_lookup, d_keys = content_digest(pad), content_digest(lookup), content_digest(keys)
        out: dict[str, DataFrame] = {}
        left = lambda: remaining(keys, self._union(out).select("bbl_chr").distinct(), "bbl_chr")
        d = _combined(d_pad, d_lookup)
        out[M.W1] = self._whole(M.W1, d, lambda: M.wave1(pad, lookup))
        d = _combined(d, d_keys, content_digest(keyed.select("bbl_chr", "appbbl_chr")))
        out[M.W2A] = self._whole(M.W2A, d, lambda: M.wave2a(left(), keyed, out[M.W1]))
        if x.pad_bill is not None:
            d = _combined(d, content_digest(M.billing_keys(x.pad_bill)))
            out[M.W2B] = self._whole(M.W2B, d, lambda: M.wave2b(left(), x.pad_bill, out[M.W1]))
        out[M.W3] = self._near(M.W3, left(), x.buffer_ft, lambda rem: M.wave3(rem, keyed, x.line_edges, x.buffer_ft, x.cell, x.salt))
        out[M.W4] = self._near(M.W4, left(), x.nearest_ft, lambda rem: M.wave4(rem, keyed, x.line_edges, x.nearest_ft, x.cell, x.salt))
        return out

    def _union(self, waves: dict[str, DataFrame]) -> DataFrame:
        found = None
        for w in waves.values():
            found = w if found is None else found.unionByName(w)
        return found
