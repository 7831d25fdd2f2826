"""WKB bytes <-> parts of vertices (lines and polygons, single or multi, 2D or with Z/M).

Spark has no function that reads bytes as doubles, so this is the one place of
the block crosswalk with Python: Arrow functions that a reader or writer applies
once per row.  Coordinates go between the bytes and flat Arrow buffers as they
are, with offsets of parts and geometries beside them; no vertex becomes a Python
object.  A malformed value gives a NULL geometry.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

GEOMETRY_DDL = "array<array<struct<x:double,y:double>>>"


def parts_of(data: bytes) -> list[np.ndarray]:
    """Vertex arrays (n x 2) of all line parts or rings."""
    out: list[np.ndarray] = []

    def read(at: int) -> int:
        order = "<" if data[at] == 1 else ">"
        (kind,) = struct.unpack_from(order + "I", data, at + 1)
        at += 5
        dims = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000)  # flags of the extended form
        if kind & 0x20000000:
            at += 4  # an id of the reference system
        kind &= 0x0FFFFFFF
        dims = max(dims, 2 + (kind // 1000 in (1, 2, 3)) + (kind // 1000 == 3))  # codes of the ISO form
        kind %= 1000
        (n,) = struct.unpack_from(order + "I", data, at)
        at += 4
        if kind == 2:
            return points(order, dims, n, at)
        if kind == 3:
            for _ in range(n):
                (m,) = struct.unpack_from(order + "I", data, at)
                at = points(order, dims, m, at + 4)
            return at
        if kind in (5, 6, 7):
            for _ in range(n):
                at = read(at)
            return at
        raise ValueError(f"geometry kind {kind}")

    def points(order: str, dims: int, n: int, at: int) -> int:
        end = at + 8 * dims * n
        if end > len(data):
            raise ValueError("cut off")
        out.append(np.frombuffer(data, order + "f8", dims * n, at).reshape(n, dims)[:, :2])
        return end

    read(0)
    return out


def decode(data: pa.Array) -> pa.Array:
    """A batch of WKB values as nested lists over flat x and y buffers."""
    xy, part_ends, geom_ends, missing = [], [0], [0], []
    for v in data:
        parts = None
        if v.is_valid:
            try:
                parts = parts_of(v.as_buffer().to_pybytes())
            except (ValueError, IndexError, struct.error):
                pass
        for p in parts or ():
            xy.append(p)
            part_ends.append(part_ends[-1] + len(p))
        geom_ends.append(len(part_ends) - 1)
        missing.append(parts is None)
    flat = np.concatenate(xy).astype(np.float64) if xy else np.zeros((0, 2))
    points = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in (0, 1)], ["x", "y"])
    parts = pa.ListArray.from_arrays(pa.array(part_ends, pa.int32()), points)
    return pa.ListArray.from_arrays(pa.array(geom_ends, pa.int32()), parts, mask=pa.array(missing, pa.bool_()))


def encode(geoms: pa.Array, rings: bool) -> pa.Array:
    """A batch of geometries as little-endian WKB: multilines, or polygons whose rings are the parts."""
    parts = geoms.values
    points = parts.values
    xy = np.stack([points.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)], axis=1).astype("<f8") if len(points) else np.zeros((0, 2), "<f8")
    part_ends, geom_ends, valid = parts.offsets.to_numpy(), geoms.offsets.to_numpy(), geoms.is_valid().to_numpy(zero_copy_only=False)
    out = []
    for i in range(len(geoms)):
        if not valid[i]:
            out.append(None)
            continue
        lo, hi = geom_ends[i], geom_ends[i + 1]
        body = [struct.pack("<BII", 1, 3 if rings else 5, hi - lo)]
        for k in range(lo, hi):
            p = xy[part_ends[k]:part_ends[k + 1]]
            body += [struct.pack("<I", len(p)) if rings else struct.pack("<BII", 1, 2, len(p)), p.tobytes()]
        out.append(b"".join(body))
    return pa.array(out, pa.binary())


def from_wkb(data: Column) -> Column:
    return F.arrow_udf(decode, GEOMETRY_DDL)(data)


def to_wkb(geom: Column, rings: bool = False) -> Column:
    """WKB of a vertex-array column: MULTILINESTRING, or with ``rings`` POLYGON."""
    return F.arrow_udf(lambda g: encode(g, rings), "binary")(geom)
