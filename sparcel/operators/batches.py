"""Arrow batches <-> flat numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import kernel as K

EDGES = pa.list_(pa.float64())
VERTEX = pa.struct([("x", pa.float64()), ("y", pa.float64())])
ARROW_GEOM = pa.struct([
    ("srid", pa.int32()), ("dim", pa.int8()), ("multi", pa.bool_()),
    ("parts", pa.list_(pa.list_(pa.list_(VERTEX)))),
])
LEVEL_SHIFT, IX_SHIFT, HALF_RANGE, LEVEL_ZERO = 56, 28, 1 << 27, 64


def one(column):
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def offsets(lists: pa.Array) -> np.ndarray:
    return lists.offsets.to_numpy()


def decode(geom: pa.StructArray):
    """Geometry column -> (row, dim per row, edges, p) with one entry per segment.

    Rings are turned so that shells run counter-clockwise and holes clockwise. ``p`` numbers the
    vertices of a row (the segment from vertex p to p + 1), with a gap between parts. A point
    becomes a segment of length zero.
    """
    geom = one(geom)
    dims = geom.field("dim").to_numpy(zero_copy_only=False)
    parts = geom.field("parts")
    rings = parts.values
    verts = rings.values
    xy = verts.values
    x = K.snap(xy.field("x").to_numpy(zero_copy_only=False))
    y = K.snap(xy.field("y").to_numpy(zero_copy_only=False))
    po, ro, vo = offsets(parts), offsets(rings), offsets(verts)
    ids = np.arange(ro[po[0]], ro[po[-1]])
    part = np.searchsorted(ro, ids, "right") - 1
    ring_row = np.searchsorted(po, part, "right") - 1
    ring_dim = dims[ring_row]
    count = vo[ids + 1] - vo[ids]
    segs = np.maximum(np.where(ring_dim == 0, count, count - 1), 0)
    ring = np.repeat(np.arange(len(ids)), segs)
    a = vo[ids][ring] + K.ranges(segs)
    row, dim = ring_row[ring], ring_dim[ring]
    b = np.where(dim == 0, a, a + 1)
    e = np.column_stack([x[a], y[a], x[b], y[b]])
    p = (a - vo[ro[po[row]]] + part[ring] - po[row]).astype(float)
    if (ring_dim == 2).any():
        ox, oy = x[vo[ids][ring]], y[vo[ids][ring]]
        cross = (e[:, 0] - ox) * (e[:, 3] - oy) - (e[:, 2] - ox) * (e[:, 1] - oy)
        sign = np.bincount(ring, cross, minlength=len(ids))
        flip = (ring_dim == 2) & ((sign < 0) == (ids == ro[part]))
        e = np.where(flip[ring][:, None], e[:, [2, 3, 0, 1]], e)
    keep = (dim == 0) | (e[:, :2] != e[:, 2:]).any(axis=1)
    return row[keep], dims, e[keep], p[keep]


def edge_lists(owner_sorted, n_rows, values):
    """Rows of ``values`` grouped by a sorted owner index -> Arrow list<double> of n_rows."""
    count = np.bincount(owner_sorted, minlength=n_rows) * values.shape[1]
    off = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(np.ascontiguousarray(values).ravel()))


def read_edges(lists, width):
    """Arrow list<double> column -> (row, array of ``width`` columns)."""
    lists = one(lists)
    off = offsets(lists)
    v = lists.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]].reshape(-1, width)
    return np.repeat(np.arange(len(off) - 1), np.diff(off) // width), v


def pack(level, ix, iy):
    return ((level + LEVEL_ZERO) << LEVEL_SHIFT) | ((ix + HALF_RANGE) << IX_SHIFT) | (iy + HALF_RANGE)


def unpack(tile):
    """tile -> (size, lattice x, lattice y) of its lower-left corner before the offset."""
    tile = np.asarray(tile, dtype=np.int64)
    size = np.exp2(((tile >> LEVEL_SHIFT) - LEVEL_ZERO).astype(float))
    ix = ((tile >> IX_SHIFT) & ((1 << 28) - 1)) - HALF_RANGE
    iy = (tile & ((1 << 28) - 1)) - HALF_RANGE
    return size, ix * size, iy * size


def polygons_to_arrow(polys, srid: int, dim: int = 2):
    """List of part lists (each part a list of (n, 2) rings) -> geometry array."""
    n_part = [len(p) for p in polys]
    parts = [part for p in polys for part in p]
    rings = [r for part in parts for r in part]
    xy = np.concatenate(rings) if rings else np.zeros((0, 2))

    def lists(counts, values):
        off = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(off), values)

    v = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], fields=list(VERTEX))
    a = lists([len(r) for r in rings], v)
    a = lists([len(p) for p in parts], a)
    a = lists(n_part, a)
    n = len(polys)
    return pa.StructArray.from_arrays(
        [pa.array(np.full(n, srid, np.int32)), pa.array(np.full(n, dim, np.int8)),
         pa.array(np.array(n_part) > 1), a],
        fields=list(ARROW_GEOM),
    )


def lines_to_arrow(lines, srid: int, dim: int = 1):
    """List of (n, 2) vertex arrays -> geometry array of single lines or points."""
    return polygons_to_arrow([[[xy]] for xy in lines], srid, dim)
