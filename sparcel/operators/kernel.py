"""Vectorised numpy helpers that run inside Arrow batches.

Everything here works on *flat edge arrays*: ``e`` is ``(n, 4)`` with rows ``x0 y0 x1 y1`` and
``g`` gives the group (one tile, or one pair of pieces) each edge belongs to, so a whole Arrow
batch is processed by one set of numpy calls. Spark partitions, shuffles, joins and sums; these
functions only know one batch.

Conventions
-----------
* Vertices are snapped to a grid of 2**-20 m. Tile borders lie at ``k * size + OFFSET``, half a
  grid step off that grid, so no input edge or vertex can lie on a border: measures of tiles
  just add up.
* A region inside a tile is its boundary edges directed with the interior on the left, plus
  "seams": horizontal edges on the tile's top border. Side and bottom borders are not stored;
  they are implied because coverage is counted along an upward ray, and area is taken relative
  to the tile's bottom.
"""

from __future__ import annotations

import numpy as np

GRID = float(2**20)
# 2/7 m rounded to half a grid step: off the grid, and far from coordinates data likes to use
OFFSET = 299593 * 2.0**-20 + 2.0**-21
TOL = 2.0**-19
PAIR_CHUNK = 4_000_000


def snap(v):
    return np.round(np.asarray(v, dtype=float) * GRID) / GRID


def on_lattice(v):
    """True for coordinates on a tile border (an odd multiple of half a grid step)."""
    return np.mod(np.asarray(v) * GRID, 1.0) == 0.5


def is_seam(e):
    return (e[:, 1] == e[:, 3]) & on_lattice(e[:, 1])


def ranges(counts):
    """0..c-1 for every c in ``counts``, concatenated."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


class Buckets:
    """Per-group partition of the x axis, to find candidates without comparing all pairs."""

    def __init__(self, g, n_groups, lo, hi):
        count = np.bincount(g, minlength=n_groups)
        self.lo = np.full(n_groups, np.inf)
        top = np.full(n_groups, -np.inf)
        np.minimum.at(self.lo, g, lo)
        np.maximum.at(top, g, hi)
        span = np.where(count > 0, top - self.lo, 0.0)
        mean = np.bincount(g, hi - lo, minlength=n_groups) / np.maximum(count, 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            n = np.where(mean > 0, 2 * span / mean, 1.0)
        self.n = np.clip(np.nan_to_num(n, posinf=1.0), 1, np.maximum(count, 1)).astype(np.int64)
        self.scale = np.where(span > 0, self.n / np.where(span > 0, span, 1.0), 0.0)
        self.lo[count == 0] = 0.0
        self.start = np.cumsum(self.n) - self.n
        self.first, self.last = self.of(g, lo), self.of(g, hi)
        reps = self.last - self.first + 1
        item = np.repeat(np.arange(len(g)), reps)
        bucket = np.repeat(self.first, reps) + ranges(reps)
        order = np.argsort(bucket, kind="stable")
        self.item, self.bucket = item[order], bucket[order]

    def of(self, g, x):
        b = np.floor((x - self.lo[g]) * self.scale[g]).astype(np.int64)
        return self.start[g] + np.clip(b, 0, self.n[g] - 1)

    def _expand(self, begin, count):
        """Chunks of (row, position) for position in begin[row] .. begin[row]+count[row]."""
        total = np.cumsum(count)
        at = 0
        while at < len(count):
            base = total[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(total, base + PAIR_CHUNK, "right")))
            c = count[at:stop]
            yield np.repeat(np.arange(at, stop), c), np.repeat(begin[at:stop], c) + ranges(c)
            at = stop

    def self_pairs(self):
        """Candidate pairs (i, j) of the items, each once."""
        pos = np.arange(len(self.item))
        end = np.searchsorted(self.bucket, self.bucket, "right")
        for row, other in self._expand(pos + 1, end - pos - 1):
            i, j = self.item[row], self.item[other]
            keep = np.maximum(self.first[i], self.first[j]) == self.bucket[row]
            yield i[keep], j[keep]

    def query(self, g, x):
        """Candidate (query, item) pairs whose interval may contain x."""
        b = self.of(g, x)
        begin = np.searchsorted(self.bucket, b, "left")
        end = np.searchsorted(self.bucket, b, "right")
        for q, pos in self._expand(begin, end - begin):
            yield q, self.item[pos]


def _length(e):
    return np.hypot(e[:, 2] - e[:, 0], e[:, 3] - e[:, 1])


def _meet(a, b):
    """Nodes where edges ``a[k]`` and ``b[k]`` touch or cross.

    Returns five parallel lists' worth of arrays: pair index, 0/1 = node belongs to a/b, x, y;
    and the mask of pairs that have any point in common.
    """
    da, db = a[:, 2:] - a[:, :2], b[:, 2:] - b[:, :2]
    la, lb = np.maximum(_length(a), 1e-300), np.maximum(_length(b), 1e-300)
    common = np.zeros(len(a), dtype=bool)
    # a seam is only met by end points exactly on it
    tol = np.where(is_seam(a) | is_seam(b), 0.0, TOL)
    where, side, px, py = [], [], [], []
    dist = []
    for edge, d, ln, other, k in ((a, da, la, b, 0), (a, da, la, b, 2), (b, db, lb, a, 0), (b, db, lb, a, 2)):
        rx, ry = other[:, k] - edge[:, 0], other[:, k + 1] - edge[:, 1]
        off = (d[:, 0] * ry - d[:, 1] * rx) / ln
        along = (d[:, 0] * rx + d[:, 1] * ry) / ln
        off = np.where(ln > 1e-200, off, np.hypot(rx, ry))
        touch = (np.abs(off) <= tol) & (along >= -tol) & (along <= ln + tol)
        inner = np.flatnonzero(touch & (along > tol) & (along < ln - tol))
        common |= touch
        dist.append(off)
        where.append(inner)
        side.append(np.full(len(inner), 0 if edge is a else 1))
        px.append(other[inner, k])
        py.append(other[inner, k + 1])
    cross = np.flatnonzero(~common & (dist[0] * dist[1] < 0) & (dist[2] * dist[3] < 0))
    t = dist[2][cross] / (dist[2][cross] - dist[3][cross])
    cx = snap(a[cross, 0] + t * da[cross, 0])
    cy = snap(a[cross, 1] + t * da[cross, 1])
    common[cross] = True
    for s in (0, 1):
        where.append(cross)
        side.append(np.full(len(cross), s))
        px.append(cx)
        py.append(cy)
    return np.concatenate(where), np.concatenate(side), np.concatenate(px), np.concatenate(py), common


def _box_overlap(a, b):
    lo_a, hi_a = np.minimum(a[:, 1], a[:, 3]), np.maximum(a[:, 1], a[:, 3])
    lo_b, hi_b = np.minimum(b[:, 1], b[:, 3]), np.maximum(b[:, 1], b[:, 3])
    return (
        (lo_a <= hi_b + TOL) & (lo_b <= hi_a + TOL)
        & (np.minimum(a[:, 0], a[:, 2]) <= np.maximum(b[:, 0], b[:, 2]) + TOL)
        & (np.minimum(b[:, 0], b[:, 2]) <= np.maximum(a[:, 0], a[:, 2]) + TOL)
    )


def _cut(e, edge, x, y):
    """Cut edges at their nodes; returns (parent, sub-edges) without zero-length pieces."""
    idx = np.arange(len(e))
    who = np.concatenate([idx, edge, idx])
    px = np.concatenate([e[:, 0], x, e[:, 2]])
    py = np.concatenate([e[:, 1], y, e[:, 3]])
    t = (px - e[who, 0]) * (e[who, 2] - e[who, 0]) + (py - e[who, 1]) * (e[who, 3] - e[who, 1])
    rank = np.concatenate([np.zeros(len(e)), np.ones(len(edge)), np.full(len(e), 2)])
    order = np.lexsort((t, rank, who))
    who, px, py = who[order], px[order], py[order]
    ok = (who[1:] == who[:-1]) & ((px[1:] != px[:-1]) | (py[1:] != py[:-1]))
    k = np.flatnonzero(ok)
    return who[k], np.column_stack([px[k], py[k], px[k + 1], py[k + 1]])


def node(g, n_groups, e, lab=None):
    """Cut all edges of a group where they meet.

    With ``lab``, also returns the (group, label, label) triples of labels that touch.
    """
    lo, hi = np.minimum(e[:, 0], e[:, 2]), np.maximum(e[:, 0], e[:, 2])
    edge, x, y, touch = [], [], [], []
    if len(e):
        for i, j in Buckets(g, n_groups, lo - TOL, hi + TOL).self_pairs():
            near = _box_overlap(e[i], e[j])
            i, j = i[near], j[near]
            k, side, px, py, common = _meet(e[i], e[j])
            edge.append(np.where(side == 0, i[k], j[k]))
            x.append(px)
            y.append(py)
            if lab is not None:
                m = common & (lab[i] != lab[j])
                if m.any():
                    la, lb = np.minimum(lab[i[m]], lab[j[m]]), np.maximum(lab[i[m]], lab[j[m]])
                    touch.append(np.unique(np.column_stack([g[i[m]], la, lb]), axis=0))
    cat = lambda v, t: np.concatenate(v) if v else np.zeros(0, dtype=t)
    parent, sub = _cut(e, cat(edge, np.int64), cat(x, float), cat(y, float))
    triples = np.unique(np.concatenate(touch), axis=0) if touch else np.zeros((0, 3), dtype=np.int64)
    return parent, sub, triples


def _canonical(e):
    """Order end points; ``w`` = coverage(below or left) - coverage(above or right)."""
    flip = (e[:, 0] > e[:, 2]) | ((e[:, 0] == e[:, 2]) & (e[:, 1] > e[:, 3]))
    c = np.where(flip[:, None], e[:, [2, 3, 0, 1]], e)
    vertical = c[:, 0] == c[:, 2]
    return c, vertical, np.where(flip ^ vertical, 1, -1)


def stab(g, n_groups, e, weight, qg, qx, qy, skip=None):
    """Sum of ``weight`` rows over the non-vertical edges straight above each query point."""
    out = np.zeros((len(qg), weight.shape[1]))
    flat = np.flatnonzero(e[:, 0] != e[:, 2])
    if not len(flat) or not len(qg):
        return out
    f = e[flat]
    for q, k in Buckets(g[flat], n_groups, f[:, 0], f[:, 2]).query(qg, qx):
        s = f[k]
        hit = (s[:, 0] <= qx[q]) & (qx[q] < s[:, 2])
        q, k, s = q[hit], k[hit], s[hit]
        t = (qx[q] - s[:, 0]) / (s[:, 2] - s[:, 0])
        up = s[:, 1] + t * (s[:, 3] - s[:, 1]) > qy[q]
        if skip is not None:
            up &= flat[k] != skip[q]
        q, k = q[up], flat[k[up]]
        for c in range(weight.shape[1]):
            out[:, c] += np.bincount(q, weight[k, c], minlength=len(qg))
    return out


class Arrangement:
    """Noded edges of many groups with the coverage of every label on both of their sides."""

    def __init__(self, g, n_groups, e, lab, n_labels, want_touch=False):
        parent, sub, self.touch = node(g, n_groups, e, lab if want_touch else None)
        c, vertical, w = _canonical(sub)
        sg, sl = g[parent], lab[parent]
        order = np.lexsort((c[:, 3], c[:, 2], c[:, 1], c[:, 0], sg))
        c, w, sg, sl, vertical = c[order], w[order], sg[order], sl[order], vertical[order]
        new = np.ones(len(c), dtype=bool)
        new[1:] = (sg[1:] != sg[:-1]) | (c[1:] != c[:-1]).any(axis=1)
        at = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        weight = np.zeros((len(first), n_labels))
        np.add.at(weight, (at, sl), w)
        keep = (weight != 0).any(axis=1)
        first, weight = first[keep], weight[keep]
        self.g, self.e, self.vertical, self.n_groups = sg[first], c[first], vertical[first], n_groups
        mx, my = (self.e[:, 0] + self.e[:, 2]) / 2, (self.e[:, 1] + self.e[:, 3]) / 2
        self.right = stab(self.g, n_groups, self.e, weight, self.g, mx, my, np.arange(len(mx)))
        self.left = self.right + weight

    def boundary(self, inside):
        """Directed boundary (group, edges) of the area where ``inside(coverage)`` holds."""
        a, b = inside(self.left), inside(self.right)
        sel = np.flatnonzero(a != b)
        e = self.e[sel]
        forward = np.where(self.vertical[sel], a[sel], b[sel])
        return self.g[sel], np.where(forward[:, None], e, e[:, [2, 3, 0, 1]])


def area(g, n_groups, e):
    """Area per group; ``e`` relative to the tile origin (bottom border at OFFSET)."""
    return np.bincount(g, -(e[:, 2] - e[:, 0]) * ((e[:, 1] + e[:, 3]) / 2 - OFFSET), minlength=n_groups)


def perimeter(g, n_groups, e):
    return np.bincount(g, np.where(is_seam(e), 0.0, _length(e)), minlength=n_groups)


# ---------------------------------------------------------------------------- tile splitting


def _cut_axis(e, t0, t1, axis, size):
    """Cut edges at the tile borders of one axis; returns (parent, cell, edges, t0, t1)."""
    a, b = e[:, axis], e[:, axis + 2]
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    c0 = np.floor((lo - OFFSET) / size).astype(np.int64)
    c1 = np.where(hi > lo, np.ceil((hi - OFFSET) / size).astype(np.int64) - 1, c0)
    reps = c1 - c0 + 1
    if (reps == 1).all():
        return np.arange(len(e)), c0, e, t0, t1
    p = np.repeat(np.arange(len(e)), reps)
    k = ranges(reps)
    cell = np.repeat(c0, reps) + k
    first, last = k == 0, k == reps[p] - 1
    o = 1 - axis
    up = (b >= a)[p]
    # parameters and points from the low end to the high end of each edge
    span = np.where(hi > lo, hi - lo, 1.0)[p]
    low = np.where(up[:, None], e[p][:, :2], e[p][:, 2:])
    high = np.where(up[:, None], e[p][:, 2:], e[p][:, :2])
    out = np.empty((len(p), 4))
    ts = []
    for border, end, flag, col in ((cell * size + OFFSET, low, first, 0), ((cell + 1) * size + OFFSET, high, last, 2)):
        t = (border - lo[p]) / span
        v = snap(low[:, o] + t * (high[:, o] - low[:, o]))
        v = np.clip(v, np.minimum(low[:, o], high[:, o]), np.maximum(low[:, o], high[:, o]))
        out[:, col + axis] = np.where(flag, end[:, axis], border)
        out[:, col + o] = np.where(flag, end[:, o], v)
        ts.append(np.where(flag, 0.0 if col == 0 else 1.0, t))
    out = np.where(up[:, None], out, out[:, [2, 3, 0, 1]])
    ta, tb = np.where(up, ts[0], 1 - ts[1]), np.where(up, ts[1], 1 - ts[0])
    d = (t1 - t0)[p]
    return p, cell, out, np.where(ta == 0, t0[p], t0[p] + ta * d), np.where(tb == 1, t1[p], t0[p] + tb * d)


def cut_to_tiles(e, size):
    """Cut edges at all tile borders: (parent, column, row, edges, t0, t1)."""
    t0, t1 = np.zeros(len(e)), np.ones(len(e))
    p, col, e, t0, t1 = _cut_axis(e, t0, t1, 0, size)
    q, row, e, t0, t1 = _cut_axis(e, t0, t1, 1, size)
    return p[q], col[q], row, e, t0, t1


def _net(key, xa, xb, w):
    """Net signed cover of intervals per key: (key, xa, xb, value) with value != 0."""
    k = np.concatenate([key, key])
    x = np.concatenate([xa, xb])
    v = np.concatenate([w, -w])
    order = np.lexsort((x, k))
    k, x, v = k[order], x[order], v[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (x[1:] != x[:-1])
    first = np.flatnonzero(new)
    if not len(first):
        return key, xa, xb, w
    change = np.add.reduceat(v, first)
    total = np.cumsum(change)
    # where one interval ends and the next begins nothing changes
    k, x, total = k[first][change != 0], x[first][change != 0], total[change != 0]
    ok = np.flatnonzero((k[1:] == k[:-1]) & (total[:-1] != 0))
    return k[ok], x[ok], x[ok + 1], total[ok]


def split_region(f, e, size, floor=None):
    """Split polygon edges (feature index ``f``) into tiles: (feature, column, row, edges).

    Pieces of tiles are open at the bottom: for them ``floor`` gives the lowest row per feature.
    """
    p, col, row, s, _, _ = cut_to_tiles(e, size)
    f = f[p]
    seam = is_seam(s)
    real = ~seam
    out = [(f[real], col[real], row[real], s[real])]
    # seams: what the parts above a border cover, carried down row by row
    flat = s[:, 0] != s[:, 2]
    fc, fr, ff, fe = col[flat], row[flat], f[flat], s[flat]
    if len(fe):
        key = np.unique(np.column_stack([ff, fc]), axis=0, return_inverse=True)
        cells, group = key[0], key[1].ravel()
        top = np.full(len(cells), np.iinfo(np.int64).min)
        np.maximum.at(top, group, fr)
        depth = top[group] - fr
        xa, xb = np.minimum(fe[:, 0], fe[:, 2]), np.maximum(fe[:, 0], fe[:, 2])
        w = np.where(fe[:, 2] < fe[:, 0], 1, -1)
        order = np.argsort(depth, kind="stable")
        depth, group, xa, xb, w = depth[order], group[order], xa[order], xb[order], w[order]
        carry = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0), np.zeros(0, np.int64))
        last = int(depth[-1]) if floor is None else int((top - floor[cells[:, 0]]).max())
        for d in range(last + 1):
            a, b = np.searchsorted(depth, [d, d + 1])
            carry = _net(
                np.concatenate([carry[0], group[a:b]]), np.concatenate([carry[1], xa[a:b]]),
                np.concatenate([carry[2], xb[a:b]]), np.concatenate([carry[3], w[a:b]]),
            )
            k, ca, cb, v = carry
            if not len(k):
                continue
            r = top[k] - d
            if floor is not None:
                m = r > floor[cells[k, 0]]
                k, ca, cb, v, r = k[m], ca[m], cb[m], v[m], r[m]
            y = r * size + OFFSET
            n = np.abs(v).astype(np.int64)
            left = v > 0
            line = np.column_stack([np.where(left, cb, ca), y, np.where(left, ca, cb), y])
            out.append(tuple(np.repeat(z, n, axis=0) for z in (cells[k, 0], cells[k, 1], r - 1, line)))
    return tuple(np.concatenate([o[i] for o in out]) for i in range(4))


def strips(e, r, style="round", quarter=8):
    """Edges of the convex ring around every segment: (segment index, edges)."""
    n = len(e)
    d = e[:, 2:] - e[:, :2]
    ln = _length(e)
    u = np.where(ln[:, None] > 0, d / np.where(ln > 0, ln, 1.0)[:, None], [1.0, 0.0])
    side = np.column_stack([-u[:, 1], u[:, 0]])
    if style == "square":
        corner = [(0, -1, -1), (2, 1, -1), (2, 1, 1), (0, -1, 1)]
        pts = [e[:, k:k + 2] + r[:, None] * (a * u + b * side) for k, a, b in corner]
    else:
        turn = np.pi * np.arange(2 * quarter + 1) / (2 * quarter)
        pts = []
        for k, sign in ((2, 1.0), (0, -1.0)):
            for t in turn:
                # half a turn, from the right side of the end point to its left side
                pts.append(e[:, k:k + 2] + r[:, None] * sign * (np.sin(t) * u - np.cos(t) * side))
    p = snap(np.stack(pts, axis=1))
    out = np.concatenate([p, np.roll(p, -1, axis=1)], axis=2)
    m = (out[:, :, :2] != out[:, :, 2:]).any(axis=2)
    return np.repeat(np.arange(n), m.sum(axis=1)), out[m]


# ---------------------------------------------------------------------------- point and line in region


def locate(g, n_groups, region, qg, qx, qy):
    """Closed-set test of points against the region of their group."""
    c, vertical, w = _canonical(region)
    inside = stab(g, n_groups, c, w[:, None].astype(float), qg, qx, qy)[:, 0] > 0
    if len(c) and len(qg):
        real = np.flatnonzero(~is_seam(region))
        r = c[real]
        for q, k in Buckets(g[real], n_groups, r[:, 0] - TOL, r[:, 2] + TOL).query(qg, qx) if len(real) else ():
            s = r[k]
            d = s[:, 2:] - s[:, :2]
            ln = np.maximum(_length(s), 1e-300)
            rx, ry = qx[q] - s[:, 0], qy[q] - s[:, 1]
            on = np.abs(d[:, 0] * ry - d[:, 1] * rx) <= TOL * ln
            along = d[:, 0] * rx + d[:, 1] * ry
            on &= (along >= -TOL * ln) & (along <= (ln + TOL) * ln)
            inside[q[on]] = True
    return inside


def line_in_region(g, n_groups, region, sg, seg):
    """Parts of segments inside (closed) regions of the same group: (segment, edges, t0, t1)."""
    both = np.concatenate([region, seg])
    bg = np.concatenate([g, sg])
    n = len(region)
    edge, x, y = [], [], []
    lo, hi = np.minimum(both[:, 0], both[:, 2]), np.maximum(both[:, 0], both[:, 2])
    if len(both):
        for i, j in Buckets(bg, n_groups, lo - TOL, hi + TOL).self_pairs():
            mixed = (i < n) != (j < n)
            i, j = i[mixed], j[mixed]
            i, j = np.where(i < n, i, j), np.where(i < n, j, i)
            near = _box_overlap(both[i], both[j])
            i, j = i[near], j[near]
            k, side, px, py, _ = _meet(both[i], both[j])
            m = side == 1
            edge.append(j[k[m]] - n)
            x.append(px[m])
            y.append(py[m])
    cat = lambda v, t: np.concatenate(v) if v else np.zeros(0, dtype=t)
    parent, sub = _cut(seg, cat(edge, np.int64), cat(x, float), cat(y, float))
    mx, my = (sub[:, 0] + sub[:, 2]) / 2, (sub[:, 1] + sub[:, 3]) / 2
    ok = locate(g, n_groups, region, sg[parent], mx, my)
    parent, sub = parent[ok], sub[ok]
    ln = np.maximum(_length(seg), 1e-300)[parent]
    d = (seg[parent, 2:] - seg[parent, :2]) / ln[:, None]
    t = [((sub[:, k] - seg[parent, 0]) * d[:, 0] + (sub[:, k + 1] - seg[parent, 1]) * d[:, 1]) / ln for k in (0, 2)]
    same = [(sub[:, 0:2] == seg[parent, 0:2]).all(axis=1), (sub[:, 2:4] == seg[parent, 2:4]).all(axis=1)]
    return parent, sub, np.where(same[0], 0.0, t[0]), np.where(same[1], 1.0, t[1])


# ---------------------------------------------------------------------------- rings


def close_tiles(g, e, x0, y0, x1):
    """Add the missing side and bottom borders of tile regions (tile box per edge's group).

    Walks each tile's border down the left side, along the bottom and up the right side; the
    running sum of edge ends minus edge starts is the border piece that has to be there.
    """
    pts = np.concatenate([e[:, :2], e[:, 2:]])
    pg = np.concatenate([g, g])
    flow = np.concatenate([np.full(len(e), -1), np.full(len(e), 1)])
    bx0, by0, bx1 = x0[pg], y0[pg], x1[pg]
    far = 1e9
    left, bottom, right = pts[:, 0] == bx0, pts[:, 1] == by0, pts[:, 0] == bx1
    pos = np.where(left, -(pts[:, 1] - by0), np.where(bottom, pts[:, 0] - bx0, far + pts[:, 1] - by0))
    m = left | bottom | right
    pg, pts, flow, pos = pg[m], pts[m], flow[m], pos[m]
    # corners take part so that a piece may turn around them
    groups = np.unique(g)
    corner = np.concatenate([np.column_stack([x0[groups], y0[groups]]), np.column_stack([x1[groups], y0[groups]])])
    cpos = np.concatenate([np.zeros(len(groups)), x1[groups] - x0[groups]])
    right_corner = np.full(len(groups), far)
    pg = np.concatenate([pg, groups, groups, groups])
    pts = np.concatenate([pts, corner, corner[len(groups):]])
    flow = np.concatenate([flow, np.zeros(3 * len(groups), dtype=flow.dtype)])
    pos = np.concatenate([pos, cpos, right_corner])
    order = np.lexsort((pos, pg))
    pg, pts, flow = pg[order], pts[order], flow[order]
    run = np.cumsum(flow)
    ok = np.flatnonzero((pg[1:] == pg[:-1]) & (run[:-1] != 0) & (pts[1:] != pts[:-1]).any(axis=1))
    fwd = run[ok] > 0
    line = np.concatenate([pts[ok], pts[ok + 1]], axis=1)
    line = np.where(fwd[:, None], line, line[:, [2, 3, 0, 1]])
    return np.concatenate([g, pg[ok]]), np.concatenate([e, line])


def _ring_area(r):
    x, y = r[:, 0] - r[0, 0], r[:, 1] - r[0, 1]
    return 0.5 * float(np.dot(x[:-1], y[1:]) - np.dot(x[1:], y[:-1]))


def _holds(ring, x, y):
    """Even-odd test of one point."""
    a, b = ring[:-1], ring[1:]
    span = (a[:, 1] > y) != (b[:, 1] > y)
    a, b = a[span], b[span]
    return int(np.count_nonzero(a[:, 0] + (y - a[:, 1]) / (b[:, 1] - a[:, 1]) * (b[:, 0] - a[:, 0]) > x)) % 2 == 1


def _close_gaps(pts, vid, n):
    """Let an edge that ends a grid step or two beside the start of the next one end there.

    Nearly coincident edges may be cut a grid step apart; only vertices with more edges coming in
    than going out (or the reverse) are moved.
    """
    size = int(vid.max()) + 1
    surplus = np.bincount(vid[n:], minlength=size) - np.bincount(vid[:n], minlength=size)
    if not surplus.any():
        return vid
    where = np.zeros((size, 3))
    where[vid] = pts
    reach = 4 * TOL
    starts: dict = {}
    for k in np.flatnonzero(surplus < 0):
        grp, x, y = where[k]
        starts.setdefault((grp, int(x // reach), int(y // reach)), []).append(k)
    move = np.arange(size)
    for k in np.flatnonzero(surplus > 0):
        grp, x, y = where[k]
        cx, cy = int(x // reach), int(y // reach)
        near = [s for i in (-1, 0, 1) for j in (-1, 0, 1) for s in starts.get((grp, cx + i, cy + j), []) if surplus[s] < 0]
        if near:
            s = min(near, key=lambda s: np.hypot(*(where[s, 1:] - where[k, 1:])))
            move[k] = s
            surplus[s] += surplus[k]
    return move[vid]


def _paths(follow):
    """Edges in the order of ``follow``, an array for each cycle, by first edges, then whatever is not a cycle.

    List ranking by pointer doubling: the number of numpy passes grows with the logarithm of the longest cycle.
    """
    n = len(follow)
    into = np.bincount(follow[follow >= 0], minlength=n)
    whole = (follow >= 0) & (into == 1)
    # an edge is on a cycle if everything behind and before it is: other edges spread along their path
    odd = np.flatnonzero(~whole)
    if len(odd):
        jump, loose = np.where(follow >= 0, follow, np.arange(n)), ~whole
        for _ in range(max(1, int(n).bit_length())):
            loose = loose | loose[jump]
            jump = jump[jump]
        back = np.full(n, -1)
        back[follow[whole & (follow >= 0)]] = np.flatnonzero(whole & (follow >= 0))
        jump = np.where(back >= 0, back, np.arange(n))
        for _ in range(max(1, int(n).bit_length())):
            loose = loose | loose[jump]
            jump = jump[jump]
        whole = ~loose
    ring = np.flatnonzero(whole)
    if len(ring):
        place = np.full(n, -1)
        place[ring] = np.arange(len(ring))
        nxt = place[follow[ring]]
        head, jump = np.arange(len(ring)), nxt
        while True:
            head = np.minimum(head, head[jump])
            jump = jump[jump]
            if (head == head[nxt]).all():
                break
        # cut each cycle before its head, then count the steps to its end
        last = nxt == head
        steps, jump = np.where(last, 0, 1), np.where(last, np.arange(len(ring)), nxt)
        while (steps[jump] > 0).any():
            steps = steps + steps[jump]
            jump = jump[jump]
        order = np.lexsort((-steps, head))
        yield from np.split(ring[order], np.flatnonzero(head[order][1:] != head[order][:-1]) + 1)
    rest = np.flatnonzero(~whole)
    if len(rest):
        seen = whole.copy()
        onward = follow.tolist()
        for s in rest.tolist():
            path, k = [], s
            while k >= 0 and not seen[k]:
                seen[k] = True
                path.append(k)
                k = onward[k]
            if path:
                yield np.array(path)


def chain(g, e, drop_lattice=True):
    """Directed edges -> list of (group, [shell, hole, ...]); rings are closed (k, 2) arrays."""
    n = len(e)
    if n == 0:
        return []
    pts = np.column_stack([np.concatenate([g, g]), np.concatenate([e[:, :2], e[:, 2:]])])
    _, vid = np.unique(pts, axis=0, return_inverse=True)
    vid = vid.ravel()
    vid = _close_gaps(pts, vid, n)
    start, end = vid[:n], vid[n:]
    angle = np.arctan2(e[:, 3] - e[:, 1], e[:, 2] - e[:, 0])
    order = np.argsort(start, kind="stable")
    sorted_start = start[order]
    lo, hi = np.searchsorted(sorted_start, end, "left"), np.searchsorted(sorted_start, end, "right")
    follow = np.where(hi > lo, order[np.minimum(lo, n - 1)], -1)
    for k in np.flatnonzero(hi - lo > 1):
        out = order[lo[k]:hi[k]]
        turn = np.mod(angle[k] + np.pi - angle[out], 2 * np.pi)
        turn[turn < 1e-12] = 2 * np.pi
        follow[k] = out[np.argmin(turn)]
    multi = np.bincount(start, minlength=vid.max() + 1) > 1
    rings = []

    def close(path):
        ring = np.concatenate([e[path, :2], e[path[:1], :2]])
        if drop_lattice:
            keep = ~(on_lattice(ring[:, 0]) | on_lattice(ring[:, 1]))
            ring = ring[:-1][keep[:-1]]
            if len(ring) < 3:
                return
            ring = np.concatenate([ring, ring[:1]])
        a = _ring_area(ring)
        # thinner than the tolerance: two edges that should have been one
        if abs(a) > TOL * np.abs(np.diff(ring, axis=0)).sum():
            rings.append((int(g[path[0]]), ring, a))

    for path in _paths(follow):
        many = multi[start[path]]
        if not many.any():
            close(path)
            continue
        # a vertex passed twice closes a ring of its own
        kept, at = [], {}
        for k, v, m in zip(path.tolist(), start[path].tolist(), many.tolist(), strict=True):
            if m:
                if v in at:
                    p = at[v]
                    close(np.array(kept[p:]))
                    del kept[p:]
                    at = {u: i for u, i in at.items() if i < p}
                at[v] = len(kept)
            kept.append(k)
        if kept:
            close(np.array(kept))
    shells = [[grp, ring, a, []] for grp, ring, a in rings if a > 0]
    by_group: dict[int, list] = {}
    for s in shells:
        by_group.setdefault(s[0], []).append(s)
    for grp, ring, a in rings:
        if a >= 0:
            continue
        mx, my = (ring[0] + ring[1]) / 2
        home = [
            s for s in by_group.get(grp, [])
            if s[2] >= -a and s[1][:, 0].min() <= mx <= s[1][:, 0].max()
            and s[1][:, 1].min() <= my <= s[1][:, 1].max() and _holds(s[1], mx, my)
        ]
        if not home:
            raise ValueError("a hole lies in no shell: the boundary is not closed")
        min(home, key=lambda s: s[2])[3].append(ring)
    return [(grp, [ring, *holes]) for grp, ring, _, holes in shells]



def covering(e, lab, qx, qy, g=None, qg=None, n_groups=1):
    """(query, label) pairs where the label's polygon covers the query point; one tile, or points and edges of its groups."""
    g = np.zeros(len(e), np.int64) if g is None else g
    qg = np.zeros(len(qx), np.int64) if qg is None else qg
    c, _, w = _canonical(e)
    flat = np.flatnonzero(c[:, 0] != c[:, 2])
    found = []
    if len(flat) and len(qx):
        f = c[flat]
        n = int(lab.max()) + 1
        for q, k in Buckets(g[flat], n_groups, f[:, 0], f[:, 2]).query(qg, qx):
            s = f[k]
            hit = (s[:, 0] <= qx[q]) & (qx[q] < s[:, 2])
            q, k, s = q[hit], k[hit], s[hit]
            up = s[:, 1] + (qx[q] - s[:, 0]) / (s[:, 2] - s[:, 0]) * (s[:, 3] - s[:, 1]) > qy[q]
            key, at = np.unique(q[up] * n + lab[flat[k[up]]], return_inverse=True)
            total = np.bincount(at.ravel(), w[flat[k[up]]], minlength=len(key))
            found.append(key[total > 0])
    key = np.concatenate(found) if found else np.zeros(0, np.int64)
    n = int(lab.max()) + 1 if len(lab) else 1
    return key // n, key % n
