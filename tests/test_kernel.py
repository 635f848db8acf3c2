"""The batch helpers against brute force: unit cells, inclusion-exclusion, tile independence."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparcel.operators import kernel as K


def rect(x0, y0, x1, y1):
    return [[x0, y0, x1, y0], [x1, y0, x1, y1], [x1, y1, x0, y1], [x0, y1, x0, y0]]


def ngon(cx, cy, r, n, turn):
    a = turn + 2 * np.pi * np.arange(n) / n
    p = K.snap(np.column_stack([cx + r * np.cos(a), cy + r * np.sin(a)]))
    return np.concatenate([p, np.roll(p, -1, axis=0)], axis=1).tolist()


def tiles(f, e, size):
    ff, c, r, s = K.split_region(f, e, size)
    key, g = np.unique(np.column_stack([c, r]), axis=0, return_inverse=True)
    g = g.ravel()
    return ff, key, g, s, s - np.tile(key[g] * size, 2)


def union(polys, size):
    """(area, perimeter, boundary edges) of the union through tiles of one size."""
    e = np.array(sum(polys, []), float)
    f = np.repeat(np.arange(len(polys)), [len(p) for p in polys])
    _, key, g, _, loc = tiles(f, e, size)
    a = K.Arrangement(g, len(key), loc, np.zeros(len(g), int), 1)
    bg, be = a.boundary(lambda c: c[:, 0] > 0)
    glob = be + np.tile(key[bg] * size, 2)
    return K.area(bg, len(key), be).sum(), K.perimeter(bg, len(key), be).sum(), glob[~K.is_seam(be)]


def both(a, b, size):
    """Area of (union of a) and (union of b) overlapping."""
    polys = a + b
    e = np.array(sum(polys, []), float)
    f = np.repeat(np.arange(len(polys)), [len(p) for p in polys])
    ff, key, g, _, loc = tiles(f, e, size)
    arr = K.Arrangement(g, len(key), loc, (ff >= len(a)).astype(int), 2)
    bg, be = arr.boundary(lambda c: (c > 0).all(axis=1))
    return K.area(bg, len(key), be).sum()


boxes = st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40), st.integers(1, 15), st.integers(1, 15)), min_size=1, max_size=25)


@settings(max_examples=60, deadline=None)
@given(boxes, st.sampled_from([4.0, 16.0, 64.0]))
def test_union_of_boxes_is_count_of_cells(bs, size):
    grid = np.zeros((60, 60), bool)
    for x, y, w, h in bs:
        grid[x:x + w, y:y + h] = True
    pad = np.pad(grid, 1)
    sides = (pad[1:] != pad[:-1]).sum() + (pad[:, 1:] != pad[:, :-1]).sum()
    area, perimeter, edges = union([rect(x, y, x + w, y + h) for x, y, w, h in bs], size)
    assert area == pytest.approx(grid.sum(), abs=1e-4)
    assert perimeter == pytest.approx(sides, abs=1e-4)
    rings = K.chain(np.zeros(len(edges), int), edges)
    assert sum(K._ring_area(r) for _, part in rings for r in part) == pytest.approx(grid.sum(), abs=1e-4)


polygons = st.lists(
    st.tuples(st.floats(0, 60), st.floats(0, 60), st.floats(1, 20), st.integers(3, 24), st.floats(0, 6.3)), min_size=1, max_size=10
)


@settings(max_examples=60, deadline=None)
@given(polygons, polygons)
def test_inclusion_exclusion_and_tile_independence(a, b):
    a, b = [ngon(*p) for p in a], [ngon(*p) for p in b]
    whole = union(a + b, 256.0)
    parts = union(a, 256.0)[0] + union(b, 256.0)[0] - both(a, b, 256.0)
    assert whole[0] == pytest.approx(parts, abs=1e-2)
    for size in (8.0, 32.0):
        small = union(a + b, size)
        assert small[0] == pytest.approx(whole[0], abs=1e-2)
        assert small[1] == pytest.approx(whole[1], abs=1e-2)
    assert union(a + b + a, 32.0)[0] == pytest.approx(whole[0], abs=1e-2)


@settings(max_examples=40, deadline=None)
@given(polygons)
def test_area_by_sampling(a):
    polys = [ngon(*p) for p in a]
    rng = np.random.default_rng(5)
    x, y = rng.uniform(-20, 80, 4000), rng.uniform(-20, 80, 4000)
    hit = np.zeros(len(x), bool)
    for p in polys:
        ring = np.array(p)[:, :2]
        ring = np.concatenate([ring, ring[:1]])
        hit |= np.array([K._holds(ring, u, v) for u, v in zip(x, y)])
    area, _, _ = union(polys, 16.0)
    assert area == pytest.approx(hit.mean() * 1e4, abs=5 * 1e4 * 0.5 / np.sqrt(4000))


def test_pinched_hole_and_corner_contact():
    # a frame whose hole touches the shell in one vertex, and two boxes meeting in a corner
    frame = [rect(0, 0, 10, 4), rect(0, 6, 10, 10), rect(0, 4, 3, 6), rect(7, 4, 10, 6)]
    _, _, e = union(frame, 64.0)
    out = K.chain(np.zeros(len(e), int), e)
    assert len(out) == 1 and len(out[0][1]) == 2
    _, _, e = union([rect(0, 0, 5, 5), rect(5, 5, 9, 9)], 64.0)
    assert len(K.chain(np.zeros(len(e), int), e)) == 2


def test_closed_tiles_cover_the_region():
    polys = [ngon(30, 30, 28, 40, 0.1), rect(3, 3, 20, 50)]
    e = np.array(sum(polys, []), float)
    f = np.repeat([0, 1], [len(p) for p in polys])
    _, key, g, _, loc = tiles(f, e, 8.0)
    a = K.Arrangement(g, len(key), loc, np.zeros(len(g), int), 1)
    bg, be = a.boundary(lambda c: c[:, 0] > 0)
    glob = be + np.tile(key[bg] * 8.0, 2)
    x0, y0 = key[:, 0] * 8.0 + K.OFFSET, key[:, 1] * 8.0 + K.OFFSET
    cg, ce = K.close_tiles(bg, glob, x0, y0, x0 + 8.0)
    rings = K.chain(cg, ce, drop_lattice=False)
    assert sum(K._ring_area(r) for _, part in rings for r in part) == pytest.approx(union(polys, 64.0)[0], abs=1e-3)


def test_line_on_the_border_counts_as_inside():
    region = np.array(rect(0, 0, 10, 10), float)
    seg = np.array([[0, 2, 0, 8], [-5, 5, 15, 5], [0, 12, 10, 12], [3, 10, 20, 10]], float)
    p, sub, t0, t1 = K.line_in_region(np.zeros(4, int), 1, region, np.zeros(4, int), seg)
    got = {int(k): float(K._length(sub[p == k]).sum()) for k in range(4)}
    assert got == {0: 6.0, 1: 10.0, 2: 0.0, 3: 7.0}
    assert K.locate(np.zeros(4, int), 1, region, np.zeros(3, int), np.array([5.0, 10.0, 10.1]), np.array([5.0, 10.0, 5.0])).tolist() == [True, True, False]


@settings(max_examples=40, deadline=None)
@given(st.floats(-50, 50), st.floats(-50, 50), st.floats(-50, 50), st.floats(-50, 50), st.floats(0.5, 12))
def test_round_strip_has_the_closed_form_area(ax, ay, bx, by, r):
    e = K.snap(np.array([[ax, ay, bx, by]]))
    length = float(K._length(e)[0])
    _, ring = K.strips(e, np.array([r]))
    area, perimeter, _ = union([ring.tolist()], 16.0)
    assert area == pytest.approx(2 * r * length + 16 * r * r * np.sin(np.pi / 16), rel=1e-5, abs=1e-3)
    assert perimeter == pytest.approx(2 * length + 64 * r * np.sin(np.pi / 32), rel=1e-5, abs=1e-3)


@pytest.mark.parametrize("seed", range(6))
def test_road_network_with_nearly_coincident_strips(seed):
    """Straight roads cut in pieces with the same width: sides that only just miss each other."""
    rng = np.random.default_rng(seed)
    base = np.array([700000.0, 6600000.0]) if seed % 2 else np.zeros(2)
    segs, rad = [], []
    for _ in range(40):
        a = rng.uniform(0, 400, 2)
        b, n = a + rng.uniform(-200, 200, 2), rng.integers(1, 9)
        p = K.snap(a + np.outer(np.linspace(0, 1, n + 1), b - a) + base)
        r = rng.integers(3, 10) / (1.0 if seed % 3 else 3.0)
        segs += [[*p[i], *p[i + 1]] for i in range(n)]
        c = p[rng.integers(0, n + 1)]
        segs.append([*c, *K.snap(c + rng.uniform(-80, 80, 2))])
        rad += [r] * (n + 1)
    k, ring = K.strips(np.array(segs), np.array(rad))
    seen = []
    for size in (1024.0, 64.0, 16.0):
        _, key, g, _, loc = tiles(k, ring, size)
        arr = K.Arrangement(g, len(key), loc, np.zeros(len(g), int), 1)
        assert arr.left.min() >= 0 and arr.right.min() >= 0
        bg, be = arr.boundary(lambda c: c[:, 0] > 0)
        glob = be + np.tile(key[bg] * size, 2)
        real = ~K.is_seam(be)
        polys = K.chain(np.zeros(real.sum(), int), glob[real])
        total = K.area(bg, len(key), be).sum()
        x0, y0 = key[:, 0] * size + K.OFFSET, key[:, 1] * size + K.OFFSET
        cg, ce = K.close_tiles(bg, glob, x0, y0, x0 + size)
        closed = sum(K._ring_area(r) for _, part in K.chain(cg, ce, drop_lattice=False) for r in part)
        assert closed == pytest.approx(total, rel=1e-6)
        assert sum(K._ring_area(r) for _, part in polys for r in part) == pytest.approx(total, rel=1e-6)
        seen.append((len(polys), total, K.perimeter(bg, len(key), be).sum()))
    assert seen[0] == pytest.approx(seen[1], rel=1e-6) and seen[0] == pytest.approx(seen[2], rel=1e-6)
