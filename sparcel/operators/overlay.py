"""Spatial join and overlay of two layers.

Both layers are cut to the same tiles; candidates come from an equi-join on the tile with a
bounding-box residual, so Spark shuffles by tile and adaptive execution may split a hot one. The
exact geometry of each candidate is then worked out row by row in Arrow batches, and what a tile
border cut apart is put together again per pair of features.

Two upright rectangles need none of that: their corners tell whether they meet and what they share (see ``boxes``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as G
from ..session import checkpoint, ship
from . import batches as B
from . import kernel as K
from .boxes import BOX, CORNERS, BoxPlan, box_corners, box_pairs
from .boxes import plan_boxes as _boxes
from .checks import layer_facts, one_srid, one_type
from .tiling import TilePlan, covers_below, plan_tiles, split_to_tiles
from .union import chain_rows, slices, to_global, to_local

DIMENSION = {"Point": 0, "LineString": 1, "Polygon": 2}
ROW = "_row"
_PIECE = ("dim", "edges", "bx0", "by0", "bx1", "by1")


def identified(df: DataFrame, key: Sequence[str] | None, check: bool = True) -> tuple[DataFrame, list[str]]:
    """The layer with columns that tell its rows apart, and their names.

    A named key serves if no value of it repeats (one pass over the key alone; ``check=False`` takes
    the caller's word). Otherwise rows get ids of their own, on a checkpoint, so that a task that
    runs again gives the same ids.
    """
    if key and not (check and key_repeats(df, key)):
        return df, list(key)
    return checkpoint(df.withColumn(ROW, F.monotonically_increasing_id())), [ROW]


def key_repeats(df: DataFrame, key: Sequence[str]) -> bool:
    return not df.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1").limit(1).isEmpty()


def _prefixed(df: DataFrame, side: str, fields: Sequence[str], key: Sequence[str]) -> DataFrame:
    cols = [F.col(f).alias(f"{side}_{f}") for f in dict.fromkeys([*fields, *key])]
    return df.select(*cols, F.col("geom"))


def candidates(a: DataFrame, b: DataFrame, plan: TilePlan, keep_a, keep_b) -> DataFrame:
    """Pairs of pieces in the same tile with overlapping boxes (columns of b suffixed ``_b``).

    Where features are wide, their inside lies in larger cells: pieces then also meet the cells above
    them, in their own tile. Of two tiles that overlap one holds the other, so a pair meets once at every place.
    """
    if not plan.covers:
        return pair_pieces(split_to_tiles(a, plan, keep_a), split_to_tiles(b, plan, keep_b), keep_a, keep_b)
    pieces_a = checkpoint(split_to_tiles(a, plan, keep_a, cover=True))
    pieces_b = checkpoint(split_to_tiles(b, plan, keep_b, cover=True))
    return (
        pair_pieces(pieces_a, pieces_b, keep_a, keep_b)
        .unionByName(pair_pieces(pieces_a, covers_below(pieces_a, pieces_b, keep_b), keep_a, keep_b))
        .unionByName(pair_pieces(covers_below(pieces_b, pieces_a, keep_a), pieces_b, keep_a, keep_b))
    )


def pair_pieces(pieces_a: DataFrame, pieces_b: DataFrame, keep_a, keep_b) -> DataFrame:
    """``candidates`` for layers that are cut already."""
    pb = pieces_b.select(*keep_b, "tile", *[F.col(c).alias(f"{c}_b") for c in _PIECE])
    # two grid steps: cut points are rounded to the grid
    slack = 2.0**-19
    near = (
        (F.col("bx0") <= F.col("bx1_b") + slack) & (F.col("bx0_b") <= F.col("bx1") + slack)
        & (F.col("by0") <= F.col("by1_b") + slack) & (F.col("by0_b") <= F.col("by1") + slack)
    )
    # The size of cut pieces cannot be known beforehand, so no side is broadcast on an estimate (see
    # ``tune``): both are shuffled by tile, a side measured as small is then broadcast, and a hot
    # partition is split, by adaptive execution.
    return pieces_a.join(pb, "tile").where(near).select(*keep_a, *keep_b, "tile", "dim", "edges", F.col("dim_b"), F.col("edges_b"))


def _other_pairs(a: DataFrame, b: DataFrame, plan: TilePlan, keep_a, keep_b, boxes: bool) -> DataFrame:
    """``candidates``, without those of two upright rectangles if ``boxes`` says that ``box_pairs`` has them."""
    if not boxes:
        return candidates(a, b, plan, keep_a, keep_b)
    a, b = (df.withColumn(f"{side}{BOX}", box_corners().isNotNull()) for df, side in ((a, "_a"), (b, "_b")))
    c = candidates(a, b, plan, [*keep_a, f"_a{BOX}"], [*keep_b, f"_b{BOX}"])
    return c.where(~(F.col(f"_a{BOX}") & F.col(f"_b{BOX}"))).drop(f"_a{BOX}", f"_b{BOX}")


def region_pieces(reg: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Rows of a region in the form of cut features, with the tile as bounding box."""
    box = [F.lit(v).alias(c) for c, v in (("bx0", -1e300), ("by0", -1e300), ("bx1", 1e300), ("by1", 1e300))]
    return reg.select(*keep, "tile", F.lit(2).cast("tinyint").alias("dim"), "edges", *box)


def lines_in_region(
    reg: DataFrame, lines: DataFrame, plan: TilePlan, fields_reg: Sequence[str], key: Sequence[str], fields: Sequence[str] = (),
    srid: int = G.TARGET_SRID,
) -> DataFrame:
    """Pieces of lines inside each group of a region, whole across tile borders.

    ``key`` tells lines apart if it does not repeat; see ``identified``.
    """
    lines, key = identified(lines, key)
    keep_b = [f"b_{c}" for c in dict.fromkeys([*fields, *key])]
    ids = [*fields_reg, *[f"b_{c}" for c in key]]
    c = pair_pieces(region_pieces(reg, fields_reg), split_to_tiles(_prefixed(lines, "b", fields, key), plan, keep_b), fields_reg, keep_b)
    keep = [*fields_reg, *keep_b]
    out = _join_runs(_line_runs(c, keep), keep, ids, srid)
    return out.select(*fields_reg, *[F.col(f"b_{f}").alias(f) for f in fields], "part", "geom")


def _sides(s: pa.RecordBatch):
    """Local edges of both sides of candidate rows with uniform dimensions."""
    da, db = int(s.column("dim")[0].as_py()), int(s.column("dim_b")[0].as_py())
    _, ox, oy = B.unpack(s.column("tile").to_numpy())
    ra, ea = B.read_edges(s.column("edges"), 4 if da == 2 else 6)
    rb, eb = B.read_edges(s.column("edges_b"), 4 if db == 2 else 6)
    pb = eb[:, 4:6] if db != 2 else None
    return da, db, ra, to_local(ea, ra, ox, oy), rb, to_local(eb, rb, ox, oy), pb, ox, oy


def _uniform(batches):
    """Slices of bounded size in which dim and dim_b are constant."""
    for b in batches:
        d = B.one(b.column("dim")).to_numpy() * 4 + B.one(b.column("dim_b")).to_numpy()
        for v in np.unique(d):
            part = b if (d == v).all() else b.filter(pa.array(d == v))
            yield from slices(part, "edges", "edges_b")


def _first_edge(row, n):
    return np.searchsorted(row, np.arange(n))


def _intersects(s) -> np.ndarray:
    da, db, ra, ea, rb, eb, _, _, _ = _sides(s)
    n = s.num_rows
    g = np.concatenate([ra, rb])
    lab = np.concatenate([np.zeros(len(ra), np.int64), np.ones(len(rb), np.int64)])
    _, _, touch = K.node(g, n, np.concatenate([ea, eb]), lab)
    hit = np.zeros(n, dtype=bool)
    hit[touch[:, 0]] = True
    for dim, row, e, other_row, other in ((da, ra, ea, rb, eb), (db, rb, eb, ra, ea)):
        if dim == 2:
            f = _first_edge(other_row, n)
            hit |= K.locate(row, n, e, np.arange(n), other[f, 0], other[f, 1])
    return hit


def spatial_join(
    a: DataFrame, b: DataFrame, key_a: Sequence[str], key_b: Sequence[str], plan: TilePlan | None = None
) -> DataFrame:
    """Keys (``a_*``, ``b_*``) of all pairs that intersect; touching counts.

    The keys must identify the rows of their layer.
    """
    keep_a, keep_b = [f"a_{k}" for k in key_a], [f"b_{k}" for k in key_b]
    keep = keep_a + keep_b
    boxes, others = _boxes(a, b)
    sides = _prefixed(a, "a", [], key_a), _prefixed(b, "b", [], key_b)
    ship(a.sparkSession)
    met = None
    if boxes:
        met = box_pairs(*sides, boxes, keep_a, keep_b, corners=False)
        # each pair of rows is there once; only keys that repeat make pairs of keys repeat
        met = met.distinct() if key_repeats(a, key_a) or key_repeats(b, key_b) else met
        if not others:
            return met
    c = _other_pairs(*sides, plan or plan_tiles([a, b]), keep_a, keep_b, bool(boxes))
    schema = T.StructType([c.schema[k] for k in keep])

    def run(batches):
        for s in _uniform(batches):
            yield s.filter(pa.array(_intersects(s))).select(keep)

    # a pair may meet in several tiles
    out = c.mapInArrow(run, schema).distinct()
    return out if met is None else met.unionByName(out)


# ---------------------------------------------------------------------------- overlay


def _polygon_pairs(c: DataFrame, keep) -> DataFrame:
    """Boundary of a ∩ b per tile and pair, with its measures."""
    schema = T.StructType([c.schema[k] for k in keep] + [
        T.StructField("edges", T.ArrayType(T.DoubleType())), T.StructField("area", T.DoubleType()), T.StructField("perimeter", T.DoubleType()),
    ])

    def run(batches):
        for s in _uniform(batches):
            da, db, ra, ea, rb, eb, _, ox, oy = _sides(s)
            if da != 2 or db != 2:
                continue
            n = s.num_rows
            lab = np.concatenate([np.zeros(len(ra), np.int64), np.ones(len(rb), np.int64)])
            arr = K.Arrangement(np.concatenate([ra, rb]), n, np.concatenate([ea, eb]), lab, 2)
            g, e = arr.boundary(lambda v: (v > 0).all(axis=1))
            order = np.argsort(g, kind="stable")
            g, e = g[order], e[order]
            cols = [s.column(k) for k in keep] + [
                B.edge_lists(g, n, to_global(e, g, ox, oy)), pa.array(K.area(g, n, e)), pa.array(K.perimeter(g, n, e)),
            ]
            out = pa.RecordBatch.from_arrays(cols, names=schema.names)
            hit = np.zeros(n, dtype=bool)
            hit[g] = True
            yield out.filter(pa.array(hit))

    return c.mapInArrow(run, schema)


RUN_FIELDS = [
    T.StructField("p0", T.DoubleType()), T.StructField("p1", T.DoubleType()),
    T.StructField("len", T.DoubleType()), T.StructField("verts", T.ArrayType(T.DoubleType())),
]


def _runs(row, parent, sub, p0, p1, ox, oy):
    """Join consecutive sub-segments of one row: (row, p0, p1, length, verts as p x y triples)."""
    order = np.lexsort((p0, row))
    row, sub, p0, p1 = row[order], sub[order], p0[order], p1[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (np.abs(p0[1:] - p1[:-1]) > 1e-9)
    first = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    ln = np.bincount(run, K._length(sub), minlength=len(first)) if len(first) else np.zeros(0)
    last = np.append(first[1:], len(row))[: len(first)] - 1
    g = to_global(sub, row, ox, oy)
    # vertices of a run as p x y, then a separator
    count = np.diff(np.append(first, len(row))) + 2
    verts = np.full((count.sum(), 3), np.nan)
    verts[np.arange(len(row)) + 2 * run] = np.column_stack([p0, g[:, 0], g[:, 1]])
    verts[last + 2 * np.arange(len(first)) + 1] = np.column_stack([p1[last], g[last, 2], g[last, 3]])
    off = np.concatenate([[0], np.cumsum(count * 3)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(off), pa.array(verts.ravel()))
    return row[first], p0[first], p1[last], ln, lists


def _line_runs(c: DataFrame, keep) -> DataFrame:
    """Pieces of b's lines or points inside a, per tile: vertex position range and vertices."""
    schema = T.StructType([c.schema[k] for k in keep] + [T.StructField("dim_b", T.ByteType())] + RUN_FIELDS)

    def run(batches):
        for s in _uniform(batches):
            da, db, ra, ea, rb, eb, pb, ox, oy = _sides(s)
            if db == 2 or da < db:
                continue
            n = s.num_rows
            if da != 2:
                # a line or point has no inside: there and back again leaves only its edges
                ea, ra = np.concatenate([ea, ea[:, [2, 3, 0, 1]]]), np.concatenate([ra, ra])
            if db == 0:
                ok = K.locate(ra, n, ea, rb, eb[:, 0], eb[:, 1])
                rb, sub, p0 = rb[ok], eb[ok], pb[ok, 0]
                p1 = p0
            else:
                parent, sub, t0, t1 = K.line_in_region(ra, n, ea, rb, eb)
                q0, q1 = pb[parent, 0], pb[parent, 1]
                p0 = np.where(t0 == 0, q0, q0 + t0 * (q1 - q0))
                p1 = np.where(t1 == 1, q1, q0 + t1 * (q1 - q0))
                rb = rb[parent]
            row, p0, p1, ln, verts = _runs(rb, None, sub, p0, p1, ox, oy)
            take = pa.array(row)
            cols = [s.column(k).take(take) for k in keep]
            cols += [s.column("dim_b").take(take), pa.array(p0), pa.array(p1), pa.array(ln), verts]
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return c.mapInArrow(run, schema)


def _join_runs(runs: DataFrame, keep, ids, srid: int) -> DataFrame:
    """Put together the runs of a line that meet at tile borders: one row per piece.

    The group is one feature, so it is no larger than that feature.
    """
    keep = list(keep)
    rest = [c for c in keep if c not in ids]
    whole = runs.groupBy(*ids).agg(
        *[F.any_value(c).alias(c) for c in rest], F.any_value("dim_b").alias("dim_b"),
        F.flatten(F.collect_list("verts")).alias("verts"),
    )
    schema = T.StructType([whole.schema[c] for c in keep] + [T.StructField("part", T.IntegerType()), T.StructField("geom", G.GEOM)])

    def run(batches):
        for b in batches:
            dims = B.one(b.column("dim_b")).to_numpy()
            for dim in np.unique(dims):
                s = b.filter(pa.array(dims == dim))
                row, v = B.read_edges(s.column("verts"), 3)
                owner, sizes, xy = _pieces(row, v, dim == 0)
                count = np.bincount(owner, minlength=s.num_rows)
                lines = np.split(xy, np.cumsum(sizes)[:-1])
                cols = [s.column(c).take(pa.array(owner)) for c in keep]
                cols += [pa.array(K.ranges(count).astype(np.int32)), B.lines_to_arrow(lines, srid, int(dim))]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return whole.select(*keep, "dim_b", "verts").mapInArrow(run, schema)


def _pieces(row, v, points: bool):
    """Runs (separated by NaN rows) -> maximal pieces: (row, vertex count, vertices)."""
    sep = np.isnan(v[:, 0])
    run = (np.cumsum(sep) - sep)[~sep]
    row, v = row[~sep], v[~sep]
    first = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    last = np.append(first[1:], len(run)) - 1
    rows, p0, p1 = row[first], v[first, 0], v[last, 0]
    order = np.lexsort((p1, p0, rows))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    new = np.ones(len(order), dtype=bool)
    if not points:
        o = order
        new[1:] = (rows[o][1:] != rows[o][:-1]) | (p0[o][1:] > p1[o][:-1] + 1e-9)
    piece_of_run = (np.cumsum(new) - 1)[rank]
    piece = np.repeat(piece_of_run, last - first + 1)
    o = np.lexsort((v[:, 0], piece))
    piece, v, row = piece[o], v[o], row[o]
    start = np.append(True, piece[1:] != piece[:-1])
    end = np.append(start[1:], True)
    again = np.append(False, v[1:, 0] == v[:-1, 0]) & ~start
    if points:
        keep = start
    else:
        # positions that are not vertices of the line are cuts inside the piece
        keep = ~again & (start | end | (v[:, 0] == np.floor(v[:, 0])))
        keep |= end & ~keep & ~again
    owner = row[start]
    sizes = np.bincount(piece, keep, minlength=start.sum()).astype(np.int64)
    return owner, sizes, v[keep, 1:]


def overlay_intersection(
    a: DataFrame,
    b: DataFrame,
    fields_a: Sequence[str] = (),
    fields_b: Sequence[str] = (),
    key_a: Sequence[str] | None = None,
    key_b: Sequence[str] | None = None,
    plan: TilePlan | None = None,
    check: bool = True,
    measured: bool = False,
) -> DataFrame:
    """Intersection of every pair of intersecting features, one row per piece.

    Pieces have b's dimension; anything lower (touching borders) is dropped. Output: a surrogate
    ``id`` (unless a chosen field has that name), the chosen fields of a and b (a's and b's own names), ``geom``. ``key_*`` name columns that tell the rows of a layer apart; without
    them, or where they repeat, rows get ids of their own (see ``identified``) unless all are rectangles, so features that are
    alike in the chosen fields stay apart. ``check=False`` skips the checks of type, SRID and keys,
    for layers already known. ``measured`` adds ``area`` and ``perimeter`` of the pieces; those of rectangles come
    from their corners, so a caller who wants no geometry has none made.
    """
    srid, dim = _checked(a, b) if check else (G.TARGET_SRID, None)
    a, b = (df.select(*dict.fromkeys([*fields, *(key or ()), "geom"])) for df, fields, key in ((a, fields_a, key_a), (b, fields_b, key_b)))
    kinds = _boxes(a, b) if dim in (None, 2) else (None, True)
    if kinds[1] or not kinds[0]:
        (a, key_a), (b, key_b) = identified(a, key_a, check), identified(b, key_b, check)
    else:
        # each pair of rectangles is made once, so nothing has to tell rows apart
        key_a = key_b = ()
    out = _pair_pieces(a, b, fields_a, fields_b, key_a, key_b, plan, srid, dim, kinds, measured)
    names = [F.col(f"a_{f}").alias(f) for f in fields_a] + [F.col(f"b_{f}").alias(f) for f in fields_b]
    if "id" not in (*fields_a, *fields_b):
        names.insert(0, F.monotonically_increasing_id().alias("id"))
    return out.select(*names, "geom", *(("area", "perimeter") if measured else ()))


def _checked(a: DataFrame, b: DataFrame) -> tuple[int, int | None]:
    """SRID that both layers share, and the dimension of b's features if it has any."""
    facts = layer_facts(a, b)
    kind = one_type(facts[1], allow_multi=False)
    return one_srid(*facts) or G.TARGET_SRID, DIMENSION[kind] if kind else None


def _pair_pieces(
    a, b, fields_a, fields_b, key_a, key_b, plan, srid: int, dim: int | None, kinds: tuple[BoxPlan | None, bool], measured: bool = False
) -> DataFrame:
    """Pieces of each pair of features, with ``a_*`` and ``b_*`` for fields and keys; keys do not repeat.

    ``kinds``: plan of the rectangles, and whether there are other features (see ``plan_boxes``).
    """
    keep_a = [f"a_{c}" for c in dict.fromkeys([*fields_a, *key_a])]
    keep_b = [f"b_{c}" for c in dict.fromkeys([*fields_b, *key_b])]
    keep = keep_a + keep_b
    ids = [f"a_{c}" for c in key_a] + [f"b_{c}" for c in key_b]
    ship(a.sparkSession)
    sides = _prefixed(a, "a", fields_a, key_a), _prefixed(b, "b", fields_b, key_b)
    boxes, others = kinds
    outs = []
    if others or not boxes:
        c = _other_pairs(*sides, plan or plan_tiles([a, b]), keep_a, keep_b, bool(boxes))
        if dim in (None, 2):
            tiles = _polygon_pairs(c, keep)
            rest = [x for x in keep if x not in ids]
            whole = tiles.groupBy(*ids).agg(*[F.any_value(x).alias(x) for x in rest], F.flatten(F.collect_list("edges")).alias("edges"))
            outs.append(chain_rows(whole, keep, srid))
        if dim in (None, 0, 1):
            outs.append(_join_runs(_line_runs(c, keep), keep, ids, srid))
        if measured:
            outs = [o.withColumns({"area": G.area(), "perimeter": G.perimeter()}) for o in outs]
    if boxes:
        outs.append(_box_pieces(box_pairs(*sides, boxes, keep_a, keep_b), keep, srid, measured))
    return reduce(DataFrame.unionByName, outs)


def _box_pieces(pairs: DataFrame, keep, srid: int, measured: bool) -> DataFrame:
    """What pairs of rectangles share, as polygons; those that only touch go."""
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    more = [(w * h).alias("area"), (2 * (w + h)).alias("perimeter")] if measured else []
    return pairs.where((w > 0) & (h > 0)).select(*keep, F.lit(0).alias("part"), G.rectangle(*CORNERS, srid).alias("geom"), *more)


def overlay_pairs(
    a: DataFrame, b: DataFrame, key_a: Sequence[str], key_b: Sequence[str], plan: TilePlan | None = None, check: bool = True
) -> DataFrame:
    """One row per intersecting pair, its pieces kept together as one multi geometry.

    Columns ``a_*`` and ``b_*`` for the keys, which may repeat. Pairs that do not meet in b's dimension are left out.
    """
    srid, dim = _checked(a, b) if check else (G.TARGET_SRID, None)
    a, id_a = identified(a.select(*key_a, "geom"), key_a)
    b, id_b = identified(b.select(*key_b, "geom"), key_b)
    kinds = _boxes(a, b) if dim in (None, 2) else (None, True)
    pieces = _pair_pieces(a, b, key_a, key_b, id_a, id_b, plan, srid, dim, kinds)
    g = F.col("geom")
    names_a, names_b = [f"a_{k}" for k in key_a], [f"b_{k}" for k in key_b]
    ids = dict.fromkeys([*names_a, *names_b, *[f"a_{k}" for k in id_a], *[f"b_{k}" for k in id_b]])
    out = pieces.groupBy(*ids).agg(
        F.first(g["srid"]).alias("srid"), F.first(g["dim"]).alias("dim"), F.flatten(F.collect_list(g["parts"])).alias("parts")
    )
    geom = F.struct("srid", "dim", F.lit(True).alias("multi"), "parts")
    return out.select(*names_a, *names_b, geom.alias("geom"))


def overlay_measures(
    a: DataFrame, b: DataFrame, by: Sequence[str], plan: TilePlan | None = None, key_b: Sequence[str] = ()
) -> DataFrame:
    """Total area, perimeter and length of a ∩ b per ``by`` (fields of a), without geometry.

    Tiles just add up, so this needs no second shuffle by pair.
    """
    plan = plan or plan_tiles([a, b])
    keep_a, keep_b = [f"a_{c}" for c in by], [f"b_{c}" for c in key_b]
    keep = keep_a + keep_b
    ship(a.sparkSession)
    c = candidates(_prefixed(a, "a", by, []), _prefixed(b, "b", [], key_b), plan, keep_a, keep_b)
    zero = F.lit(0.0)
    area = _polygon_pairs(c, keep).select(*keep, "area", "perimeter", zero.alias("length"))
    line = _line_runs(c, keep).select(*keep, zero.alias("area"), zero.alias("perimeter"), F.col("len").alias("length"))
    total = area.unionByName(line).groupBy(*keep).agg(*[F.sum(m).alias(m) for m in ("area", "perimeter", "length")])
    return total.select(*[F.col(f"a_{f}").alias(f) for f in by], *[F.col(f"b_{f}").alias(f) for f in key_b], "area", "perimeter", "length")
