"""Tiles: the partitioning key of every spatial operator.

Features are cut at the borders of square tiles, so that all later work is an equi-join or a
grouping on the tile key, followed by row-wise batches. The tile size follows the data: a plan
counts edges where they lie, in cells of 64 m, and picks the size at which an average tile holds
``target`` edges; tiles that hold far more are the inner nodes of a quadtree, so one dense spot never
becomes one huge task. Pieces find the leaves below them with a lookup of the tile they are in.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as G
from ..session import checkpoint, ship
from . import batches as B
from . import kernel as K

MIN_LEVEL, MAX_LEVEL = 2, 20  # tiles of 4 m to 1049 km
TARGET_VERTICES = 600
HOT_FACTOR = 16
#: Level at which edges are counted, and level of the cells whose counts one task rolls up (4**8 of them at most).
COUNT_LEVEL, GROUP_LEVEL = 6, 14
#: Levels that a lookup of hot tiles goes down: at most 1 + 4 + 16 + 64 keys in a row of the lookup table.
LOOKUP_DEPTH = 4
#: Features more tiles wide than this have their inside in cells as large as it allows, instead of in tiles.
WIDE_TILES = 16
#: Pieces of edges that are counted at once.
COUNT_PIECES = 1 << 20
COMBINE_PIECES = 64

TILE_FIELDS = [
    T.StructField("tile", T.LongType()), T.StructField("dim", T.ByteType()),
    T.StructField("edges", T.ArrayType(T.DoubleType())),
    T.StructField("bx0", T.DoubleType()), T.StructField("by0", T.DoubleType()),
    T.StructField("bx1", T.DoubleType()), T.StructField("by1", T.DoubleType()),
]


@dataclass(frozen=True)
class TilePlan:
    """Base level (tile side 2**level), tiles to cut further, and tiles that cannot be cut.

    ``hot`` has the inner nodes of the quadtree below the base level: for a tile on one of the levels
    in ``steps``, the keys of the tiles to cut (itself included) down to the next step. ``finest`` is the
    level of the smallest tiles. ``crowded`` tiles are at the smallest size and still hold too much: unions
    take them in ``chunks`` first. ``covers``: some feature is so wide that overlays keep its inside in
    larger cells.
    """

    level: int
    hot: DataFrame | None = None
    finest: int | None = None
    crowded: DataFrame | None = None
    steps: tuple[int, ...] = ()
    covers: bool = False


def tile_key(level, x, y):
    """Tile of a coordinate, as a column; the same packing as in the batches."""
    size = F.pow(F.lit(2.0), level.cast("double"))
    ix = F.floor((x - K.OFFSET) / size)
    iy = F.floor((y - K.OFFSET) / size)
    lv = F.shiftleft((level + B.LEVEL_ZERO).cast("long"), B.LEVEL_SHIFT)
    return lv.bitwiseOR(F.shiftleft(ix + B.HALF_RANGE, B.IX_SHIFT)).bitwiseOR(iy + B.HALF_RANGE)


# Reference systems in degrees that layers may come in.
GEOGRAPHIC = frozenset([4171, 4258, 4326])


def _at_level(cell: Column, level: int, to: int) -> Column:
    """Ancestor on level ``to`` of a cell key of ``level``."""
    mask = F.lit((1 << B.IX_SHIFT) - 1)
    by = to - level
    ix = F.shiftright(F.shiftright(cell, B.IX_SHIFT).bitwiseAND(mask) - B.HALF_RANGE, by)
    iy = F.shiftright(cell.bitwiseAND(mask) - B.HALF_RANGE, by)
    zero = F.lit((to + B.LEVEL_ZERO) << B.LEVEL_SHIFT).cast("long")
    return zero.bitwiseOR(F.shiftleft(ix + B.HALF_RANGE, B.IX_SHIFT)).bitwiseOR(iy + B.HALF_RANGE)


def _edge_counts(df: DataFrame, weight: float, level: int) -> DataFrame:
    """(cell, n, span, extent) of a layer, summed up in each batch: edges that begin in a cell, metres of edges
    in it, and how wide the widest feature of the batch is.

    In a tile of side s above the cells, edges make about ``n + span / s`` pieces.
    """
    size = 2.0**level

    def run(batches):
        for b in batches:
            geom = B.one(b.column(0))
            refuse_degrees(geom)
            owner, _, e, _ = B.decode(geom)
            extent = float(_extents(owner, e, b.num_rows).max(initial=0))
            pieces = np.cumsum(2 + (np.abs(e[:, 2:] - e[:, :2]).sum(axis=1) / size).astype(np.int64))
            at = 0
            while at < len(e):
                stop = max(at + 1, int(np.searchsorted(pieces, (pieces[at - 1] if at else 0) + COUNT_PIECES, "right")))
                _, col, row, s, t0, _ = K.cut_to_tiles(e[at:stop], size)
                at = stop
                cell, where = np.unique(B.pack(level, col, row), return_inverse=True)
                n = np.bincount(where.ravel(), t0 == 0, minlength=len(cell)) * weight
                span = np.bincount(where.ravel(), np.hypot(s[:, 2] - s[:, 0], s[:, 3] - s[:, 1]), minlength=len(cell)) * weight
                wide = np.full(len(cell), extent)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (cell, n, span, wide)], names=["cell", "n", "span", "extent"])

    return df.where(F.size("geom.parts") > 0).select("geom").mapInArrow(run, "cell long, n double, span double, extent double")


def _counted(layers: Sequence[DataFrame], weights: Sequence[float], level: int, within: DataFrame | None = None) -> DataFrame:
    """Counts of all layers by cell; ``within`` names the cells of COUNT_LEVEL that are looked into."""
    cells = None
    for df, w in zip(layers, weights, strict=True):
        own = _edge_counts(df, float(w), level)
        if within is not None:
            own = own.withColumn("above", _at_level(F.col("cell"), level, COUNT_LEVEL)).join(within, "above", "left_semi").drop("above")
        cells = own if cells is None else cells.unionByName(own)
    return cells.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("span").alias("span"), F.max("extent").alias("extent"))


def _extents(owner: np.ndarray, e: np.ndarray, n: int) -> np.ndarray:
    """Width or height, whichever is more, of every feature."""
    low, high = np.full((n, 2), np.inf), np.full((n, 2), -np.inf)
    for k in (0, 2):
        np.minimum.at(low, owner, e[:, k:k + 2])
        np.maximum.at(high, owner, e[:, k:k + 2])
    return np.where(np.isfinite(low[:, 0]), (high - low).max(axis=1), 0.0)


def _levels(table: pa.Table, level: int, top: int):
    """Cells of one group rolled up: (level, ix, iy, pieces) from ``level`` to ``top``."""
    cell, n, span = (table.column(c).to_numpy() for c in ("cell", "n", "span"))
    mask = (1 << B.IX_SHIFT) - 1
    ix, iy = ((cell >> B.IX_SHIFT) & mask) - B.HALF_RANGE, (cell & mask) - B.HALF_RANGE
    for lv in range(level, top + 1):
        yield lv, ix, iy, n + span / 2.0**lv
        key, where = np.unique(((ix >> 1) + B.HALF_RANGE << B.IX_SHIFT) | ((iy >> 1) + B.HALF_RANGE), return_inverse=True)
        n, span = (np.bincount(where.ravel(), v, minlength=len(key)) for v in (n, span))
        ix, iy = (key >> B.IX_SHIFT) - B.HALF_RANGE, (key & mask) - B.HALF_RANGE


def _grouped(cells: DataFrame, level: int, top: int):
    return cells.withColumn("above", _at_level(F.col("cell"), level, top)).groupBy("above")


def _level_stats(cells: DataFrame, limit: float) -> DataFrame:
    """(level, tiles, pieces, held, most, extent) from COUNT_LEVEL up; ``held`` counts no tile for more than ``limit``, as the rest is cut."""
    def run(key, table):
        rows = [
            (lv, len(ix), float(n.sum()), float(np.minimum(n, limit).sum()), float(n.max()), pc.max(table.column("extent")).as_py())
            for lv, ix, _, n in _levels(table, COUNT_LEVEL, GROUP_LEVEL)
        ]
        return pa.table([pa.array(x) for x in zip(*rows, strict=True)], names=["level", "tiles", "pieces", "held", "most", "extent"])

    below = _grouped(cells, COUNT_LEVEL, GROUP_LEVEL).applyInArrow(run, "level long, tiles long, pieces double, held double, most double, extent double")
    wide = _wide(cells).groupBy(F.col("level").cast("long").alias("level")).agg(
        F.count("*").alias("tiles"), F.sum("n").alias("pieces"), F.sum(F.least("n", F.lit(limit))).alias("held"), F.max("n").alias("most"),
        F.lit(0.0).alias("extent"),
    )
    sums = [F.sum(c).alias(c) for c in ("tiles", "pieces", "held")]
    return below.unionByName(wide).groupBy("level").agg(*sums, F.max("most").alias("most"), F.max("extent").alias("extent"))


def _wide(cells: DataFrame) -> DataFrame:
    """(tile, level, n) of the levels above the groups; there are few groups (a row for 16 km of land), so each goes to all."""
    groups = _grouped(cells, COUNT_LEVEL, GROUP_LEVEL).agg(F.sum("n").alias("n"), F.sum("span").alias("span"))
    up = F.array(*[
        F.struct(_at_level(F.col("above"), GROUP_LEVEL, lv).alias("tile"), F.lit(lv).alias("level"), (F.col("n") + F.col("span") / 2.0**lv).alias("n"))
        for lv in range(GROUP_LEVEL + 1, MAX_LEVEL + 1)
    ])
    return groups.select(F.explode(up).alias("t")).select("t.*").groupBy("tile", "level").agg(F.sum("n").alias("n"))


def _hot_tiles(cells: DataFrame, level: int, top: int, limit: float) -> DataFrame:
    """(tile, level, n) of the tiles from ``level`` to ``top`` that hold more than ``limit``, rolled up in groups."""
    group = min(top, GROUP_LEVEL)

    def run(key, table):
        out = [
            (B.pack(lv, ix[hot], iy[hot]), np.full(hot.sum(), lv, np.int32), n[hot])
            for lv, ix, iy, n in _levels(table, level, group) for hot in (n > limit,)
        ]
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["tile", "level", "n"])

    return _grouped(cells, level, group).applyInArrow(run, "tile long, level int, n double")


def plan_tiles(
    layers: Iterable[DataFrame], target: int = TARGET_VERTICES, weights: Sequence[float] | None = None
) -> TilePlan:
    """Choose tile sizes from one pass over the layers, which counts edges in the cells they lie in.

    ``weights`` scale a layer's count (a layer that will be buffered grows). Only where a cell of 64 m holds too
    much are its edges counted again, in cells of the smallest size.
    """
    layers = [df.select("geom") for df in layers]
    weights = list(weights or [1.0] * len(layers))
    ship(layers[0].sparkSession)
    cells = checkpoint(_counted(layers, weights, COUNT_LEVEL))
    limit = float(target * HOT_FACTOR)
    stats = {r["level"]: r for r in _level_stats(cells, limit).collect()}
    if not stats:
        return TilePlan(MAX_LEVEL)
    fit = [lv for lv, r in stats.items() if r["held"] <= target * r["tiles"]]
    level = max(fit, default=COUNT_LEVEL)
    covers = max(r["extent"] for r in stats.values()) > WIDE_TILES * 2.0**level
    if stats[level]["most"] <= limit:
        return TilePlan(level, covers=covers)
    hot = _hot_tiles(cells, COUNT_LEVEL, level, limit)
    if level > GROUP_LEVEL:
        hot = hot.unionByName(_wide(cells).where(F.col("n") > limit))
    hot = checkpoint(hot.where(F.col("level") <= level).select("tile", "level", "n"))
    deep = hot.where(F.col("level") == COUNT_LEVEL).select(F.col("tile").alias("above"))
    crowded = None
    if stats[COUNT_LEVEL]["most"] > limit:
        fine = _hot_tiles(_counted(layers, weights, MIN_LEVEL, deep), MIN_LEVEL, COUNT_LEVEL, limit)
        fine = checkpoint(fine.where(F.col("level") < COUNT_LEVEL))
        chunks = F.ceil(F.col("n") / limit).cast("int").alias("chunks")
        piled = fine.where(F.col("level") == MIN_LEVEL)
        crowded = None if piled.isEmpty() else piled.select("tile", chunks)
        hot = hot.unionByName(fine.where(F.col("level") > MIN_LEVEL))
    lowest = hot.agg(F.min("level")).first()[0]
    steps = tuple(range(level, lowest - 1, -LOOKUP_DEPTH))
    tables = []
    for step in steps:
        own = hot.where((F.col("level") <= step) & (F.col("level") > step - LOOKUP_DEPTH))
        above = F.coalesce(*[F.when(F.col("level") == lv, _at_level(F.col("tile"), lv, step)) for lv in range(step, max(step - LOOKUP_DEPTH, MIN_LEVEL), -1)])
        tables.append(own.groupBy(above.alias("tile")).agg(F.collect_list("tile").alias("cells")))
    lookup = tables[0]
    for t in tables[1:]:
        lookup = lookup.unionByName(t)
    return TilePlan(level, checkpoint(lookup), max(lowest - 1, MIN_LEVEL), crowded, steps, covers)


def _tile_batch(keep, owner, tile, dim, values):
    """Group piece rows by (owner, tile) and build the output batch."""
    order = np.lexsort((tile, owner))
    owner, tile, dim, values = owner[order], tile[order], dim[order], values[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (tile[1:] != tile[:-1])
    first = np.flatnonzero(new)
    at = np.cumsum(new) - 1
    x = np.stack([values[:, 0], values[:, 2]])
    y = np.stack([values[:, 1], values[:, 3]])
    box = [
        np.minimum.reduceat(x.min(axis=0), first), np.minimum.reduceat(y.min(axis=0), first),
        np.maximum.reduceat(x.max(axis=0), first), np.maximum.reduceat(y.max(axis=0), first),
    ] if len(first) else [np.zeros(0)] * 4
    d = dim[first]
    if len(first):
        # the bottom border is implied: a region that was cut may reach down to it
        _, _, oy = B.unpack(tile[first])
        cut = K.on_lattice(values[:, :4]).any(axis=1)
        cut = np.bincount(at, cut, minlength=len(first)) > 0
        box[1] = np.where((d == 2) & cut, oy + K.OFFSET, box[1])
    cols = [c.take(pa.array(owner[first])) for c in keep]
    width = np.where(d == 2, 4, 6)
    count = np.bincount(at, minlength=len(first)) * width
    off = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    flat = values.ravel() if values.shape[1] == 6 and not (d == 2).any() else (
        values[:, :4].ravel() if (d == 2).all() else
        np.concatenate([v[:4] if k == 2 else v for v, k in zip(values, dim)])
    )
    edges = pa.ListArray.from_arrays(pa.array(off), pa.array(np.ascontiguousarray(flat)))
    cols += [pa.array(tile[first]), pa.array(d.astype(np.int8)), edges] + [pa.array(b) for b in box]
    return cols


def _split(row, dim_of_edge, e, p, level, floor=None):
    """Cut decoded edges at the tiles of one level: (row, tile, dim, values of 6 columns)."""
    size = float(2.0**level)
    out = []
    m = dim_of_edge == 2
    if m.any():
        f, c, r, s = K.split_region(row[m], e[m], size, floor)
        out.append((f, B.pack(level, c, r), np.full(len(f), 2), np.column_stack([s, np.zeros((len(s), 2))])))
    m = ~m
    if m.any():
        par, c, r, s, t0, t1 = K.cut_to_tiles(e[m], size)
        p0, p1 = p[m][:, 0][par], p[m][:, 1][par]
        v = np.column_stack([s, p0 + t0 * (p1 - p0), p0 + t1 * (p1 - p0)])
        out.append((row[m][par], B.pack(level, c, r), dim_of_edge[m][par], v))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros((0, 6))
    return tuple(np.concatenate([o[i] for o in out]) for i in range(4))


def _whole(tile, edges) -> np.ndarray:
    """Which pieces (an edge each) are nothing but the top border of their tile: the tile lies inside the feature."""
    size, ox, oy = B.unpack(tile)
    x0, top = ox + K.OFFSET, oy + size + K.OFFSET
    return (edges[:, 0] == x0 + size) & (edges[:, 2] == x0) & (edges[:, 1] == top) & (edges[:, 3] == top)


def _split_wide(row, dim_of_edge, e, p, level, n_rows):
    """``_split``, but wide polygons are cut level by level, and a cell that lies inside of one stays whole.

    Rows of a polygon then grow with its boundary, not with its area.
    """
    extent = _extents(row, e, n_rows)
    wide = (dim_of_edge == 2) & (extent > WIDE_TILES * 2.0**level)[row]
    if not wide.any():
        return _split(row, dim_of_edge, e, p, level)
    out = [_split(row[~wide], dim_of_edge[~wide], e[~wide], p[~wide], level)]
    at = min(MAX_LEVEL, int(np.ceil(np.log2(extent[row[wide]].max()))))
    r, t, d, v = _split(row[wide], dim_of_edge[wide], e[wide], p[wide], at)
    while at > level:
        key, group, count = np.unique(np.column_stack([r, t]), axis=0, return_inverse=True, return_counts=True)
        group = group.ravel()
        whole = (count[group] == 1) & _whole(t, v)
        out.append((r[whole], t[whole], d[whole], v[whole]))
        size, _, oy = B.unpack(key[:, 1])
        floor = np.round(oy / size).astype(np.int64) * 2
        at -= 1
        f, t, d, v = _split(group[~whole], d[~whole], v[~whole, :4], v[~whole, 4:6], at, floor)
        r = key[f, 0]
    out.append((r, t, d, v))
    return tuple(np.concatenate([o[i] for o in out]) for i in range(4))


def refuse_degrees(geometry: pa.StructArray) -> None:
    """Tiles and the grid are in metres; a layer in degrees has to be projected first."""
    systems = pc.unique(geometry.field("srid")).to_pylist()
    if any(s in GEOGRAPHIC for s in systems if s is not None):
        raise ValueError(f"layers in degrees cannot be tiled, project them first: {sorted(s for s in systems if s is not None)}")


def split_to_tiles(
    df: DataFrame, plan: TilePlan, keep: Sequence[str], geom: str = "geom", radius: Column | str | None = None, style: str = "round",
    combine: bool = False, cover: bool = False,
) -> DataFrame:
    """Cut features at tile borders: one row per feature and tile.

    Output: the ``keep`` columns, ``tile``, ``dim``, ``edges`` (flat doubles: ``x0 y0 x1 y1`` for
    polygons, plus the vertex positions ``p0 p1`` along the feature for lines and points) and the
    bounding box of the piece.

    With ``radius``, the features are buffered first (see ``functions.geometry.buffer``); the many
    vertices of the buffers then exist only inside the batch that cuts them. Rows with a NULL
    radius give nothing.

    ``combine`` is for unions: pieces of one batch that pile up on a tile (with equal ``keep``
    values) are united before they are shuffled. Their bounding boxes are not kept.

    With ``cover``, the inside of wide polygons comes in cells of any larger level (see ``is_cover``).
    """
    ship(df.sparkSession)
    keep = list(keep)
    fields = [df.schema[c] for c in keep]
    level, buffered = plan.level, radius is not None

    def first(batches):
        for b in batches:
            refuse_degrees(B.one(b.column(len(keep))))
            row, dims, e, p = B.decode(b.column(len(keep)))
            d = dims[row] if len(row) else np.zeros(0)
            if buffered:
                r = B.one(b.column(len(keep) + 1)).to_numpy(zero_copy_only=False)
                k, ring = K.strips(e, r[row], style)
                solid = d == 2
                row, e = np.concatenate([row[solid], row[k]]), np.concatenate([e[solid], ring])
                d, p = np.full(len(row), 2), np.zeros(len(row))
            step = np.where(d == 0, 0.0, 1.0)
            position = np.column_stack([p, p + step])
            r = _split_wide(row, d, e, position, level, b.num_rows) if cover else _split(row, d, e, position, level)
            cols = _tile_batch([b.column(i) for i in range(len(keep))], *r)
            out = pa.RecordBatch.from_arrays(cols, names=keep + [f.name for f in TILE_FIELDS])
            yield combine_pieces(out, keep) if combine else out

    source = df.where(F.size(F.col(geom)["parts"]) > 0)
    if buffered:
        if style not in ("round", "square"):
            raise ValueError(f"unknown buffer style: {style}")
        r = F.expr(radius) if isinstance(radius, str) else radius
        r = F.when(r < 0, F.raise_error(F.lit("negative buffer radius")).cast("double")).otherwise(r.cast("double"))
        solid = F.when(r == 0, F.col(geom)["dim"] == 2).otherwise(True)
        source = source.select(*keep, geom, r.alias("_radius")).where(F.col("_radius").isNotNull() & solid)
        source = source.select(*keep, geom, "_radius")
    else:
        source = source.select(*keep, geom)
    out = source.mapInArrow(first, T.StructType(fields + TILE_FIELDS))
    for step in plan.steps:
        out = _refine(out, plan.hot, step, plan.finest, keep, fields, cover)
    return out


def is_cover() -> Column:
    """Whether a piece is its whole tile."""
    wide = F.get("edges", F.lit(0)) - F.get("edges", F.lit(2))
    return (F.col("dim") == 2) & (F.size("edges") == 4) & (wide == _side("tile"))


def _side(tile: str) -> Column:
    return F.pow(F.lit(2.0), (F.shiftright(tile, B.LEVEL_SHIFT) - B.LEVEL_ZERO).cast("double"))


def covers_below(pieces: DataFrame, covering: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Covers of ``covering``, a row for each tile of ``pieces`` that lies strictly inside of them, as pieces of that tile.

    Tiles look for their ancestors on the levels that have covers; only keys are joined.
    """
    covers = covering.where(is_cover()).select(*keep, F.col("tile").alias("above"))
    level = F.shiftright("above", B.LEVEL_SHIFT) - B.LEVEL_ZERO
    levels = sorted(r[0] for r in covers.select(level.cast("int")).distinct().collect())
    own = (F.shiftright("tile", B.LEVEL_SHIFT) - B.LEVEL_ZERO).cast("int")
    mask = F.lit((1 << B.IX_SHIFT) - 1)
    ix = F.shiftright("tile", B.IX_SHIFT).bitwiseAND(mask) - B.HALF_RANGE
    iy = F.col("tile").bitwiseAND(mask) - B.HALF_RANGE
    tiles = pieces.select("tile").distinct().select("tile", own.alias("own"), ix.alias("ix"), iy.alias("iy"))
    tiles = tiles.withColumn("to", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>"))).where("to > own")
    above = F.shiftleft((F.col("to") + B.LEVEL_ZERO).cast("long"), B.LEVEL_SHIFT)
    for place, shift in (("ix", B.IX_SHIFT), ("iy", 0)):
        above = above.bitwiseOR(F.shiftleft(F.expr(f"shiftright({place}, to - own)") + B.HALF_RANGE, shift))
    side = _side("tile")
    x0, y0 = F.col("ix") * side + K.OFFSET, F.col("iy") * side + K.OFFSET
    box = [x0.alias("bx0"), y0.alias("by0"), (x0 + side).alias("bx1"), (y0 + side).alias("by1")]
    edge = F.array(x0 + side, y0 + side, x0, y0 + side).alias("edges")
    return tiles.withColumn("above", above).join(covers, "above").select(*keep, "tile", F.lit(2).cast("tinyint").alias("dim"), edge, *box)


def combine_pieces(batch: pa.RecordBatch, keep: Sequence[str]) -> pa.RecordBatch:
    """Unite the pieces of a batch that share tile and ``keep``, a bounded number at a time."""
    while batch.num_rows >= COMBINE_PIECES:
        codes = [B.one(batch.column("tile")).to_numpy()]
        codes += [B.one(batch.column(c)).dictionary_encode().indices.fill_null(-1).to_numpy() for c in keep]
        _, group, count = np.unique(np.column_stack(codes), axis=0, return_inverse=True, return_counts=True)
        group = group.ravel()
        pile = count[group] >= COMBINE_PIECES
        if not pile.any():
            break
        order = np.argsort(group, kind="stable")
        rank = np.empty(len(group), np.int64)
        rank[order] = K.ranges(count)
        # chunks of a pile
        _, first, chunk = np.unique(
            np.column_stack([group[pile], rank[pile] // COMBINE_PIECES]), axis=0, return_index=True, return_inverse=True
        )
        chunk = chunk.ravel()
        piled = batch.filter(pa.array(pile))
        head = piled.take(pa.array(first))
        row, e = B.read_edges(piled.column("edges"), 4)
        size, ox, oy = B.unpack(head.column("tile").to_numpy())
        g, n = chunk[row], head.num_rows
        origin = np.tile(np.column_stack([ox, oy]), 2)
        a = K.Arrangement(g, n, e - origin[g], np.zeros(len(g), np.int64), 1)
        bg, be = a.boundary(lambda c: c[:, 0] > 0)
        o = np.argsort(bg, kind="stable")
        lists = B.edge_lists(bg[o], n, be[o] + origin[bg[o]])
        box = [ox + K.OFFSET, oy + K.OFFSET, ox + size + K.OFFSET, oy + size + K.OFFSET]
        cols = [head.column(c) for c in (*keep, "tile", "dim")] + [lists] + [pa.array(v) for v in box]
        united = pa.RecordBatch.from_arrays(cols, names=batch.schema.names)
        rest = batch.filter(pa.array(~pile))
        batch = pa.Table.from_batches([rest, united.cast(rest.schema)]).combine_chunks().to_batches()[0]
    return batch


def _refine(pieces: DataFrame, lookup: DataFrame, step: int, finest: int, keep, fields, cover: bool = False) -> DataFrame:
    """Cut pieces in hot tiles of level ``step`` down to their leaves, LOOKUP_DEPTH levels at most; others pass unchanged."""
    names = keep + [f.name for f in TILE_FIELDS]
    marked = pieces.join(lookup, "tile", "left").select(*names, "cells")

    def lower(h: pa.RecordBatch, level: int) -> list[pa.RecordBatch]:
        """The pieces of hot tiles cut at ``level``."""
        out = []
        dims = h.column("dim").to_numpy()
        for group, width in ((dims == 2, 4), (dims != 2, 6)):
            if not group.any():
                continue
            s = h.filter(pa.array(group))
            row, v = B.read_edges(s.column("edges"), width)
            d = s.column("dim").to_numpy()[row]
            p = v[:, 4:6] if width == 6 else np.zeros((len(v), 2))
            size, _, oy = B.unpack(s.column("tile").to_numpy())
            floor = np.round(oy / size).astype(np.int64) * 2
            r = _split(row, d, v[:, :4], p, level, floor)
            cols = _tile_batch([s.column(i) for i in range(len(keep))], *r)
            out.append(pa.RecordBatch.from_arrays(cols, names=names))
        return out

    def cut(batches):
        for b in batches:
            cells = np.unique(B.one(b.column(len(names))).flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            parts = [pa.RecordBatch.from_arrays(b.columns[: len(names)], names=names)]
            for level in range(step - 1, max(finest, step - LOOKUP_DEPTH) - 1, -1):
                below = []
                for part in parts:
                    tile = part.column("tile").to_numpy()
                    hot = np.isin(tile, cells)
                    if cover:
                        off = B.offsets(part.column("edges"))
                        flat = part.column("edges").values.to_numpy(zero_copy_only=False)
                        one = np.flatnonzero((np.diff(off) == 4) & (part.column("dim").to_numpy() == 2))
                        hot[one[_whole(tile[one], flat[off[one][:, None] + np.arange(4)])]] = False
                    if not hot.all():
                        yield part.filter(pa.array(~hot))
                    if hot.any():
                        below += lower(part.filter(pa.array(hot)), level)
                parts = below
            yield from parts

    return marked.mapInArrow(cut, T.StructType(fields + TILE_FIELDS))
