"""Unions: of a whole layer, of filtered layers, of buffers, and dissolving into polygons.

A union is kept as a *region*: one row per tile (and per ``by`` group) with the boundary edges of
the covered area and its exact area and perimeter. Tile borders are never counted as boundary, so
measures of a region are plain sums over its rows, and no union ever meets in one task. Whole
polygons are assembled only where asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as G
from ..session import checkpoint, ship
from . import batches as B
from . import kernel as K
from .components import connected_components
from .tiling import TilePlan, plan_tiles, split_to_tiles

BATCH_EDGES = 40_000
#: Chunks of a crowded tile that are united in one row.
FAN_IN = 16
#: Pieces of a tile that are united at once.
PILE = 32
MEASURES = [T.StructField("area", T.DoubleType()), T.StructField("perimeter", T.DoubleType())]
EDGES_FIELD = T.StructField("edges", T.ArrayType(T.DoubleType()))


def slices(batch: pa.RecordBatch, *lists: str, limit: int = BATCH_EDGES):
    """Cut a batch so that no slice holds many more than ``limit`` edges."""
    size = np.zeros(batch.num_rows, dtype=np.int64)
    for name in lists:
        size += np.diff(B.offsets(B.one(batch.column(name)))) // 4
    end = np.cumsum(size)
    at = 0
    while at < batch.num_rows:
        base = end[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(end, base + limit, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def to_local(e, row, ox, oy):
    out = np.array(e[:, :4])
    out[:, 0::2] -= ox[row][:, None]
    out[:, 1::2] -= oy[row][:, None]
    return out


def to_global(e, row, ox, oy):
    out = np.array(e)
    out[:, 0::2] += ox[row][:, None]
    out[:, 1::2] += oy[row][:, None]
    return out


def _covered(c):
    return c[:, 0] > 0


def _unite(row: np.ndarray, n: int, piece: np.ndarray, e: np.ndarray):
    """Boundary of the union of the pieces of each of ``n`` rows: (row, edges), sorted by row.

    PILE pieces at a time, then their unions, and so on: an arrangement of many pieces at once has a node
    for each of their crossings, most of which lie inside the union.
    """
    while True:
        most = np.zeros(n, np.int64)
        np.maximum.at(most, row, piece)
        deep = (most >= PILE)[row]
        if not deep.any():
            break
        width = int(most.max()) // PILE + 1
        key, g = np.unique(row[deep] * width + piece[deep] // PILE, return_inverse=True)
        g = g.ravel()
        bg, be = K.Arrangement(g, len(key), e[deep], np.zeros(len(g), np.int64), 1).boundary(_covered)
        row = np.concatenate([row[~deep], key[bg] // width])
        piece = np.concatenate([piece[~deep], key[bg] % width])
        e = np.concatenate([e[~deep], be])
    g, out = K.Arrangement(row, n, e, np.zeros(len(row), np.int64), 1).boundary(_covered)
    order = np.argsort(g, kind="stable")
    return g[order], out[order]


def _merge(pieces: DataFrame, by: Sequence[str]) -> DataFrame:
    """Union of all pieces with the same ``tile`` and ``by``."""
    keys = [*by, "tile"]
    # a set: copies of a piece collapse before the shuffle
    grouped = pieces.groupBy(*keys).agg(F.collect_set("edges").alias("pieces"))
    grouped = grouped.select(*keys, F.flatten("pieces").alias("edges"), F.transform("pieces", F.size).alias("sizes"))
    schema = T.StructType([pieces.schema[k] for k in keys] + [EDGES_FIELD] + MEASURES)

    def run(batches):
        for b in batches:
            for s in slices(b, "edges"):
                n = s.num_rows
                row, e = B.read_edges(s.column("edges"), 4)
                sizes = B.one(s.column("sizes"))
                of_row = np.diff(B.offsets(sizes))
                piece = np.repeat(K.ranges(of_row), sizes.flatten().to_numpy() // 4)
                _, ox, oy = B.unpack(s.column("tile").to_numpy())
                g, out = _unite(row, n, piece, to_local(e, row, ox, oy))
                cols = [s.column(i) for i in range(len(keys))] + [
                    B.edge_lists(g, n, to_global(out, g, ox, oy)),
                    pa.array(K.area(g, n, out)), pa.array(K.perimeter(g, n, out)),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return grouped.mapInArrow(run, schema)


def region(df: DataFrame, plan: TilePlan | None = None, by: Sequence[str] = (), geom: str = "geom") -> DataFrame:
    """Union of the polygons of a layer, as a region; one union per value of ``by``."""
    # copies add nothing to a union: they go before anything is counted or cut
    polygons = df.where(F.col(geom)["dim"] == 2).select(*by, F.col(geom).alias("geom")).distinct()
    plan = plan or plan_tiles([polygons])
    ship(df.sparkSession)
    pieces = split_to_tiles(polygons, plan, by, combine=True).select(*by, "tile", "edges")
    return merge_pieces(pieces, plan, by)


def merge_pieces(pieces: DataFrame, plan: TilePlan, by: Sequence[str] = ()) -> DataFrame:
    """Union pieces that are already cut to tiles (edges of several layers may be stacked).

    Tiles that cannot be cut further are united as a tree: in bounded chunks first, then FAN_IN
    chunks at a time, with a checkpoint between the rounds, until one is left.
    """
    if plan.crowded is None:
        return _merge(pieces, by).where(F.size("edges") > 0)
    most = plan.crowded.agg(F.max("chunks")).first()[0] or 1
    chunk = F.when(F.col("chunks").isNotNull(), F.pmod(F.xxhash64("edges"), F.col("chunks")).cast("int"))
    salted = pieces.join(plan.crowded, "tile", "left").select(*by, "tile", "edges", chunk.alias("_chunk"))
    first = checkpoint(_merge(salted, [*by, "_chunk"]))
    calm, pile = first.where("_chunk IS NULL").drop("_chunk"), first.where("_chunk IS NOT NULL")
    while most > FAN_IN:
        most = -(-most // FAN_IN)
        up = pile.select(*by, "tile", "edges", F.floor(F.col("_chunk") / FAN_IN).cast("int").alias("_chunk"))
        pile = checkpoint(_merge(up, [*by, "_chunk"]))
    return calm.unionByName(_merge(pile.select(*by, "tile", "edges"), by)).where(F.size("edges") > 0)


def measure(reg: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total area and perimeter of a region, per ``by``."""
    return reg.groupBy(*by).agg(F.sum("area").alias("area"), F.sum("perimeter").alias("perimeter"))


def union_where_equals(df, column: str, value, plan=None, geom="geom") -> DataFrame:
    """Union of the rows with ``column = value``."""
    return region(df.where(F.col(column) == value), plan, geom=geom)


def union_where_like(df, column: str, pattern: str, plan=None, geom="geom") -> DataFrame:
    """Union of the rows with ``column LIKE pattern``."""
    return region(df.where(F.col(column).like(pattern)), plan, geom=geom)


def union_buffer(df, radius: Column | str, plan=None, style="round", by=(), geom="geom") -> DataFrame:
    """Union of the buffers of all rows; ``radius`` may be any expression of the row.

    The buffer of a line is the union of the strips around its segments, so the strips go
    straight into the union. Rows alike in geometry and radius count once.
    """
    width = F.expr(radius) if isinstance(radius, str) else radius
    shapes = df.select(*by, F.col(geom).alias("geom"), width.alias("_width")).distinct()
    plan = plan or plan_tiles([shapes], weights=[10.0])
    pieces = split_to_tiles(shapes, plan, by, "geom", "_width", style, combine=True).select(*by, "tile", "edges")
    return merge_pieces(pieces, plan, by)


# ---------------------------------------------------------------------------- whole polygons


def assemble(reg: DataFrame, by: Sequence[str] = (), srid: int = G.TARGET_SRID) -> DataFrame:
    """Chain the boundary of each ``by`` group into polygons: one row per polygon.

    The connected parts of a group are found first, and each is put together by itself, so no task
    ever sees more than one polygon's boundary, whatever the size of the group. A polygon that is too
    large for one row is what ``tile_polygons`` is for. Output: the keys, ``part`` (a name of the
    polygon within its group), ``geom``.
    """
    keys = list(by)
    reg = checkpoint(reg.select(*keys, "tile", "edges"))
    return _assembled(labelled_parts(reg, srid, keys), keys, srid)


def _assembled(parts: DataFrame, keys: Sequence[str], srid: int) -> DataFrame:
    """Parts in tiles -> one row per polygon: ``keys``, ``part``, ``geom``."""
    edges = parts.where(F.size("edges") > 0).groupBy(*keys, F.col("part").alias("_label")).agg(F.flatten(F.collect_list("edges")).alias("edges"))
    out = chain_rows(edges, [*keys, "_label"], srid)
    return out.select(*keys, F.concat_ws("/", "_label", "part").alias("part"), "geom")


def tile_polygons(reg: DataFrame, by: Sequence[str] = (), srid: int = G.TARGET_SRID) -> DataFrame:
    """The polygons of a region inside each tile (columns ``by``, ``part``, ``geom``).

    They tile the region without overlap; tile borders show up in their outlines.
    """
    out = _tile_parts(reg, srid, by)
    return out.select(*by, F.element_at(F.split("node", ":"), -1).cast("int").alias("part"), "geom")


def chain_rows(rows: DataFrame, keep: Sequence[str], srid: int = G.TARGET_SRID) -> DataFrame:
    """Rows with directed boundary ``edges`` -> one row per polygon, numbered within the row."""
    keep = list(keep)
    ship(rows.sparkSession)
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField("part", T.IntegerType()), T.StructField("geom", G.GEOM)])

    def run(batches):
        for b in batches:
            for s in slices(b, "edges"):
                row, e = B.read_edges(s.column("edges"), 4)
                m = ~K.is_seam(e)
                row, e = row[m], e[m]
                polys = K.chain(row, e)
                polys.sort(key=lambda p: (p[0], p[1][0][:, 0].min(), p[1][0][:, 1].min()))
                owner = np.array([p[0] for p in polys], dtype=np.int64)
                count = np.bincount(owner, minlength=s.num_rows) if len(owner) else np.zeros(s.num_rows, np.int64)
                cols = [s.column(c).take(pa.array(owner)) for c in keep]
                cols += [pa.array(K.ranges(count).astype(np.int32)), B.polygons_to_arrow([[p[1]] for p in polys], srid)]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return rows.select(*keep, "edges").mapInArrow(run, schema)


SEAM = T.StructType([
    T.StructField("axis", T.IntegerType()), T.StructField("at", T.DoubleType()), T.StructField("side", T.IntegerType()),
    T.StructField("lo", T.DoubleType()), T.StructField("hi", T.DoubleType()),
])


def _tile_parts(reg: DataFrame, srid: int, keep: Sequence[str] = ()) -> DataFrame:
    """Polygons inside each tile, with the stretches where they reach the tile's border."""
    keep = list(keep)
    schema = T.StructType([
        *[reg.schema[c] for c in keep],
        T.StructField("node", T.StringType()), T.StructField("edges", T.ArrayType(T.DoubleType())), *MEASURES,
        T.StructField("geom", G.GEOM), T.StructField("seams", T.ArrayType(SEAM)),
    ])
    seam_type = pa.list_(pa.struct([("axis", pa.int32()), ("at", pa.float64()), ("side", pa.int32()), ("lo", pa.float64()), ("hi", pa.float64())]))

    def run(batches):
        for b in batches:
            for s in slices(b, "edges"):
                tile = s.column("tile").to_numpy()
                row, e = B.read_edges(s.column("edges"), 4)
                size, ox, oy = B.unpack(tile)
                x0, y0 = ox + K.OFFSET, oy + K.OFFSET
                g, full = K.close_tiles(row, e, x0, y0, x0 + size)
                polys = K.chain(g, full, drop_lattice=False)
                polys.sort(key=lambda p: (p[0], p[1][0][:, 0].min(), p[1][0][:, 1].min(), len(p[1][0])))
                owner = np.array([p[0] for p in polys], dtype=np.int64)
                number = K.ranges(np.bincount(owner, minlength=s.num_rows)) if len(owner) else owner
                nodes, edges, areas, lengths, seams = [], [], [], [], []
                for (r, rings), k in zip(polys, number):
                    seg = np.concatenate([np.concatenate([q[:-1], q[1:]], axis=1) for q in rings])
                    flat = (seg[:, 1] == seg[:, 3]) & K.on_lattice(seg[:, 1])
                    wall = (seg[:, 0] == seg[:, 2]) & K.on_lattice(seg[:, 0])
                    real = seg[~(flat | wall)]
                    nodes.append(f"{tile[r]}:{k}")
                    edges.append(real.ravel())
                    areas.append(sum(K._ring_area(q) for q in rings))
                    lengths.append(float(K._length(real).sum()))
                    border = []
                    for q in seg[flat]:
                        border.append((0, q[1], int(q[1] > y0[r]), min(q[0], q[2]), max(q[0], q[2])))
                    for q in seg[wall]:
                        border.append((1, q[0], int(q[0] > x0[r]), min(q[1], q[3]), max(q[1], q[3])))
                    seams.append([dict(zip(("axis", "at", "side", "lo", "hi"), z)) for z in border])
                yield pa.RecordBatch.from_arrays(
                    [s.column(c).take(pa.array(owner)) for c in keep] + [pa.array(nodes, pa.string()), pa.array([x.tolist() for x in edges], B.EDGES), pa.array(areas, pa.float64()),
                     pa.array(lengths, pa.float64()), B.polygons_to_arrow([[p[1]] for p in polys], srid), pa.array(seams, seam_type)],
                    names=schema.names,
                )

    return reg.select(*keep, "tile", "edges").mapInArrow(run, schema)


def labelled_parts(reg: DataFrame, srid: int = G.TARGET_SRID, by: Sequence[str] = ()) -> DataFrame:
    """Label the connected parts of each ``by`` group of a region.

    One row per tile and part: the keys, ``part`` (the same for all rows of one connected part),
    the row's boundary ``edges``, ``area``, ``perimeter`` and its ``geom`` inside the tile.
    """
    keys = list(by)
    parts = _tile_parts(reg, srid, keys)
    if keys:  # the same tile may hold parts of several groups
        parts = parts.withColumn("node", F.concat_ws("|", "node", F.to_json(F.struct(*keys))))
    parts = checkpoint(parts)
    # stretches on both sides of one border that overlap join two parts; they are looked up by the
    # cells of the largest tile, in one of which each of them lies
    level = F.shiftright("tile", B.LEVEL_SHIFT) - B.LEVEL_ZERO
    top = reg.agg(F.max(level)).first()[0]
    seams = parts.select(*keys, "node", F.explode("seams").alias("s")).select(*keys, "node", "s.*")
    bucket = F.floor((F.col("lo") - K.OFFSET) / F.lit(2.0 ** (top or 0)))
    seams = seams.withColumn("bucket", bucket)
    a = seams.where("side = 0").select(*keys, "axis", "at", "bucket", F.col("node").alias("u"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"))
    b = seams.where("side = 1").select(*[F.col(k).alias(f"_{k}") for k in keys], "axis", "at", "bucket", F.col("node").alias("v"), "lo", "hi")
    met = a.join(b, ["axis", "at", "bucket"]).where(F.least("hi", "ahi") > F.greatest("lo", "alo"))
    for k in keys:
        met = met.where(F.col(k).eqNullSafe(F.col(f"_{k}")))
    label = connected_components(met.select("u", "v").distinct())
    out = parts.join(label, parts["node"] == label["id"], "left")
    tile = F.regexp_extract("node", r"^(-?\d+):", 1).cast("long").alias("tile")
    return out.select(*keys, F.coalesce("component", "node").alias("part"), tile, "edges", "area", "perimeter", "geom")


def dissolved_parts(reg: DataFrame, plan: TilePlan | None = None, srid: int = G.TARGET_SRID) -> DataFrame:
    """The connected parts of a region, in tiles (see ``labelled_parts``)."""
    return labelled_parts(reg, srid)


def dissolve(a: DataFrame, b: DataFrame, plan: TilePlan | None = None, srid: int = G.TARGET_SRID) -> DataFrame:
    """Union of two layers, split into its connected polygons, kept as tile rows (see above)."""
    from .checks import assert_same_srid

    both = assert_same_srid(a, b)
    plan = plan or plan_tiles([both])
    return dissolved_parts(region(both, plan), plan, srid)


def dissolve_polygons(a: DataFrame, b: DataFrame, plan: TilePlan | None = None, srid: int = G.TARGET_SRID) -> DataFrame:
    """``dissolve`` with every part assembled: one row per polygon, ``component``, ``geom``."""
    parts = checkpoint(dissolve(a, b, plan, srid))
    return _assembled(parts, [], srid).withColumnRenamed("part", "component")
