"""Connected components of a graph given as links, and clustering of touching features."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint, ship
from . import batches as B
from . import kernel as K
from .tiling import TilePlan, _whole, plan_tiles, split_to_tiles


#: Chunks of a crowded tile whose outlines meet in one row.
FAN_IN = 16
#: Polygons of a tile that are compared at once; clusters go on with the outline of their union.
CHUNK = 16


def _point_to_min(links: DataFrame, keep_larger: bool) -> DataFrame:
    """Link every neighbour of u to the smallest of them; a join, so hot nodes can be split."""
    low = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    out = links.join(low, "u")
    if keep_larger:
        return out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _both(out, ("v", "m"), ("u", "m"))


def _both(rows: DataFrame, *ends: tuple[str, str]) -> DataFrame:
    """(u, v) for each of the pairs of columns: one scan of the rows, a union would take one for each."""
    pairs = [F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in ends]
    return rows.select(F.explode(F.array(*pairs)).alias("e")).select("e.u", "e.v")


def _only_stars(edges: DataFrame) -> bool:
    """Whether every u has one link, and to a node that is no u itself."""
    ends = _both(edges.withColumn("up", F.lit(True)).withColumn("down", F.lit(False)), ("u", "up"), ("v", "down"))
    met = ends.groupBy("u").agg(F.count_if("v").alias("ups"), F.count_if(~F.col("v")).alias("downs"))
    return not met.agg(F.max((F.col("ups") > 1) | ((F.col("ups") > 0) & (F.col("downs") > 0)))).first()[0]


def star_links(links: DataFrame, keep: Callable[[DataFrame], DataFrame] = checkpoint) -> DataFrame:
    """(u, v = smallest id of its component) for all ids in the links ``u, v`` but these smallest ones.

    Alternating large-star and small-star (Kiveris et al., SoCC 2014). Every round goes through ``keep``, the
    reliable checkpoint folder, so a lost executor costs one round at most. Rounds go on until only
    stars are left; their number grows with the logarithm of the largest component.
    """
    edges = keep(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _only_stars(edges):
        large = _point_to_min(_both(edges, ("u", "v"), ("v", "u")), True)
        small = _point_to_min(large, False)
        edges = keep(small.where("u != v").distinct())
    return edges


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component = smallest id) for all ids in the links ``u, v``."""
    edges = star_links(links)
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _spanning_links(group, n_groups, a, b):
    """Keep enough of the local links (group, a, b) to span their components: (group, b -> root)."""
    key = np.concatenate([np.column_stack([group, a]), np.column_stack([group, b])])
    nodes, inv = np.unique(key, axis=0, return_inverse=True)
    inv = inv.ravel()
    u, v = inv[: len(a)], inv[len(a):]
    root = np.arange(len(nodes))
    while len(u):
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        np.minimum.at(root, u, low)
        np.minimum.at(root, v, low)
        root = root[root]
        if (root == before).all():
            break
    m = root != np.arange(len(nodes))
    return nodes[m, 0], nodes[root[m], 1], nodes[m, 1]


LINKS = ("u", "v", "tile", "dim", "edges")


def _links_of(node: T.DataType) -> T.StructType:
    types = (node, node, T.LongType(), T.ByteType(), T.ArrayType(T.DoubleType()))
    return T.StructType([T.StructField(name, t) for name, t in zip(LINKS, types, strict=True)])


def _tile_links(rows: DataFrame, compress: bool) -> DataFrame:
    """Rows (tile, f = array of features) -> links u, v that span the touching features of a row.

    With ``compress``, also one row (v NULL) per polygon cluster with the boundary of its union,
    and every line and point as it is: what the cluster still needs to find other neighbours.
    """

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                f = B.one(b.column("f")).slice(i, 1).flatten()
                names, dims = f.field("n"), f.field("dim").to_numpy(zero_copy_only=False)
                tile = b.column("tile").to_numpy()[i: i + 1]
                _, ox, oy = B.unpack(tile)
                hub = _hub(names, f.field("edges"), dims, tile)
                if hub is None:
                    lab, e = _edges_of(f.field("edges"), dims)
                    e[:, 0::2] -= ox[0]
                    e[:, 1::2] -= oy[0]
                    u, v = _clusters(lab, e, dims)
                else:
                    v = np.delete(np.arange(len(f)), hub)
                    u = np.full(len(v), hub)
                n = len(u)
                if n:
                    none = pa.nulls(n)
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array(u)), names.take(pa.array(v)), none.cast(pa.int64()), none.cast(pa.int8()), none.cast(B.EDGES)],
                        names=LINKS,
                    )
                if compress and hub is not None:
                    one = pa.array([hub])
                    yield _piece_rows(names.take(one), tile[0], dims[[hub]], f.field("edges").take(one))
                    continue
                if not compress:
                    continue
                root = np.arange(len(f))
                root[v] = u
                poly = dims[lab] == 2
                who, group = np.unique(root[lab[poly]], return_inverse=True)
                arr = K.Arrangement(group.ravel(), len(who), e[poly], np.zeros(int(poly.sum()), np.int64), 1)
                g, out = arr.boundary(lambda c: c[:, 0] > 0)
                order = np.argsort(g, kind="stable")
                out = out[order] + np.tile([ox[0], oy[0]], 2)
                lists = B.edge_lists(g[order], len(who), out)
                yield _piece_rows(names.take(pa.array(who)), tile[0], np.full(len(who), 2), lists)
                rest = np.flatnonzero(dims != 2)
                if len(rest):
                    yield _piece_rows(names.take(pa.array(root[rest])), tile[0], dims[rest], f.field("edges").take(pa.array(rest)))

    node = rows.schema["f"].dataType.elementType["n"].dataType
    return rows.select("tile", "f").mapInArrow(run, _links_of(node))


def _piece_rows(names, tile, dims, lists):
    n = len(names)
    return pa.RecordBatch.from_arrays(
        [names, pa.nulls(n, names.type), pa.array(np.full(n, tile, np.int64)), pa.array(np.asarray(dims).astype(np.int8)), lists], names=LINKS
    )


def _edges_of(lists, dims):
    """Edges of the features of one tile, polygons first: (feature, edges)."""
    off = B.offsets(lists)
    vals = lists.values.to_numpy(zero_copy_only=False)
    lab, e = [], []
    for width, mask in ((4, dims == 2), (6, dims != 2)):
        which = np.flatnonzero(mask)
        n = (off[which + 1] - off[which]) // width
        lab.append(np.repeat(which, n))
        idx = np.repeat(off[which], n) + K.ranges(n) * width
        e.append(vals[idx[:, None] + np.arange(4)] if len(idx) else np.zeros((0, 4)))
    return np.concatenate(lab), np.concatenate(e)


def _hub(names, lists, dims, tile):
    """Of the features that the whole tile lies in, the one with the smallest name; all others there touch it."""
    off = B.offsets(lists)
    one = np.flatnonzero((np.diff(off) == 4) & (dims == 2))
    edges = lists.values.to_numpy(zero_copy_only=False)[off[one][:, None] + np.arange(4)]
    over = one[_whole(np.repeat(tile, len(one)), edges)]
    if not len(over):
        return None
    own = names.take(pa.array(over))
    return int(over[pc.index(own, pc.min(own)).as_py()])


def _clusters(lab, e, dims):
    """Spanning links (root, feature) of the features of one tile that touch or overlap.

    A few polygons at a time: what they make together goes on as one outline, without the crossings inside of it.
    More at once where that does not halve their number: clusters that lie apart stay as many as they are.
    """
    links, width = [], CHUNK
    while True:
        poly = dims[lab] == 2
        left, at = np.unique(lab[poly], return_inverse=True)
        if len(left) <= width:
            break
        rest, lab, e = (lab[~poly], e[~poly]), lab[poly], e[poly]
        u, v = _touching(lab, e, dims, at.ravel() // width)
        links.append(np.column_stack([u, v]))
        root = np.arange(len(dims))
        root[v] = u
        lab = root[lab]
        joined = np.isin(lab, u)
        who, group = np.unique(lab[joined], return_inverse=True)
        arr = K.Arrangement(group.ravel(), len(who), e[joined], np.zeros(int(joined.sum()), np.int64), 1)
        g, out = arr.boundary(lambda c: c[:, 0] > 0)
        lab, e = np.concatenate([lab[~joined], who[g], rest[0]]), np.concatenate([e[~joined], out, rest[1]])
        if 2 * (len(left) - len(v)) > len(left):
            width *= 4
    u, v = _touching(lab, e, dims)
    if not links:
        return u, v
    pairs = np.concatenate([*links, np.column_stack([u, v])])
    return _spanning_links(np.zeros(len(pairs), np.int64), 1, pairs[:, 0], pairs[:, 1])[1:]


def _touching(lab, e, dims, chunk=None):
    """Spanning links (root, feature) of the features of one tile that touch or overlap, if their edges are of one chunk.

    A feature may come into the tile several times, so the place of each of its edges is looked up.
    """
    none = np.zeros(0, np.int64)
    if not len(lab):
        return none, none
    chunk = np.zeros(len(e), np.int64) if chunk is None else chunk
    n = int(chunk.max()) + 1
    _, _, touch = K.node(chunk, n, e, lab)
    poly = dims[lab] == 2
    q, owner = K.covering(e[poly], lab[poly], e[:, 0], e[:, 1], chunk[poly], chunk, n)
    pairs = np.concatenate([touch[:, 1:], np.column_stack([lab[q], owner])])
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    if not len(pairs):
        return none, none
    _, u, v = _spanning_links(np.zeros(len(pairs), np.int64), 1, pairs[:, 0], pairs[:, 1])
    return u, v


def touching_links(df: DataFrame, plan: TilePlan, node: str, geom: str = "geom") -> DataFrame:
    """Links between features that touch or overlap, thinned to what connects each tile.

    Tiles that cannot be cut further are taken in chunks: each chunk links its own features and
    passes on the outlines of its clusters, which meet those of FAN_IN chunks at a time, round by
    round, until one chunk is left.
    """
    ship(df.sparkSession)
    pieces = split_to_tiles(df, plan, [node], geom).select("tile", F.col(node).alias("n"), "dim", "edges")
    feature = F.collect_set(F.struct("n", "dim", "edges")).alias("f")
    if plan.crowded is None:
        return _tile_links(pieces.groupBy("tile").agg(feature), False).select("u", "v")
    most = plan.crowded.agg(F.max("chunks")).first()[0] or 1
    marked = pieces.join(plan.crowded, "tile", "left")
    links = _tile_links(marked.where("chunks IS NULL").groupBy("tile").agg(feature), False).select("u", "v")
    pile, share = marked.where("chunks IS NOT NULL").select("tile", "n", "dim", "edges", "chunks"), 1
    while most > 1:
        chunk = F.pmod(F.xxhash64("n"), F.ceil(F.col("chunks") / share)).alias("chunk")
        step = checkpoint(_tile_links(pile.groupBy("tile", chunk).agg(feature), True))
        links = links.unionByName(step.where("v IS NOT NULL").select("u", "v"))
        outlines = step.where("v IS NULL").select("tile", F.col("u").alias("n"), "dim", "edges")
        pile, most, share = outlines.join(plan.crowded, "tile"), -(-most // FAN_IN) if most > FAN_IN else 1, share * FAN_IN
    return links.unionByName(_tile_links(pile.groupBy("tile").agg(feature), False).select("u", "v"))


def _shape(parts):
    """Digest of a geometry's vertices: two hashes of the binary values with their nesting, no text is made."""
    sizes = F.transform(parts, lambda part: F.transform(part, F.size))
    return F.concat_ws("-", *[F.hex(F.xxhash64(F.lit(seed), sizes, parts)) for seed in (1, 2)], F.hex(F.hash(parts)))


def cluster_touching(df: DataFrame, key: str, plan: TilePlan | None = None, geom: str = "geom") -> DataFrame:
    """Add ``cluster``: the smallest key among all features connected through touching ones.

    Equal geometries share one node, so a pile of copies costs a star of links, not all pairs.
    """
    plan = plan or plan_tiles([df.withColumnRenamed(geom, "geom")])
    shape = F.concat(F.lit("g"), _shape(F.col(geom)["parts"]))
    shaped = df.select(F.col(key).alias("_key"), shape.alias("_shape"), F.col(geom).alias("geom"))
    distinct = shaped.groupBy("_shape").agg(F.any_value("geom").alias("geom"))
    # links hold a number for a shape; on a checkpoint, so that a task that runs again gives the same numbers
    distinct = checkpoint(distinct.withColumn("_node", F.monotonically_increasing_id()))
    links = touching_links(distinct, plan, "_node")
    label = connected_components(links)
    placed = shaped.select("_key", "_shape").join(distinct.select("_shape", "_node"), "_shape")
    placed = placed.join(label, F.col("_node") == F.col("id"), "left")
    placed = placed.select("_key", F.coalesce("component", "_node").alias("_component"))
    names = placed.groupBy("_component").agg(F.min("_key").alias("cluster"))
    return placed.join(names, "_component").select(F.col("_key").alias(key), "cluster")
