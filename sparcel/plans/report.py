"""The whole analysis: how much land is given to cars, per zone, for any number of départements.

All départements run in one job: ``dep`` is a grouping column next to the tile key, so there is
no loop and no union that spans more than a tile.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as G
from ..functions.crs import project, project_3d_to_2d
from ..operators import attributes as A
from ..operators import batches as B
from ..operators import kernel as K
from ..operators.overlay import lines_in_region
from ..operators.tiling import TilePlan, plan_tiles, split_to_tiles
from ..operators.union import merge_pieces, region, slices, to_local
from ..session import checkpoint, ship
from .zonal import KM, KM2, indicators, zonal_summary

BUFFER_OFFSET = 2
OVERSEAS = "97%"

# The attribute columns and the categories that count as used by cars / artificial.
LAYER_COLUMNS = {
    "corine": (["id", "code_18", "geom"], ["id", "classe", "geom"]),
    "equipement_ign": (["cleabs", "nature", "geom"], ["cleabs", "nature", "geom"]),
    "equipement_osm": (["osm_id", "fclass", "geom"], ["cleabs", "nature", "geom"]),
    "troncon_ign": (["cleabs", "nature", "largeur_de_chaussee", "geom"], ["cleabs", "nature", "largeur", "geom"]),
}
CATEGORY_COLUMN = {"corine": "code_18", "equipement_ign": "nature", "equipement_osm": "fclass", "troncon_ign": "nature"}
CATEGORIES = {
    "corine": ["111", "112", "121", "122", "123", "124", "131", "132", "133", "141", "142"],
    "equipement_ign": [
        "Aire de repos ou de service", "Autre équipement", "Carrefour", "Parking", "Péage", "Service dédié aux véhicules",
    ],
    "equipement_osm": ["fuel", "parking", "parking_multistorey", "parking_underground", "service"],
    "troncon_ign": ["Bretelle", "Rond-point", "Route à 1 chaussée", "Route à 2 chaussées", "Type autoroutier"],
}


def select_layer(df: DataFrame, layer: str) -> DataFrame:
    """Keep the rows and columns of a source layer that the analysis uses."""
    source, target = LAYER_COLUMNS[layer]
    return A.subset_columns(A.extract_features(df, CATEGORY_COLUMN[layer], CATEGORIES[layer]), source, target)


def prepare_zones(df: DataFrame, code: str = "INSEE_COM", dep: str = "INSEE_DEP") -> DataFrame:
    """Communes: without overseas, multi, in Lambert-93."""
    out = A.delete_like(df, code, OVERSEAS).withColumn("geom", G.to_multi("geom"))
    return project(out).select(F.col(code).alias("insee_com"), F.col(dep).alias("insee_dep"), "geom")


def prepare_layer(df: DataFrame) -> DataFrame:
    """Bring any other layer to 2D multi geometries in Lambert-93."""
    return project_3d_to_2d(df).withColumn("geom", G.to_multi("geom"))


def departements(zones: DataFrame, plan: TilePlan | None = None, dep: str = "insee_dep") -> DataFrame:
    """Union of the zones of every département, as one region with ``dep`` as group."""
    return region(zones, plan, by=[dep])


def crop_roads(roads: DataFrame, deps: DataFrame, plan: TilePlan, key: Sequence[str] = ("cleabs",), dep: str = "insee_dep") -> DataFrame:
    """Pieces of roads inside each département; written once, as several steps start from them."""
    return checkpoint(lines_in_region(deps, roads, plan, [dep], key, [*key, "nature", "largeur"]))


def counted(df: DataFrame, *fields: str) -> DataFrame:
    """Rows alike in geometry and fields as one, with their number as ``copies``."""
    return df.groupBy(*fields, "geom").agg(F.count("*").alias("copies"))


def counted_roads(roads: DataFrame) -> DataFrame:
    """Roads that are alike as one, ``road`` being its key; what the medians and lengths need is kept."""
    return checkpoint(counted(roads, "nature", "largeur").withColumn("road", F.monotonically_increasing_id()))


def fill_widths(pieces: DataFrame, dep: str = "insee_dep") -> DataFrame:
    """Median fill of the widths, a piece counting as often as it has ``copies``."""
    if "copies" not in pieces.columns:
        return A.median_fill(pieces, "largeur", [dep, "nature"])
    return A.median_fill(pieces, "largeur", [dep, "nature"], "copies")


MEASURES = ["car_area", "car_perimeter", "urban_area", "car_urban_area", "car_urban_perimeter", "road_length", "road_urban_length"]


def _tile_measures(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Per zone and tile: area and perimeter of zone ∩ car (∩ urban), road lengths."""
    keep = list(keep)
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField(m, T.DoubleType()) for m in MEASURES])

    def run(batches):
        for b in batches:
            for s in slices(b, "edges", "car", "urban", "lines"):
                n = s.num_rows
                _, ox, oy = B.unpack(s.column("tile").to_numpy())
                row, e = [], []
                for c in ("edges", "car", "urban"):
                    r, v = B.read_edges(s.column(c), 4)
                    row.append(r)
                    e.append(to_local(v, r, ox, oy))
                lab = np.repeat(np.arange(3), [len(r) for r in row])
                arr = K.Arrangement(np.concatenate(row), n, np.concatenate(e), lab, 3)
                out = dict.fromkeys(MEASURES, np.zeros(n))
                for name, need in (("car", [0, 1]), ("urban", [0, 2]), ("car_urban", [0, 1, 2])):
                    g, be = arr.boundary(lambda v, need=need: (v[:, need] > 0).all(axis=1))
                    out[f"{name}_area"] = K.area(g, n, be)
                    if name != "urban":
                        out[f"{name}_perimeter"] = K.perimeter(g, n, be)
                # a tile's lines may come in several chunks; its areas count with the first
                first = (B.one(s.column("chunk")).to_numpy() == 0).astype(float)
                for m in MEASURES[:5]:
                    out[m] = out[m] * first
                r, v = B.read_edges(s.column("lines"), 6)
                copies = v[:, 5]
                v = to_local(v, r, ox, oy)
                p, sub, _, _ = K.line_in_region(row[0], n, e[0], r, v)
                r, copies = r[p], copies[p]
                out["road_length"] = np.bincount(r, K._length(sub) * copies, minlength=n)
                p, sub, _, _ = K.line_in_region(row[2], n, e[2], r, sub)
                out["road_urban_length"] = np.bincount(r[p], K._length(sub) * copies[p], minlength=n)
                cols = [s.column(c) for c in keep] + [pa.array(out[m]) for m in MEASURES]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return rows.mapInArrow(run, schema)


def car_region(
    deps: DataFrame, pieces: DataFrame, equipment: DataFrame, plan: TilePlan, radius: Column | str | None = None, style: str = "round",
    dep: str = "insee_dep",
) -> DataFrame:
    """Car space of every département as a region: buffers of its road pieces, and equipment in every tile it has.

    Cutting equipment at the département changes nothing, as zones lie inside theirs.
    """
    radius = f"largeur + {BUFFER_OFFSET}" if radius is None else radius
    width = F.expr(radius) if isinstance(radius, str) else radius
    wide = fill_widths(pieces, dep).select(dep, "geom", width.alias("_width")).distinct()
    strips = split_to_tiles(wide, plan, [dep], radius="_width", style=style, combine=True).select(dep, "tile", "edges")
    plots = split_to_tiles(equipment.select("geom").distinct(), plan, [], combine=True).select("tile", "edges")
    plots = plots.join(deps.select(dep, "tile"), "tile").select(dep, "tile", "edges")
    return merge_pieces(strips.unionByName(plots), plan, [dep])


def zone_sums(
    zones: DataFrame, equipment: DataFrame, roads: DataFrame, urban: DataFrame, radius: Column | str | None = None,
    style: str = "round", plan: TilePlan | None = None, road_key: Sequence[str] = ("cleabs",),
) -> DataFrame:
    """The five zonal aggregates of the analysis (square metres, metres), one row per zone."""
    ship(zones.sparkSession)
    # land that is covered twice counts once, and roads that are alike count by their number
    equipment, urban = (df.select("geom").distinct() for df in (equipment, urban))
    if radius is None:
        roads, road_key = counted_roads(roads), ("road",)
    else:  # a radius may be an expression of any column
        roads = roads.withColumn("copies", F.lit(1).cast("long"))
    plan = plan or report_plan(zones, equipment, roads, urban)
    dep = "insee_dep"
    deps = departements(zones, plan, dep)
    pieces = crop_roads(roads, deps, plan, (*road_key, "copies"), dep)
    car = car_region(deps, pieces, equipment, plan, radius, style, dep).select(dep, "tile", F.col("edges").alias("car"))
    town = region(urban.select("geom"), plan).select("tile", F.col("edges").alias("urban"))
    own = pieces.groupBy(dep, "geom").agg(F.sum("copies").alias("copies"))
    # the last of the six numbers of an edge of a line, its position, gives way to the number of copies
    weighted = F.transform("edges", lambda v, i: F.when(i % 6 == 5, F.col("copies").cast("double")).otherwise(v))
    lines = split_to_tiles(own, plan, [dep, "copies"]).select(dep, "tile", weighted.alias("edges"))
    chunk = F.lit(0)
    if plan.crowded is not None:
        lines = lines.join(plan.crowded, "tile", "left")
        chunk = F.pmod(F.xxhash64("edges"), F.coalesce("chunks", F.lit(1))).cast("int")
    lines = lines.groupBy(dep, "tile", chunk.alias("chunk")).agg(F.flatten(F.collect_list("edges")).alias("lines"))
    parts = split_to_tiles(zones, plan, ["insee_com", dep]).select("insee_com", dep, "tile", "edges")
    # the light sides meet first: car space and lines are partitioned by (dep, tile) already
    rows = parts.join(town, "tile", "left").join(car, [dep, "tile"], "left")
    rows = rows.join(lines, [dep, "tile"], "left")
    none = F.array().cast("array<double>")
    rows = rows.select(
        "insee_com", "tile", "edges", *[F.coalesce(c, none).alias(c) for c in ("car", "urban", "lines")],
        F.coalesce("chunk", F.lit(0)).alias("chunk"),
    )
    # without lines in chunk 0, the smallest chunk carries the areas
    if plan.crowded is not None:
        low = F.min("chunk").over(_by("insee_com", "tile"))
        rows = rows.withColumn("chunk", F.col("chunk") - low)
    sums = _tile_measures(rows, ["insee_com"])
    return sums.groupBy("insee_com").agg(*[F.sum(m).alias(m) for m in MEASURES])


def _by(*cols):
    from pyspark.sql import Window

    return Window.partitionBy(*cols)


def within_box(df: DataFrame, box: Sequence[float], geom: str = "geom") -> DataFrame:
    """Rows whose bounding box meets ``box``; uses stored boxes (pruned in the scan) if there are any."""
    if not {"xmin", "ymin", "xmax", "ymax"} <= set(df.columns):
        x0, y0, x1, y1 = G.bounds(geom)
        return df.where((x1 >= box[0]) & (y1 >= box[1]) & (x0 <= box[2]) & (y0 <= box[3]))
    return df.where((F.col("xmax") >= box[0]) & (F.col("ymax") >= box[1]) & (F.col("xmin") <= box[2]) & (F.col("ymin") <= box[3]))


def report_plan(zones, equipment, roads, urban) -> TilePlan:
    """Tile plan of the analysis; a road weighs as much as its buffer."""
    layers = [df.select("geom") for df in (zones, equipment, roads, urban)]
    return plan_tiles(layers, weights=[1.0, 1.0, 10.0, 1.0])


def car_space_report(
    zones: DataFrame, equipment: DataFrame, roads: DataFrame, urban: DataFrame, departement: str | None = None,
    radius: Column | str | None = None, style: str = "round", plan: TilePlan | None = None,
    road_key: Sequence[str] = ("cleabs",),
) -> DataFrame:
    """The 17 result columns per zone, for one département or (None) for all of them.

    Layers must be prepared: 2154, 2D, selected rows; zones have ``insee_com`` and ``insee_dep``.
    ``equipment`` holds both equipment layers. A code without any zone is an error.
    """
    if departement is not None:
        code = str(departement).rjust(2, "0")
        zones = zones.where(F.col("insee_dep") == code)
        box = zones.select(*G.bounds()).agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).first()
        if box[0] is None:
            raise ValueError(f"no zones for département {departement}")
        # what does not reach the département cannot count: drop it before anything is cut
        equipment, roads, urban = (within_box(df, box) for df in (equipment, roads, urban))
    stray = F.raise_error(F.concat(F.lit("zone outside its département: "), F.col("insee_com"))).cast("string")
    zones = zones.withColumn("insee_com", F.when(F.startswith("insee_com", "insee_dep"), F.col("insee_com")).otherwise(stray))
    sums = zone_sums(zones, equipment, roads, urban, radius, style, plan, road_key)
    km = sums.select(
        "insee_com",
        (F.col("car_area") * KM2).alias("aire_voiture"), (F.col("car_perimeter") * KM).alias("perimetre_voiture"),
        (F.col("road_length") * KM).alias("longueur_voiture"), (F.col("urban_area") * KM2).alias("aire_urbain"),
        (F.col("car_urban_area") * KM2).alias("aire_voiture_urbain"),
        (F.col("car_urban_perimeter") * KM).alias("perimetre_voiture_urbain"),
        (F.col("road_urban_length") * KM).alias("longueur_voiture_urbain"),
    )
    return indicators(zonal_summary(zones, [km], "insee_com"))
