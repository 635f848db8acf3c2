"""Geometry values and their functions, as plain Catalyst expressions.

A geometry is a struct column: spatial reference id, dimension (0 point, 1 line, 2 polygon),
whether it is declared a multi geometry, and its parts (part -> ring -> vertex). A point is one
part with one ring of one vertex; a line has one ring per part; a polygon has its shell first,
then its holes, all closed. The kind of a 3D layer is visible in its schema: vertices carry z.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
PARTS = T.ArrayType(T.ArrayType(T.ArrayType(VERTEX)))
GEOM = T.StructType([
    T.StructField("srid", T.IntegerType()),
    T.StructField("dim", T.ByteType()),
    T.StructField("multi", T.BooleanType()),
    T.StructField("parts", PARTS),
])
GEOM_DDL = (
    "struct<srid:int,dim:tinyint,multi:boolean,"
    "parts:array<array<array<struct<x:double,y:double>>>>>"
)

TARGET_SRID = 2154
QUARTER_SEGMENTS = 8


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ constructors


def vertex(x, y) -> Column:
    return F.struct(_c(x).cast("double").alias("x"), _c(y).cast("double").alias("y"))


def make_geom(dim: int, parts: Column, srid=TARGET_SRID, multi=False) -> Column:
    srid = srid if isinstance(srid, Column) else F.lit(srid)
    multi = multi if isinstance(multi, Column) else F.lit(multi)
    return F.struct(
        srid.cast("int").alias("srid"), F.lit(dim).cast("tinyint").alias("dim"),
        multi.cast("boolean").alias("multi"), parts.alias("parts"),
    )


def point(x, y, srid=TARGET_SRID) -> Column:
    return make_geom(0, F.array(F.array(F.array(vertex(x, y)))), srid)


def segment(x0, y0, x1, y1, srid=TARGET_SRID) -> Column:
    return make_geom(1, F.array(F.array(F.array(vertex(x0, y0), vertex(x1, y1)))), srid)


def rectangle(x0, y0, x1, y1, srid=TARGET_SRID) -> Column:
    ring = F.array(vertex(x0, y0), vertex(x1, y0), vertex(x1, y1), vertex(x0, y1), vertex(x0, y0))
    return make_geom(2, F.array(F.array(ring)), srid)


# ------------------------------------------------------------------ measures


def _steps(ring: Column, f) -> Column:
    """Sum of ``f(a, b)`` over consecutive vertices."""
    n = F.size(ring)
    body = F.zip_with(F.slice(ring, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(ring, F.lit(2), F.greatest(n - 1, F.lit(0))), f)
    return F.aggregate(body, F.lit(0.0), lambda s, v: s + v)


def _ring_area(ring: Column) -> Column:
    o = F.get(ring, F.lit(0))
    cross = _steps(ring, lambda a, b: (a.x - o.x) * (b.y - o.y) - (b.x - o.x) * (a.y - o.y))
    return F.abs(cross) / 2


def _ring_length(ring: Column) -> Column:
    return _steps(ring, lambda a, b: F.sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)))


def _sum(array: Column, f) -> Column:
    return F.aggregate(F.transform(array, f), F.lit(0.0), lambda s, v: s + v)


def _when_dim(g: Column, dim: int, value: Column) -> Column:
    return F.when(g.isNull(), F.lit(None)).when(g["dim"] == dim, value).otherwise(F.lit(0.0))


def area(geom="geom") -> Column:
    """Planar area; holes subtract; 0 for lines and points."""
    g = _c(geom)
    part = lambda p: 2 * _ring_area(F.get(p, F.lit(0))) - _sum(p, _ring_area)
    return _when_dim(g, 2, _sum(g["parts"], part))


def perimeter(geom="geom") -> Column:
    """Length of all rings of polygons; 0 for lines and points."""
    g = _c(geom)
    return _when_dim(g, 2, _sum(F.flatten(g["parts"]), _ring_length))


def length(geom="geom") -> Column:
    """Length of lines; 0 for polygons and points."""
    g = _c(geom)
    return _when_dim(g, 1, _sum(F.flatten(g["parts"]), _ring_length))


def dimension(geom="geom") -> Column:
    return _c(geom)["dim"].cast("int")


def srid(geom="geom") -> Column:
    return _c(geom)["srid"]


def vertex_count(geom="geom") -> Column:
    rings = F.flatten(_c(geom)["parts"])
    return F.aggregate(rings, F.lit(0), lambda s, r: s + F.size(r))


def bounds(geom="geom") -> list[Column]:
    """xmin, ymin, xmax, ymax."""
    verts = F.flatten(F.flatten(_c(geom)["parts"]))
    x, y = F.transform(verts, lambda v: v.x), F.transform(verts, lambda v: v.y)
    return [
        F.array_min(x).alias("xmin"), F.array_min(y).alias("ymin"),
        F.array_max(x).alias("xmax"), F.array_max(y).alias("ymax"),
    ]


def with_bounds(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Add the pruning columns; filters on them reach the Parquet scan of a stored layer."""
    return df.select("*", *bounds(geom))


# ------------------------------------------------------------------ types


def type_name(geom="geom") -> Column:
    """``ST_Polygon``, ``ST_MultiLineString``, ..."""
    g = _c(geom)
    kind = F.when(g["dim"] == 0, "Point").when(g["dim"] == 1, "LineString").when(g["dim"] == 2, "Polygon")
    return F.concat(F.lit("ST_"), F.when(g["multi"], "Multi").otherwise(""), kind)


def plain_type(name, allow_multi: bool = True) -> Column:
    """Strip the ``ST_`` prefix (an error without it) and, if asked, the ``Multi`` prefix."""
    n = _c(name)
    text = F.substring(n, 4, 100)
    if not allow_multi:
        text = F.regexp_replace(text, "^Multi", "")
    bad = F.raise_error(F.concat(F.lit("not a geometry type name: "), n)).cast("string")
    return F.when(n.startswith("ST_"), text).otherwise(F.when(n.isNotNull(), bad))


def _replace(g: Column, **fields) -> Column:
    for k, v in fields.items():
        g = g.withField(k, v)
    return g


def to_multi(geom="geom") -> Column:
    return _replace(_c(geom), multi=F.lit(True))


def force_2d(geom="geom") -> Column:
    """Drop z from every vertex."""
    g = _c(geom)
    flat = F.transform(g["parts"], lambda p: F.transform(p, lambda r: F.transform(r, lambda v: vertex(v.x, v.y))))
    return F.when(g.isNotNull(), F.struct(g["srid"].alias("srid"), g["dim"].alias("dim"), g["multi"].alias("multi"), flat.alias("parts")))


def has_z(df: DataFrame, geom: str = "geom") -> bool:
    kind = df.schema[geom].dataType["parts"].dataType.elementType.elementType.elementType
    return "z" in kind.fieldNames()


def map_vertices(geom, f) -> Column:
    """Apply ``f(vertex) -> vertex`` to every vertex."""
    g = _c(geom)
    return _replace(g, parts=F.transform(g["parts"], lambda p: F.transform(p, lambda r: F.transform(r, f))))


def dump(df: DataFrame, geom: str = "geom", index: str | None = None) -> DataFrame:
    """One row per part, each a single geometry."""
    rest = [c for c in df.columns if c != geom]
    g = F.col(geom)
    out = df.select(*rest, g["srid"].alias("_s"), g["dim"].alias("_d"), F.posexplode(g["parts"]).alias("_i", "_p"))
    single = F.struct(
        F.col("_s").alias("srid"), F.col("_d").alias("dim"), F.lit(False).alias("multi"),
        F.array("_p").alias("parts"),
    ).alias(geom)
    cols = [F.col("_i").alias(index)] if index else []
    return out.select(*rest, *cols, single)


# ------------------------------------------------------------------ buffer


def _capsule(a: Column, b: Column, r: Column) -> Column:
    """Ring around one segment: half circle at each end, 2 x 8 chords each."""
    n = 2 * QUARTER_SEGMENTS
    heading = F.when((a.x == b.x) & (a.y == b.y), F.lit(0.0)).otherwise(F.atan2(b.y - a.y, b.x - a.x))

    def ring(h: Column) -> Column:
        def at(c: Column, turn: float, i: Column) -> Column:
            angle = h + F.lit(turn) + i * F.lit(math.pi / n)
            return vertex(c.x + r * F.cos(angle), c.y + r * F.sin(angle))

        def cap(c: Column, turn: float) -> Column:
            return F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: at(c, turn, i))

        # the first vertex again, by itself: a ring that is named twice is made twice
        return F.concat(cap(b, -math.pi / 2), cap(a, math.pi / 2), F.array(at(b, -math.pi / 2, F.lit(0))))

    return F.get(F.transform(F.array(heading), ring), F.lit(0))


def _box(a: Column, b: Column, r: Column) -> Column:
    """Ring around one segment with square ends."""
    ln = F.sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y))
    ux = F.when(ln == 0, F.lit(1.0)).otherwise((b.x - a.x) / F.nullif(ln, F.lit(0.0)))
    uy = F.when(ln == 0, F.lit(0.0)).otherwise((b.y - a.y) / F.nullif(ln, F.lit(0.0)))

    def corner(c, along, side):
        return vertex(c.x + r * (along * ux - side * uy), c.y + r * (along * uy + side * ux))

    ring = [corner(a, -1, -1), corner(b, 1, -1), corner(b, 1, 1), corner(a, -1, 1)]
    return F.array(*ring, ring[0])


def buffer(geom="geom", radius="radius", style: str = "round") -> Column:
    """Multi polygon of everything within ``radius``; NULL radius gives NULL.

    One convex ring per segment (plus the polygon itself): their union is the buffer. The parts
    may overlap, so measure it through a union. ``style``: ``round`` or ``square`` ends.
    """
    if style not in ("round", "square"):
        raise ValueError(f"unknown buffer style: {style}")
    g, r = _c(geom), _c(radius).cast("double")
    shape = _capsule if style == "round" else _box

    def ring_parts(ring: Column) -> Column:
        n = F.size(ring)
        ends = F.when(n < 2, ring).otherwise(F.slice(ring, F.lit(2), F.greatest(n - 1, F.lit(1))))
        starts = F.slice(ring, F.lit(1), F.greatest(n - 1, F.lit(1)))
        return F.zip_with(starts, ends, lambda a, b: F.array(shape(a, b, r)))

    around = F.flatten(F.transform(F.flatten(g["parts"]), ring_parts))
    parts = F.when(g["dim"] == 2, F.concat(g["parts"], around)).otherwise(around)
    negative = F.raise_error(F.lit("negative buffer radius")).cast(PARTS)
    parts = F.when(r < 0, negative).when(r == 0, F.when(g["dim"] == 2, g["parts"]).otherwise(F.array().cast(PARTS))).otherwise(parts)
    return F.when(g.isNotNull() & r.isNotNull(), make_geom(2, parts, g["srid"], True))
