"""Reprojection to Lambert-93 (2154) as column expressions.

Formulas: J. P. Snyder, Map Projections - A Working Manual (USGS 1395, 1987), Lambert conformal
conic with two standard parallels and the spherical Mercator inverse. WGS 84 and RGF93 are
treated as the same datum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import geometry as G

# GRS80 ellipsoid, Lambert-93 parameters (degrees, metres), Mercator sphere radius.
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101
PARALLEL_1 = 44.0
PARALLEL_2 = 49.0
LATITUDE_0 = 46.5
LONGITUDE_0 = 3.0
FALSE_EASTING = 700000.0
FALSE_NORTHING = 6600000.0
MERCATOR_R = 6378137.0

SUPPORTED = (4326, 3857, 2154)

_E = math.sqrt(GRS80_F * (2 - GRS80_F))


def _m(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - (_E * math.sin(lat)) ** 2)


def _t(lat: float) -> float:
    s = _E * math.sin(lat)
    return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (_E / 2)


_P1, _P2, _P0 = (math.radians(d) for d in (PARALLEL_1, PARALLEL_2, LATITUDE_0))
CONE = (math.log(_m(_P1)) - math.log(_m(_P2))) / (math.log(_t(_P1)) - math.log(_t(_P2)))
_SCALE = GRS80_A * _m(_P1) / (CONE * _t(_P1) ** CONE)
_RHO_0 = _SCALE * _t(_P0) ** CONE


def lonlat_to_l93(lon: Column, lat: Column) -> tuple[Column, Column]:
    phi = F.radians(lat)
    s = F.sin(phi) * _E
    t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(_E / 2))
    rho = F.pow(t, F.lit(CONE)) * _SCALE
    theta = (F.radians(lon) - math.radians(LONGITUDE_0)) * CONE
    return rho * F.sin(theta) + FALSE_EASTING, F.lit(_RHO_0) - rho * F.cos(theta) + FALSE_NORTHING


def mercator_to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    lat = math.pi / 2 - 2 * F.atan(F.exp(-y / MERCATOR_R))
    return F.degrees(x / MERCATOR_R), F.degrees(lat)


def to_l93(geom="geom") -> Column:
    """Reproject every vertex; the source system is read from the geometry itself.

    z, where present, is kept. Systems other than ``SUPPORTED`` are an error.
    """
    g = F.col(geom) if isinstance(geom, str) else geom

    def with_xy(v: Column, xy) -> Column:
        return v.withField("x", xy[0]).withField("y", xy[1])

    deg = G.map_vertices(g, lambda v: with_xy(v, lonlat_to_l93(v.x, v.y)))
    merc = G.map_vertices(g, lambda v: with_xy(v, lonlat_to_l93(*mercator_to_lonlat(v.x, v.y))))
    s = g["srid"]
    known = F.when(s.isin(*SUPPORTED), F.lit(2154)).otherwise(
        F.raise_error(F.concat(F.lit("no reprojection from SRID "), F.coalesce(s.cast("string"), F.lit("NULL")))).cast("int")
    )
    parts = F.when(s == 4326, deg["parts"]).when(s == 3857, merc["parts"]).otherwise(g["parts"])
    return F.when(g.isNotNull(), g.withField("srid", known).withField("parts", parts))


def project(df: DataFrame, srid: int = 2154, geom: str = "geom") -> DataFrame:
    """Reproject a layer, as the first step of preparing it."""
    if srid != 2154:
        raise ValueError(f"target SRID {srid} is not supported")
    return df.withColumn(geom, to_l93(geom))


def project_3d_to_2d(df: DataFrame, srid: int = 2154, geom: str = "geom") -> DataFrame:
    """Reproject and drop z."""
    out = project(df, srid, geom)
    return out.withColumn(geom, G.force_2d(geom)) if G.has_z(df, geom) else out
