"""Checks of a layer's geometry type and reference system."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G


def geometry_types(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Distinct ``ST_*`` type names of a layer (column ``type``)."""
    g = F.col(geom)
    return df.where(g.isNotNull()).select(g["dim"].alias("dim"), g["multi"].alias("multi")).distinct().select(
        G.type_name(F.struct("dim", "multi")).alias("type")
    )


def srids(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Distinct reference systems of a layer (column ``srid``)."""
    return df.where(F.col(geom).isNotNull()).select(F.col(geom)["srid"].alias("srid")).distinct()


def layer_facts(*layers: DataFrame, geom: str = "geom") -> list[dict]:
    """First and last type name and SRID of every layer, from one job over four nested fields.

    Values are None for an empty layer.
    """
    g = F.col(geom)
    kind = G.type_name(F.struct(g["dim"].alias("dim"), g["multi"].alias("multi")))
    rows = None
    for k, df in enumerate(layers):
        r = df.where(g.isNotNull()).select(F.lit(k).alias("layer"), kind.alias("kind"), g["srid"].alias("srid"))
        rows = r if rows is None else rows.unionByName(r)
    found = {
        r["layer"]: r.asDict()
        for r in rows.groupBy("layer").agg(
            F.min("kind").alias("low"), F.max("kind").alias("high"), F.min("srid").alias("srid_low"), F.max("srid").alias("srid_high")
        ).collect()
    }
    empty = {"low": None, "high": None, "srid_low": None, "srid_high": None}
    return [found.get(k, empty) for k in range(len(layers))]


def one_type(facts: dict, allow_multi: bool = True) -> str | None:
    if facts["low"] is None:
        return None
    if facts["low"] != facts["high"]:
        raise ValueError("layer has more than one geometry type")
    name = facts["low"][3:]
    return name if allow_multi else name.removeprefix("Multi")


def one_srid(*facts: dict) -> int | None:
    """The SRID that all layers share; ValueError if they do not."""
    found = set()
    for f in facts:
        if f["srid_low"] != f["srid_high"]:
            raise ValueError("layer mixes reference systems")
        if f["srid_low"] is not None:
            found.add(f["srid_low"])
    if len(found) > 1:
        raise ValueError("layers do not share the same SRID")
    return found.pop() if found else None


def single_type(df: DataFrame, geom: str = "geom", allow_multi: bool = True) -> str | None:
    """Plain name of the layer's only geometry type; None for an empty layer.

    ValueError if there are several.
    """
    return one_type(layer_facts(df, geom=geom)[0], allow_multi)


def layer_srid(df: DataFrame, geom: str = "geom") -> int | None:
    """The layer's only SRID; None for an empty layer, ValueError if mixed."""
    return one_srid(layer_facts(df, geom=geom)[0])


def same_srid(a: DataFrame, b: DataFrame, geom: str = "geom") -> bool:
    x, y = (one_srid(f) for f in layer_facts(a, b, geom=geom))
    return x is None or y is None or x == y


def assert_same_srid(a: DataFrame, b: DataFrame, geom: str = "geom") -> DataFrame:
    """Stack the geometry of two layers (keeping duplicates); ValueError if their SRIDs differ."""
    one_srid(*layer_facts(a, b, geom=geom))
    return union_all(a, b, geom)


def union_all(a: DataFrame, b: DataFrame, geom: str = "geom") -> DataFrame:
    return a.select(F.col(geom).alias("geom")).unionByName(b.select(F.col(geom).alias("geom")))


def assert_geom(df: DataFrame, kind: str, srid: int, geom: str = "geom") -> DataFrame:
    """Row-wise constraint: geometry must be of ``kind`` (e.g. ``MultiPolygon``) and ``srid``.

    Evaluated inside the scan, so it costs no job of its own; a mismatch fails the query.
    """
    g = F.col(geom)
    name = F.coalesce(G.plain_type(G.type_name(g)), F.lit("NULL"))
    text = F.concat(F.lit(f"expected {kind} in SRID {srid}, found "), name, F.lit(" in "), F.coalesce(g["srid"].cast("string"), F.lit("NULL")))
    bad = F.raise_error(text).cast(df.schema[geom].dataType)
    return df.withColumn(geom, F.when(g.isNull() | ((name == kind) & (g["srid"] == srid)), g).otherwise(bad))
