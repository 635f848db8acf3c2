"""Zonal sums and ratio indicators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G

# The result columns in output order, and the unit factors (m2 -> km2, m -> km).
SUM_COLUMNS = ["ArCom", "ArVoiCom", "PeVoiCom", "LeTroCom", "ArUrb", "ArVoiUrb", "PeVoiUrb", "LeTroUrb"]
RESULT_COLUMNS = [
    "num_insee", *SUM_COLUMNS,
    "PaArVoi", "PaLeTro", "PaArVoiCom", "PaArVoiUrb",
    "RaLeArTroCom", "RaLeArTroUrb", "RaPeArVoiCom", "RaPeArVoiUrb",
]
KM2 = 1e-6
KM = 1e-3


def zonal_sum(df: DataFrame, key: str | Sequence[str], prefix: str | None = None, **measures: Column) -> DataFrame:
    """Sum measures per key; with ``prefix``, only keys that start with it."""
    keys = [key] if isinstance(key, str) else list(key)
    if prefix is not None:
        df = df.where(F.col(keys[0]).startswith(prefix))
    return df.groupBy(*keys).agg(*[F.sum(v).alias(k) for k, v in measures.items()])


def zonal_area(df, key, prefix=None, name="area", geom="geom"):
    return zonal_sum(df, key, prefix, **{name: G.area(geom) * KM2})


def zonal_perimeter(df, key, prefix=None, name="perimeter", geom="geom"):
    return zonal_sum(df, key, prefix, **{name: G.perimeter(geom) * KM})


def zonal_length(df, key, prefix=None, name="length", geom="geom"):
    return zonal_sum(df, key, prefix, **{name: G.length(geom) * KM})


def zonal_summary(zones: DataFrame, sums: Sequence[DataFrame], key: str, prefix: str | None = None) -> DataFrame:
    """Zones with their area in km2 and every aggregate in ``sums`` (NULL where there is none).

    An outer join of all of them restricted to zone keys is a left join from the zones.
    """
    out = zones if prefix is None else zones.where(F.col(key).startswith(prefix))
    out = out.select(key, (G.area("geom") * KM2).alias("zone_area"))
    for s in sums:
        out = out.join(s, key, "left")
    return out


def relabel(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give the first names to the columns by position."""
    return df.toDF(*list(names)[: len(df.columns)])


def ratio(a: str, b: str) -> Column:
    return F.try_divide(F.col(a), F.col(b))


def indicators(df: DataFrame) -> DataFrame:
    """Add the eight ratio columns to the nine summed ones, then turn nulls into 0."""
    out = relabel(df, RESULT_COLUMNS)
    out = out.select(
        "*",
        (ratio("ArVoiUrb", "ArVoiCom") * 100).alias("PaArVoi"),
        (ratio("LeTroUrb", "LeTroCom") * 100).alias("PaLeTro"),
        (ratio("ArVoiCom", "ArCom") * 100).alias("PaArVoiCom"),
        (ratio("ArVoiUrb", "ArUrb") * 100).alias("PaArVoiUrb"),
        ratio("LeTroCom", "ArCom").alias("RaLeArTroCom"),
        ratio("LeTroUrb", "ArUrb").alias("RaLeArTroUrb"),
        F.try_divide(F.col("PeVoiCom"), F.sqrt("ArVoiCom")).alias("RaPeArVoiCom"),
        F.try_divide(F.col("PeVoiUrb"), F.sqrt("ArVoiUrb")).alias("RaPeArVoiUrb"),
    )
    return out.fillna(0)
