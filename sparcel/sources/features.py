"""Feature layers: the geometry struct in Parquet, or WKB and WKT next to plain attributes.

A layer keeps its reference system: the struct holds it, WKB carries it as EWKB and WKT as EWKT.
Values that carry none need the ``srid`` argument; without it reading them is an error.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as G
from ..operators import batches as B
from ..operators.relations import create_relation
from ..session import ship

GEOM_COLUMN = "geom"
BOX = ("xmin", "ymin", "xmax", "ymax")


# ------------------------------------------------------------------ WKT, in Catalyst


def from_wkt(text, srid: int = G.TARGET_SRID) -> Column:
    """Parse WKT (z is dropped) by rewriting it to JSON, so it stays in the JVM."""
    t = F.upper(F.trim(F.col(text) if isinstance(text, str) else text))
    kind = F.regexp_extract(t, r"^([A-Z]+)", 1)
    body = F.regexp_extract(t, r"^[A-Z ]*?(\(.*\))$", 1)
    number = r"[-+0-9.E]+"
    body = F.regexp_replace(body, rf"({number})\s+({number})(\s+{number})*", r'{"x":$1,"y":$2}')
    body = F.translate(body, "()", "[]")
    # multi points come with or without inner parentheses
    dots = F.regexp_replace(body, r"\[(\{[^}]*\})\]", "$1")
    dots = F.regexp_replace(dots, r"(\{[^}]*\})", "[[$1]]")
    lines = F.regexp_replace(body, r"(\[\{[^\]]*\])", "[$1]")
    json = (
        F.when(kind == "POINT", F.concat(F.lit("[["), body, F.lit("]]")))
        .when(kind == "LINESTRING", F.concat(F.lit("[["), body, F.lit("]]")))
        .when(kind == "POLYGON", F.concat(F.lit("["), body, F.lit("]")))
        .when(kind == "MULTIPOINT", F.when(dots.startswith("[[["), dots).otherwise(F.concat(F.lit("["), dots, F.lit("]"))))
        .when(kind == "MULTILINESTRING", lines)
        .when(kind == "MULTIPOLYGON", body)
    )
    parts = F.from_json(json, G.PARTS)
    dim = F.when(kind.endswith("POINT"), 0).when(kind.endswith("LINESTRING"), 1).when(kind.endswith("POLYGON"), 2)
    bad = F.raise_error(F.concat(F.lit("not WKT: "), F.substring(t, 1, 60))).cast(G.PARTS)
    parts = F.when(dim.isNotNull() & parts.isNotNull(), parts).otherwise(bad)
    g = F.struct(
        F.lit(srid).alias("srid"), dim.cast("tinyint").alias("dim"), kind.startswith("MULTI").alias("multi"), parts.alias("parts")
    )
    return F.when(t.isNotNull(), g)


def to_wkt(geom="geom") -> Column:
    g = F.col(geom) if isinstance(geom, str) else geom
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(r, lambda v: F.concat_ws(" ", v.x, v.y)), ", "), F.lit(")"))
    first = lambda p: F.get(p, F.lit(0))
    polygon = lambda p: F.concat(F.lit("("), F.array_join(F.transform(p, ring), ", "), F.lit(")"))
    each = F.when(g["dim"] == 2, F.transform(g["parts"], polygon)).otherwise(F.transform(g["parts"], lambda p: ring(first(p))))
    kind = F.upper(F.substring(G.type_name(g), 4, 30))
    body = F.when(g["multi"], F.concat(F.lit("("), F.array_join(each, ", "), F.lit(")"))).otherwise(F.get(each, F.lit(0)))
    return F.when(g.isNotNull(), F.concat(kind, F.lit(" "), body))


# ------------------------------------------------------------------ WKB, in Arrow batches


def wkb_srid(buf: bytes) -> int | None:
    """The reference system that an EWKB value carries."""
    order = "<" if buf[0] == 1 else ">"
    code = struct.unpack_from(order + "I", buf, 1)[0]
    return struct.unpack_from(order + "I", buf, 5)[0] or None if code & 0x20000000 else None


def _parse_wkb(buf: bytes, at: int = 0):
    """One WKB value -> (dimension, multi, parts, next offset); z and m are dropped."""
    order = "<" if buf[at] == 1 else ">"
    code = struct.unpack_from(order + "I", buf, at + 1)[0]
    at += 5 + (4 if code & 0x20000000 else 0)
    extra = bool(code & 0x80000000) + bool(code & 0x40000000)
    base = code & 0x0FFFFFFF
    extra += {0: 0, 1: 1, 2: 1, 3: 2}[base // 1000]
    base %= 1000
    width = 2 + extra

    def points(at, n):
        a = np.frombuffer(buf, dtype=order + "f8", count=n * width, offset=at).reshape(n, width)
        return a[:, :2].astype(float), at + n * width * 8

    def count(at):
        return struct.unpack_from(order + "I", buf, at)[0], at + 4

    if base == 1:
        p, at = points(at, 1)
        return 0, False, [] if np.isnan(p).any() else [[p]], at
    if base == 2:
        n, at = count(at)
        p, at = points(at, n)
        return 1, False, [[p]] if n else [], at
    if base == 3:
        n, at = count(at)
        rings = []
        for _ in range(n):
            k, at = count(at)
            p, at = points(at, k)
            rings.append(p)
        return 2, False, [rings] if n else [], at
    if base in (4, 5, 6):
        n, at = count(at)
        parts = []
        for _ in range(n):
            _, _, sub, at = _parse_wkb(buf, at)
            parts += sub
        return base - 4, True, parts, at
    raise ValueError(f"WKB geometry type {base} is not supported")


def _write_wkb(dim: int, multi: bool, parts, srid: int | None = None) -> bytes:
    def single(part):
        head = struct.pack("<BI", 1, dim + 1)
        if dim == 0:
            return head + part[0][:1].tobytes()
        if dim == 1:
            return head + struct.pack("<I", len(part[0])) + part[0].tobytes()
        return head + struct.pack("<I", len(part)) + b"".join(struct.pack("<I", len(r)) + r.tobytes() for r in part)

    if multi or len(parts) != 1:
        out = struct.pack("<BII", 1, dim + 4, len(parts)) + b"".join(single(p) for p in parts)
    else:
        out = single(parts[0])
    if not srid:
        return out
    code = struct.unpack_from("<I", out, 1)[0]
    return struct.pack("<BII", 1, code | 0x20000000, srid) + out[5:]


def decode_wkb(df: DataFrame, column: str, srid: int | None = None, geom: str = "geom") -> DataFrame:
    """Replace a WKB column by a geometry column; ``srid`` is for values that carry none."""
    ship(df.sparkSession)
    keep = [c for c in df.columns if c != column]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(geom, G.GEOM)])

    def run(batches):
        for b in batches:
            dims, multis, parts = [], [], []
            raw = b.column(len(keep)).to_pylist()
            for v in raw:
                d, m, p, _ = (0, False, [], 0) if v is None else _parse_wkb(v)
                dims.append(d)
                multis.append(m)
                parts.append(p)
            g = B.polygons_to_arrow(parts, srid or 0)
            null = pa.array([v is None for v in raw], pa.bool_())
            own = [srid if v is None else wkb_srid(v) or srid for v in raw]
            if any(s is None for s, v in zip(own, raw) if v is not None):
                raise ValueError("a WKB value carries no reference system: name it with srid")
            g = pa.StructArray.from_arrays(
                [pa.array(own, g.field(0).type), pa.array(dims, pa.int8()), pa.array(multis, pa.bool_()), g.field(3)], fields=list(B.ARROW_GEOM), mask=null
            )
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(keep))] + [g], names=schema.names)

    return df.select(*keep, column).mapInArrow(run, schema)


def encode_wkb(df: DataFrame, column: str = "wkb", geom: str = "geom") -> DataFrame:
    """Replace the geometry column by an EWKB column, which carries the reference system."""
    ship(df.sparkSession)
    keep = [c for c in df.columns if c != geom]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(column, T.BinaryType())])

    def run(batches):
        for b in batches:
            out = []
            for v in b.column(len(keep)).to_pylist():
                if v is None or v["parts"] is None:
                    out.append(None)
                    continue
                parts = [[np.array([[q["x"], q["y"]] for q in r], dtype="<f8").reshape(-1, 2) for r in p] for p in v["parts"]]
                out.append(_write_wkb(v["dim"], v["multi"], parts, v["srid"]))
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(keep))] + [pa.array(out, pa.binary())], names=schema.names)

    return df.select(*keep, geom).mapInArrow(run, schema)


# ------------------------------------------------------------------ layers


def write_layer(df: DataFrame, path: str, bounds: bool = True, geom: str = "geom") -> None:
    """Store a layer as Parquet with its geometry struct and, for scan pruning, its bounding boxes.

    Nothing is encoded, so scans read the nested fields they need and no more. Other programs take
    ``encode_wkb``.
    """
    out = G.with_bounds(df, geom) if bounds else df
    out.withColumnRenamed(geom, GEOM_COLUMN).write.mode("overwrite").parquet(path)


def save_layer(df: DataFrame, name: str, geom: str = "geom") -> None:
    """Store a layer as a table, replacing an older one once it is written."""
    create_relation(G.with_bounds(df, geom).withColumnRenamed(geom, GEOM_COLUMN), name)


def read_features(
    spark: SparkSession, path: str, layer: str | None = None, column: str | None = None, encoding: str | None = None,
    srid: int | None = None, columns: Sequence[str] | None = None, box: Sequence[float] | None = None, keep_bounds: bool = False,
    fmt: str = "parquet", geom: str = "geom", **options,
) -> DataFrame:
    """Read a layer: a geometry, WKB or WKT column of any Spark format, or ``shapefile`` / ``gpkg`` files.

    Without ``encoding`` and ``column`` the layer is one that ``write_layer`` stored, or has a column
    ``wkb``. The reference system is that of the data; ``srid`` stands in where values carry none.

    ``layer`` names a sub-folder of ``path`` holding several layers. ``box`` (xmin, ymin, xmax,
    ymax) prunes on the stored bounding boxes inside the scan; ``columns`` limits the attributes;
    ``keep_bounds`` keeps the stored boxes as columns, for later pruning.
    """
    if fmt in ("shapefile", "gpkg"):
        from .files import SOURCES

        ship(spark)
        spark.dataSource.register(SOURCES[fmt])
        extra = {"layer": layer} if layer is not None else {}
        out = spark.read.format(SOURCES[fmt].name()).options(**({"srid": srid} if srid is not None else {}), **extra, **options).load(path)
        attrs = [c for c in out.columns if c != "geom"] if columns is None else list(columns)
        return out.select(*attrs, F.col("geom").alias(geom))
    where = path if layer is None else f"{path.rstrip('/')}/{layer}"
    df = spark.read.format(fmt).options(**options).load(where)
    if box is not None:
        df = df.where((F.col("xmax") >= box[0]) & (F.col("ymax") >= box[1]) & (F.col("xmin") <= box[2]) & (F.col("ymin") <= box[3]))
    if encoding is None:
        encoding = "native" if column is None and GEOM_COLUMN in df.columns else "wkb"
    column = column or (GEOM_COLUMN if encoding == "native" else encoding)
    drop = (column,) if keep_bounds else (column, *BOX)
    attrs = [c for c in df.columns if c not in drop] if columns is None else list(columns)
    df = df.select(*attrs, column)
    if encoding == "native":
        return df.select(*attrs, F.col(column).alias(geom))
    if encoding == "wkt":
        own = F.nullif(F.regexp_extract(column, r"(?i)^\s*SRID\s*=\s*(\d+)\s*;", 1), F.lit("")).cast("int")
        missing = F.raise_error(F.lit("a WKT value carries no reference system: name it with srid")).cast("int")
        system = F.coalesce(own, F.lit(srid).cast("int") if srid is not None else missing)
        shape = from_wkt(F.regexp_replace(column, r"(?i)^\s*SRID\s*=\s*\d+\s*;\s*", ""), srid or 0)
        return df.select(*attrs, F.when(F.col(column).isNotNull(), shape.withField("srid", system)).alias(geom))
    if encoding != "wkb":
        raise ValueError(f"unknown geometry encoding: {encoding}")
    return decode_wkb(df, column, srid, geom)
