"""Shapefile and GeoPackage layers as Spark data sources.

Every file is cut into record ranges, one Spark partition each, so many files (one per
département, say) are read in one job. Files must lie where all executors can open them. z and m
values are dropped while reading.
"""

from __future__ import annotations

import glob
import os
import re
import sqlite3
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import geometry as G
from ..operators import batches as B
from ..operators import kernel as K
from .features import _parse_wkb

ROWS_PER_PARTITION = 100_000
ROWS_PER_BATCH = 5_000
ARROW = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), T.BooleanType(): pa.bool_(), T.BinaryType(): pa.binary()}


class Range(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


def _files(path: str, ending: str) -> list[str]:
    found = sorted(glob.glob(os.path.join(path, "*" + ending)) if os.path.isdir(path) else glob.glob(path))
    if not found:
        raise FileNotFoundError(f"no {ending} file at {path}")
    return found


def _geometry(items, srid: int) -> pa.StructArray:
    """items: (dim, multi, parts) or None."""
    g = B.polygons_to_arrow([[] if v is None else v[2] for v in items], srid)
    dims = pa.array([0 if v is None else v[0] for v in items], pa.int8())
    multi = pa.array([bool(v and v[1]) for v in items], pa.bool_())
    null = pa.array([v is None for v in items], pa.bool_())
    return pa.StructArray.from_arrays([g.field(0), dims, multi, g.field(3)], fields=list(B.ARROW_GEOM), mask=null)


class _Layer(DataSource):
    ending = ""

    def _paths(self):
        return _files(self.options["path"], self.ending)

    def _srid(self):
        """The system named by the caller; else files have to name theirs."""
        return int(self.options["srid"]) if "srid" in self.options else None


class _Reader(DataSourceReader):
    def __init__(self, source, schema):
        self.paths, self.schema, self.srid = source._paths(), schema, source._srid()
        self.step = int(source.options.get("rowsPerPartition", ROWS_PER_PARTITION))
        self.layer = source.options.get("layer")

    def partitions(self):
        out = []
        for p in self.paths:
            lo, hi = self.extent(p)
            out += [Range(p, s, min(s + self.step, hi)) for s in range(lo, hi, self.step)]
        return out or [Range(self.paths[0], 0, 0)]

    def _batch(self, columns, shapes, names, srid):
        """``columns`` by ``names``: those of the file, which may stand in another order than the schema's."""
        fields = [f for f in self.schema.fields if f.name != "geom"]
        by_name = dict(zip(names, columns))
        if set(by_name) != {f.name for f in fields}:
            raise ValueError(f"files of one layer have other columns: {sorted(by_name)} and {sorted(f.name for f in fields)}")
        if srid is None:
            raise ValueError("the file names no known reference system: name it with srid")
        cols = [pa.array(by_name[f.name], ARROW[f.dataType]) for f in fields]
        return pa.RecordBatch.from_arrays(cols + [_geometry(shapes, srid)], names=[f.name for f in fields] + ["geom"])


# ------------------------------------------------------------------ shapefile


# Names of reference systems in .prj files.
PRJ_NAMES = {
    "RGF_1993_Lambert_93": 2154, "RGF93_Lambert_93": 2154, "RGF93 / Lambert-93": 2154, "RGF93 v1 / Lambert-93": 2154,
    "GCS_WGS_1984": 4326, "WGS 84": 4326, "WGS_1984_Web_Mercator_Auxiliary_Sphere": 3857, "WGS 84 / Pseudo-Mercator": 3857,
}


def _dbf_fields(path: str):
    """(header size, record size, [(name, type, offset, width, decimals)])."""
    with open(path[:-4] + ".dbf", "rb") as f:
        head = f.read(32)
        size, width = struct.unpack_from("<HH", head, 8)
        body = f.read(size - 32)
    fields, at = [], 1
    for k in range(0, len(body) - 31, 32):
        if body[k] == 0x0D:
            break
        name = body[k:k + 11].split(b"\0")[0].decode("latin-1")
        fields.append((name, chr(body[k + 11]), at, body[k + 16], body[k + 17]))
        at += body[k + 16]
    return size, width, fields


def _dbf_type(kind: str, decimals: int):
    if kind in "NF":
        return T.LongType() if kind == "N" and decimals == 0 else T.DoubleType()
    return T.BooleanType() if kind == "L" else T.StringType()


def _dbf_value(raw: bytes, kind: str, decimals: int, encoding: str):
    text = raw.decode(encoding, "replace").strip().strip("\0")
    if kind == "L":
        return None if text in ("", "?") else text in "YyTt"
    if kind in "NF":
        if not text or text.startswith("*"):
            return None
        return int(float(text)) if kind == "N" and decimals == 0 else float(text)
    return text or None


def _shape(buf: bytes):
    """One shapefile record -> (dim, multi, parts) or None."""
    kind = struct.unpack_from("<i", buf, 0)[0] % 10
    if kind == 0:
        return None
    if kind == 1:
        return 0, False, [[np.frombuffer(buf, "<f8", 2, 4).reshape(1, 2)]]
    if kind == 8:
        n = struct.unpack_from("<i", buf, 36)[0]
        xy = np.frombuffer(buf, "<f8", 2 * n, 40).reshape(n, 2)
        return 0, True, [[p.reshape(1, 2)] for p in xy]
    n_parts, n = struct.unpack_from("<ii", buf, 36)
    cut = np.frombuffer(buf, "<i4", n_parts, 44)
    xy = np.frombuffer(buf, "<f8", 2 * n, 44 + 4 * n_parts).reshape(n, 2)
    rings = np.split(xy, cut[1:])
    if kind == 3:
        return 1, len(rings) > 1, [[r] for r in rings]
    # shells run clockwise, holes the other way
    turn = [K._ring_area(r) for r in rings]
    parts = [[r] for r, a in zip(rings, turn) if a <= 0] or [[r] for r in rings]
    for r, a in zip(rings, turn):
        if a > 0 and not any(p[0] is r for p in parts):
            mx, my = (r[0] + r[1]) / 2
            home = [p for p in parts if K._holds(p[0], mx, my)] or parts
            min(home, key=lambda p: abs(K._ring_area(p[0]))).append(r)
    return 2, len(parts) > 1, parts


class ShapefileSource(_Layer):
    ending = ".shp"

    @classmethod
    def name(cls):
        return "sparcel_shapefile"

    def schema(self):
        _, _, fields = _dbf_fields(self._paths()[0])
        return T.StructType([T.StructField(n, _dbf_type(k, d)) for n, k, _, _, d in fields] + [T.StructField("geom", G.GEOM)])

    def reader(self, schema):
        return _ShapefileReader(self, schema)


class _ShapefileReader(_Reader):
    def extent(self, path):
        return 0, (os.path.getsize(path[:-4] + ".shx") - 100) // 8

    def read(self, part):
        if part.stop <= part.start:
            return
        size, width, fields = _dbf_fields(part.path)
        cpg = part.path[:-4] + ".cpg"
        encoding = open(cpg).read().strip() if os.path.exists(cpg) else "utf-8"
        with open(part.path[:-4] + ".shx", "rb") as f:
            f.seek(100 + 8 * part.start)
            index = np.frombuffer(f.read(8 * (part.stop - part.start)), ">i4").reshape(-1, 2) * 2
        with open(part.path, "rb") as shp, open(part.path[:-4] + ".dbf", "rb") as dbf:
            for lo in range(0, len(index), ROWS_PER_BATCH):
                rows = index[lo:lo + ROWS_PER_BATCH]
                shapes = []
                for at, n in rows.tolist():
                    shp.seek(at + 8)
                    shapes.append(_shape(shp.read(n)))
                dbf.seek(size + width * (part.start + lo))
                raw = dbf.read(width * len(rows))
                recs = [raw[k * width:(k + 1) * width] for k in range(len(rows))]
                cols = [[_dbf_value(r[o:o + w], k, d, encoding) for r in recs] for _, k, o, w, d in fields]
                live = [k for k, r in enumerate(recs) if r[:1] != b"*"]
                names, srid = [f[0] for f in fields], self.srid or _prj_srid(part.path)
                yield self._batch([[c[k] for k in live] for c in cols], [shapes[k] for k in live], names, srid)


def _prj_srid(path: str) -> int | None:
    """The system that a shapefile's ``.prj`` names, by code or as one of those known here."""
    prj = path[:-4] + ".prj"
    if not os.path.exists(prj):
        return None
    with open(prj, encoding="latin-1") as f:
        text = f.read()
    if codes := re.findall(r'AUTHORITY\["EPSG",\s*"?(\d+)"?\]\s*\]\s*$', text):
        return int(codes[-1])
    name = re.match(r'\s*(\w+)\["([^"]*)"', text)
    return PRJ_NAMES.get(name[2]) if name else None


# ------------------------------------------------------------------ GeoPackage


def _open(path: str):
    return sqlite3.connect(f"file:{path}?mode=ro&immutable=1", uri=True)


def _gpkg_layer(con, layer):
    """(table, geometry column, [(attribute, declared type)])."""
    rows = con.execute("SELECT table_name, column_name FROM gpkg_geometry_columns ORDER BY table_name").fetchall()
    names = dict(rows)
    if layer is None and len(names) == 1:
        layer = next(iter(names))
    if layer not in names:
        raise ValueError(f"layer {layer!r} not found; the file has {sorted(names)}")
    quoted = layer.replace('"', '""')
    info = con.execute(f'PRAGMA table_info("{quoted}")').fetchall()
    return quoted, names[layer], [(r[1], r[2].upper()) for r in info if r[1] != names[layer]]


def _gpkg_type(declared: str):
    base = declared.split("(")[0]
    if "INT" in base:
        return T.LongType()
    if base in ("REAL", "DOUBLE", "FLOAT"):
        return T.DoubleType()
    return {"BOOLEAN": T.BooleanType(), "BLOB": T.BinaryType()}.get(base, T.StringType())


# Bytes of the envelope for each envelope code of the geometry header.
ENVELOPE = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}


def _gpkg_srid(blob) -> int | None:
    """The reference system in the header of a geometry."""
    value = struct.unpack_from("<i" if blob[3] & 1 else ">i", blob, 4)[0]
    return value if value > 0 else None


def _gpkg_shape(blob):
    if blob is None or blob[3] & 0x10:
        return None
    return _parse_wkb(blob, 8 + ENVELOPE[(blob[3] >> 1) & 7])[:3]


class GeoPackageSource(_Layer):
    ending = ".gpkg"

    @classmethod
    def name(cls):
        return "sparcel_gpkg"

    def schema(self):
        with _open(self._paths()[0]) as con:
            _, _, attrs = _gpkg_layer(con, self.options.get("layer"))
        return T.StructType([T.StructField(n, _gpkg_type(t)) for n, t in attrs] + [T.StructField("geom", G.GEOM)])

    def reader(self, schema):
        return _GeoPackageReader(self, schema)


class _GeoPackageReader(_Reader):
    def extent(self, path):
        with _open(path) as con:
            table, _, _ = _gpkg_layer(con, self.layer)
            lo, hi = con.execute(f'SELECT min(rowid), max(rowid) FROM "{table}"').fetchone()
        return (0, 0) if lo is None else (lo, hi + 1)

    def read(self, part):
        with _open(part.path) as con:
            table, geom, attrs = _gpkg_layer(con, self.layer)
            cols = ", ".join('"' + n.replace('"', '""') + '"' for n in [a for a, _ in attrs] + [geom])
            kinds = [f.dataType for f in self.schema.fields]
            cur = con.execute(f'SELECT {cols} FROM "{table}" WHERE rowid >= ? AND rowid < ?', (part.start, part.stop))
            while rows := cur.fetchmany(ROWS_PER_BATCH):
                columns = []
                for k in range(len(attrs)):
                    v = [r[k] for r in rows]
                    columns.append([None if x is None else bool(x) for x in v] if kinds[k] == T.BooleanType() else v)
                systems = {_gpkg_srid(r[-1]) for r in rows if r[-1] is not None} or {G.TARGET_SRID}
                if self.srid is None and len(systems) > 1:
                    raise ValueError("a layer mixes reference systems")
                yield self._batch(columns, [_gpkg_shape(r[-1]) for r in rows], [a for a, _ in attrs], self.srid or systems.pop())


SOURCES = {"shapefile": ShapefileSource, "gpkg": GeoPackageSource}
