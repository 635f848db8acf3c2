"""Feature files and layers by name."""

import sqlite3
import struct

import pytest
from pyspark.sql import functions as F

from sparcel.functions import geometry as G
from sparcel.plans.catalog import LayerCatalog
from sparcel.sources import features as S

from test_operators import box, layer


def write_shapefile(base, records, fields, rows):
    """Minimal writer: records are (shape type, list of rings) with closed rings."""
    body, index, at = b"", b"", 50
    for k, (kind, rings) in enumerate(records):
        pts = [p for r in rings for p in r]
        if kind == 1:
            content = struct.pack("<i2d", 1, *pts[0])
        else:
            cuts = [sum(len(r) for r in rings[:i]) for i in range(len(rings))]
            content = struct.pack("<i4dii", kind, 0, 0, 0, 0, len(rings), len(pts)) + struct.pack(f"<{len(cuts)}i", *cuts)
            content += b"".join(struct.pack("<2d", *p) for p in pts)
        body += struct.pack(">ii", k + 1, len(content) // 2) + content
        index += struct.pack(">ii", at, len(content) // 2)
        at += 4 + len(content) // 2
    head = lambda n: struct.pack(">7i", 9994, 0, 0, 0, 0, 0, n) + struct.pack("<ii8d", 1000, 5, *[0.0] * 8)
    base.with_suffix(".shp").write_bytes(head(50 + len(body) // 2) + body)
    base.with_suffix(".shx").write_bytes(head(50 + len(index) // 2) + index)
    width = 1 + sum(f[2] for f in fields)
    size = 32 + 32 * len(fields) + 1
    dbf = struct.pack("<4BIHH20x", 3, 0, 0, 0, len(rows), size, width)
    for name, kind, w, d in fields:
        dbf += name.encode().ljust(11, b"\0") + kind.encode() + b"\0" * 4 + bytes([w, d]) + b"\0" * 14
    dbf += b"\r"
    for r in rows:
        dbf += b" " + b"".join(str("" if v is None else v).encode("utf-8").ljust(f[2])[:f[2]] for v, f in zip(r, fields))
    base.with_suffix(".dbf").write_bytes(dbf)


def test_shapefiles(spark, tmp_path):
    cw = lambda x0, y0, x1, y1: [(x0, y0), (x0, y1), (x1, y1), (x1, y0), (x0, y0)]
    fields = [("INSEE_COM", "C", 8, 0), ("N", "N", 6, 0), ("W", "N", 8, 2)]
    for k in range(3):
        recs = [(5, [cw(0, 0, 10, 10), cw(2, 2, 4, 4)[::-1]]), (5, [cw(0, 0, 1, 1), cw(5, 5, 7, 7)]), (5, [cw(k, 0, k + 1, 1)])]
        write_shapefile(tmp_path / f"f{k}", recs, fields, [("Évry", 1, 1.5), ("b", None, None), (f"c{k}", 3, 2.25)])
    with pytest.raises(Exception, match="no known reference system"):
        S.read_features(spark, str(tmp_path), fmt="shapefile").count()
    df = S.read_features(spark, str(tmp_path), fmt="shapefile", srid=2154, rowsPerPartition=2)
    assert df.schema["N"].dataType.simpleString() == "bigint" and df.schema["W"].dataType.simpleString() == "double"
    assert df.rdd.getNumPartitions() == 6
    got = df.select("INSEE_COM", "N", "W", G.area().alias("a"), G.type_name().alias("t")).collect()
    assert len(got) == 9
    assert {tuple(r) for r in got if r[0] == "Évry"} == {("Évry", 1, 1.5, 96.0, "ST_Polygon")}
    assert {tuple(r) for r in got if r[0] == "b"} == {("b", None, None, 5.0, "ST_MultiPolygon")}
    with pytest.raises(Exception, match="no .shp file"):
        S.read_features(spark, str(tmp_path / "none"), fmt="shapefile").count()


def test_shapefile_columns_go_by_name(spark, tmp_path):
    ring = [(0, 0), (0, 1), (1, 1), (1, 0), (0, 0)]
    name, code = ("NAME", "C", 8, 0), ("CODE", "C", 8, 0)
    write_shapefile(tmp_path / "a", [(5, [ring])], [code, name], [("c1", "n1")])
    write_shapefile(tmp_path / "b", [(5, [ring])], [name, code], [("n2", "c2")])
    (tmp_path / "a.prj").write_text('GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984"]]')
    (tmp_path / "b.prj").write_text('PROJCS["x",GEOGCS["y",AUTHORITY["EPSG","4171"]],AUTHORITY["EPSG","2154"]]')
    rows = S.read_features(spark, str(tmp_path), fmt="shapefile").select("CODE", "NAME", "geom.srid").collect()
    assert sorted(map(tuple, rows)) == [("c1", "n1", 4326), ("c2", "n2", 2154)]
    write_shapefile(tmp_path / "c", [(5, [ring])], [name, code, ("MORE", "C", 8, 0)], [("n3", "c3", "m")])
    with pytest.raises(Exception, match="other columns"):
        S.read_features(spark, str(tmp_path), fmt="shapefile", srid=2154).count()


def test_reference_system_of_values(spark):
    wkb = spark.createDataFrame([(1, struct.pack("<BI2d", 1, 1, 3, 4))], "id int, wkb binary")
    with pytest.raises(Exception, match="no reference system"):
        S.decode_wkb(wkb, "wkb").collect()
    point = S.decode_wkb(wkb, "wkb", 4326)
    assert point.select("geom.srid").first()[0] == 4326
    assert S.decode_wkb(S.encode_wkb(point), "wkb").select("geom.srid").first()[0] == 4326
    assert S.decode_wkb(S.encode_wkb(point), "wkb", 2154).select("geom.srid").first()[0] == 4326


def test_geopackage_layers(spark, tmp_path):
    path = tmp_path / "D001.gpkg"
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
    for name in ("troncon_de_route", "equipement_de_transport"):
        con.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'shape')", (name,))
        con.execute(f"CREATE TABLE {name} (fid INTEGER PRIMARY KEY, nature TEXT, largeur REAL, shape BLOB)")
    for k in range(25):
        wkb = struct.pack("<BII6d", 1, 1002, 2, k, 0, 5, k, 3, 5)
        con.execute("INSERT INTO troncon_de_route VALUES (?, ?, ?, ?)", (k + 1, "Bretelle", None if k % 2 else 4.5, b"GP\0\x03" + struct.pack("<i4d", 2154, 0, 0, 0, 0) + wkb))
    con.execute("INSERT INTO troncon_de_route VALUES (26, NULL, 1, NULL)")
    con.commit()
    con.close()
    df = S.read_features(spark, str(path), "troncon_de_route", fmt="gpkg", rowsPerPartition=10)
    assert df.rdd.getNumPartitions() == 3 and df.count() == 26
    assert df.agg(F.sum(G.length()), F.max("geom.srid")).first() == (75.0, 2154)
    assert df.where("geom IS NULL").count() == 1 and df.where("largeur IS NULL").count() == 12
    assert S.read_features(spark, str(path), "equipement_de_transport", fmt="gpkg").count() == 0
    with pytest.raises(Exception, match="not found"):
        S.read_features(spark, str(path), "other", fmt="gpkg").count()


def test_catalog(spark):
    cat = LayerCatalog(spark)
    names = ["cat_zone", "cat_plot", "cat_urban", "cat_cut", "cat_all", "cat_road"]
    cat.drop_relations("TABLE", names)
    try:
        cat.add("cat_zone", layer(spark, [(1, box(0, 0, 10, 10)), (97, box(50, 50, 60, 60))], 2).select(F.col("id").cast("string").alias("code"), "geom"))
        cat.add("cat_plot", layer(spark, [(1, box(5, 5, 15, 8)), (2, box(0, 0, 2, 2)), (3, box(1, 1, 4, 4))], 2))
        cat.add("cat_road", layer(spark, [(1, [[[(0, 0), (20, 0)]]])], 1))
        cat.delete_like("cat_zone", "code", "97%")
        cat.singlepart_to_multipart("cat_zone")
        cat.project_geometry("cat_zone")
        assert cat.get_geometry_types("cat_zone") == ("ST_MultiPolygon",) and cat.get_srid("cat_zone") == 2154
        assert cat.map_geometry_type("cat_zone", False) == "Polygon" and cat.is_same_srid("cat_zone", "cat_plot")
        cat.intersect_geometries("cat_zone", "cat_plot", ["code"], out_name="cat_cut", key_b=["id"])
        assert cat.table("cat_cut").agg(F.sum(G.area())).first()[0] == pytest.approx(15 + 4 + 9)
        cat.intersect_geometries("cat_zone", "cat_plot", fields_b=["id"])
        assert sorted(cat.table("cat_plot").columns) == ["geom", "id"] and cat.table("cat_plot").count() == 3
        cat.dissolve_geometries("cat_plot", "cat_zone", "cat_all")
        assert cat.table("cat_all").select(G.area()).collect()[0][0] == pytest.approx(100.0)
        cat.create_union("cat_plot", "cat_urban")
        assert sorted(round(r[0], 6) for r in cat.table("cat_urban").select(G.area()).collect()) == [12.0, 15.0]
        cat.create_union_buffer("cat_road", "cat_strip", "1.0", as_view=True)
        assert cat.table("cat_strip").count() == 1
        assert cat.execute_query("string", "SELECT count(*) AS n FROM IDENTIFIER(:t)", t="cat_cut").first()["n"] == 3
    finally:
        cat.drop_relations("TABLE", names)
        cat.drop_relations("VIEW", ["cat_strip"])
