"""Operators on general geometry: tile plans, hot spots, copies, pieces across borders, guards."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparcel.functions import crs
from sparcel.functions import geometry as G
from sparcel.operators import attributes as A
from sparcel.operators import checks as C
from sparcel.operators import relations as R
from sparcel.operators import boxes, components, overlay, tiling, union
from sparcel.operators.components import cluster_touching, connected_components, star_links
from sparcel.operators.overlay import lines_in_region, overlay_intersection, overlay_measures, overlay_pairs, spatial_join
from sparcel.operators.tiling import TilePlan, plan_tiles
from sparcel.operators.union import assemble, dissolve, dissolve_polygons, measure, region, union_buffer
from sparcel.plans import report as P
from sparcel.plans import zonal as Z
from sparcel.session import checkpoint
from sparcel.sources import features as S
from sparcel.sources import tables as TB


def layer(spark, rows, dim, multi=False, srid=2154):
    """rows: list of (id, parts) with parts -> rings -> (x, y)."""
    data = [
        (i, (srid, dim, multi, [[[(float(x), float(y)) for x, y in ring] for ring in part] for part in parts])) for i, parts in rows
    ]
    return spark.createDataFrame(data, f"id long, geom {G.GEOM_DDL}")


def box(x0, y0, x1, y1):
    return [[[(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]]


def disc(cx, cy, r, n=24):
    ring = [(cx + r * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n)) for k in range(n)]
    return [[ring + ring[:1]]]


def total(df, by=()):
    r = measure(df, by).first()
    return r["area"], r["perimeter"]


@pytest.fixture(scope="module")
def discs(spark):
    rnd = random.Random(3)
    return layer(spark, [(k, disc(rnd.uniform(0, 300), rnd.uniform(0, 300), rnd.uniform(3, 25))) for k in range(120)], 2).cache()


def test_union_does_not_depend_on_the_tiles(discs):
    a = total(region(discs, TilePlan(10)))
    for level in (3, 5, 7):
        b = total(region(discs, TilePlan(level)))
        assert b == pytest.approx(a, rel=1e-7)


def test_assembled_union_keeps_area_and_perimeter(discs):
    plan = TilePlan(5)
    a = total(region(discs, plan))
    whole = assemble(region(discs, plan)).agg(F.sum(G.area()), F.sum(G.perimeter())).first()
    assert tuple(whole) == pytest.approx(a, rel=1e-7)
    parts = dissolve(discs.where("id < 60"), discs.where("id >= 60"), plan)
    n = parts.select("part").distinct().count()
    polys = dissolve_polygons(discs.where("id < 60"), discs.where("id >= 60"), plan)
    r = polys.agg(F.count("*"), F.sum(G.area()), F.sum(G.perimeter())).first()
    assert r[0] == n and tuple(r[1:]) == pytest.approx(a, rel=1e-7)
    # the same parts with one big tile
    assert dissolve(discs, discs.limit(0), TilePlan(12)).select("part").distinct().count() == n


def test_hot_spot_is_cut_further(spark):
    rnd = random.Random(5)
    rows = [(k, disc(rnd.uniform(100, 110), rnd.uniform(100, 110), rnd.uniform(0.2, 1.0), 12)) for k in range(400)]
    rows += [(1000 + k, disc(rnd.uniform(0, 4000), rnd.uniform(0, 4000), 20, 12)) for k in range(200)]
    df = layer(spark, rows, 2)
    plan = plan_tiles([df], target=60)
    assert plan.hot is not None and plan.finest < plan.level
    assert total(region(df, plan)) == pytest.approx(total(region(df, TilePlan(12))), rel=1e-7)
    assert dissolve(df, df.limit(0), plan).select("part").distinct().count() == \
        dissolve(df, df.limit(0), TilePlan(12)).select("part").distinct().count()
    road = layer(spark, [(1, [[[(0, 0), (105, 105.5), (300, 90), (4000, 4000)]]]), (2, [[[(90, 104), (120, 104.5)]]])], 1)
    want = overlay_intersection(df, road, [], ["id"], key_a=["id"], plan=TilePlan(12)).groupBy("id").agg(F.count("*").alias("n"), F.sum(G.length()).alias("l"))
    got = overlay_intersection(df, road, [], ["id"], key_a=["id"], plan=plan).groupBy("id").agg(F.count("*").alias("n"), F.sum(G.length()).alias("l"))
    w, g = {r["id"]: r for r in want.collect()}, {r["id"]: r for r in got.collect()}
    assert w.keys() == g.keys() and all(w[k]["n"] == g[k]["n"] and w[k]["l"] == pytest.approx(g[k]["l"], rel=1e-6) for k in w)


def test_large_polygon_lies_in_many_tiles(spark):
    """One polygon of 60,000 vertices, and nothing else: no tile holds more than the budget."""
    one = layer(spark, [(1, disc(0, 0, 900, 60_000))], 2)
    plan = plan_tiles([one])
    pieces = tiling.split_to_tiles(one, plan, ["id"]).select("tile", (F.size("edges") / 4).alias("n"))
    r = pieces.agg(F.count("*").alias("tiles"), F.max("n").alias("most"), F.sum("n").alias("n")).first()
    assert r["tiles"] > 100 and r["most"] <= tiling.TARGET_VERTICES * tiling.HOT_FACTOR and r["n"] >= 60_000
    assert total(region(one, plan)) == pytest.approx((60_000 / 2 * 900**2 * math.sin(2 * math.pi / 60_000), 2 * 60_000 * 900 * math.sin(math.pi / 60_000)), rel=1e-6)


def test_counts_are_those_of_the_pieces(spark, discs):
    """The planner's estimate of pieces, against cutting; and one level of a quadtree sums up to the next."""
    cells = tiling._counted([discs], [1.0], tiling.COUNT_LEVEL)
    stats = {r["level"]: r for r in tiling._level_stats(cells, 1e9).collect()}
    edges = 120 * 24
    for level in (6, 8, 10, 14, 20):
        pieces = tiling.split_to_tiles(discs, TilePlan(level), ["id"]).select(F.explode(F.sequence(F.lit(1), (F.size("edges") / 4).cast("int")))).count()
        assert edges <= stats[level]["pieces"] <= 1.6 * pieces and stats[level]["most"] <= stats[level]["pieces"]
    assert stats[20]["tiles"] <= 4 and stats[6]["tiles"] >= stats[7]["tiles"] >= stats[8]["tiles"]


def test_hot_tiles_over_several_lookups(spark):
    """A spot ten levels below the base: leaves are found whatever the depth, and hold no more than the budget."""
    rnd = random.Random(8)
    rows = [(k, disc(50 + rnd.gauss(0, 6), 50 + rnd.gauss(0, 6), 0.05, 6)) for k in range(600)]
    rows += [(1000 + k, disc(rnd.uniform(0, 60_000), rnd.uniform(0, 60_000), 3, 6)) for k in range(600)]
    df = layer(spark, rows, 2)
    plan = plan_tiles([df], target=10)
    assert len(plan.steps) > 1 and plan.finest == tiling.MIN_LEVEL
    sizes = tiling.split_to_tiles(df, plan, ["id"]).groupBy("tile").agg(F.sum(F.size("edges") / 4).alias("n"))
    level = F.shiftright("tile", 56) - 64
    assert sizes.where((level > tiling.MIN_LEVEL) & (F.col("n") > 1.5 * 10 * tiling.HOT_FACTOR)).count() == 0
    assert total(region(df, plan)) == pytest.approx(total(region(df, TilePlan(10))), rel=1e-6)


def test_pile_that_no_tile_size_separates(spark):
    # a third of all rows are copies, a third are distinct shapes over one spot
    rnd = random.Random(7)
    rows = [(k, disc(50, 50, 1.0, 16)) for k in range(300)]
    rows += [(300 + k, disc(50 + rnd.uniform(-.2, .2), 50 + rnd.uniform(-.2, .2), rnd.uniform(0.5, 1.4), 9)) for k in range(300)]
    rows += [(600 + k, disc(rnd.uniform(0, 3000), rnd.uniform(0, 3000), 5, 8)) for k in range(300)]
    df = layer(spark, rows, 2)
    plan = plan_tiles([df], target=20)
    assert plan.crowded is not None and plan.finest == tiling.MIN_LEVEL
    assert total(region(df, plan)) == pytest.approx(total(region(df, TilePlan(12))), rel=1e-6)
    c = cluster_touching(df, "id", plan)
    assert c.where("id < 600").select("cluster").distinct().collect() == [(0,)]
    assert c.count() == 900


def test_insides_of_wide_polygons(spark):
    """Rows of a polygon grow with its boundary, and results are those of plain tiles."""
    plan = TilePlan(3, covers=True)
    counts = []
    for r in (200, 400, 800):
        one = layer(spark, [(1, disc(0, 0, r, 60))], 2)
        counts.append(tiling.split_to_tiles(one, plan, ["id"], cover=True).count())
        assert counts[-1] < tiling.split_to_tiles(one, plan, ["id"]).count() / (r / 100)
    assert counts[2] < 2.4 * counts[1] < 6 * counts[0]
    rnd = random.Random(12)
    ring = [[disc(0, 0, 400, 50)[0][0], disc(30, 10, 150, 40)[0][0][::-1]]]
    a = layer(spark, [(1, disc(100, 100, 900, 40)), (2, ring), (3, box(-300, -300, 500, 200))], 2).withColumnRenamed("id", "a")
    b = layer(spark, [(k, disc(rnd.uniform(-500, 600), rnd.uniform(-500, 600), rnd.choice([3, 20, 300]), 16)) for k in range(60)]
              + [(100 + k, disc(rnd.uniform(180, 200), rnd.uniform(90, 110), 0.4, 6)) for k in range(80)], 2)
    hot = plan_tiles([a, b], target=8)
    assert hot.covers and hot.hot is not None

    def measured(plan):
        o = overlay_intersection(a, b, ["a"], ["id"], key_a=["a"], key_b=["id"], plan=plan)
        rows = o.groupBy("a", "id").agg(F.count("*").alias("n"), F.sum(G.area()).alias("s"), F.sum(G.perimeter()).alias("p")).collect()
        sums = overlay_measures(a, b, ["a"], plan).orderBy("a").collect()
        met = {tuple(r) for r in spatial_join(a, b, ["a"], ["id"], plan).collect()}
        return {(r["a"], r["id"]): (r["n"], r["s"], r["p"]) for r in rows}, [x for r in sums for x in r], met

    want = measured(TilePlan(12))
    for other in (plan, TilePlan(4, covers=True), hot):
        got = measured(other)
        assert got[0].keys() == want[0].keys() and got[2] == want[2]
        assert all(got[0][k] == pytest.approx(want[0][k], rel=1e-6) for k in want[0])
        assert got[1] == pytest.approx(want[1], rel=1e-6)
    road = layer(spark, [(1, [[[(-600, -20), (700, 90)]]]), (2, [[[(10, 10), (20, 30)]]])], 1)
    for other in (plan, TilePlan(12)):
        o = overlay_intersection(a, road, ["a"], ["id"], key_a=["a"], key_b=["id"], plan=other).groupBy("a", "id").agg(F.count("*").alias("n"), F.sum(G.length()).alias("l"))
        found = sorted((r["a"], r["id"], r["n"], round(r["l"], 4)) for r in o.collect())
        assert other is plan or found == before
        before = found


def test_crowded_tiles_are_united_as_a_tree(spark, monkeypatch):
    """2,000 distinct shapes on one spot: no row has more than FAN_IN chunk outlines, and nothing is lost."""
    rnd = random.Random(11)
    df = layer(spark, [(k, disc(50 + rnd.uniform(-.3, .3), 50 + rnd.uniform(-.3, .3), rnd.uniform(0.3, 0.9), 9)) for k in range(2000)], 2)
    plan = plan_tiles([df], target=20)
    assert plan.crowded.agg(F.max("chunks")).first()[0] > union.FAN_IN
    rows, old = [], union._merge

    def merge(pieces, by):
        rows.append(pieces.groupBy(*by, "tile").count().agg(F.max("count")).first()[0])
        return old(pieces, by)

    monkeypatch.setattr(union, "_merge", merge)
    assert total(region(df, plan)) == pytest.approx(total(region(df, TilePlan(12))), rel=1e-6)
    assert len(rows) >= 3 and all(n <= union.FAN_IN for n in rows[1:-1])
    assert cluster_touching(df, "id", plan).select("cluster").distinct().collect() == [(0,)]


def test_lines_come_back_whole(spark):
    zones = layer(spark, [(1, box(0, 0, 100, 100)), (2, box(100, 0, 200, 100))], 2)
    road = layer(spark, [(7, [[[(-10, 50), (30.3, 60.7), (90, 20), (150, 80), (220, 50)]]]), (8, [[[(100, 10), (100, 90)]]]), (9, [[[(0, 150), (0, 200)]]])], 1)
    for level in (3, 4, 9):
        o = overlay_intersection(zones.withColumnRenamed("id", "zone"), road, ["zone"], ["id"], plan=TilePlan(level))
        got = {(r["zone"], r["id"]): (r["n"], r["v"]) for r in o.select("zone", "id", G.vertex_count().alias("v")).groupBy("zone", "id").agg(F.count("*").alias("n"), F.sum("v").alias("v")).collect()}
        # the road crosses x = 0 and x = 100 and x = 200: vertices are its own plus the cuts
        assert got == {(1, 7): (1, 4), (2, 7): (1, 3), (1, 8): (1, 2), (2, 8): (1, 2)}
        length = o.where("id = 7").agg(F.sum(G.length())).first()[0]
        xs = road.where("id = 7").select(G.length()).first()[0]
        assert length < xs


def test_polygon_pieces_and_holes(spark):
    ring = [[[(0, 0), (60, 0), (60, 60), (0, 60), (0, 0)], [(20, 20), (20, 40), (40, 40), (40, 20), (20, 20)]]]
    a = layer(spark, [(1, ring)], 2).withColumnRenamed("id", "a")
    b = layer(spark, [(5, box(-5, 10, 65, 50)), (6, box(22, 22, 30, 30)), (7, box(60, 0, 70, 10)), (8, box(30, 25, 50, 35)), (9, box(-50, -50, 100, 100))], 2)
    for level in (3, 8):
        o = overlay_intersection(a, b, ["a"], ["id"], plan=TilePlan(level))
        got = {r["id"]: (r["n"], round(r["s"], 3), round(r["p"], 3), r["v"]) for r in o.groupBy("id").agg(
            F.count("*").alias("n"), F.sum(G.area()).alias("s"), F.sum(G.perimeter()).alias("p"), F.sum(G.vertex_count()).alias("v")).collect()}
        assert got == {5: (1, 2000.0, 280.0, 10), 8: (1, 100.0, 40.0, 5), 9: (1, 3200.0, 320.0, 10)}
    assert overlay_measures(a, b, ["a"], TilePlan(4)).first()["area"] == pytest.approx(5300.0)


def test_spatial_join_is_closed_and_sees_containment(spark):
    a = layer(spark, [(1, box(0, 0, 10, 10))], 2)
    b = layer(spark, [(1, box(10, 10, 12, 12)), (2, box(3, 3, 4, 4)), (3, box(-50, -50, 90, 90)), (4, box(11, 0, 12, 5))], 2)
    for level in (2, 9):
        got = {r[1] for r in spatial_join(a, b, ["id"], ["id"], TilePlan(level)).collect()}
        assert got == {1, 2, 3}
    p = layer(spark, [(1, [[[(10, 5)]]]), (2, [[[(5, 5)]]]), (3, [[[(10.5, 5)]]])], 0)
    assert {r[1] for r in spatial_join(a, p, ["id"], ["id"], TilePlan(4)).collect()} == {1, 2}
    line = layer(spark, [(1, [[[(20, 0), (0, 20)]]]), (2, [[[(20, 1), (1, 20)]]])], 1)
    assert {r[1] for r in spatial_join(a, line, ["id"], ["id"], TilePlan(4)).collect()} == {1}


def test_all_layers_may_be_empty(spark, discs):
    none = discs.where("id < 0")
    assert region(none).count() == 0
    assert plan_tiles([none]).hot is None
    assert spatial_join(discs, none, ["id"], ["id"]).count() == 0
    assert overlay_intersection(discs, none, [], ["id"], key_a=["id"]).count() == 0
    assert cluster_touching(none, "id").count() == 0


def test_buffer_of_a_bent_line(spark):
    road = layer(spark, [(1, [[[(0, 0), (100, 0), (100, 100)]]])], 1)
    area, _ = total(union_buffer(road, "3.0", TilePlan(5)))
    # two bars that share a 3 x 3 corner, half a disc at both ends, a quarter outside the bend
    c = 16 * 9 * math.sin(math.pi / 16)
    assert area == pytest.approx(1200 - 9 + c + c / 4, rel=1e-6)
    g = G.buffer("geom", F.lit(3.0))
    b = road.select(g.alias("geom"))
    assert total(region(b, TilePlan(5)))[0] == pytest.approx(area, rel=1e-9)
    assert road.select(G.buffer("geom", F.lit(None).cast("double")).alias("g")).first()["g"] is None
    plot = layer(spark, [(1, box(0, 0, 10, 10))], 2)
    assert total(union_buffer(plot, "1.0", TilePlan(5), "round"))[0] == pytest.approx(140 + 8 * math.sin(math.pi / 16) * 2, rel=1e-6)
    with pytest.raises(Exception, match="negative"):
        union_buffer(road, "-1.0", TilePlan(5)).count()


def test_components_of_a_long_chain_and_a_star(spark):
    links = spark.createDataFrame(
        [(f"n{k:04d}", f"n{k + 1:04d}") for k in range(200)] + [("s000", f"s{k:03d}") for k in range(1, 300)], "u string, v string"
    )
    out = connected_components(links).groupBy("component").count().collect()
    assert sorted((r[0], r[1]) for r in out) == [("n0000", 201), ("s000", 300)]


def test_star_links_end_when_only_stars_are_left(spark):
    def stars(pairs):
        kept = []
        links = spark.createDataFrame(pairs, "u long, v long")
        out = star_links(links, lambda edges: kept.append(1) or checkpoint(edges))
        return sorted(tuple(r) for r in out.collect()), len(kept)

    # stars need no round, whichever way their links point
    assert stars([(1, 5), (6, 1), (7, 1), (1, 7), (9, 8), (3, 3)]) == ([(5, 1), (6, 1), (7, 1), (9, 8)], 1)
    assert stars([]) == ([], 1)
    assert stars([(i, i + 1) for i in range(40)])[0] == [(i, 0) for i in range(1, 41)]
    # a node with two smaller neighbours, and one that is both a child and a root
    assert stars([(9, 2), (9, 4)])[0] == [(4, 2), (9, 2)]
    assert stars([(9, 4), (4, 2)])[0] == [(4, 2), (9, 2)]


def test_medians(spark):
    df = spark.createDataFrame(
        [(1, "a", 4.0), (2, "a", 0.0), (3, "a", None), (4, "a", 7.0), (5, "b", None), (6, None, 0.0), (7, "b", None)],
        "id int, nature string, w double",
    )
    got = {r["id"]: r["w"] for r in A.median_fill(df, "w", "nature").collect()}
    # zeros count in the median, an all-NULL group stays NULL, a NULL group has no equals
    assert got == {1: 4.0, 2: 4.0, 3: 4.0, 4: 7.0, 5: None, 6: None, 7: None}
    assert {r["nature"]: r["median"] for r in A.median_by(df.where("nature is not null"), "w", "nature").collect()} == {"a": 4.0, "b": None}


def test_guards(spark, discs):
    mixed = discs.withColumn("geom", F.when(F.col("id") == 3, G.to_multi()).otherwise(F.col("geom")))
    assert C.single_type(discs) == "Polygon"
    with pytest.raises(ValueError):
        C.single_type(mixed)
    assert C.single_type(discs.where("id < 0")) is None
    moved = discs.withColumn("geom", F.col("geom").withField("srid", F.lit(4326)))
    assert not C.same_srid(discs, moved)
    with pytest.raises(ValueError):
        overlay_intersection(moved, discs, [], ["id"])
    with pytest.raises(ValueError):
        dissolve(moved, discs)
    with pytest.raises(Exception, match="expected MultiPolygon"):
        C.assert_geom(discs, "MultiPolygon", 2154).collect()
    with pytest.raises(Exception, match="not a geometry type"):
        spark.range(1).select(G.plain_type(F.lit("Polygon"))).collect()
    assert spark.range(1).select(G.plain_type(F.lit("ST_MultiPoint"), False)).first()[0] == "Point"


def test_reprojection(spark):
    p = layer(spark, [(1, [[[(3.0, 46.5)]]])], 0, srid=4326)
    v = p.select(crs.to_l93().alias("geom")).first()["geom"]
    assert v["srid"] == 2154 and (v["parts"][0][0][0]["x"], v["parts"][0][0][0]["y"]) == pytest.approx((700000, 6600000), abs=1e-6)
    assert crs.CONE == pytest.approx(0.72560776505, abs=1e-11)
    with pytest.raises(Exception, match="no reprojection"):
        layer(spark, [(1, [[[(3.0, 46.5)]]])], 0, srid=32631).select(crs.to_l93()).collect()
    with pytest.raises(ValueError):
        crs.project(p, 4326)


def test_relations(spark, tmp_path):
    with pytest.raises(ValueError):
        R.drop_relations(spark, "INDEX", ["a"])
    with pytest.raises(ValueError):
        R.run_sql(spark, "direct", "SELECT 1")
    f = tmp_path / "q.sql"
    f.write_text("SELECT :n +\n 1 AS v")
    assert R.run_sql(spark, "file", str(f), n=41).first()["v"] == 42
    R.create_relation(spark.range(3), "three", as_view=True)
    R.replace_relation(spark.table("three").where("id > 0"), "three")
    assert spark.table("three").count() == 2
    R.drop_relations(spark, "view", ["three"])
    assert not spark.catalog.tableExists("three")


def test_delete_like_keeps_nulls_and_pad_never_cuts(spark):
    df = spark.createDataFrame([("97124",), ("01001",), (None,)], "c string")
    assert {r[0] for r in A.delete_like(df, "c", "97%").collect()} == {"01001", None}
    assert [r[0] for r in spark.createDataFrame([("1",), ("2A",), ("971",)], "c string").select(A.zero_pad("c", 2)).collect()] == ["01", "2A", "971"]


def test_layers_roundtrip(spark, tmp_path):
    shapes = layer(spark, [(1, [[[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]]])], 2)
    shapes = shapes.unionByName(layer(spark, [(2, [[[(0.5, 1e-7), (3, 4)]], [[(5, 5), (6, 7)]]])], 1, True))
    shapes = shapes.unionByName(layer(spark, [(3, [[[(1.25, -2)]]])], 0)).unionByName(layer(spark, [(4, [[[(1, 2)]], [[(3, 4)]]])], 0, True))
    shapes = shapes.unionByName(layer(spark, [(5, box(0, 0, 1, 1) + box(5, 5, 6, 6))], 2, True))
    shapes = shapes.unionByName(spark.createDataFrame([(6, None)], shapes.schema))
    want = {r["id"]: r["geom"] for r in shapes.collect()}
    S.write_layer(shapes, str(tmp_path / "wkb"))
    got = {r["id"]: r["geom"] for r in S.read_features(spark, str(tmp_path / "wkb")).collect()}
    assert got == want
    got = {r["id"]: r["geom"] for r in S.decode_wkb(S.encode_wkb(shapes), "wkb").collect()}
    assert got == want
    text = shapes.select("id", S.to_wkt().alias("t"))
    got = {r["id"]: r["geom"] for r in text.select("id", S.from_wkt("t").alias("geom")).collect()}
    assert got == want
    wkt = spark.createDataFrame([("MULTIPOINT (1 2, 3 4)",), ("POINT Z (1 2 3)",)], "t string").select(S.from_wkt("t").alias("g")).collect()
    assert len(wkt[0]["g"]["parts"]) == 2 and wkt[1]["g"]["parts"][0][0][0]["y"] == 2.0
    with pytest.raises(Exception, match="not WKT"):
        spark.createDataFrame([("CIRCLE (1 2)",)], "t string").select(S.from_wkt("t")).collect()


def test_lookup(spark, tmp_path):
    f = tmp_path / "lookup.csv"
    f.write_text("CODE_DPT\tNOM_DPT\tCODE_REG\tNOM_REG\tOSM_REG\n1\tAin\t84\tX\tRhone-Alpes\n2A\tCorse\t94\tY\tCorse\n")
    df = TB.read_lookup(spark, str(f))
    assert TB.lookup_one(df, "CODE_DPT", "1", "OSM_REG") == "rhone-alpes" == TB.lookup_one(df, "CODE_DPT", "01", "OSM_REG")
    assert TB.lookup_one(df, "CODE_DPT", "2A", "OSM_REG") == "corse"
    with pytest.raises(ValueError):
        TB.lookup_one(df, "CODE_DPT", "99", "OSM_REG")
    with pytest.raises(Exception, match="exactly one row"):
        TB.lookup_join(spark.createDataFrame([("7",)], "d string"), df, "d", "CODE_DPT", "OSM_REG", "r").collect()


# Published result rows (fixed values): a usual one, one without urban cover, one just over 100 %.
GOLDEN = [
    ("75056", 105.42423095469047, 27.776423755052246, 3184.329500826058, 2071.511364875034, 102.93383543596029, 27.315879359316746, 3160.8374219336706,
     2041.71349075396, 98.34195935446249, 98.56153943317267, 26.347286106350708, 26.53731811665676, 19.64929073815425, 19.83520270187737, 604.1987685436382, 604.7760239328969),
    ("2A197", 51.53345970487016, 0.3825000931134414, 50.201774581370096, 25.27069579365472, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.742236394187393, 0.0,
     0.49037452440373447, 0.0, 81.17144862690007, 0.0),
    ("93013", 2.08002684499337, 0.4742364687860501, 57.61093081527449, 36.122550235771435, 2.08002684499337, 0.4742364687860509, 57.6109308152745,
     36.122550235771456, 100.00000000000017, 100.00000000000007, 22.799535973660074, 22.799535973660117, 17.3663865554036, 17.36638655540361, 83.65798850124342, 83.65798850124335),
]


def test_golden_ratios(spark):
    cols = ", ".join(f"c{k} {'string' if k == 0 else 'double'}" for k in range(9))
    raw = spark.createDataFrame([tuple(None if v == 0.0 else v for v in r[:9]) for r in GOLDEN], cols)
    out = {r["num_insee"]: r for r in Z.indicators(raw).collect()}
    for r in GOLDEN:
        got = out[r[0]]
        assert list(got.asDict()) == Z.RESULT_COLUMNS
        assert tuple(got)[1:] == pytest.approx(r[1:], abs=1e-9)


def test_report_from_source_layers(spark):
    """Raw layers with their source names through the whole analysis."""
    g = lambda rows, dim, **k: layer(spark, rows, dim, **k)
    zones = g([(1, box(0, 0, 1000, 1000)), (2, box(1000, 0, 2000, 1000)), (3, box(5000, 0, 6000, 1000))], 2).select(
        F.element_at(F.array(F.lit("01001"), F.lit("01002"), F.lit("97101")), F.col("id").cast("int")).alias("INSEE_COM"),
        F.element_at(F.array(F.lit("01"), F.lit("01"), F.lit("971")), F.col("id").cast("int")).alias("INSEE_DEP"), "geom",
    )
    road = g([(1, [[[(500, 500), (1500, 500)]]]), (2, [[[(100, 100), (100, 200)]]]), (3, [[[(1, 1), (2, 2)]]])], 1).select(
        F.col("id").alias("cleabs"), F.when(F.col("id") == 3, "Sentier").otherwise("Route à 1 chaussée").alias("nature"),
        F.when(F.col("id") == 1, 4.0).alias("largeur_de_chaussee"),
        G.map_vertices("geom", lambda v: F.struct(v.x.alias("x"), v.y.alias("y"), F.lit(9.0).alias("z"))).alias("geom"),
    )
    plots = g([(1, box(495, 495, 505, 505)), (2, box(1990, 990, 2010, 1010))], 2)
    ign = plots.select(F.col("id").cast("string").alias("cleabs"), F.lit("Parking").alias("nature"), "geom")
    osm = plots.limit(0).select(F.col("id").cast("string").alias("osm_id"), F.lit("fuel").alias("fclass"), "geom")
    land = g([(1, box(0, 0, 700, 1000)), (2, box(1500, 0, 2000, 50))], 2).select("id", F.when(F.col("id") == 1, "112").otherwise("512").alias("code_18"), "geom")

    zs = P.prepare_zones(zones)
    equip = P.prepare_layer(P.select_layer(ign, "equipement_ign")).unionByName(P.prepare_layer(P.select_layer(osm, "equipement_osm")))
    args = (zs, equip, P.prepare_layer(P.select_layer(road, "troncon_ign")), P.prepare_layer(P.select_layer(land, "corine")))
    out = {r["num_insee"]: r for r in P.car_space_report(*args, "1", style="square").collect()}
    a, b = out["01001"], out["01002"]
    # strips are 12 m wide and 6 m longer at each end; road 2 takes the median width 4
    assert set(out) == {"01001", "01002"}
    assert a["ArCom"] == pytest.approx(1.0)
    assert a["LeTroCom"] == pytest.approx(0.6) and b["LeTroCom"] == pytest.approx(0.5)
    assert a["ArVoiCom"] == pytest.approx((506 * 12 + 112 * 12) * 1e-6)
    assert b["ArVoiCom"] == pytest.approx((506 * 12 + 100) * 1e-6)
    assert a["PeVoiCom"] == pytest.approx((2 * (506 + 12) + 2 * (112 + 12)) * 1e-3)
    assert a["ArUrb"] == pytest.approx(0.7) and b["ArUrb"] == 0.0 and b["PaArVoiUrb"] == 0.0
    assert a["ArVoiUrb"] == pytest.approx((206 * 12 + 112 * 12) * 1e-6)
    assert a["LeTroUrb"] == pytest.approx(0.3)
    with pytest.raises(ValueError):
        P.car_space_report(*args, "971")


def test_assembled_form_does_not_depend_on_tiles(spark, discs):
    halves = discs.withColumn("half", F.when(F.col("id") % 3 > 0, F.col("id") % 3))  # null is a group as well
    sums = []
    for level in (4, 6, 12):
        whole = assemble(region(halves, TilePlan(level), by=["half"]), ["half"])
        rows = whole.groupBy("half").agg(F.count("*"), F.sum(G.area()), F.sum(G.perimeter())).collect()
        sums.append({r[0]: tuple(r[1:]) for r in rows})
    assert sums[0].keys() == {None, 1, 2}
    for other in sums[1:]:
        for k, v in sums[0].items():
            assert other[k] == pytest.approx(v, rel=1e-6)
    strip = spark.createDataFrame([(i, f"POLYGON(({i} 0,{i + 1} 0,{i + 1} 5,{i} 5,{i} 0))") for i in range(200)], "id int, wkt string")
    one = assemble(region(strip.select("id", S.from_wkt("wkt").alias("geom")), TilePlan(3))).select(G.area(), G.perimeter()).collect()
    assert [tuple(r) for r in one] == [(1000.0, 410.0)]


def test_named_keys_may_repeat(spark):
    rows = [(i, "same", None, f"LINESTRING(0 {i},{10 * (i + 1)} {i})") for i in range(4)] + [(0, "same", None, "LINESTRING(0 0,10 0)")]
    geom = S.from_wkt("wkt").alias("geom")
    road = spark.createDataFrame(rows, "id int, grp string, none string, wkt string").select("id", "grp", "none", geom)
    box = spark.createDataFrame([(7, "POLYGON((-1 -1,100 -1,100 9,-1 9,-1 -1))")], "zone int, wkt string").select("zone", geom)
    for kw in ({}, {"key_b": ["id"]}, {"key_b": ["grp"]}, {"key_b": ["none"]}):
        o = overlay_intersection(box, road, ["zone"], ["grp"], **kw)
        assert sorted(r[0] for r in o.select(G.length()).collect()) == [10.0, 10.0, 20.0, 30.0, 40.0]
    o = overlay_intersection(box, road)
    assert o.count() == 5 and o.columns == ["id", "geom"]
    pairs = overlay_pairs(box, road, ["zone"], ["grp"])
    assert sorted(r[0] for r in pairs.select(G.length()).collect()) == [10.0, 10.0, 20.0, 30.0, 40.0]
    plan = TilePlan(4)
    inside = lines_in_region(region(box, plan, ["zone"]), road, plan, ["zone"], ["none"], ["grp"])
    assert sorted(r[0] for r in inside.select(G.length()).collect()) == [10.0, 10.0, 20.0, 30.0, 40.0]



def test_pieces_are_combined_before_the_shuffle(spark):
    rnd = random.Random(11)
    rows = [(k, disc(20 + rnd.uniform(-3, 3), 20 + rnd.uniform(-3, 3), rnd.uniform(1, 4), 10)) for k in range(500)]
    df = layer(spark, rows, 2).withColumn("half", F.col("id") % 2).coalesce(1)
    plain = tiling.split_to_tiles(df, TilePlan(6), ["half"])
    packed = tiling.split_to_tiles(df, TilePlan(6), ["half"], combine=True)
    # two piles of 250 pieces, at most 64 of which are united at a time
    assert plain.count() == 500 and packed.count() == 8
    whole = {r["half"]: (r["area"], r["perimeter"]) for r in measure(region(df, TilePlan(3), ["half"]), ["half"]).collect()}
    one = {r["half"]: (r["area"], r["perimeter"]) for r in measure(region(df, TilePlan(6), ["half"]), ["half"]).collect()}
    assert whole.keys() == one.keys() == {0, 1}
    for k in whole:
        assert one[k] == pytest.approx(whole[k], rel=1e-6)


def test_layers_in_degrees_are_refused(spark, discs):
    degrees = discs.withColumn("geom", F.col("geom").withField("srid", F.lit(4326)))
    with pytest.raises(Exception, match="project them first"):
        overlay_intersection(degrees, degrees, ["id"], [], plan=TilePlan(5)).count()
    with pytest.raises(Exception, match="project them first"):
        region(degrees, TilePlan(5)).count()


@pytest.mark.parametrize("shape", ["id", "id * 0.5 - 250000", "exp(id / 20000)", "-exp((id % 777777) / 10000)", "CASE WHEN id % 3 = 0 THEN 7 ELSE id END"])
def test_median_of_very_many_values(spark, shape):
    """10^6 values in one group, beside a small one and one of ties: the rank search against sorting."""
    big = spark.range(1_000_000).selectExpr("'big' AS g", f"CAST({shape} AS DOUBLE) AS v")
    few = spark.createDataFrame([("few", float(v)) for v in (1, 2, 2, 9)] + [("tie", 5.0)] * 9 + [("none", None)], "g string, v double")
    got = {r["g"]: r["median"] for r in A.median_by(big.unionByName(few), "v", "g").collect()}
    values = np.sort(np.array([r[0] for r in big.select("v").toPandas().itertuples(index=False)]))
    assert got == {"big": pytest.approx((values[499_999] + values[500_000]) / 2, rel=1e-15), "few": 2.0, "tie": 5.0, "none": None}


def test_median_fill_by_broadcast_or_salt(spark, monkeypatch):
    rows = [(i, "ab"[i % 2] if i % 7 else None, None if i % 3 == 0 else float(i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, grp string, v double")
    one = sorted(map(tuple, A.median_fill(df, "v", "grp").collect()))
    monkeypatch.setattr(A, "BROADCAST_MEDIANS", 0)
    assert sorted(map(tuple, A.median_fill(df, "v", "grp").collect())) == one
    assert all(v is None for _, g, v in one if g is None and v == 0) and len(one) == 60


def test_pieces_of_a_tile_are_united_as_a_tree(monkeypatch):
    """Crossings of 400 boxes in one tile: few edges meet at once, and the union is that of one arrangement."""
    from sparcel.operators import kernel as K

    rnd = np.random.default_rng(5)
    low = rnd.integers(1, 300, (400, 2)).astype(float)
    high = low + rnd.integers(20, 200, (400, 2))
    corner = [np.column_stack([a[:, 0], b[:, 1]]) for a, b in ((low, low), (high, low), (high, high), (low, high))]
    e = np.concatenate([np.concatenate([corner[k], corner[(k + 1) % 4]], axis=1) for k in range(4)])
    piece = np.tile(np.arange(400), 4)
    plain, g = K.Arrangement(np.zeros(1600, np.int64), 1, e, np.zeros(1600, np.int64), 1).boundary(union._covered)[::-1]
    sizes, made = [], K.Arrangement
    monkeypatch.setattr(K, "Arrangement", lambda g, n, e, *rest: sizes.append(np.bincount(g, minlength=n).max()) or made(g, n, e, *rest))
    row, out = union._unite(np.zeros(1600, np.int64), 1, piece, e)
    assert K.area(row, 1, out) == pytest.approx(K.area(g, 1, plain)) and K.perimeter(row, 1, out) == pytest.approx(K.perimeter(g, 1, plain))
    assert max(sizes) < 800


def test_copies_go_before_a_union_is_planned(spark, monkeypatch):
    """3000 copies of one road crowd no tile, as they are one strip of the union."""
    road = layer(spark, [(0, [[[(10, 10), (60, 10)]]])], 1).drop("id")
    roads = road.crossJoin(spark.range(3000))
    plans, made = [], union.plan_tiles
    monkeypatch.setattr(union, "plan_tiles", lambda *a, **k: plans.append(made(*a, **k)) or plans[-1])
    area, perimeter = total(union_buffer(roads, F.lit(3.0), style="square"))
    assert (area, perimeter) == pytest.approx((56 * 6, 2 * (56 + 6)))
    assert plans[0].hot is None and plans[0].crowded is None


def test_median_fill_counts_copies(spark):
    """A row that stands for five outweighs four others."""
    rows = [("a", 1.0, 5), ("a", 9.0, 1), ("a", 8.0, 1), ("a", 7.0, 1), ("a", 6.0, 1), ("a", None, 3)]
    df = spark.createDataFrame(rows, "nature string, largeur double, copies long")
    out = A.median_fill(df, "largeur", "nature", "copies").where("copies = 3").first()
    assert out["largeur"] == 1.0


def test_roads_that_are_alike_count_by_their_number(spark):
    """Three copies of a road: one strip of car space, three times its length, and one row to cut."""
    zones = layer(spark, [(1, box(0, 0, 100, 100))], 2).selectExpr("'01001' AS insee_com", "'01' AS insee_dep", "geom")
    road = layer(spark, [(0, [[[(10, 10), (60, 10)]]])], 1).drop("id")
    roads = road.crossJoin(spark.range(3)).selectExpr("id AS cleabs", "'x' AS nature", "2.0D AS largeur", "geom")
    plots = layer(spark, [(1, box(70, 70, 80, 80))], 2).selectExpr("id AS cleabs", "'x' AS nature", "geom")
    urban = layer(spark, [(1, box(0, 0, 35, 100))], 2).selectExpr("id", "'x' AS classe", "geom")
    assert [r["copies"] for r in P.counted_roads(roads).collect()] == [3]
    out = P.zone_sums(zones, plots, roads, urban, style="square").first()
    assert out["road_length"] == pytest.approx(150) and out["road_urban_length"] == pytest.approx(75)
    assert out["car_area"] == pytest.approx(58 * 8 + 100)


def test_rows_of_one_row_group_are_dealt_evenly(spark, tmp_path):
    """Small splits of a file with a single row group: every part gets its share of the rows."""
    from sparcel.session import spread

    spark.range(400_000).selectExpr("id", "uuid() AS u").coalesce(1).write.parquet(str(tmp_path / "t"))
    sizes = spread(spark.read.parquet(str(tmp_path / "t"))).groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert sizes.sum() == 400_000 and len(sizes) >= 4 and sizes.max() < 2 * sizes.mean()


def _rectangles(rnd, n, wide=60):
    return [(x, y, x + rnd.randint(1, wide), y + rnd.randint(1, wide)) for x, y in ((rnd.randint(0, 200), rnd.randint(0, 200)) for _ in range(n))]


@pytest.mark.parametrize("plan", [TilePlan(4), TilePlan(9), TilePlan(2, covers=True), "hot"])
def test_overlay_of_rectangles_takes_their_corners(spark, monkeypatch, plan):
    """Pieces and measures by the join alone, once for each pair, whatever the tiles."""
    rnd = random.Random(11)
    ra, rb = _rectangles(rnd, 60), _rectangles(rnd, 50)
    # the ring may begin anywhere and turn either way
    rings = [(box(*r)[0][0][:-1] * 2)[k % 4:k % 4 + 5] for k, r in enumerate(ra)]
    a = layer(spark, [(k, [[ring[::1 if k % 3 else -1]]]) for k, ring in enumerate(rings)], 2).withColumnRenamed("id", "a")
    b = layer(spark, [(k, box(*r)) for k, r in enumerate(rb)], 2)
    if plan == "hot":
        plan = plan_tiles([a, b], target=1)
        assert plan.hot is not None
    monkeypatch.setattr(overlay, "pair_pieces", lambda *_: pytest.fail("edges are compared"))
    o = overlay_intersection(a, b, ["a"], ["id"], key_a=["a"], key_b=["id"], plan=plan, measured=True)
    got = o.select("a", "id", "area", "perimeter", G.area(), G.perimeter(), "geom").collect()
    want = {}
    for i, (x0, y0, x1, y1) in enumerate(ra):
        for j, (u0, v0, u1, v1) in enumerate(rb):
            w, h = min(x1, u1) - max(x0, u0), min(y1, v1) - max(y0, v0)
            if w > 0 and h > 0:
                want[i, j] = (w * h, 2 * (w + h))
    assert len(got) == len(want) and {(r[0], r[1]): (r[2], r[3]) for r in got} == want
    assert {(r[0], r[1]): (r[4], r[5]) for r in got} == want
    assert all(not r["geom"]["multi"] and r["geom"]["srid"] == 2154 for r in got)


def test_rectangles_among_other_polygons(spark, discs, monkeypatch):
    """Layers of both kinds: the same pairs, pieces and forms as by their edges."""
    rnd = random.Random(12)
    a = layer(spark, [(1000 + k, box(*r)) for k, r in enumerate(_rectangles(rnd, 40))], 2).unionByName(discs.where("id < 25"))
    b = layer(spark, [(2000 + k, box(*r)) for k, r in enumerate(_rectangles(rnd, 40))], 2).unionByName(discs.where("id >= 95"))
    a = a.withColumnRenamed("id", "a")

    def both():
        o = overlay_intersection(a, b, ["a"], ["id"], key_a=["a"], key_b=["id"], plan=TilePlan(5), measured=True)
        rows = o.select("a", "id", "area", "perimeter", "geom").collect()
        return sorted((r[0], r[1], round(r[2], 6), round(r[3], 6), r[4]["multi"], len(r[4]["parts"][0][0])) for r in rows)

    got = both()
    monkeypatch.setattr(overlay, "_boxes", lambda *_: (False, True))
    assert got == both() and len(got) > 100


def test_spatial_join_of_rectangles_takes_their_corners(spark, monkeypatch):
    """Touching counts; each pair is made once, so pairs are not shuffled; keys that repeat give their pairs once."""
    rnd = random.Random(13)
    ra, rb = _rectangles(rnd, 60), _rectangles(rnd, 50)
    a, b = (layer(spark, [(k, box(*r)) for k, r in enumerate(rs)], 2) for rs in (ra, rb))
    monkeypatch.setattr(overlay, "pair_pieces", lambda *_: pytest.fail("edges are compared"))
    want = sorted((i, j) for i, r in enumerate(ra) for j, s in enumerate(rb) if r[0] <= s[2] and s[0] <= r[2] and r[1] <= s[3] and s[1] <= r[3])
    for plan in (TilePlan(4), TilePlan(2, covers=True), plan_tiles([a, b], target=1)):
        assert sorted(tuple(r) for r in spatial_join(a, b, ["id"], ["id"], plan).collect()) == want
    twice = spatial_join(a.unionByName(a), b, ["id"], ["id"], TilePlan(6))
    assert sorted(tuple(r) for r in twice.collect()) == want


def _plain(spark, rects):
    return spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(rects)], "id long, x0 double, y0 double, x1 double, y1 double").select(
        "id", G.rectangle("x0", "y0", "x1", "y1").alias("geom")
    )


def _shuffled(df):
    """Rows that the shuffles of a query that has run wrote."""
    def walk(node):
        metrics, name = node.metrics(), node.nodeName()
        if name == "AdaptiveSparkPlan" or name.endswith("QueryStage"):
            return walk(node.executedPlan() if name == "AdaptiveSparkPlan" else node.plan())
        below = node.children()
        own = metrics.apply("shuffleRecordsWritten").value() if metrics.contains("shuffleRecordsWritten") else 0
        return own + sum(walk(below.apply(k)) for k in range(below.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_dense_rectangles_are_shuffled_about_once(spark, monkeypatch):
    """However dense rectangles lie, no edges are cut, no ids are stored, and few rows are made of each."""
    rnd = random.Random(14)
    ra, rb = ([(x, y, x + rnd.randint(20, 140), y + rnd.randint(20, 140)) for x, y in ((rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(1500))] for _ in "ab")
    monkeypatch.setattr(overlay, "split_to_tiles", lambda *_: pytest.fail("edges are cut"))
    monkeypatch.setattr(overlay, "identified", lambda *_: pytest.fail("ids are stored"))
    o = overlay_intersection(_plain(spark, ra).withColumnRenamed("id", "a"), _plain(spark, rb), ["a"], ["id"], measured=True)
    sums = o.agg(F.count("*").alias("n"), F.sum("area").alias("area"), F.sum("perimeter").alias("perimeter"))
    got = sums.collect()[0]
    u, v = (np.array(r)[:, None] if k == 0 else np.array(r)[None] for k, r in enumerate((ra, rb)))
    w, h = (np.minimum(u[..., k + 2], v[..., k + 2]) - np.maximum(u[..., k], v[..., k]) for k in (0, 1))
    hit = (w > 0) & (h > 0)
    assert got["n"] == hit.sum() > 100_000
    assert (got["area"], got["perimeter"]) == ((w * h)[hit].sum(), 2 * (w + h)[hit].sum())
    # and a row of each task of the sum
    assert 3000 <= _shuffled(sums) < 2 * 3000 + 100


def test_rectangles_of_all_sizes_and_crowded_cells(spark, monkeypatch):
    """Sizes of cells that differ, and cells dealt to several tasks: each pair once, also of rows that are alike."""
    rnd = random.Random(15)
    def some(n, *wide):
        at = ((rnd.randint(-3000, 9000), rnd.randint(-3000, 9000)) for _ in range(n))
        return [(x, y, x + rnd.randint(1, wide[k % len(wide)]), y + rnd.randint(1, wide[k % len(wide)])) for k, (x, y) in enumerate(at)]
    pile = [(100, 100, 110, 110)] * 40
    monkeypatch.setattr(boxes, "CHUNK_ROWS", 30)
    for ra, rb in ((some(150, 40, 500, 4000), some(150, 300, 20000)), (some(60, 6000) + pile, some(200, 30) + pile), (some(60, 100) + pile, some(60, 100) + pile)):
        a, b = _plain(spark, ra), _plain(spark, rb)
        plan, others = boxes.plan_boxes(a, b)
        assert plan.hot is not None and not others
        rows = boxes._in_cells(a.withColumnRenamed("id", "a_id"), plan, 0, ["a_id"])
        most = rows.where("chunk > 0").groupBy("tile", "chunk").count().agg(F.max("count")).first()[0]
        assert most is None or most < 60
        want = sorted((i, j) for i, r in enumerate(ra) for j, q in enumerate(rb) if r[0] <= q[2] and q[0] <= r[2] and r[1] <= q[3] and q[1] <= r[3])
        assert sorted(tuple(r) for r in spatial_join(a, b, ["id"], ["id"]).collect()) == want
        o = overlay_intersection(a.withColumn("kind", F.lit("k")), b.withColumn("sort", F.lit("s")), ["kind"], ["sort"], measured=True)
        areas = [(min(r[2], q[2]) - max(r[0], q[0])) * (min(r[3], q[3]) - max(r[1], q[1])) for i, j in want for r, q in ((ra[i], rb[j]),)]
        assert sorted(r[0] for r in o.select("area").collect()) == sorted(x for x in areas if x > 0)


def test_rectangles_of_a_cell_meet_a_bounded_number_at_a_time(monkeypatch):
    rnd = np.random.default_rng(16)
    n = 400
    for few in (0, 1 << 30):
        monkeypatch.setattr(boxes, "FEW_PAIRS", few)
        monkeypatch.setattr(boxes, "PAIRS", 500)
        tile, chunk = boxes.B.pack(9, rnd.integers(0, 2, n), 0), rnd.integers(0, 2, n)
        side, own = rnd.integers(0, 2, n).astype(np.int8), rnd.random(n) < 0.7
        low = [rnd.integers(-100, 1000, n).astype(float), rnd.integers(-100, 500, n).astype(float)]
        at = [*low, *(v + rnd.integers(1, 300, n) for v in low)]
        found = list(boxes._met(tile, chunk, side, own, at))
        got = sorted((i, j) for x, y in found for i, j in zip(x.tolist(), y.tolist(), strict=True))
        corner = boxes.B.unpack(tile)[1] + boxes.K.OFFSET, boxes.B.unpack(tile)[2] + boxes.K.OFFSET
        want = sorted(
            (i, j) for i in np.flatnonzero(side == 0).tolist() for j in np.flatnonzero(side == 1).tolist()
            if tile[i] == tile[j] and chunk[i] == chunk[j] and (own[i] or own[j]) and all(
                at[k][i] <= at[k + 2][j] and at[k][j] <= at[k + 2][i] and max(at[k][i], at[k][j]) >= corner[k][i] for k in (0, 1))
        )
        assert got == want and len(got) > 500
        assert few or max(len(x) for x, _ in found) <= 500


def test_polygons_of_a_tile_are_clustered_a_few_at_a_time(monkeypatch):
    """What is compared at once is bounded where polygons pile up, and clusters are those of comparing all."""
    rnd = np.random.default_rng(5)
    for n, spread, r in ((600, 0.5, 3.0), (300, 60.0, 1.2), (300, 40.0, 2.0)):
        rings = [np.array(disc(*(30 + rnd.uniform(-spread, spread, 2)), rnd.uniform(0.5, 1) * r, 8)[0][0]) for _ in range(n)]
        lines = [np.array([c, c + rnd.uniform(-2, 2, 2)]) for c in 30 + rnd.uniform(-spread, spread, (20, 2))]
        e = [components.K.snap(np.concatenate([q[:-1], q[1:]], axis=1)) for q in [*rings, *lines]]
        lab, dims = np.repeat(np.arange(n + 20), [len(x) for x in e]), np.repeat([2, 1], [n, 20])
        whole, most, touching = components._touching(lab, np.concatenate(e), dims), [], components._touching
        monkeypatch.setattr(components, "_touching", lambda lab, e, dims, chunk=None: most.append(
            np.bincount(chunk).max() if chunk is not None else len(e)) or touching(lab, e, dims, chunk))
        u, v = components._clusters(lab, np.concatenate(e), dims)
        monkeypatch.undo()
        root, want = np.arange(n + 20), np.arange(n + 20)
        root[v], want[whole[1]] = u, whole[0]
        assert (root == want).all() and len(np.unique(want)) < n
        assert len(most) > 1 and (spread > 1 or max(most) < 0.2 * len(lab))


def test_a_feature_over_the_whole_tile_links_all_others_there(spark):
    a = layer(spark, [(5, box(0, 0, 64, 64)), *[(10 + k, disc(32 + k / 9, 32, 5)) for k in range(40)], (2, box(200, 0, 203, 3))], 2)
    low = components.K.OFFSET
    top = [low + 16, low + 16, low, low + 16]
    tile, names = np.array([components.B.pack(4, 0, 0)]), components.pa.array([9, 7, 3])
    assert components._hub(names, components.pa.array([[1.0, 1.0, 0.5, 1.0], top, top]), np.array([2, 2, 2]), tile) == 2
    assert components._hub(names, components.pa.array([[1.0, 1.0, 0.5, 1.0]] * 3), np.array([2, 2, 2]), tile) is None
    got = {r["id"]: r["cluster"] for r in cluster_touching(a, "id", TilePlan(4)).collect()}
    assert got == {2: 2, 5: 5, **{10 + k: 5 for k in range(40)}}
