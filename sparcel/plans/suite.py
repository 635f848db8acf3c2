"""One query per operator over the derived layers, with the SQL that checks it.

``QUERIES`` and ``ORACLES`` share their keys. Every query reads whole tables; only the analysis
itself keeps some categories of its layers, which is part of it. A query without an oracle entry is covered by closed forms and properties in the tests.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crs
from ..functions import geometry as G
from ..operators import attributes as A
from ..operators import checks as C
from ..operators import relations as R
from ..operators.components import cluster_touching
from ..operators.overlay import lines_in_region, overlay_intersection, overlay_measures, overlay_pairs, spatial_join
from ..operators.tiling import plan_tiles
from ..operators.union import assemble, dissolve, dissolve_polygons, measure, region, union_buffer, union_where_equals, union_where_like
from ..session import scratch, tune
from ..sources import features as S
from ..sources import tables as TB
from . import fixtures as X
from . import report as P
from . import zonal as Z
from .catalog import LayerCatalog

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(tune(spark), sf_dir)

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if oracle is not None:
            ORACLES[f.__name__] = oracle.strip()
        return f

    return register


def cte(*layers: str, chosen: bool = False) -> str:
    """Layers as common table expressions; ``chosen`` keeps the categories of the analysis, as in ``fixtures``."""
    where = {n: "" for n in X.SQL} if not chosen else {
        "zone": "WHERE insee_com NOT LIKE '97%'",
        "equip": "WHERE nature IN ('ECONOMY','LARGE','MEDIUM')",
        "landcover": "WHERE classe IN ('BUILDING','FURNITURE','HOUSEHOLD')",
        "road": "WHERE nature <> '5-LOW'", "pt": "",
    }
    return ", ".join(f"{n} AS (SELECT * FROM ({X.SQL[n]}) t {where[n]})" for n in layers)


def cells(layer: str, name: str = "cells", extra: str = "") -> str:
    """Distinct unit cells covered by a layer's rectangles."""
    cols = f"{extra}, " if extra else ""
    return (
        f"{name} AS (SELECT DISTINCT {cols}x0+i AS x, y0+j AS y FROM {layer}, "
        "unnest(range(CAST(x1-x0 AS BIGINT))) a(i), unnest(range(CAST(y1-y0 AS BIGINT))) b(j))"
    )


# Area and perimeter of the table ``cells`` (x, y), also for groups.
TOTAL = """
SELECT CAST((SELECT count(*) FROM cells) AS DOUBLE) AS area,
       CAST(2*(SELECT count(*) FROM cells c ANTI JOIN cells d ON d.x=c.x+1 AND d.y=c.y)
          + 2*(SELECT count(*) FROM cells c ANTI JOIN cells d ON d.x=c.x AND d.y=c.y+1) AS DOUBLE) AS perimeter
"""


def _read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _r(col, digits=6):
    return F.round(col, digits)


def _measured(reg):
    return measure(reg).select(_r(F.col("area")).alias("area"), _r(F.col("perimeter")).alias("perimeter"))


# ------------------------------------------------------------------ sources and sinks


@query("SELECT CAST(c_custkey AS VARCHAR) AS CODE_DPT, c_name AS NOM_DPT, CAST(c_nationkey AS INTEGER) AS CODE_REG, c_mktsegment AS NOM_REG, upper(c_mktsegment) AS OSM_REG FROM customer")
def src_lookup_tsv(spark, d):
    path = scratch(spark, "lookup")
    c = _read(spark, d, "customer").select(
        F.col("c_custkey").alias("CODE_DPT"), F.col("c_name").alias("NOM_DPT"), F.col("c_nationkey").alias("CODE_REG"),
        F.col("c_mktsegment").alias("NOM_REG"), F.upper("c_mktsegment").alias("OSM_REG"),
    )
    c.write.csv(path, sep="\t", header=True)
    return TB.read_lookup(spark, path)


@query("SELECT c_custkey, lower(n_name) AS region FROM customer JOIN nation ON n_nationkey = c_nationkey")
def lookup_region(spark, d):
    lookup = _read(spark, d, "nation")
    c = _read(spark, d, "customer").select("c_custkey", "c_nationkey")
    return TB.lookup_join(c, lookup, "c_nationkey", "n_nationkey", "n_name", "region").select("c_custkey", "region")


@query(f"WITH {cte('equip')} SELECT cleabs, nature, CAST((x1-x0)*(y1-y0) AS DOUBLE) AS area FROM equip WHERE x1 >= 1000 AND y1 >= 1000 AND x0 <= 4000 AND y0 <= 4500")
def src_feature_layer(spark, d):
    path = scratch(spark, "layer")
    S.write_layer(X.equipment(spark, d).select("cleabs", "nature", "geom"), f"{path}/plots")
    out = S.read_features(spark, path, "plots", box=(1000, 1000, 4000, 4500))
    return out.select("cleabs", "nature", G.area().alias("area"))


@query(f"WITH {cte('road')} SELECT cleabs, CAST((x1-x0)+(y1-y0) AS DOUBLE) AS length FROM road")
def src_wkt_layer(spark, d):
    path = scratch(spark, "wkt")
    X.roads(spark, d).select("cleabs", S.to_wkt().alias("wkt")).write.parquet(path)
    return S.read_features(spark, path, column="wkt", encoding="wkt", srid=G.TARGET_SRID).select("cleabs", G.length().alias("length"))


_SYSTEM = "CASE cleabs % 3 WHEN 0 THEN 2154 WHEN 1 THEN 4326 ELSE 3857 END"


def _systems(spark, d):
    """Roads in three reference systems (the numbers stay, only the system differs)."""
    return X.roads(spark, d).withColumn("geom", F.col("geom").withField("srid", F.expr(_SYSTEM)))


@query(f"WITH {cte('road')} SELECT cleabs, nature, largeur, 'ST_LineString' AS type, {_SYSTEM} AS srid, CAST((x1-x0)+(y1-y0) AS DOUBLE) AS length FROM road")
def sink_layer_roundtrip(spark, d):
    path = scratch(spark, "roads")
    S.write_layer(X.roads(spark, d), path)
    S.write_layer(_systems(spark, d), path)
    out = S.read_features(spark, path)
    return out.select("cleabs", "nature", "largeur", G.type_name().alias("type"), F.col("geom.srid").alias("srid"), G.length().alias("length"))


@query(f"WITH {cte('road')} SELECT cleabs, {_SYSTEM} AS srid, CAST((x1-x0)+(y1-y0) AS DOUBLE) AS length FROM road UNION ALL SELECT cleabs, 3857, CAST((x1-x0)+(y1-y0) AS DOUBLE) FROM road")
def src_srid_from_data(spark, d):
    """The reference system comes with the values, as EWKB and as EWKT."""
    path = scratch(spark, "systems")
    S.encode_wkb(_systems(spark, d).select("cleabs", "geom")).write.parquet(f"{path}/wkb")
    text = F.concat(F.lit("SRID=3857;"), S.to_wkt()).alias("wkt")
    X.roads(spark, d).select("cleabs", text).write.parquet(f"{path}/wkt")
    both = S.read_features(spark, path, "wkb").unionByName(S.read_features(spark, path, "wkt", encoding="wkt"))
    return both.select("cleabs", F.col("geom.srid").alias("srid"), G.length().alias("length"))


@query("SELECT lpad(CAST(c_nationkey AS VARCHAR), CAST(greatest(length(CAST(c_nationkey AS VARCHAR)), 2) AS INTEGER), '0') AS dep, c_name AS num_insee, c_acctbal AS total FROM customer")
def sink_result_tsv(spark, d):
    path = scratch(spark, "result")
    c = _read(spark, d, "customer").select(F.col("c_name").alias("num_insee"), F.col("c_acctbal").alias("total"), F.col("c_nationkey").alias("dep"))
    TB.write_results(c, path)
    return TB.read_results(spark, path, "num_insee string, total double, dep string")


# ------------------------------------------------------------------ rows, columns, scalars


@query("SELECT p_partkey, p_type FROM part WHERE p_type IN ('ECONOMY','LARGE','MEDIUM')")
def filter_isin(spark, d):
    return A.extract_features(_read(spark, d, "part"), "p_type", X.EQUIP_NATURES).select("p_partkey", "p_type")


@query("SELECT o_orderkey AS cleabs, o_orderpriority AS nature, o_totalprice AS largeur FROM orders")
def project_rename(spark, d):
    return A.subset_columns(_read(spark, d, "orders"), ["o_orderkey", "o_orderpriority", "o_totalprice"], ["cleabs", "nature", "largeur"])


@query("SELECT id, seg FROM (SELECT c_custkey AS id, nullif(c_mktsegment, 'MACHINERY') AS seg FROM customer) t WHERE seg IS NULL OR seg NOT LIKE 'B%'")
def delete_like(spark, d):
    c = _read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.expr("nullif(c_mktsegment, 'MACHINERY')").alias("seg"))
    return A.delete_like(c, "seg", "B%")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '2-HIGH'")
def filter_equals(spark, d):
    return A.filter_equals(_read(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "2-HIGH")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment LIKE 'B%'")
def filter_like_prefix(spark, d):
    return A.filter_like(_read(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "B%")


@query(f"WITH {cte('road')} SELECT cleabs, largeur FROM road WHERE largeur IS NULL OR largeur = 0")
def filter_null_or_zero(spark, d):
    return X.roads(spark, d).where(A.null_or_zero("largeur")).select("cleabs", "largeur")


@query("""SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(length(CAST(c_custkey AS VARCHAR)), 2) AS INTEGER), '0') AS pad2,
  lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(length(CAST(c_custkey AS VARCHAR)), 3) AS INTEGER), '0') AS pad3 FROM customer""")
def scalar_zfill(spark, d):
    return _read(spark, d, "customer").select("c_custkey", A.zero_pad("c_custkey", 2).alias("pad2"), A.zero_pad("c_custkey", 3).alias("pad3"))


_RAW = """SELECT CAST(o_orderkey AS VARCHAR(20)) AS a, o_totalprice AS b, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice / 4 END AS c,
 CAST(o_orderkey % 97 AS DOUBLE) AS d, CAST(o_orderkey % 89 AS DOUBLE) AS e, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 71 + 1 AS DOUBLE) END AS f,
 CAST(o_orderkey % 13 + 1 AS DOUBLE) AS g, CAST(o_custkey % 50 AS DOUBLE) AS h, CAST(o_custkey % 40 AS DOUBLE) AS i FROM """


@query(f"""WITH q(num_insee, ArCom, ArVoiCom, PeVoiCom, LeTroCom, ArUrb, ArVoiUrb, PeVoiUrb, LeTroUrb) AS ({_RAW} orders)
SELECT num_insee, ArCom, coalesce(ArVoiCom,0) AS ArVoiCom, PeVoiCom, LeTroCom, coalesce(ArUrb,0) AS ArUrb, ArVoiUrb, PeVoiUrb, LeTroUrb,
 coalesce(round(ArVoiUrb/nullif(ArVoiCom,0)*100,6),0) AS PaArVoi, coalesce(round(LeTroUrb/nullif(LeTroCom,0)*100,6),0) AS PaLeTro,
 coalesce(round(ArVoiCom/nullif(ArCom,0)*100,6),0) AS PaArVoiCom, coalesce(round(ArVoiUrb/nullif(ArUrb,0)*100,6),0) AS PaArVoiUrb,
 coalesce(round(LeTroCom/nullif(ArCom,0),6),0) AS RaLeArTroCom, coalesce(round(LeTroUrb/nullif(ArUrb,0),6),0) AS RaLeArTroUrb,
 coalesce(round(PeVoiCom/nullif(sqrt(ArVoiCom),0),6),0) AS RaPeArVoiCom, coalesce(round(PeVoiUrb/nullif(sqrt(ArVoiUrb),0),6),0) AS RaPeArVoiUrb FROM q""")
def ratio_indicators(spark, d):
    raw = spark.sql(_RAW + "{o}", o=_read(spark, d, "orders"))
    out = Z.indicators(raw)
    return out.select(*Z.RESULT_COLUMNS[:9], *[_r(F.col(c)).alias(c) for c in Z.RESULT_COLUMNS[9:]])


@query(f"WITH {cte('road')} SELECT cleabs, coalesce(largeur, 0) AS largeur FROM road")
def fillna_zero(spark, d):
    return X.roads(spark, d).select("cleabs", "largeur").fillna(0)


@query("SELECT c_custkey AS num_insee, c_nationkey AS ArCom, c_acctbal AS ArVoiCom FROM customer")
def relabel_positional(spark, d):
    return Z.relabel(_read(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), Z.RESULT_COLUMNS)


# ------------------------------------------------------------------ geometry functions


def _frames(spark, d):
    """Equipment as frames: rectangles with a rectangular hole two metres inside."""
    q = X.raw(spark, d, "equip")
    ring = lambda e: F.array(
        G.vertex(F.col("x0") + e, F.col("y0") + e), G.vertex(F.col("x1") - e, F.col("y0") + e), G.vertex(F.col("x1") - e, F.col("y1") - e),
        G.vertex(F.col("x0") + e, F.col("y1") - e), G.vertex(F.col("x0") + e, F.col("y0") + e),
    )
    return q.select("cleabs", G.make_geom(2, F.array(F.array(ring(0), ring(2)))).alias("geom"))


@query(f"WITH {cte('equip')} SELECT cleabs, CAST((x1-x0)*(y1-y0) - (x1-x0-4)*(y1-y0-4) AS DOUBLE) AS area FROM equip")
def geom_area(spark, d):
    return _frames(spark, d).select("cleabs", G.area().alias("area"))


@query(f"WITH {cte('equip')} SELECT cleabs, CAST(2*(x1-x0+y1-y0) + 2*(x1-x0+y1-y0-8) AS DOUBLE) AS perimeter FROM equip")
def geom_perimeter(spark, d):
    return _frames(spark, d).select("cleabs", G.perimeter().alias("perimeter"))


@query(f"WITH {cte('road')} SELECT cleabs, CAST((x1-x0)+(y1-y0) AS DOUBLE) AS length, CAST(0 AS DOUBLE) AS area FROM road")
def geom_length(spark, d):
    return X.roads(spark, d).select("cleabs", G.length().alias("length"), G.area().alias("area"))


def _mixed(spark, d):
    """All layers in one, every third geometry declared multi."""
    multi = lambda k: F.when(F.col(k) % 3 == 0, G.to_multi()).otherwise(F.col("geom")).alias("geom")
    return (
        X.equipment(spark, d).select(F.col("cleabs").alias("id"), multi("cleabs"))
        .unionByName(X.roads(spark, d).select(F.col("cleabs").alias("id"), multi("cleabs")))
        .unionByName(X.points(spark, d).select("id", F.col("geom")))
    )


_KIND = """SELECT cleabs AS id, 2 AS dim, cleabs % 3 = 0 AS multi FROM equip UNION ALL SELECT cleabs, 1, cleabs % 3 = 0 FROM road
UNION ALL SELECT id, 0, false FROM pt"""
_NAME = "concat('ST_', CASE WHEN multi THEN 'Multi' ELSE '' END, CASE dim WHEN 0 THEN 'Point' WHEN 1 THEN 'LineString' ELSE 'Polygon' END)"


@query(f"WITH {cte('equip', 'road', 'pt')} SELECT dim AS dimension, count(*) AS n FROM ({_KIND}) k GROUP BY dim")
def geom_dimension(spark, d):
    return _mixed(spark, d).groupBy(G.dimension().alias("dimension")).agg(F.count("*").alias("n"))


@query(f"WITH {cte('equip', 'road', 'pt')} SELECT DISTINCT {_NAME} AS type FROM ({_KIND}) k")
def geom_types_distinct(spark, d):
    return C.geometry_types(_mixed(spark, d))


@query(f"WITH {cte('equip', 'road', 'pt')} SELECT id, substr({_NAME}, 4) AS type, replace(substr({_NAME}, 4), 'Multi', '') AS single FROM ({_KIND}) k")
def geom_type_map(spark, d):
    name = G.type_name()
    return _mixed(spark, d).select("id", G.plain_type(name).alias("type"), G.plain_type(name, False).alias("single"))


@query(f"""WITH {cte('equip', 'road', 'pt')} SELECT 'equip' AS layer, 'Polygon' AS kind, count(*) AS n FROM equip UNION ALL
 SELECT 'road', 'LineString', count(*) FROM road UNION ALL SELECT 'pt', 'Point', count(*) FROM pt""")
def guard_single_type(spark, d):
    out = None
    for name, df in (("equip", X.equipment(spark, d)), ("road", X.roads(spark, d)), ("pt", X.points(spark, d))):
        kind = C.single_type(df)
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("layer"), F.lit(kind).alias("kind"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query(f"WITH {cte('equip', 'road')} SELECT DISTINCT srid FROM (SELECT 2154 AS srid FROM equip UNION ALL SELECT CASE WHEN cleabs % 2 = 0 THEN 4326 ELSE 2154 END FROM road) q")
def geom_srid_distinct(spark, d):
    roads = X.roads(spark, d).withColumn("geom", F.col("geom").withField("srid", F.when(F.col("cleabs") % 2 == 0, 4326).otherwise(2154)))
    return C.srids(C.union_all(X.equipment(spark, d), roads))


@query(f"WITH {cte('road')} SELECT cleabs, 'ST_MultiLineString' AS type, 1 AS parts FROM road")
def geom_to_multi(spark, d):
    r = X.roads(spark, d).select("cleabs", G.to_multi().alias("geom"))
    return r.select("cleabs", G.type_name().alias("type"), F.size("geom.parts").alias("parts"))


@query(f"WITH {cte('road')} SELECT cleabs, CAST(x0 AS DOUBLE) AS xa, CAST(y1 AS DOUBLE) AS yb, CAST((x1-x0)+(y1-y0) AS DOUBLE) AS length, 2154 AS srid FROM road")
def geom_force_2d(spark, d):
    r = X.roads(spark, d)
    deep = G.map_vertices("geom", lambda v: F.struct(v.x.alias("x"), v.y.alias("y"), (v.x + v.y).alias("z")))
    flat = crs.project_3d_to_2d(r.select("cleabs", deep.alias("geom")))
    if G.has_z(flat):
        raise AssertionError("z was kept")
    ring = F.col("geom.parts")[0][0]
    return flat.select("cleabs", ring[0]["x"].alias("xa"), ring[1]["y"].alias("yb"), G.length().alias("length"), G.srid().alias("srid"))


def _l93_sql() -> str:
    e = "sqrt((1/298.257222101)*(2-1/298.257222101))"
    m = lambda p: f"(cos(radians({p}))/sqrt(1-({e}*sin(radians({p})))*({e}*sin(radians({p})))))"
    t = lambda p: f"(tan(pi()/4-radians({p})/2)/pow((1-{e}*sin(radians({p})))/(1+{e}*sin(radians({p}))), {e}/2))"
    return f"""WITH g AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 4326 ELSE 3857 END AS srid,
   -4.5 + CAST(event_id % 1283 AS DOUBLE)/100 AS lon, 41.5 + CAST(event_id % 941 AS DOUBLE)/100 AS lat FROM events),
 k AS (SELECT (ln({m(44)})-ln({m(49)}))/(ln({t(44)})-ln({t(49)})) AS n),
 c AS (SELECT n, 6378137.0*{m(44)}/(n*pow({t(44)},n)) AS f FROM k)
 SELECT event_id, 2154 AS srid, round(700000 + f*pow({t('lat')},n)*sin(n*radians(lon-3)),3) AS x,
   round(6600000 + f*pow({t(46.5)},n) - f*pow({t('lat')},n)*cos(n*radians(lon-3)),3) AS y FROM g, c"""


@query(_l93_sql())
def geom_to_l93(spark, d):
    e = _read(spark, d, "events").select("event_id")
    lon = F.lit(-4.5) + (F.col("event_id") % 1283).cast("double") / 100
    lat = F.lit(41.5) + (F.col("event_id") % 941).cast("double") / 100
    mx, my = F.radians(lon) * crs.MERCATOR_R, F.log(F.tan(math.pi / 4 + F.radians(lat) / 2)) * crs.MERCATOR_R
    even = F.col("event_id") % 2 == 0
    g = F.when(even, G.point(lon, lat, 4326)).otherwise(G.point(mx, my, 3857))
    p = e.select("event_id", crs.to_l93(g).alias("geom"))
    v = F.col("geom.parts")[0][0][0]
    return p.select("event_id", G.srid().alias("srid"), _r(v["x"], 3).alias("x"), _r(v["y"], 3).alias("y"))


@query(f"""WITH {cte('road')}, q AS (SELECT cleabs, CAST((x1-x0)+(y1-y0) AS DOUBLE) AS l, largeur + 2 AS r FROM road)
SELECT cleabs, round(2*r*l + 16*r*r*sin(pi()/16), 6) AS area, round(2*l + 64*r*sin(pi()/32), 6) AS perimeter FROM q""")
def geom_buffer_segment(spark, d):
    b = X.roads(spark, d).select("cleabs", G.buffer("geom", F.col("largeur") + 2).alias("geom"))
    return b.select("cleabs", _r(G.area()).alias("area"), _r(G.perimeter()).alias("perimeter"))


@query(f"WITH {cte('equip')} SELECT cleabs, 'ST_MultiPolygon' AS type FROM equip")
def geom_assert(spark, d):
    e = X.equipment(spark, d).select("cleabs", G.to_multi().alias("geom"))
    return C.assert_geom(e, "MultiPolygon", 2154).select("cleabs", G.type_name().alias("type"))


@query(f"""WITH {cte('road')} SELECT cleabs, 0 AS part, CAST((x1-x0)+(y1-y0) AS DOUBLE) AS length FROM road
UNION ALL SELECT cleabs, 1, CAST((x1-x0)+(y1-y0) AS DOUBLE) FROM road WHERE cleabs % 2 = 0""")
def geom_dump(spark, d):
    g = F.col("geom")
    shifted = F.transform(g["parts"], lambda p: F.transform(p, lambda r: F.transform(r, lambda v: G.vertex(v.x + 7, v.y))))
    r = X.roads(spark, d).withColumn("geom", F.when(F.col("cleabs") % 2 == 0, g.withField("parts", F.concat(g["parts"], shifted))).otherwise(g))
    return G.dump(r, index="part").select("cleabs", "part", G.length().alias("length"))


# ------------------------------------------------------------------ joins and overlays


@query(f"""WITH {cte('zone', 'road')} SELECT insee_com AS a_insee_com, cleabs AS b_cleabs FROM zone z JOIN road r
 ON r.x0 <= z.x1 AND r.x1 >= z.x0 AND r.y0 <= z.y1 AND r.y1 >= z.y0""")
def spatial_join_lines(spark, d):
    return spatial_join(X.zones(spark, d), X.roads(spark, d), ["insee_com"], ["cleabs"])


@query(f"""WITH {cte('equip', 'landcover')} SELECT cleabs AS a_cleabs, id AS b_id FROM equip e JOIN landcover l
 ON l.x0 <= e.x1 AND l.x1 >= e.x0 AND l.y0 <= e.y1 AND l.y1 >= e.y0""")
def spatial_join_polygons(spark, d):
    return spatial_join(X.equipment(spark, d), X.landcover(spark, d), ["cleabs"], ["id"])


_BOX = """least(a.x1,b.x1)-greatest(a.x0,b.x0) AS w, least(a.y1,b.y1)-greatest(a.y0,b.y0) AS h"""


@query(f"""WITH {cte('zone', 'equip')}, q AS (SELECT insee_com, cleabs, nature, {_BOX} FROM zone a, equip b)
SELECT insee_com, cleabs, nature, CAST(w*h AS DOUBLE) AS area, CAST(2*(w+h) AS DOUBLE) AS perimeter FROM q WHERE w > 0 AND h > 0""")
def overlay_polygon(spark, d):
    o = overlay_intersection(X.zones(spark, d), X.equipment(spark, d), ["insee_com"], ["cleabs", "nature"])
    return o.select("insee_com", "cleabs", "nature", _r(G.area()).alias("area"), _r(G.perimeter()).alias("perimeter"))


@query(f"""WITH {cte('equip', 'landcover')}, q AS (SELECT cleabs, id, {_BOX} FROM equip a, landcover b WHERE a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1)
SELECT cleabs, id, CAST(w*h AS DOUBLE) AS area, CAST(2*(w+h) AS DOUBLE) AS perimeter FROM q""")
def overlay_polygon_dense(spark, d):
    o = overlay_intersection(X.equipment(spark, d), X.landcover(spark, d), ["cleabs"], ["id"], measured=True)
    return o.select("cleabs", "id", _r(F.col("area")).alias("area"), _r(F.col("perimeter")).alias("perimeter"))


@query(f"""WITH {cte('equip')}, sky AS ({X.SKYLINE}),
 q AS (SELECT cleabs, (least(x1*8, b) - greatest(x0*8, a)) * (least(y1, h) - y0) AS eighths FROM equip JOIN sky ON a < x1*8 AND x0*8 < b AND y0 < h)
SELECT cleabs, CAST(sum(eighths) AS DOUBLE) / 8 AS area FROM q GROUP BY cleabs""")
def overlay_large_polygon(spark, d):
    """Plots under one polygon of very many vertices, which lies in many tiles."""
    o = overlay_intersection(X.skyline(spark, d), X.equipment(spark, d), [], ["cleabs"])
    return o.groupBy("cleabs").agg(_r(F.sum(G.area())).alias("area"))


@query(f"""WITH {cte('zone', 'landcover')}, q AS (SELECT insee_com, id, {_BOX} FROM zone a, landcover b WHERE a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1)
SELECT insee_com AS a_insee_com, id AS b_id, CAST(w*h AS DOUBLE) AS area, 'ST_MultiPolygon' AS type FROM q""")
def overlay_pairs_multi(spark, d):
    o = overlay_pairs(X.zones(spark, d), X.landcover(spark, d), ["insee_com"], ["id"])
    return o.select("a_insee_com", "b_id", _r(G.area()).alias("area"), G.type_name().alias("type"))


@query(f"""WITH {cte('zone', 'road')}, q AS (SELECT insee_com, cleabs, {_BOX} FROM zone a JOIN road b ON b.x0 <= a.x1 AND b.x1 >= a.x0 AND b.y0 <= a.y1 AND b.y1 >= a.y0)
SELECT insee_com, cleabs, CAST(w+h AS DOUBLE) AS length, 2 AS vertices FROM q WHERE w + h > 0""")
def overlay_line(spark, d):
    o = overlay_intersection(X.zones(spark, d), X.roads(spark, d), ["insee_com"], ["cleabs"])
    return o.select("insee_com", "cleabs", _r(G.length()).alias("length"), G.vertex_count().alias("vertices"))


@query(f"""WITH {cte('zone', 'road')}, q AS (SELECT a.insee_com, b.nature, {_BOX} FROM zone a JOIN road b ON b.x0 <= a.x1 AND b.x1 >= a.x0 AND b.y0 <= a.y1 AND b.y1 >= a.y0)
SELECT insee_com, nature, CAST(w+h AS DOUBLE) AS length FROM q WHERE w + h > 0""")
def overlay_line_shared_field(spark, d):
    """Roads that share the only field asked for stay rows of their own."""
    o = overlay_intersection(X.zones(spark, d), X.roads(spark, d), ["insee_com"], ["nature"])
    return o.select("insee_com", "nature", _r(G.length()).alias("length"))


@query(f"""WITH {cte('zone', 'equip')}, q AS (SELECT a.insee_dep, b.nature, {_BOX} FROM zone a, equip b WHERE a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1)
SELECT insee_dep, nature, CAST(w*h AS DOUBLE) AS area FROM q""")
def overlay_polygon_shared_field(spark, d):
    """The same for polygons, with a field that repeats on either side."""
    o = overlay_intersection(X.zones(spark, d), X.equipment(spark, d), ["insee_dep"], ["nature"])
    return o.select("insee_dep", "nature", _r(G.area()).alias("area"))


@query(f"""WITH {cte('zone', 'road', 'landcover')},
 p AS (SELECT a.insee_com, greatest(a.x0,b.x0) AS x0, least(a.x1,b.x1) AS x1, greatest(a.y0,b.y0) AS y0, least(a.y1,b.y1) AS y1
   FROM zone a JOIN road b ON b.x0 <= a.x1 AND b.x1 >= a.x0 AND b.y0 <= a.y1 AND b.y1 >= a.y0),
 q AS (SELECT b.insee_com, {_BOX} FROM landcover a JOIN p b ON b.x0 <= a.x1 AND b.x1 >= a.x0 AND b.y0 <= a.y1 AND b.y1 >= a.y0 WHERE b.x1-b.x0+b.y1-b.y0 > 0)
SELECT insee_com, CAST(sum(w+h) AS DOUBLE) AS length FROM q WHERE w + h > 0 GROUP BY insee_com""")
def overlay_chain(spark, d):
    """Zones with roads keeping the zone's code, then landcover with those pieces: length by zone.

    Roads and land cover of equal geometry go in once, with their number, which the lengths are multiplied by.
    """
    catalog = LayerCatalog(spark)
    copies = lambda layer, name: layer(spark, d).groupBy("geom").agg(F.count("*").alias(name))
    R.create_relation(X.zones(spark, d), "chain_zone", as_view=True)
    R.create_relation(copies(X.roads, "roads"), "chain_road", as_view=True)
    R.create_relation(copies(X.landcover, "covers"), "chain_cover", as_view=True)
    catalog.intersect_geometries("chain_zone", "chain_road", ["insee_com"], ["roads"], out_name="chain_piece", as_view=True)
    catalog.intersect_geometries("chain_cover", "chain_piece", ["covers"], ["insee_com", "roads"], out_name="chain_end", as_view=True)
    total = F.sum(G.length() * F.col("covers") * F.col("roads"))
    out = catalog.table("chain_end").groupBy("insee_com").agg(_r(total).alias("length"))
    return out.select("insee_com", "length")


@query(f"WITH {cte('zone', 'pt')} SELECT insee_com, id, x, y FROM zone JOIN pt ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1")
def overlay_point(spark, d):
    pts = X.points(spark, d).withColumnRenamed("id", "event")
    o = overlay_intersection(X.zones(spark, d), pts, ["insee_com"], ["event"])
    v = F.col("geom.parts")[0][0][0]
    return o.select("insee_com", F.col("event").alias("id"), v["x"].alias("x"), v["y"].alias("y"))


@query(f"""WITH {cte('zone', 'road')}, dep AS (SELECT min(x0) AS x0, max(x1) AS x1, min(y0) AS y0, max(y1) AS y1 FROM zone WHERE insee_dep = '03'),
 q AS (SELECT cleabs, nature, {_BOX} FROM dep a JOIN road b ON b.x0 <= a.x1 AND b.x1 >= a.x0 AND b.y0 <= a.y1 AND b.y1 >= a.y0)
SELECT cleabs, nature, CAST(w+h AS DOUBLE) AS length FROM q WHERE w + h > 0""")
def overlay_crop(spark, d):
    """Crop the road layer to one département and let the result replace the layer."""
    zones, roads = X.zones(spark, d), X.roads(spark, d)
    plan = plan_tiles([zones, roads])
    dep = union_where_equals(zones, "insee_dep", "03", plan)
    o = lines_in_region(dep, roads, plan, [], ["cleabs"], ["cleabs", "nature"])
    return R.replace_relation(o, "road_layer").select("cleabs", "nature", _r(G.length()).alias("length"))


@query(f"""WITH {cte('zone', 'equip')}, q AS (SELECT insee_com, {_BOX} FROM zone a, equip b WHERE a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1)
SELECT insee_com, CAST(sum(w*h) AS DOUBLE) AS area, CAST(sum(2*(w+h)) AS DOUBLE) AS perimeter, CAST(0 AS DOUBLE) AS length FROM q GROUP BY insee_com""")
def overlay_totals(spark, d):
    o = overlay_measures(X.zones(spark, d), X.equipment(spark, d), ["insee_com"])
    return o.select("insee_com", _r(F.col("area")).alias("area"), _r(F.col("perimeter")).alias("perimeter"), _r(F.col("length")).alias("length"))


# ------------------------------------------------------------------ aggregates


_RECT = "CAST((x1-x0)*(y1-y0) AS DOUBLE)"


@query(f"WITH {cte('landcover')} SELECT classe, round(sum({_RECT})*1e-6, 9) AS area FROM landcover GROUP BY classe")
def zonal_area(spark, d):
    return Z.zonal_area(X.landcover(spark, d), "classe").select("classe", _r(F.col("area"), 9).alias("area"))


@query(f"WITH {cte('landcover')} SELECT classe, round(sum(CAST(2*(x1-x0+y1-y0) AS DOUBLE))*1e-3, 6) AS perimeter FROM landcover WHERE classe LIKE 'B%' GROUP BY classe")
def zonal_perimeter(spark, d):
    return Z.zonal_perimeter(X.landcover(spark, d), "classe", "B").select("classe", _r(F.col("perimeter")).alias("perimeter"))


@query(f"WITH {cte('road')} SELECT nature, round(sum(CAST(x1-x0+y1-y0 AS DOUBLE))*1e-3, 6) AS length FROM road GROUP BY nature")
def zonal_length(spark, d):
    return Z.zonal_length(X.roads(spark, d), "nature").select("nature", _r(F.col("length")).alias("length"))


@query(f"""WITH {cte('zone', 'equip', 'road')}, s AS (SELECT insee_com, sum(CAST(w*h AS DOUBLE)) AS v FROM (SELECT insee_com, {_BOX} FROM zone a, equip b) q WHERE w > 0 AND h > 0 GROUP BY insee_com),
 l AS (SELECT insee_com, sum(CAST(w+h AS DOUBLE)) AS v FROM (SELECT insee_com, {_BOX} FROM zone a JOIN road b ON b.x0 <= a.x1 AND b.x1 >= a.x0 AND b.y0 <= a.y1 AND b.y1 >= a.y0) q GROUP BY insee_com)
SELECT z.insee_com, round({_RECT}*1e-6, 6) AS zone_area, round(s.v*1e-6, 6) AS plot_area, round(l.v*1e-3, 6) AS road_length
FROM zone z FULL JOIN s USING (insee_com) FULL JOIN l USING (insee_com) WHERE insee_com LIKE '0%'""")
def zonal_outer_join(spark, d):
    zones = X.zones(spark, d)
    plots = overlay_measures(zones, X.equipment(spark, d), ["insee_com"]).select("insee_com", _r(F.col("area") * Z.KM2).alias("plot_area"))
    roads = overlay_measures(zones, X.roads(spark, d), ["insee_com"]).select("insee_com", _r(F.col("length") * Z.KM).alias("road_length"))
    out = Z.zonal_summary(zones, [plots, roads], "insee_com", "0")
    return out.select("insee_com", _r(F.col("zone_area")).alias("zone_area"), "plot_area", "road_length")


@query(f"WITH {cte('road')} SELECT nature, quantile_cont(largeur, 0.5) AS median FROM road GROUP BY nature")
def median_by_nature(spark, d):
    return A.median_by(X.roads(spark, d), "largeur", "nature")


@query(f"""WITH {cte('road')}, m AS (SELECT nature, quantile_cont(largeur, 0.5) AS med FROM road GROUP BY nature)
SELECT cleabs, nature, CASE WHEN largeur IS NULL OR largeur = 0 THEN med ELSE largeur END AS largeur FROM road JOIN m USING (nature)""")
def median_fill(spark, d):
    return A.median_fill(X.roads(spark, d).select("cleabs", "nature", "largeur"), "largeur", "nature")


# ------------------------------------------------------------------ unions


@query(f"WITH {cte('equip')}, {cells('equip')} {TOTAL}")
def union_all_area(spark, d):
    return _measured(region(X.equipment(spark, d)))


@query(f"WITH {cte('landcover')}, {cells('landcover')} {TOTAL}")
def union_urban(spark, d):
    return _measured(region(X.landcover(spark, d)))


@query(f"WITH {cte('zone')}, q AS (SELECT * FROM zone WHERE insee_dep = '02'), {cells('q')} {TOTAL}")
def union_where_equals_dep(spark, d):
    return _measured(union_where_equals(X.zones(spark, d), "insee_dep", "02"))


@query(f"WITH {cte('zone')}, q AS (SELECT insee_dep, x0, y0, x1, y1 FROM zone), {cells('q', extra='insee_dep')} SELECT insee_dep, CAST(count(*) AS DOUBLE) AS area, 'ST_Polygon' AS type FROM cells GROUP BY insee_dep")
def union_by_dep_polygons(spark, d):
    """Départements as whole polygons, from the union of their zones."""
    zones = X.zones(spark, d)
    out = assemble(region(zones, by=["insee_dep"]), ["insee_dep"])
    return out.select("insee_dep", _r(G.area()).alias("area"), G.type_name().alias("type"))


@query(f"WITH {cte('equip')}, {cells('equip')} {TOTAL}")
def create_union_whole(spark, d):
    """The union of a layer through the catalog, as whole polygons."""
    R.create_relation(X.equipment(spark, d), "union_layer", as_view=True)
    out = LayerCatalog(spark).create_union("union_layer", "union_whole", as_view=True)
    return out.agg(_r(F.sum(G.area())).alias("area"), _r(F.sum(G.perimeter())).alias("perimeter"))


@query(f"WITH {cte('landcover')}, q AS (SELECT * FROM landcover WHERE classe LIKE '%U%D%'), {cells('q')} {TOTAL}")
def union_where_like_class(spark, d):
    return _measured(union_where_like(X.landcover(spark, d), "classe", "%U%D%"))


@query(f"""WITH {cte('road')}, q AS (SELECT x0-largeur-2 AS x0, x1+largeur+2 AS x1, y0-largeur-2 AS y0, y1+largeur+2 AS y1 FROM road WHERE largeur IS NOT NULL),
 {cells('q')} {TOTAL}""")
def union_buffer_square(spark, d):
    return _measured(union_buffer(X.roads(spark, d), "largeur + 2", style="square"))


def _capsule(segment: str, point: str = "p") -> str:
    """Whether a point lies in the buffer of an axis-parallel segment with caps of 16 chords, exactly.

    In the box around the segment, that is in the strip, or no farther from an end than the chord of
    the point's direction, which is that of 32 chords all round.
    """
    def cap(k):
        dx, dy = f"({point}.x - {segment}.x{k})", f"({point}.y - {segment}.y{k})"
        return f"sqrt({dx}*{dx} + {dy}*{dy}) * cos((atan2({dy}, {dx}) + 2*pi()) % (pi()/16) - pi()/32) <= {segment}.r * cos(pi()/32)"

    x, y, s = f"{point}.x", f"{point}.y", segment
    return f"""{x} BETWEEN {s}.x0 - {s}.r AND {s}.x1 + {s}.r AND {y} BETWEEN {s}.y0 - {s}.r AND {s}.y1 + {s}.r
   AND (({s}.x1 > {s}.x0 AND {x} BETWEEN {s}.x0 AND {s}.x1) OR ({s}.y1 > {s}.y0 AND {y} BETWEEN {s}.y0 AND {s}.y1) OR {cap(0)} OR {cap(1)})"""


@query(f"""WITH {cte('road', 'pt')}, w AS (SELECT x0, y0, x1, y1, largeur + 2 AS r FROM road WHERE largeur IS NOT NULL)
SELECT DISTINCT p.id, p.x, p.y FROM pt p JOIN w ON {_capsule('w')}""")
def union_buffer_round_points(spark, d):
    """Points in the union of the round buffers of all roads."""
    roads, pts = X.roads(spark, d).select("geom", "largeur").distinct(), X.raw(spark, d, "pt")
    # points at one place are looked up once
    places = pts.groupBy("x", "y").agg(F.min("id").alias("place")).withColumn("geom", G.point("x", "y"))
    plan = plan_tiles([roads, places], weights=[10.0, 1.0])
    found = lines_in_region(union_buffer(roads, "largeur + 2", plan), places, plan, [], ["place"], ["place"])
    hit = places.join(found.select("place"), "place").select("x", "y")
    return pts.join(hit, ["x", "y"]).select("id", "x", "y")


@query()
def union_buffer_round(spark, d):
    return _measured(union_buffer(X.roads(spark, d), "largeur + 2"))


@query(f"""WITH RECURSIVE {cte('equip')}, e AS (SELECT a.cleabs AS u, b.cleabs AS v FROM equip a JOIN equip b ON a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1),
 walk(u, v) AS (SELECT u, v FROM e UNION SELECT w.u, e.v FROM walk w JOIN e ON e.u = w.v)
SELECT u AS cleabs, min(v) AS cluster FROM walk GROUP BY u""")
def cluster_touching_plots(spark, d):
    return cluster_touching(X.equipment(spark, d), "cleabs")


@query(f"WITH {cte('equip')} SELECT count(*) AS n, sum({_RECT}) AS area FROM equip")
def union_all_rows(spark, d):
    e = X.equipment(spark, d)
    both = C.union_all(e.where("src = 0"), e.where("src = 1"))
    return both.agg(F.count("*").alias("n"), F.sum(G.area()).alias("area"))


# The parts of the union that share cell sides (a corner contact does not join them).
_PARTS = f"""WITH RECURSIVE {cte('equip')}, e AS (SELECT a.cleabs AS u, b.cleabs AS v FROM equip a JOIN equip b ON a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1
   AND NOT ((a.x0 = b.x1 OR b.x0 = a.x1) AND (a.y0 = b.y1 OR b.y0 = a.y1))),
 walk(u, v) AS (SELECT u, v FROM e UNION SELECT w.u, e.v FROM walk w JOIN e ON e.u = w.v),
 lab AS (SELECT u AS cleabs, min(v) AS part FROM walk GROUP BY u),
 r AS (SELECT part, x0, y0, x1, y1 FROM equip JOIN lab USING (cleabs)), {cells('r', extra='part')},
 s AS (SELECT part, count(*) AS a FROM cells GROUP BY part),
 h AS (SELECT part, 2*count(*) AS p FROM cells c ANTI JOIN cells d ON d.part = c.part AND d.x = c.x+1 AND d.y = c.y GROUP BY part),
 v AS (SELECT part, 2*count(*) AS p FROM cells c ANTI JOIN cells d ON d.part = c.part AND d.x = c.x AND d.y = c.y+1 GROUP BY part)
SELECT CAST(a AS DOUBLE) AS area, CAST(h.p + v.p AS DOUBLE) AS perimeter FROM s JOIN h USING (part) JOIN v USING (part)"""


@query(_PARTS)
def dissolve_layers(spark, d):
    """Area and perimeter of every dissolved part, from its tile rows."""
    e = X.equipment(spark, d)
    parts = dissolve(e.where("src = 0"), e.where("src = 1"))
    out = parts.groupBy("part").agg(F.sum("area").alias("area"), F.sum("perimeter").alias("perimeter"))
    return out.select(_r(F.col("area")).alias("area"), _r(F.col("perimeter")).alias("perimeter"))


@query(_PARTS)
def dissolve_whole(spark, d):
    """The same from the assembled polygons."""
    e = X.equipment(spark, d)
    parts = dissolve_polygons(e.where("src = 0"), e.where("src = 1"))
    return parts.select(_r(G.area()).alias("area"), _r(G.perimeter()).alias("perimeter"))


# ------------------------------------------------------------------ relations


@query(f"WITH {cte('road')} SELECT count(*) AS n, count(*) AS ids, CAST(sum(cleabs) AS BIGINT) AS keys FROM road")
def row_id(spark, d):
    r = A.row_id(X.roads(spark, d).select("cleabs"))
    return r.agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.sum("cleabs").alias("keys"))


@query(f"WITH {cte('road')} SELECT cleabs, coalesce(largeur, -1) * 2 AS largeur FROM road")
def column_swap(spark, d):
    r = X.roads(spark, d).select("cleabs", "largeur")
    return A.swap_column(A.update(r, "largeur", F.lit(-1.0), F.col("largeur").isNull()), "largeur", F.col("largeur") * 2)


@query(f"WITH {cte('equip')} SELECT 'TABLE' AS kind, count(*) AS n, sum({_RECT}) AS area FROM equip UNION ALL SELECT 'VIEW', count(*), sum({_RECT}) FROM equip")
def ctas_view_vs_table(spark, d):
    e = X.equipment(spark, d)
    view = R.create_relation(e, "plots_view", as_view=True)
    path = scratch(spark, "plots")
    S.write_layer(e, path)
    table = S.read_features(spark, path)
    one = lambda df, k: df.agg(F.count("*").alias("n"), F.sum(G.area()).alias("area")).select(F.lit(k).alias("kind"), "n", "area")
    return one(table, "TABLE").unionByName(one(view, "VIEW"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0")
def ctas_replace_self(spark, d):
    """A table that is replaced by a selection of its own rows."""
    name = f"own_{uuid.uuid4().hex[:8]}"
    R.create_relation(_read(spark, d, "customer").select("c_custkey", "c_name"), name)
    return R.create_relation(spark.table(name).where("c_custkey % 2 = 0"), name)


@query("SELECT count(*) AS n, false AS still_there FROM customer")
def drop_relations(spark, d):
    R.create_relation(_read(spark, d, "customer"), "to_drop", as_view=True)
    n = spark.table("to_drop").agg(F.count("*").alias("n"))
    R.drop_relations(spark, "VIEW", ["to_drop", "was_never_there"])
    return n.select("n", F.lit(spark.catalog.tableExists("to_drop")).alias("still_there"))


@query("SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_mktsegment LIKE 'B%' AND c_acctbal > 100.5 GROUP BY 1")
def sql_template(spark, d):
    text = "SELECT c_nationkey AS k, count(*) AS n FROM {layer} WHERE IDENTIFIER(:col) LIKE :pattern AND c_acctbal > :low GROUP BY 1"
    return R.run_sql(spark, "string", text, layer=_read(spark, d, "customer"), col="c_mktsegment", pattern="B%", low=100.5)


# ------------------------------------------------------------------ the whole analysis


def _report_sql(where: str, style: str = "square") -> str:
    """The analysis on rectangles: cells of half a metre, because medians may be halves."""
    return f"""WITH {cte('zone', 'equip', 'landcover', 'road', chosen=True)},
 dep AS (SELECT insee_dep, min(x0) AS x0, max(x1) AS x1, min(y0) AS y0, max(y1) AS y1 FROM zone {where} GROUP BY insee_dep),
 piece AS (SELECT insee_dep, nature, largeur, greatest(a.x0,b.x0) AS x0, least(a.x1,b.x1) AS x1, greatest(a.y0,b.y0) AS y0, least(a.y1,b.y1) AS y1
   FROM dep a JOIN road b ON b.x0 <= a.x1 AND b.x1 >= a.x0 AND b.y0 <= a.y1 AND b.y1 >= a.y0
   WHERE least(a.x1,b.x1)-greatest(a.x0,b.x0) + least(a.y1,b.y1)-greatest(a.y0,b.y0) > 0),
 med AS (SELECT insee_dep, nature, quantile_cont(largeur, 0.5) AS med FROM piece GROUP BY insee_dep, nature),
 wide AS (SELECT p.*, 2 + CASE WHEN largeur IS NULL OR largeur = 0 THEN med ELSE largeur END AS r FROM piece p JOIN med USING (insee_dep, nature)),
 car AS (SELECT insee_dep, CAST(2*(x0-r) AS BIGINT) AS x0, CAST(2*(x1+r) AS BIGINT) AS x1, CAST(2*(y0-r) AS BIGINT) AS y0, CAST(2*(y1+r) AS BIGINT) AS y1 FROM wide WHERE r IS NOT NULL
   UNION ALL SELECT insee_dep, 2*b.x0, 2*b.x1, 2*b.y0, 2*b.y1 FROM dep a JOIN equip b ON b.x0 <= a.x1 AND b.x1 >= a.x0 AND b.y0 <= a.y1 AND b.y1 >= a.y0),
 strip AS (SELECT DISTINCT insee_dep, x0, x1, y0+j AS y FROM car, unnest(range(y1-y0)) b(j)),
 ccell AS (SELECT DISTINCT z.insee_com, s.x0+i AS x, y FROM strip s, unnest(range(s.x1-s.x0)) a(i), zone z
   WHERE z.insee_dep = s.insee_dep AND s.x0+i >= 2*z.x0 AND s.x0+i < 2*z.x1 AND y >= 2*z.y0 AND y < 2*z.y1),
 ucell AS (SELECT DISTINCT x0+i AS x, y0+j AS y FROM landcover, unnest(range(CAST(x1-x0 AS BIGINT))) a(i), unnest(range(CAST(y1-y0 AS BIGINT))) b(j)),
 zu AS (SELECT insee_com, count(*) AS n FROM ucell JOIN zone z ON x >= z.x0 AND x < z.x1 AND y >= z.y0 AND y < z.y1 GROUP BY insee_com),
 cu AS (SELECT c.* FROM ccell c JOIN ucell u ON u.x = c.x // 2 AND u.y = c.y // 2),
 m AS (SELECT insee_com, count(*) AS a FROM ccell GROUP BY insee_com),
 mh AS (SELECT insee_com, count(*) AS p FROM ccell c ANTI JOIN ccell d ON d.insee_com=c.insee_com AND d.x=c.x+1 AND d.y=c.y GROUP BY insee_com),
 mv AS (SELECT insee_com, count(*) AS p FROM ccell c ANTI JOIN ccell d ON d.insee_com=c.insee_com AND d.x=c.x AND d.y=c.y+1 GROUP BY insee_com),
 k AS (SELECT insee_com, count(*) AS a FROM cu GROUP BY insee_com),
 kh AS (SELECT insee_com, count(*) AS p FROM cu c ANTI JOIN cu d ON d.insee_com=c.insee_com AND d.x=c.x+1 AND d.y=c.y GROUP BY insee_com),
 kv AS (SELECT insee_com, count(*) AS p FROM cu c ANTI JOIN cu d ON d.insee_com=c.insee_com AND d.x=c.x AND d.y=c.y+1 GROUP BY insee_com),
 zl AS (SELECT z.insee_com, greatest(z.x0,p.x0) AS x0, least(z.x1,p.x1) AS x1, greatest(z.y0,p.y0) AS y0, least(z.y1,p.y1) AS y1
   FROM zone z JOIN piece p ON p.insee_dep = z.insee_dep AND p.x0 <= z.x1 AND p.x1 >= z.x0 AND p.y0 <= z.y1 AND p.y1 >= z.y0),
 ll AS (SELECT insee_com, sum(x1-x0+y1-y0) AS n FROM zl GROUP BY insee_com),
 st AS (SELECT insee_com, CASE WHEN x1 > x0 THEN x0+i ELSE x0 END AS x, CASE WHEN x1 > x0 THEN y0 ELSE y0+i END AS y, x1 > x0 AS flat
   FROM zl, unnest(range(CAST(x1-x0+y1-y0 AS BIGINT))) a(i)),
 lu AS (SELECT insee_com, count(*) AS n FROM st WHERE EXISTS (SELECT 1 FROM ucell u WHERE u.x = st.x AND u.y = st.y)
   OR EXISTS (SELECT 1 FROM ucell u WHERE u.x = CASE WHEN flat THEN st.x ELSE st.x-1 END AND u.y = CASE WHEN flat THEN st.y-1 ELSE st.y END) GROUP BY insee_com),
 q AS (SELECT z.insee_com AS num_insee, CAST((x1-x0)*(y1-y0) AS DOUBLE)*1e-6 AS ArCom,
   coalesce(m.a,0)/4.0*1e-6 AS ArVoiCom, (coalesce(mh.p,0)+coalesce(mv.p,0))*1e-3 AS PeVoiCom, coalesce(ll.n,0)*1e-3 AS LeTroCom,
   coalesce(zu.n,0)*1e-6 AS ArUrb, coalesce(k.a,0)/4.0*1e-6 AS ArVoiUrb, (coalesce(kh.p,0)+coalesce(kv.p,0))*1e-3 AS PeVoiUrb, coalesce(lu.n,0)*1e-3 AS LeTroUrb
  FROM zone z LEFT JOIN m USING (insee_com) LEFT JOIN mh USING (insee_com) LEFT JOIN mv USING (insee_com) LEFT JOIN k USING (insee_com)
   LEFT JOIN kh USING (insee_com) LEFT JOIN kv USING (insee_com) LEFT JOIN ll USING (insee_com) LEFT JOIN zu USING (insee_com) LEFT JOIN lu USING (insee_com) {where})
SELECT num_insee, round(ArCom,6) AS ArCom, round(ArVoiCom,6) AS ArVoiCom, round(PeVoiCom,6) AS PeVoiCom, round(LeTroCom,6) AS LeTroCom,
 round(ArUrb,6) AS ArUrb, round(ArVoiUrb,6) AS ArVoiUrb, round(PeVoiUrb,6) AS PeVoiUrb, round(LeTroUrb,6) AS LeTroUrb,
 coalesce(round(ArVoiUrb/nullif(ArVoiCom,0)*100,6),0) AS PaArVoi, coalesce(round(LeTroUrb/nullif(LeTroCom,0)*100,6),0) AS PaLeTro,
 coalesce(round(ArVoiCom/nullif(ArCom,0)*100,6),0) AS PaArVoiCom, coalesce(round(ArVoiUrb/nullif(ArUrb,0)*100,6),0) AS PaArVoiUrb,
 coalesce(round(LeTroCom/nullif(ArCom,0),6),0) AS RaLeArTroCom, coalesce(round(LeTroUrb/nullif(ArUrb,0),6),0) AS RaLeArTroUrb,
 coalesce(round(PeVoiCom/nullif(sqrt(ArVoiCom),0),6),0) AS RaPeArVoiCom, coalesce(round(PeVoiUrb/nullif(sqrt(ArVoiUrb),0),6),0) AS RaPeArVoiUrb FROM q"""


def _report(spark, d, departement=None, style="square"):
    out = P.car_space_report(
        *(f(spark, d, chosen=True) for f in (X.zones, X.equipment, X.roads, X.landcover)), departement, style=style
    )
    return out.select("num_insee", *[_r(F.col(c)).alias(c) for c in Z.RESULT_COLUMNS[1:]])


@query(_report_sql("WHERE insee_dep = '03'"))
def car_space_report(spark, d):
    """One département with square-ended strips around roads."""
    return _report(spark, d, "3")


@query(_report_sql(""))
def report_all_deps(spark, d):
    """All départements in one run."""
    return _report(spark, d)


_PIECES = _report_sql("")
_PIECES = _PIECES[:_PIECES.index(" car AS (")].rstrip(", \n")


@query(f"""{_PIECES},
 pt AS ({X.SQL['pt']}),
 inside AS (SELECT z.insee_com, z.insee_dep, p.id, p.x, p.y FROM zone z JOIN pt p ON p.x BETWEEN z.x0 AND z.x1 AND p.y BETWEEN z.y0 AND z.y1),
 hit AS (SELECT DISTINCT p.insee_com, p.id FROM inside p JOIN wide w ON w.insee_dep = p.insee_dep AND w.r IS NOT NULL AND {_capsule('w')}
   UNION SELECT p.insee_com, p.id FROM inside p JOIN equip e ON p.x BETWEEN e.x0 AND e.x1 AND p.y BETWEEN e.y0 AND e.y1)
SELECT insee_com, count(*) AS points FROM hit GROUP BY insee_com""")
def report_round_points(spark, d):
    """Points of every zone in the car space of the analysis, buffers being round: the union as it is, not its measures."""
    zones, equipment, roads, urban = (f(spark, d, chosen=True) for f in (X.zones, X.equipment, X.roads, X.landcover))
    equipment, urban, roads = equipment.select("geom").distinct(), urban.select("geom").distinct(), P.counted_roads(roads)
    # points at one place are in the same zones and in the same car space
    pts = X.points(spark, d).groupBy("geom").agg(F.min("id").alias("event"), F.count("*").alias("copies"))
    plan = P.report_plan(zones, equipment, roads, urban)
    deps = P.departements(zones, plan)
    car = P.car_region(deps, P.crop_roads(roads, deps, plan, ("road", "copies")), equipment, plan)
    found = lines_in_region(car, pts, plan, ["insee_dep"], ["event"], ["event"]).select("insee_dep", "event")
    placed = overlay_intersection(zones, pts, ["insee_com", "insee_dep"], ["event", "copies"], key_b=["event"])
    placed = placed.select("insee_com", "insee_dep", "event", "copies")
    return placed.join(found, ["insee_dep", "event"]).groupBy("insee_com").agg(F.sum("copies").alias("points"))


@query()
def report_all_deps_round(spark, d):
    """The analysis as specified, with round buffers."""
    return _report(spark, d, style="round")


@query(f"""WITH {cte('zone', 'road')} SELECT insee_com, round(sum(CAST(least(z.x1,r.x1)-greatest(z.x0,r.x0)+least(z.y1,r.y1)-greatest(z.y0,r.y0) AS DOUBLE))*1e-3, 6) AS length
 FROM zone z JOIN road r ON r.x0 <= z.x1 AND r.x1 >= z.x0 AND r.y0 <= z.y1 AND r.y1 >= z.y0 GROUP BY insee_com""")
def zonal_summary(spark, d):
    """Road length per zone through full pieces and zonal sums."""
    o = overlay_intersection(X.zones(spark, d), X.roads(spark, d), ["insee_com"], ["cleabs"])
    sums = Z.zonal_length(o, "insee_com")
    out = Z.zonal_summary(X.zones(spark, d), [sums], "insee_com")
    return out.where(F.col("length").isNotNull()).select("insee_com", _r(F.col("length")).alias("length"))
