"""Layers derived from the driver tables (test inputs): zones, equipment, land cover, roads, points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..session import spread

# The same text runs on DuckDB, where the result is used as a common table expression.
SQL = {
    "zone": """
SELECT CASE WHEN n_nationkey = 24 THEN '97124' ELSE concat(lpad(CAST(n_regionkey+1 AS VARCHAR(2)),2,'0'), lpad(CAST(n_nationkey AS VARCHAR(3)),3,'0')) END AS insee_com,
       lpad(CAST(n_regionkey+1 AS VARCHAR(2)),2,'0') AS insee_dep,
       (n_nationkey % 5)*1000 AS x0, CAST(floor(n_nationkey/5) AS INT)*1000 AS y0,
       (n_nationkey % 5)*1000+1000 AS x1, CAST(floor(n_nationkey/5) AS INT)*1000+1000 AS y1
FROM nation""",
    "equip": """
SELECT cleabs, nature, src, x0, y0, x0 + w AS x1, y0 + h AS y1 FROM (
  SELECT p_partkey AS cleabs, p_type AS nature, p_partkey % 2 AS src,
         (p_partkey*p_partkey*31 + p_partkey*7919) % 4840 AS x0,
         (p_partkey*p_partkey*17 + p_partkey*104729 + 13) % 4840 AS y0,
         10 + 3*p_size AS w, 10 + p_partkey % 137 AS h FROM part) q""",
    "landcover": """
SELECT id, classe, x0, y0, x0 + w AS x1, y0 + h AS y1 FROM (
  SELECT c_custkey AS id, c_mktsegment AS classe,
         (c_custkey*c_custkey*13 + c_custkey*6151) % 4800 AS x0,
         (c_custkey*c_custkey*29 + c_custkey*39119 + 7) % 4800 AS y0,
         20 + c_custkey % 181 AS w, 20 + c_nationkey*5 AS h FROM customer) q""",
    "road": """
SELECT cleabs, nature, largeur, x0, y0,
       x0 + CASE WHEN cleabs % 2 = 0 THEN len ELSE 0 END AS x1,
       y0 + CASE WHEN cleabs % 2 = 1 THEN len ELSE 0 END AS y1 FROM (
  SELECT o_orderkey AS cleabs, o_orderpriority AS nature,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN CAST(0 AS DOUBLE)
              ELSE CAST(o_orderkey % 9 + 1 AS DOUBLE) END AS largeur,
         (o_orderkey*o_orderkey*31 + o_orderkey*7919) % 4950 AS x0,
         (o_orderkey*o_orderkey*17 + o_orderkey*104729 + 13) % 4950 AS y0,
         5 + o_orderkey % 45 AS len FROM orders) q""",
    "pt": """
SELECT event_id AS id, event_type AS nature,
       (event_id*event_id*31 + event_id*7919) % 5000 + CAST(0.5 AS DOUBLE) AS x,
       (event_id*event_id*17 + event_id*104729 + 13) % 5000 + CAST(0.5 AS DOUBLE) AS y
FROM events""",
}
TABLES = {"zone": "nation", "equip": "part", "landcover": "customer", "road": "orders", "pt": "events"}

EQUIP_NATURES = ["ECONOMY", "LARGE", "MEDIUM"]
LAND_CLASSES = ["BUILDING", "FURNITURE", "HOUSEHOLD"]
ROAD_NATURES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
OVERSEAS = "97%"


def raw(spark: SparkSession, sf_dir: str, layer: str) -> DataFrame:
    """Layer as attributes and corner coordinates."""
    table = TABLES[layer]
    # dealt as they are read, as what is made of them takes more bytes
    src = spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"))
    return spark.sql(SQL[layer].replace(f"FROM {table}", "FROM {src}"), src=src)


def with_geom(df: DataFrame, layer: str) -> DataFrame:
    if layer == "pt":
        return df.select("id", "nature", G.point("x", "y").alias("geom"))
    make = G.segment if layer == "road" else G.rectangle
    rest = [c for c in df.columns if c not in ("x0", "y0", "x1", "y1")]
    return df.select(*rest, make("x0", "y0", "x1", "y1").alias("geom"))


def features(spark: SparkSession, sf_dir: str, layer: str) -> DataFrame:
    """Unfiltered layer with geometry."""
    return with_geom(raw(spark, sf_dir, layer), layer)


def zones(spark, sf_dir, chosen=False) -> DataFrame:
    """All zones, or those that the analysis is about."""
    df = features(spark, sf_dir, "zone")
    return df.where(~F.col("insee_com").like(OVERSEAS)) if chosen else df


def equipment(spark, sf_dir, chosen=False) -> DataFrame:
    df = features(spark, sf_dir, "equip")
    return df.where(F.col("nature").isin(EQUIP_NATURES)) if chosen else df


def landcover(spark, sf_dir, chosen=False) -> DataFrame:
    df = features(spark, sf_dir, "landcover")
    return df.where(F.col("classe").isin(LAND_CLASSES)) if chosen else df


def roads(spark, sf_dir, chosen=False) -> DataFrame:
    df = features(spark, sf_dir, "road")
    return df.where(F.col("nature") != "5-LOW") if chosen else df


# One polygon of two vertices for each column of a skyline, whose columns lie an eighth of a metre apart.
SKYLINE = """
SELECT a, coalesce(lead(a) OVER (ORDER BY a), a + 1) AS b, h FROM (
  SELECT (o_orderkey*31 + o_custkey*7919) % 40000 AS a, max(100 + o_orderkey % 4801) AS h FROM orders GROUP BY 1) q"""


def skyline(spark, sf_dir) -> DataFrame:
    """A single polygon with up to 80,000 vertices, the outline of the columns of ``SKYLINE``."""
    src = spark.read.parquet(f"{sf_dir}/orders.parquet")
    steps = spark.sql(SKYLINE.replace("FROM orders", "FROM {src}"), src=src)

    def at(x, y):
        return F.struct((F.col(x) / 8.0).alias("x"), F.col(y).cast("double").alias("y"))

    tops = F.array_sort(F.collect_list(F.struct("a", F.array(at("a", "h"), at("b", "h")).alias("v"))))
    row = steps.groupBy(F.lit(1).alias("id")).agg(tops.alias("t"), F.min("a").alias("a"), F.max("b").alias("b"))
    low, high = F.struct((F.col("a") / 8.0).alias("x"), F.lit(0.0).alias("y")), F.struct((F.col("b") / 8.0).alias("x"), F.lit(0.0).alias("y"))
    ring = F.concat(F.array(low), F.flatten(F.transform("t", lambda t: t["v"])), F.array(high, low))
    geom = F.struct(F.lit(G.TARGET_SRID).alias("srid"), F.lit(2).cast("tinyint").alias("dim"), F.lit(False).alias("multi"), F.array(F.array(ring)).alias("parts"))
    return row.select("id", geom.alias("geom"))


def points(spark, sf_dir) -> DataFrame:
    return features(spark, sf_dir, "pt")
