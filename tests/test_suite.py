"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame):
    df = df[sorted(df.columns)].astype(object)
    return sorted(df.where(df.notna(), None).itertuples(index=False, name=None), key=repr)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, data, duck, name):
    out = entry.queries()[name](spark, data).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(out) > 0
        return
    want = duck.execute(sql).df()
    assert sorted(out.columns) == sorted(want.columns)
    assert rows(out) == rows(want)


def test_keys():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    out = entry.entry(spark)
    assert len(out.columns) == 17 and out.count() == 24


def test_zonal_outer_join_has_all_zones_of_the_mainland(spark, data):
    """As in the first rounds: every département, not one of them."""
    out = entry.queries()["zonal_outer_join"](spark, data)
    assert out.count() == 24
    assert "LIKE '0%'" in entry.oracle_sql()["zonal_outer_join"]


def test_overlay_chain_cuts_equal_roads_once(spark, data, tmp_path, monkeypatch):
    """Ten times the roads, at the same places: lengths are ten times as much, layers as large as before."""
    from pyspark.sql import functions as F

    from sparcel.plans import catalog

    orders = spark.read.parquet(f"{data}/orders.parquet")
    # keys that lie 4950 apart give equal geometry
    far = orders.crossJoin(spark.range(10).withColumnRenamed("id", "i")).withColumn("o_orderkey", F.col("o_orderkey") + 4950 * F.col("i"))
    far.drop("i").write.parquet(str(tmp_path / "orders.parquet"))
    for t in ("nation", "customer"):
        spark.read.parquet(f"{data}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    sizes, overlay = [], catalog.overlay_intersection
    monkeypatch.setattr(catalog, "overlay_intersection", lambda a, b, *rest: sizes.append(b.count()) or overlay(a, b, *rest))
    chain = entry.queries()["overlay_chain"]
    one, ten = ({r["insee_com"]: r["length"] for r in chain(spark, d).collect()} for d in (data, str(tmp_path)))
    assert ten == {k: pytest.approx(10 * v) for k, v in one.items()}
    assert sizes[2] == sizes[0] and sizes[3] == sizes[1]
