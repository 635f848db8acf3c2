import zlib
from collections import Counter

from sparcel.llm import sharding

SCHEMA = "doc_id long, text string, shard string, slot int"


def test_placement(spark):
    data = [(i, f"text {i}" * (i % 7), "x", 1) for i in range(500)] + [(None, None, None, None), (None, "a", "b", 2)]
    data += [(7, "long é" * 20_000, "x", 1)] + [(3, "same", "x", 1)] * 40
    docs = spark.createDataFrame(data, SCHEMA)
    out = sharding.shard_documents(spark, docs).toPandas()
    assert len(out) == len(data)
    by_key = {}
    for r in out.itertuples():
        assert r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24
        k = None if r.doc_id != r.doc_id else r.doc_id
        assert by_key.setdefault(k, r.shard) == r.shard
    sizes = Counter(zip(out["size"], out["text_crc32"], strict=True))
    assert sizes == Counter((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t, _, _ in data)
    for _, group in out.groupby("shard"):
        assert sorted(group["slot"]) == list(range(len(group)))


def test_order_of_slots_does_not_depend_on_partitions(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    seen = []
    for n in ("3", "40"):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(sorted(map(tuple, sharding.shard_documents(spark, docs, 5).collect())))
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1]


def test_many_copies_of_a_row(spark):
    docs = spark.range(45_000).selectExpr("1L AS doc_id", "'x' AS text")
    out = sharding.shard_documents(spark, docs, 3).toPandas()
    assert sorted(out["slot"]) == list(range(45_000))


def test_weights_and_extra_columns(spark):
    df = spark.range(20_000).selectExpr("id", "'old' AS shard", "1 AS slot", "map(1, 2) AS m")
    out = sharding.assign_shards(df, "id", [1.0, 3.0])
    assert out.columns == ["id", "shard", "slot", "m"]
    share = out.where("shard = 1").count() / 20_000
    assert 0.73 < share < 0.77
    grown = sharding.assign_shards(df, "id", [1.0, 3.0], grown_by=4.0)
    moved = grown.where("shard <> grown_shard")
    assert moved.where("grown_shard <> 2").count() == 0
    assert 0.47 < moved.count() / 20_000 < 0.53


def test_empty_and_written(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert sharding.shard_documents(spark, empty).count() == 0
    df = sharding.assign_shards(spark.range(100), "id", 4)
    sharding.write_shards(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100
