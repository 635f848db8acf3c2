"""Weighted rendezvous hashing of record keys to shards, and gapless slots inside each shard.

Every shard draws a score from (key, shard number, weight) alone; a record goes to the shard with
the lowest score. Adding a shard adds one score, so the only records that move are those that the
new shard wins. Assigning is a projection: nothing is shuffled and no state is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparcel.llm import common

HASH_BITS = 52
CHUNK = 10_000


def _bits(text: Column) -> Column:
    """The first 52 bits of the MD5 of a string, as a long."""
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def _key(key: Column) -> Column:
    return F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("n"))


def _score(key: Column, shard: int, weight: float) -> Column:
    """-ln(u) / weight with u uniform in (0, 1): the lowest wins with a chance in proportion to its weight."""
    u = (_bits(F.concat(key, F.lit(f"/{shard}"))) + F.lit(0.5)) / F.lit(float(1 << HASH_BITS))
    return F.struct((-F.log(u) / F.lit(float(weight))).alias("score"), F.lit(shard).alias("shard"))


def _weights(shards: int | Sequence[float]) -> list[float]:
    weights = [1.0] * shards if isinstance(shards, int) else [float(w) for w in shards]
    if not weights or min(weights) <= 0:
        raise ValueError("shards need positive weights, at least one of them")
    return weights


def shard_of(key: Column, shards: int | Sequence[float]) -> Column:
    """Shard number (from 0) of a key. ``shards``: how many of weight 1, or the weights."""
    return F.array_min(F.array(*[_score(_key(key), i, w) for i, w in enumerate(_weights(shards))]))["shard"]


def assign_shards(
    df: DataFrame, key: str, shards: int | Sequence[float], grown_by: float | None = None,
    shard: str = "shard", grown: str = "grown_shard",
) -> DataFrame:
    """Add the shard of each row and, if ``grown_by`` is the weight of one more shard, the shard after growing.

    * Rows of the same key go to the same shard; a null key counts as a key of its own.
    * Texts are never looked at, so empty, null and very long ones make no difference.
    * An empty table gives an empty table with the new columns.
    * Input columns called like the new ones are replaced; all others are kept.
    """
    weights = _weights(shards)
    best = F.array_min(F.array(*[_score(_key(F.col(key)), i, w) for i, w in enumerate(weights)]))
    if grown_by is None:
        return df.withColumn(shard, best["shard"])
    more = _score(_key(F.col(key)), len(weights), grown_by)
    both = common.let(best, lambda b: F.struct(b["shard"].alias("now"), F.least(b, more)["shard"].alias("then")))
    kept = [c for c in df.columns if c not in (shard, grown)]
    return df.select(*kept, both.alias("__both")).select(*kept, F.col("__both.now").alias(shard), F.col("__both.then").alias(grown))


def number_slots(df: DataFrame, shard: str, key: str, slot: str = "slot") -> DataFrame:
    """Number the rows of each shard 0, 1, 2, ... without a gap, in the order of a hash of ``key``.

    A shard may hold far more rows than one task can: its hash range is cut into cells, rows are
    numbered inside cells, and cell offsets are a running sum over the small table of cell counts.
    The order does not depend on the number of cells. Rows that are alike in every column are
    counted before the shuffle and written out again afterwards, so a key that repeats millions of
    times is one row meanwhile. Needs columns that can be grouped (no maps).

    * A null key has a hash like any other. An empty table stays empty.
    * A column called like ``slot`` is replaced.
    """
    spark, rows = df.sparkSession, df.drop(slot)
    cols = rows.columns
    size = max(1, common.cells(spark) // 16)
    cell = F.shiftright("__h", HASH_BITS - (size.bit_length() - 1))
    alike = (
        rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__h", _bits(_key(F.col(key)))).withColumn("__cell", cell)
    )
    counts = alike.groupBy(shard, "__cell").agg(F.sum("__n").alias("__sum"))
    before = "sum({0}) OVER (PARTITION BY {1} ORDER BY {2} ROWS UNBOUNDED PRECEDING) - {0}"
    offsets = counts.select(
        F.col(shard).alias("__shard"), F.col("__cell").alias("__at"),
        F.expr(before.format("__sum", f"`{shard}`", "__cell")).alias("__base"),
    )
    order = ", ".join(["__h", *[f"`{c}`" for c in cols]])
    placed = (
        alike.withColumn("__in", F.expr(before.format("__n", f"`{shard}`, __cell", order)))
        .join(offsets, F.col(shard).eqNullSafe(F.col("__shard")) & (F.col("__cell") == F.col("__at")))
    )
    start = F.col("__base") + F.col("__in")
    chunks = F.explode(F.sequence(F.lit(0), F.expr(f"(__n - 1) div {CHUNK}")))
    copies = F.explode(F.sequence(F.expr(f"__c * {CHUNK}"), F.expr(f"least(__n, (__c + 1) * {CHUNK}) - 1")))
    return (
        placed.select(*cols, "__n", start.alias("__start"), chunks.alias("__c"))
        .select(*cols, "__start", copies.alias("__i"))
        .select(*cols, (F.col("__start") + F.col("__i")).alias(slot))
    )


def write_shards(df: DataFrame, path: str, shard: str = "shard") -> None:
    """Write one folder per shard; each task appends to the shards that it has rows of."""
    df.write.partitionBy(shard).parquet(path)


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int | Sequence[float] = 24) -> DataFrame:
    """Placement of every document: size, checksum, shard, slot, and the shard if there were one more.

    A null text has size 8 and the checksum of no bytes.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id", (F.octet_length(text) + F.lit(8)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
    )
    placed = assign_shards(narrow, "doc_id", shards, grown_by=1.0)
    return number_slots(placed, "shard", "doc_id").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard",
    )
