"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparcel import session


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package to the workers, and bound what a batch of long texts may hold."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return session.ship(spark)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared checkpoint folder and read it back: later steps start from files."""
    path = f"{session.scratch(df.sparkSession, 'llm')}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark deletes the shuffle files of an action when it ends, not when the driver's memory is next cleaned.

    For steps that write their results and start from files; iterate over rows only where no shuffle stands before.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def checked_broadcast(df: DataFrame, most: int) -> DataFrame:
    """Broadcast a stored table of narrow rows if it has at most ``most`` of them; else leave the join to Spark."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, however often that refers to it."""
    return F.transform(F.array(value), body)[0]


def cells(spark: SparkSession, per_partition: int = 4) -> int:
    """A power of two: how many cells to cut work into, from the number of shuffle partitions."""
    wanted = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return 1 << max(0, (wanted - 1).bit_length())
