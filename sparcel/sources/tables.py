"""Tabular sources and sinks: the lookup of départements and the result files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.attributes import zero_pad

# Layout of the lookup file.
LOOKUP_SCHEMA = "CODE_DPT string, NOM_DPT string, CODE_REG int, NOM_REG string, OSM_REG string"


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated file with a header line."""
    return spark.read.csv(path, sep="\t", header=True, schema=schema)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, LOOKUP_SCHEMA)


def lookup_one(df: DataFrame, key: str, value, column: str):
    """The lower-cased value of ``column`` in the only row with ``key = value``.

    Padded and unpadded codes are both accepted. ValueError unless exactly one row matches.
    """
    rows = df.where(F.ltrim(F.col(key).cast("string"), F.lit("0")) == str(value).lstrip("0")).select(F.lower(F.col(column))).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{key} = {value!r} matches {'no row' if not rows else 'several rows'}")
    return rows[0][0]


def lookup_join(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, column: str, name: str) -> DataFrame:
    """Batch form: add the lower-cased value for every row; an unknown or ambiguous key fails.

    The lookup is left to Spark's own size check (it is broadcast only below the threshold).
    """
    found = lookup.groupBy(lookup_key).agg(F.max(F.lower(F.col(column))).alias(name), F.count("*").alias("_n"))
    out = df.join(found, F.col(key) == F.col(lookup_key), "left")
    bad = F.raise_error(F.concat(F.lit("lookup must match exactly one row: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))).cast("string")
    return out.select(*df.columns, F.when(F.col("_n") == 1, F.col(name)).otherwise(bad).alias(name))


def result_file_key(dep) -> Column:
    """Département code as used in result names, padded to two."""
    return zero_pad(dep, 2)


def write_results(df: DataFrame, path: str, dep: str = "dep") -> None:
    """Tab-separated results with a header, one folder per département."""
    out = df.withColumn(dep, result_file_key(dep))
    # rebalance: few files per département, but a large one is still split
    out.hint("rebalance", dep).write.mode("overwrite").option("sep", "\t").option("header", True).partitionBy(dep).csv(path)


def read_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read back written results; ``schema`` includes the département column, kept as text."""
    return spark.read.csv(path, sep="\t", header=True, schema=schema)
