"""Named relations of a session: create, replace and drop tables and views, run SQL templates."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

KINDS = ("TABLE", "VIEW")


def create_relation(df: DataFrame, name: str, as_view: bool = False) -> DataFrame:
    """Name a result: a table is written once, a view is evaluated where it is used.

    A table is written under another name first and then takes the name, so ``df`` may read the
    table that it replaces, and a failed query leaves that table as it was.
    """
    spark = df.sparkSession
    if as_view:
        df.createOrReplaceTempView(name)
    else:
        new = f"{name}_{uuid.uuid4().hex[:12]}"
        try:
            df.write.saveAsTable(new)
        except BaseException:
            spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:n)", args={"n": new})
            raise
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:n)", args={"n": name})
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    return spark.table(name)


def replace_relation(df: DataFrame, name: str) -> DataFrame:
    """Let ``name`` stand for a result computed from the old ``name``."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def drop_relations(spark: SparkSession, kind: str, names: Iterable[str]) -> None:
    """Drop tables or views, if they exist."""
    if kind.upper() not in KINDS:
        raise ValueError(f"cannot drop a {kind!r}: say TABLE or VIEW")
    for name in names:
        try:
            spark.sql(f"DROP {kind.upper()} IF EXISTS IDENTIFIER(:n)", args={"n": name})
        except Exception as e:
            raise ValueError(f"dropping the {kind.lower()} {name} failed; is it of the other kind? {e}") from e


def run_sql(spark: SparkSession, mode: str, query: str, **args) -> DataFrame:
    """Run SQL from text (``string``) or from a file (``file``) with named parameters.

    Values are bound (``:name``), names go through ``IDENTIFIER(:name)`` and data frames through
    ``{name}``; nothing is pasted into the text.
    """
    if mode.lower() not in ("file", "string"):
        raise ValueError(f"queries come from a file or a string, not from {mode!r}")
    if mode.lower() == "file":
        query = spark.read.text(query, wholetext=True).first()[0]
    frames = {k: v for k, v in args.items() if isinstance(v, DataFrame)}
    values = {k: v for k, v in args.items() if not isinstance(v, DataFrame)}
    return spark.sql(query, args=values or None, **frames)
