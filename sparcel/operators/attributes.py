"""Row, column and attribute operators of a layer: filters, projections, medians, updates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_features(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Keep rows whose value is in the list (NULL is dropped); reaches the Parquet scan as ``In``."""
    return df.where(F.col(column).isin(list(values)))


def subset_columns(df: DataFrame, source: Sequence[str], target: Sequence[str] | None = None) -> DataFrame:
    """Select columns in order; rename them by position if ``target`` is given."""
    out = df.select(*[F.col(f"`{c}`") for c in source])
    return out.toDF(*target) if target is not None else out


def delete_like(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Remove the rows that match LIKE; rows with NULL stay."""
    return df.where(~F.coalesce(F.col(column).like(pattern), F.lit(False)))


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == value)


def filter_like(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.where(F.col(column).like(pattern))


def null_or_zero(column) -> Column:
    return _c(column).isNull() | (_c(column) == 0)


def zero_pad(column, width: int) -> Column:
    """Pad with zeros on the left, never cutting longer values."""
    c = _c(column).cast("string")
    return F.lpad(c, F.greatest(F.length(c), F.lit(width)), F.lit("0"))


def add_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.withColumn(name, value)


def swap_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Compute a new column, drop the old one, give the new one its name."""
    return df.withColumn(f"{name}_new", value).drop(name).withColumnRenamed(f"{name}_new", name)


def update(df: DataFrame, column: str, value: Column, where: Column | None = None) -> DataFrame:
    """Set ``column`` to ``value``, where the condition is TRUE if one is given."""
    return df.withColumn(column, value if where is None else F.when(where, value).otherwise(F.col(column)))


#: Distinct values of a group up to which one task takes its median, and cells of a histogram beyond that.
SMALL_GROUP, CELLS = 50_000, 1024


def _medians(df: DataFrame, value: str, keys: Sequence[str], name: str, copies: str | None = None) -> DataFrame:
    """(keys, median) of the groups that have values; a row counts as often as ``copies`` says.

    Values are counted first. Where a group has more distinct values than one task should hold, the two
    middle ranks are searched: a histogram tells the cell that holds a rank, the values of that cell
    get a histogram of their own, until a cell holds few enough. No task sees all values of a group.
    """
    keys = list(keys)
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg((F.sum(copies) if copies else F.count("*")).alias("_n"))
    counted = checkpoint(counted.withColumn("_v", F.col(value).cast("double")).select(*keys, "_v", "_n"))
    facts = counted.groupBy(*keys).agg(
        F.sum("_n").alias("_total"), F.count("*").alias("_distinct"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    exact = F.percentile("_v", F.lit(0.5), F.col("_n")).alias(name)
    if (facts.agg(F.max("_distinct")).first()[0] or 0) <= SMALL_GROUP:
        return counted.groupBy(*keys).agg(exact)
    # for each group the two middle ranks, counted from 0, each in a range of values that shrinks
    middle = F.array(F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2))
    state = checkpoint(facts.select(*keys, "_distinct", "_low", "_high", F.posexplode(middle).alias("_side", "_rank")))
    ids = [*keys, "_side"]
    while (state.agg(F.max(F.when(F.col("_low") < F.col("_high"), F.col("_distinct")))).first()[0] or 0) > SMALL_GROUP:
        # halves, as the range of doubles may be wider than a double
        part = (F.col("_v") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2)
        cell = F.when(F.col("_low") < F.col("_high"), F.least(F.floor(part * CELLS), F.lit(CELLS - 1))).otherwise(F.lit(0)).alias("_cell")
        held = _in_range(counted, state, keys).select(*ids, "_rank", "_v", "_n", cell)
        cells = held.groupBy(*ids, "_rank", "_cell").agg(
            F.sum("_n").alias("_cell_n"), F.count("*").alias("_distinct"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
        )
        upto = F.sum("_cell_n").over(Window.partitionBy(*ids).orderBy("_cell")).alias("_upto")
        found = cells.select("*", upto).where((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_cell_n") <= F.col("_rank")))
        state = checkpoint(found.select(*keys, "_distinct", "_low", "_high", "_side", (F.col("_rank") - F.col("_upto") + F.col("_cell_n")).alias("_rank")))
    upto = F.sum("_n").over(Window.partitionBy(*ids).orderBy("_v"))
    last = _in_range(counted, state, keys).select(*ids, "_rank", "_v", "_n", upto.alias("_upto"))
    ends = last.where((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_n") <= F.col("_rank")))
    return ends.groupBy(*keys).agg(F.sum(F.col("_v") / 2).alias(name))


def _in_range(counted: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counted values that lie in the range of their group's ranks, once for each rank."""
    named = state.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)], "_low", "_high", "_side", "_rank")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_{i}"))
    return counted.join(named, same & (F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high")))


def median_by(df: DataFrame, value: str, group: Sequence[str] | str) -> DataFrame:
    """Exact continuous median per group; NULLs are ignored, zeros count."""
    keys = [group] if isinstance(group, str) else list(group)
    med = _medians(df, value, keys, "median")
    # groups without any value keep a NULL median
    return df.select(*keys).distinct().join(med, keys, "left") if keys else med


#: Most medians that are broadcast, and the parts into which a group is cut beyond it.
BROADCAST_MEDIANS, SALTS = 100_000, 32


def median_fill(df: DataFrame, value: str, group: Sequence[str] | str, copies: str | None = None) -> DataFrame:
    """Replace NULL and zero by the median of the rows with the same ``group`` (before the update).

    ``copies`` names a column that tells how many rows a row stands for.

    A group without any value, or a NULL group, stays as it is (NULL becomes NULL). The medians are
    written first and counted: few of them are broadcast, so the rows, with whatever they carry, are
    not shuffled on a handful of groups; many of them are joined on a salted key.
    """
    keys = [group] if isinstance(group, str) else list(group)
    med = checkpoint(_medians(df, value, keys, "_median", copies))
    if med.count() <= BROADCAST_MEDIANS:
        joined = df.join(F.broadcast(med), keys, "left")
    else:
        salts = med.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).join(salts, [*keys, "_salt"], "left")
    filled = F.when(null_or_zero(value), F.col("_median")).otherwise(F.col(value))
    return joined.select(*[filled.alias(c) if c == value else F.col(c) for c in df.columns])


def row_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Add a surrogate id: unique, no order, no shuffle."""
    return df.select(F.monotonically_increasing_id().alias(name), "*")
