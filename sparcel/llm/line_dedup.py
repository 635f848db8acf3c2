"""Removal of line passages that occurred before: windows of three consecutive lines, hashed, corpus-wide.

Windows overlap, one per start line. The first occurrence of a window, in the order (doc_id, line),
stays; every later one covers its three lines, covered lines of a document merge into runs, and the
runs are cut out. Only hashes, ids and positions are shuffled to find the windows; a text moves once,
to meet the list of its own covered lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparcel.llm import common

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def window_hashes(text: Column, width: int = WINDOW) -> Column:
    """128-bit hashes of the windows of a text, by start line; null where all lines of it are blank."""
    def windows(h: Column) -> Column:
        def one(i: Column) -> Column:
            parts = [F.element_at(h, i + k) for k in range(width)]
            blank = F.concat(*parts) == F.lit("")
            return F.when(~blank, F.unhex(F.md5(F.concat_ws("/", *parts))))
        return F.when(F.size(h) >= width, F.transform(F.sequence(F.lit(1), F.size(h) - F.lit(width - 1)), one))

    hashed = F.transform(_lines(text), lambda x: F.when(F.trim(x) == "", F.lit("")).otherwise(F.md5(x)))
    return common.let(hashed, windows)


def kept_lines(lines: Column, starts: Column, width: int = WINDOW) -> Column:
    """The lines outside the merged windows. ``starts``: sorted start lines (from 0) of the windows to cut."""
    def cut(p: Column) -> Column:
        n = F.size(p)
        first = F.filter(p, lambda x, i: (i == 0) | (x > F.get(p, i - 1) + F.lit(width)))
        last = F.filter(p, lambda x, i: (i == n - 1) | (F.get(p, i + 1) > x + F.lit(width)))
        after = F.transform(last, lambda x: x + F.lit(width))
        return F.zip_with(F.concat(F.array(F.lit(0)), after), first, lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def pieces(x: Column) -> Column:
        ends = F.transform(cut(starts), lambda r: F.struct(r["a"].alias("a"), F.coalesce(r["b"], F.size(x)).alias("b")))
        return F.flatten(F.transform(ends, lambda r: F.slice(x, r["a"] + F.lit(1), F.greatest(r["b"] - r["a"], F.lit(0)))))

    return common.let(lines, pieces)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """Cut later occurrences of repeated windows out of ``text``; adds ``n_lines`` and ``n_removed``.

    * Texts of fewer than ``width`` lines, windows of blank lines only and null texts are left alone
      (``n_lines`` of a null text is 0). A text that repeats as a whole becomes the empty string.
    * A window that overlaps its own first occurrence counts as a later one.
    * Null ids sort last. Rows with the same id and the same text are one document: all of them
      get the same result. Rows with the same id and other texts are told apart by the text.
    * Columns called ``n_lines`` and ``n_removed`` are replaced; other columns are kept.
    * Nothing is collected per window: the first occurrence is an aggregate that combines before
      the shuffle, and adaptive execution splits the join for a window that a third of the corpus has.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    row = [F.col(doc_id).isNull().alias("__null"), F.col(doc_id).alias("__id"), F.xxhash64(text).alias("__t")]
    found = docs.select(*row, F.posexplode(window_hashes(F.col(text), width)).alias("__pos", "__w")).where("__w IS NOT NULL")
    place = F.struct("__null", "__id", "__t", "__pos")
    repeated = (
        found.groupBy("__w").agg(F.min(place).alias("__first"), F.count(F.lit(1)).alias("__n"))
        .where("__n > 1").select("__w", "__first")
    )
    covered = (
        found.join(repeated, "__w").where(place != F.col("__first"))
        .groupBy("__null", "__id", "__t").agg(F.array_sort(F.collect_set("__pos")).alias("__starts"))
    )
    lines = _lines(F.col(text))
    left = docs.select(*kept, F.xxhash64(text).alias("__key"))
    joined = left.join(covered, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__t")), "left")
    rest = F.when(F.col("__starts").isNotNull(), kept_lines(lines, F.col("__starts"), width))
    out = joined.select(*kept, rest.alias("__rest"), F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"))
    result = F.when(F.col("__rest").isNotNull(), F.array_join("__rest", "\n")).otherwise(F.col(text))
    return out.select(
        *[result.alias(c) if c == text else F.col(c) for c in kept],
        F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.col("n_lines")).cast("long").alias("n_lines"),
        F.when(F.col("__rest").isNotNull(), F.col("n_lines") - F.size("__rest")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
    )
