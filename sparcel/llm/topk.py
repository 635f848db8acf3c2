"""Exact top-k search by inner product on a bit-sliced index.

A block of rows is stored by bits: for each attribute and each bit of its value one bitmap over the
rows of the block, sorted by id. A query adds, with bitmap arithmetic, the slices of each attribute
once for every set bit of its own component; carry-save adders keep the sums as bitmaps by weight.
The top rows are then selected from the most significant sum slice downward: rows with a set bit are
taken while they fit into k, or else become the only candidates left. What is left at the end are
rows of equal score at the boundary, of which the smallest ids are taken. Scores are exact integers: rows
with very large components lie in blocks of their own, whose slices and sums have as many bits as they need.

Blocks are cut in the scan, so indexing shuffles nothing and no key can gather rows. Queries go in
blocks to all index blocks; each pair of blocks gives k rows a query, which a window then merges.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparcel.llm.common import stored

#: Rows of an index block, queries of a query block, and words of a bitmap times queries that are added at once.
BLOCK, QUERIES, TOGETHER = 1 << 15, 512, 1 << 14
#: Components up to this are narrow, and bound of a sum of products that 64-bit numbers are used for.
NARROW, SAFE = float(1 << 26), float(1 << 61)
#: Query blocks that a copy of an index block is sent for.
ASKED = 2

INDEX = "block long, dim int, wide boolean, n int, ids binary, low binary, width binary, slices binary"
QUERY = "part long, dim int, wide boolean, ids binary, vectors binary"


def finite(vector: Column) -> Column:
    """The components as doubles; null for vectors that are null or hold null, NaN or infinity."""
    value = F.transform(vector, lambda x: x.cast("double"))
    odd = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(~odd, value)


def quantised(x: np.ndarray, scale: int, wide: bool) -> np.ndarray:
    """floor(scale * x) of doubles, as 64-bit numbers or, if ``wide``, as Python's."""
    if not wide:
        return np.floor(x * scale).astype(np.int64)
    out = np.empty(x.shape, object)
    # a double of 2**53 or more is an integer, and its product may be no double any more
    out.ravel()[:] = [int(v) * scale if abs(v) >= 2.0**53 else math.floor(v * scale) for v in x.ravel().tolist()]
    return out


def _cut(batches: Iterator[pa.RecordBatch], size: int, scale: int) -> Iterator[tuple[int, bool, np.ndarray, np.ndarray]]:
    """(dim, wide, ids, matrix) of at most ``size`` rows of the same length."""
    held: dict[tuple[int, bool], list] = {}

    def joined(group: list) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([x[0] for x in group]), np.concatenate([x[1] for x in group])

    for batch in batches:
        ids, column = np.asarray(batch.column(0)).astype(np.int64), batch.column(1)
        flat, n = np.asarray(column.flatten()).astype(np.float64), np.asarray(column.value_lengths()).astype(np.int64)
        ends = np.cumsum(n)
        for dim in np.unique(n).tolist():
            same = np.flatnonzero(n == dim)
            values = flat[(ends[same] - dim)[:, None] + np.arange(dim)]
            large = (np.abs(values) * scale > NARROW).any(1) if dim else np.zeros(len(same), bool)
            for wide in (False, True):
                pick = large == wide
                if not pick.any():
                    continue
                group = held.setdefault((dim, wide), [])
                group.append((ids[same[pick]], quantised(values[pick], scale, wide)))
                while sum(len(x[0]) for x in group) >= size:
                    i, m = joined(group)
                    yield dim, wide, i[:size], m[:size]
                    group[:] = [(i[size:], m[size:])]
    for (dim, wide), group in held.items():
        i, m = joined(group)
        if len(i):
            yield dim, wide, i, m


def _packed(x: np.ndarray) -> bytes:
    return pickle.dumps(x.tolist()) if x.dtype == object else x.tobytes()


def _unpacked(raw: bytes, wide: bool) -> np.ndarray:
    if not wide:
        return np.frombuffer(raw, np.int64)
    values = pickle.loads(raw)
    out = np.empty((len(values), *([len(values[0])] if values and isinstance(values[0], list) else [])), object)
    out.ravel()[:] = [v for row in values for v in row] if out.ndim == 2 else values
    return out


def _slices(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """Rows -> index blocks."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for dim, wide, ids, matrix in _cut(batches, BLOCK, scale):
        order = np.argsort(ids, kind="stable")
        ids, matrix = ids[order], matrix[order]
        low = matrix.min(0) if dim else np.zeros(0, np.int64)
        above = matrix - low
        width = np.array([int(x).bit_length() for x in (above.max(0) if dim else [])], np.uint16)
        words = -(-len(ids) // 64)
        bits = np.zeros((int(width.sum()), words * 64), np.uint8)
        row = 0
        for d in range(dim):
            for j in range(int(width[d])):
                bits[row, :len(ids)] = (above[:, d] >> j) & 1
                row += 1
        packed = np.packbits(bits, axis=1, bitorder="little")
        yield pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([dim], pa.int32()), pa.array([wide]), pa.array([len(ids)], pa.int32())]
            + [pa.array([x], pa.binary()) for x in (ids.tobytes(), _packed(low), width.tobytes(), packed.tobytes())],
            names=["block", "dim", "wide", "n", "ids", "low", "width", "slices"],
        )
        number += 1


def _query_blocks(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for dim, wide, ids, matrix in _cut(batches, QUERIES, scale):
        yield pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([dim], pa.int32()), pa.array([wide]), pa.array([ids.tobytes()], pa.binary()), pa.array([_packed(matrix)], pa.binary())],
            names=["part", "dim", "wide", "ids", "vectors"],
        )
        number += 1


class _Sum:
    """Bitmaps by weight, kept at two for a weight by carry-save adders."""

    def __init__(self):
        self.planes: list[list[np.ndarray]] = []

    def add(self, plane: np.ndarray, weight: int) -> None:
        while True:
            while len(self.planes) <= weight:
                self.planes.append([])
            here = self.planes[weight]
            here.append(plane)
            if len(here) < 3:
                return
            a, b, c = here
            half = a ^ b
            plane = (a & b) | (half & c)
            self.planes[weight] = [half ^ c]
            weight += 1

    def slices(self) -> list[np.ndarray]:
        """One bitmap a weight, least significant first."""
        weight = 0
        while weight < len(self.planes):
            here = self.planes[weight]
            if len(here) == 2:
                a, b = here
                self.planes[weight] = [a ^ b]
                self.add(a & b, weight + 1)
            weight += 1
        return [p[0] if p else None for p in self.planes]


def score_slices(queries: np.ndarray, low, width, slices) -> tuple[list[np.ndarray], np.ndarray]:
    """Sum slices (queries x words) of the inner products, and what to add to them for each query."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    total, row = _Sum(), 0
    magnitude, negative = np.abs(queries), queries < 0
    for d in range(queries.shape[1]):
        own = magnitude[:, d]
        sign = np.where(negative[:, d].astype(bool), full, np.uint64(0))[:, None]
        bits = [b for b in range(int(own.max()).bit_length()) if ((own >> b) & 1).any()]
        masks = [np.where(((own >> b) & 1).astype(bool), full, np.uint64(0))[:, None] for b in bits]
        for j in range(int(width[d])):
            if masks:
                plane = slices[row][None, :] ^ sign  # of a negative component the complement is added
                for b, mask in zip(bits, masks, strict=True):
                    total.add(plane & mask, b + j)
            row += 1
    top = np.array([(1 << int(w)) - 1 for w in width], queries.dtype)
    return total.slices(), (queries * low).sum(1) - (np.where(negative, magnitude, 0) * top).sum(1)


def select_top(sums: list[np.ndarray], valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) of the k rows with the largest sums among ``valid`` (queries x words); ties to the first rows."""
    chosen, left = np.zeros_like(valid), valid
    for plane in reversed(sums):
        if plane is None:
            continue
        with_bit = chosen | (left & plane)
        over = (np.bitwise_count(with_bit).sum(1, dtype=np.int64) > k)[:, None]
        left = left & np.where(over, plane, ~plane)
        chosen = np.where(over, chosen, with_bit)
    missing = k - np.bitwise_count(chosen).sum(1, dtype=np.int64)
    sure = np.nonzero(np.unpackbits(chosen.view(np.uint8), axis=1, bitorder="little"))
    query, row = np.nonzero(np.unpackbits(left.view(np.uint8), axis=1, bitorder="little"))
    nth = np.arange(len(query)) - np.searchsorted(query, query)
    ok = nth < missing[query]
    return np.concatenate([sure[0], query[ok]]), np.concatenate([sure[1], row[ok]])


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a query block and an index block -> the best rows of the block for each query."""
    for batch in batches:
        for i in range(batch.num_rows):
            def field(name, kind, batch=batch, i=i):
                return np.frombuffer(batch.column(name)[i].as_buffer(), kind)

            part, dim, n, q_wide, wide = (batch.column(c)[i].as_py() for c in ("part", "dim", "n", "q_wide", "wide"))
            q_ids, ids, width = field("q_ids", np.int64), field("ids", np.int64), field("width", np.uint16)
            low = _unpacked(batch.column("low")[i].as_py(), wide)
            vectors = _unpacked(batch.column("vectors")[i].as_py(), q_wide).reshape(len(q_ids), dim)
            # sums and offsets that may not fit 64 bits are Python's numbers
            most = np.abs(low.astype(float)) + np.exp2(np.minimum(width, 900).astype(float))
            if q_wide or wide or not (np.abs(vectors.astype(float)) * most).sum(1).max(initial=0) < SAFE:
                vectors, low = vectors.astype(object), low.astype(object)
            words = -(-n // 64)
            slices = field("slices", np.uint64).reshape(-1, words)
            everyone = np.packbits(np.arange(words * 64) < n, bitorder="little").view(np.uint64)
            step = max(1, TOGETHER // words)
            for a in range(0, len(q_ids), step):
                q, own = vectors[a:a + step], q_ids[a:a + step]
                sums, base = score_slices(q, low, width, slices)
                valid = np.repeat(everyone[None, :], len(q), axis=0)
                first, last = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
                for x in np.flatnonzero(last > first):
                    mine = np.arange(first[x], last[x])
                    np.bitwise_and.at(valid[x], mine // 64, ~(np.uint64(1) << (mine % 64).astype(np.uint64)))
                query, row = select_top(sums, valid, k)
                score = base[query]
                for weight, plane in enumerate(sums):
                    if plane is not None:
                        bit = (plane[query, row // 64] >> (row % 64).astype(np.uint64)) & np.uint64(1)
                        score = score + (bit.astype(score.dtype if score.dtype == object else np.int64) << weight)
                if score.dtype == object:
                    if any(not -(1 << 63) <= int(x) < 1 << 63 for x in score):
                        raise OverflowError("a score among the highest does not fit 64 bits")
                    score = score.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (np.full(len(query), part), a + query, own[query], ids[row], score)],
                    names=["part", "nth", "query_id", "vec_id", "score"],
                )


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """Index blocks of all rows that take part (see ``top_k``), stored."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), finite(F.col(vector)).alias("q")).where("id IS NOT NULL AND q IS NOT NULL")
    return stored(rows.mapInArrow(lambda it: _slices(it, scale), INDEX), "slices")


def top_k(
    index: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector: str = "embedding", scale: int = 64,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k rows with the largest inner products, its own id left out.

    Components are ``floor(scale * x)``; ranks start at 1 and ties go to the smaller id.

    * Rows without id, with a null vector, or with null, NaN or infinite components take no part. Vectors
      meet only vectors of the same length. Components may have any finite size; a score among the
      results that does not fit 64 bits is an error.
    * Rows that repeat an id are candidates each. Of queries that repeat id and vector one is asked;
      queries that repeat an id with other vectors are ranked each by itself.
    * Fewer candidates than k give all of them. Empty tables give no rows.
    """
    asked = (
        queries.select(F.col(id_col).cast("long").alias("id"), finite(F.col(vector)).alias("q"))
        .where("id IS NOT NULL AND q IS NOT NULL").distinct()
    )
    blocks = stored(asked.mapInArrow(lambda it: _query_blocks(it, scale), QUERY), "queries")
    # every block meets every query block of its length, a few of them for each copy of the block
    groups = max(1, -(-blocks.count() // ASKED))
    mine = F.pmod(F.xxhash64("part"), F.lit(groups)).alias("group")
    asking = blocks.select("part", "dim", F.col("wide").alias("q_wide"), F.col("ids").alias("q_ids"), "vectors", mine)
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = asking.join(index.select("dim", "block"), "dim").repartition(parts, "block", "group")
    copies = asking.select("dim", "group").distinct().join(index, "dim").repartition(parts, "block", "group")
    met = pairs.join(copies.drop("dim"), ["block", "group"]).select(
        "part", "dim", "q_wide", "q_ids", "vectors", "wide", "n", "ids", "low", "width", "slices"
    )
    found = met.mapInArrow(lambda it: _search(it, k), "part long, nth long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id", "part", "nth").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
