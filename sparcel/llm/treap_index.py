"""Ranked lexical search on K2-treaps over the grid of terms and documents.

Documents are cut into blocks in the scan. A block is a grid with a row for each of its terms, those of
most documents first, and a column for each document. It is stored as a quadtree without its empty
cells: a level holds, in Z order, four bits a cell for the quadrants that are not empty and the largest
impact of the cell. A leaf is one term in one document and holds its count, which gives the exact impact;
inner cells hold their largest one in steps of 16, rounded up, which is an upper bound.

A query descends with all its terms together: a range of documents stands with one cell a term, that of
the term's row, and the weighted maxima of these cells bound the score of every document of the range. The
ranges of the highest bounds are split first, and a range goes as soon as its bound is below the lowest of
the k scores that the task already has, over all its blocks. So the result is exact, and whole.

Terms are told apart by 64-bit hashes. Counts of the corpus come from a scan, document frequencies of the
asked terms from the row sizes of the blocks. Queries go in groups of bounded size to all blocks, each
group with one scan of the index, which itself is never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparcel.llm import hashing
from sparcel.llm.common import stored

#: Most documents and postings of a block; a document with more postings is a block of its own.
BLOCK, POSTINGS = 1 << 12, 1 << 20
#: Most queries and terms of a group of queries that meets the index in one scan.
QUERIES, TERMS = 1 << 10, 1 << 18
#: Document ranges of one query that are split together, and cells of its ranges beyond which deep ranges go
#: first, whatever their bounds: a query of very many terms then holds few ranges at a time.
TOGETHER, WIDE = 256, 1 << 22
#: Step of the maxima of inner cells.
STEP = 16
#: Salts that share the candidates of one query before they are merged.
SALTS = 64
#: Impact of a term that fills a document: the scale of all impacts.
SCALE = 1_000_000_000

_TERM = np.zeros(256, bool)
_TERM[128:] = True
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    _TERM[_low:_high + 1] = True

_BLOCK = "block long, n int, terms binary, sizes binary, ids array<long>, lengths binary, counts binary, masks binary, tops binary, levels binary"
_FOUND = "item long, query_id long, doc_id long, score long, part int"


def term_spans(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of the terms in ``data``, the texts of these lengths one after the other."""
    solid = _TERM[data]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    start = np.flatnonzero(solid & (edge[:-1] | ~np.concatenate([[False], solid[:-1]])))
    end = np.flatnonzero(solid & (edge[1:] | ~np.concatenate([solid[1:], [False]]))) + 1
    return start, end, np.searchsorted(bounds, start, "right") - 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) -> documents with terms and terms with repeats, one row a task."""
    docs, terms = 0, 0
    for batch in batches:
        n = np.zeros(batch.num_rows, np.int64)
        for rows, data, lengths in hashing.pieces(batch.column(0)):
            n[rows] += np.bincount(term_spans(data, lengths)[2], minlength=len(rows))
        docs, terms = docs + int((n > 0).sum()), terms + int(n.sum())
    yield pa.RecordBatch.from_arrays([pa.array([docs]), pa.array([terms])], names=["docs", "terms"])


def term_counts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, row of each posting, term, count), a piece of the column at a time; rows of a cut text come several times."""
    for rows, data, lengths in hashing.pieces(column):
        data = hashing.lowered(data)
        start, end, text = term_spans(data, lengths)
        if not len(start):
            yield rows, *(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64))
            continue
        term, at = np.unique(hashing.hash_spans(data, start, end), return_inverse=True)
        both, count = np.unique(at * len(rows) + text, return_counts=True)
        yield rows, rows[both % len(rows)], term[both // len(rows)], count


def _summed(doc: np.ndarray, term: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Postings of equal document and term made one."""
    order = np.lexsort((term, doc))
    doc, term = doc[order], term[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
    starts = np.flatnonzero(first)
    return doc[starts], term[starts], np.add.reduceat(count[order], starts) if len(starts) else count[:0]


def penalties(lengths: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """100 - 50 + (50 * n * N) div L for documents of n terms."""
    if not len(lengths) or not terms:
        return np.full(len(lengths), 50, np.int64)
    if int(lengths.max()) * 50 * docs < 1 << 63:
        return 50 + (50 * lengths * docs) // terms
    return np.array([50 + (50 * int(n) * docs) // terms for n in lengths], np.int64)


def impacts(count: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    return (SCALE * count) // (1000 * count + 20 * penalty)


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of x at the even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def build_block(ids: list, lengths: np.ndarray, doc: np.ndarray, term: np.ndarray, count: np.ndarray, docs: int, terms: int) -> dict:
    """The treap of one block: ``doc`` are places in ``ids``, one posting for each document and term."""
    names, at, sizes = np.unique(term, return_inverse=True, return_counts=True)
    order = np.argsort(-sizes, kind="stable")
    row = np.empty(len(names), np.int64)
    row[order] = np.arange(len(names))
    value = impacts(count, penalties(lengths, docs, terms)[doc])
    z = (_spread(row[at]) << np.uint64(1)) | _spread(doc)
    along = np.argsort(z)
    cell, top = z[along], value[along]
    height = max(int(max(len(names), len(ids), 1) - 1).bit_length(), 1)
    masks, tops, levels = [], [], [len(cell)]
    for _ in range(height):
        above = cell >> np.uint64(2)
        starts = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]])) if len(above) else np.zeros(0, np.int64)
        quadrant = np.left_shift(1, (cell & np.uint64(3)).astype(np.int64))
        masks.append(np.bitwise_or.reduceat(quadrant, starts).astype(np.uint8) if len(starts) else np.zeros(0, np.uint8))
        top = np.maximum.reduceat(top, starts) if len(starts) else top
        tops.append(-(-top // STEP))
        cell = above[starts]
        levels.append(len(cell))
    four = np.concatenate(masks[::-1])
    four = np.append(four, np.uint8(0)) if len(four) % 2 else four
    exact = count[along]
    return {
        "n": len(ids), "terms": names[order].tobytes(), "sizes": sizes[order].astype(np.int32).tobytes(), "ids": ids,
        "lengths": lengths.tobytes(), "counts": exact.astype(np.min_scalar_type(int(exact.max(initial=0)))).tobytes(),
        "masks": (four[::2] | (four[1::2] << 4)).tobytes(), "tops": np.concatenate(tops[::-1]).astype(np.uint16).tobytes(),
        "levels": np.array(levels[::-1], np.int64).tobytes(),
    }


def _blocks(batches: Iterator[pa.RecordBatch], docs: int, terms: int) -> Iterator[pa.RecordBatch]:
    """(id, text) -> blocks of the index."""
    from pyspark import TaskContext

    schema = pa.schema([
        ("block", pa.int64()), ("n", pa.int32()), ("terms", pa.binary()), ("sizes", pa.binary()), ("ids", pa.list_(pa.int64())),
        ("lengths", pa.binary()), ("counts", pa.binary()), ("masks", pa.binary()), ("tops", pa.binary()), ("levels", pa.binary()),
    ])
    number = TaskContext.get().partitionId() << 32
    ids: list = []
    lengths: list[np.ndarray] = []
    held: list[tuple] = []

    def close(number: int) -> pa.RecordBatch:
        doc, term, count = (np.concatenate(x) for x in zip(*held, strict=True))
        block = build_block(ids, np.concatenate(lengths), doc, term, count, docs, terms)
        return pa.RecordBatch.from_pylist([{"block": number, **block}], schema=schema)

    for batch in batches:
        # rows of a piece stand together; a cut text comes in several pieces, which are summed here
        waiting: list[tuple] = []
        own_ids = batch.column(0).to_pylist()
        stream = term_counts(batch.column(1))
        following = next(stream, None)
        while following is not None:
            rows, *posting = following
            waiting.append(tuple(posting))
            following = next(stream, None)
            if following is not None and following[0][0] == rows[-1]:
                if len(waiting) > 8:
                    waiting = [_summed(*(np.concatenate(x) for x in zip(*waiting, strict=True)))]
                continue
            doc, term, count = _summed(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
            waiting = []
            ends = np.searchsorted(doc, rows, "right")
            n = np.bincount(doc - rows[0], weights=count, minlength=len(rows)).astype(np.int64)
            a = 0
            while a < len(rows):  # as many of the rows as the open block takes
                size = sum(len(x[0]) for x in held)
                begin = ends[a - 1] if a else 0
                room = int(np.searchsorted(ends - begin, POSTINGS - size, "right"))
                b = min(len(rows), a + BLOCK - len(ids), max(room, a + 1 if not ids else a))
                if b > a:
                    stop = ends[b - 1]
                    held.append((doc[begin:stop] - rows[a] + len(ids), term[begin:stop], count[begin:stop]))
                    ids.extend(own_ids[rows[a]:rows[b - 1] + 1])
                    lengths.append(n[a:b])
                if b < len(rows) or len(ids) >= BLOCK:
                    yield close(number)
                    number += 1
                    ids, lengths, held = [], [], []
                a = b
    if ids:
        yield close(number)


@dataclass
class Index:
    """Stored blocks, and the corpus counts that their impacts rest on."""

    blocks: DataFrame
    docs: int
    terms: int


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Index:
    """K2-treaps of all rows of ``docs``, stored; see ``search``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    total = rows.select("text").mapInArrow(_counted, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    n, length = int(total[0] or 0), int(total[1] or 0)
    return Index(stored(rows.mapInArrow(lambda it: _blocks(it, n, length), _BLOCK), "treaps"), n, length)


class Block:
    """A block as it is read back."""

    def __init__(self, row: dict, docs: int, terms: int):
        self.levels = np.frombuffer(row["levels"], np.int64)
        self.height = len(self.levels) - 1
        self.offset = np.concatenate([[0], np.cumsum(self.levels)])
        pairs = np.frombuffer(row["masks"], np.uint8)
        self.mask = np.empty(2 * len(pairs), np.uint8)
        self.mask[::2], self.mask[1::2] = pairs & 15, pairs >> 4
        self.mask = self.mask[:self.offset[-2]]
        self.top = np.frombuffer(row["tops"], np.uint16)
        # children stand in the order of their parents, so their places are running sums
        self.child = self.levels[0] + np.cumsum(_BITS[self.mask]) - _BITS[self.mask]
        kind = np.dtype(f"u{max(1, len(row['counts']) // max(1, int(self.levels[-1])))}")
        self.count = np.frombuffer(row["counts"], kind)
        self.names = np.frombuffer(row["terms"], np.uint64)
        self.by_name = np.argsort(self.names)
        self.sorted_names = self.names[self.by_name]
        self.penalty = penalties(np.frombuffer(row["lengths"], np.int64), docs, terms)
        self.ids = row["ids"]

    def rows(self, term: np.ndarray) -> np.ndarray:
        """Row of each term, -1 where no document of the block has it."""
        if not len(self.names):
            return np.full(len(term), -1)
        at = np.minimum(np.searchsorted(self.sorted_names, term), len(self.names) - 1)
        return np.where(self.sorted_names[at] == term, self.by_name[at], -1)


_BITS = np.array([bin(x).count("1") for x in range(16)], np.int64)


class Best:
    """The k highest (score, id) of one query so far: higher scores first, then smaller ids, null last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id, self.none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """A document with a lower score is not among the k any more."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        score, ids, none = np.concatenate([self.score, score]), np.concatenate([self.id, ids]), np.concatenate([self.none, none])
        order = np.lexsort((ids, none, -score))[:self.k]
        self.score, self.id, self.none = score[order], ids[order], none[order]


def descend(block: Block, term: np.ndarray, weight: np.ndarray, best: Best, ids: np.ndarray, none: np.ndarray) -> int:
    """Add the documents of the block that are among the best for these terms; returns the ranges that were split."""
    row = block.rows(term)
    row, weight = row[row >= 0], weight[row >= 0]
    if not len(row):
        return 0
    leaves, split = int(block.offset[-2]), 0
    # the frontier: bound, level (0: single documents), place of the range at its level, a cell for each row
    bound = np.array([int((weight * (int(block.top[0]) * STEP)).sum())], np.int64)
    level, place = np.array([block.height]), np.zeros(1, np.int64)
    cells = np.zeros((1, len(row)), np.int32)
    while len(bound):
        least = best.least
        together = max(1, min(TOGETHER, WIDE // (4 * len(row))))
        if len(bound) > together:
            first = np.argpartition(-bound if cells.size <= WIDE else level, together - 1)
            now, later = first[:together], first[together:]
        else:
            now, later = np.arange(len(bound)), np.zeros(0, np.int64)
        now = now[bound[now] >= least]
        later = later[bound[later] >= least]
        if not len(now):
            break
        split += len(now)
        at, below = cells[now], level[now] - 1
        mask = np.where(at >= 0, block.mask[at], 0)
        first = block.child[at]
        upper = (row[None, :] >> below[:, None]) & 1
        parts = [(bound[later], level[later], place[later], cells[later])]
        for half in (0, 1):
            quadrant = 2 * upper + half
            there = (mask >> quadrant) & 1 > 0
            child = np.where(there, first + _BITS[mask & ((1 << quadrant) - 1)], -1).astype(np.int32)
            spot = 2 * place[now] + half
            inner = below > 0
            high = np.zeros(len(now), np.int64)
            if inner.any():
                top = np.where(there[inner], block.top[np.where(there[inner], child[inner], 0)].astype(np.int64), 0)
                high[inner] = (top * STEP) @ weight
            single = np.flatnonzero(~inner & there.any(1))
            if len(single):
                own, has = child[single], there[single]
                count = np.where(has, block.count[np.where(has, own - leaves, 0)].astype(np.int64), 0)
                score = impacts(count, block.penalty[spot[single]][:, None]) @ weight
                ok = score >= least
                best.add(score[ok], ids[spot[single][ok]], none[spot[single][ok]])
            go = np.flatnonzero(inner & (high >= least))
            parts.append((high[go], below[go], spot[go], child[go]))
        bound, level, place, cells = (np.concatenate(x) for x in zip(*parts, strict=True))
    return split


def _searched(batches: Iterator[pa.RecordBatch], queries, docs: int, terms: int, k: int) -> Iterator[pa.RecordBatch]:
    """Index blocks -> the k best documents of the task for each query of the group."""
    from pyspark import TaskContext

    asked = queries.value
    found = [Best(k) for _ in asked]
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names if name != "ids"}
            held = batch.column("ids")[i].values
            row["ids"] = held
            block = Block(row, docs, terms)
            none = np.asarray(held.is_null()) if held is not None else np.zeros(0, bool)
            ids = np.asarray(held.fill_null(0)).astype(np.int64) if held is not None else np.zeros(0, np.int64)
            for (_, _, term, weight), best in zip(asked, found, strict=True):
                descend(block, term, weight, best, ids, none)
    part = TaskContext.get().partitionId() % SALTS
    for (item, query_id, _, _), best in zip(asked, found, strict=True):
        n = len(best.score)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, item)), pa.array([query_id] * n, pa.int64()), pa.array(best.id, pa.int64(), mask=best.none),
                 pa.array(best.score), pa.array(np.full(n, part, np.int32))],
                names=["item", "query_id", "doc_id", "score", "part"],
            )


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> the distinct terms of each query."""
    for batch in batches:
        own: dict[int, list] = {}
        for _, row, term, _ in term_counts(batch.column(1)):
            for r in np.unique(row):
                own.setdefault(int(r), []).append(term[row == r])
        terms = [np.unique(np.concatenate(own[r])).tobytes() if r in own else b"" for r in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.binary())], names=["id", "terms"])


def _rows_of(batches: Iterator[pa.RecordBatch], wanted) -> Iterator[pa.RecordBatch]:
    """(terms, sizes) of blocks -> (place of an asked term, documents that hold it), summed over the task."""
    asked = wanted.value
    total = np.zeros(len(asked), np.int64)
    for batch in batches:
        for i in range(batch.num_rows):
            names, sizes = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in ((0, np.uint64), (1, np.int32)))
            at = np.minimum(np.searchsorted(asked, names), len(asked) - 1)
            ok = asked[at] == names
            total[at[ok]] += sizes[ok]
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["at", "df"])


def _groups(queries: DataFrame) -> Iterator[list[tuple]]:
    """Queries in groups of bounded size, one at a time on the driver."""
    group, size = [], 0
    for row in queries.toLocalIterator():
        terms = np.frombuffer(row["terms"], np.uint64)
        if group and (len(group) == QUERIES or size + len(terms) > TERMS):
            yield group
            group, size = [], 0
        group.append((row["id"], terms))
        size += len(terms)
    if group:
        yield group


def search(
    index: Index, queries: DataFrame, k: int = 50, item_id: str = "item_id", text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): for each query the k documents with the highest scores above 0.

    Terms are runs of ASCII letters and digits and of everything beyond ASCII, A-Z lowered, of whole
    texts. With N documents that have terms, L terms in all, n terms in a document, df documents
    that hold a term and tf its occurrences, a document scores ``sum(w * ((10**9 * tf) div (1000 * tf
    + 20 * m)))`` over the distinct terms of the query, ``w = floor(1000 * ln((2N + 2) / (2df + 1)))``,
    ``m = 50 + (50 * n * N) div L``.

    * Equal scores go by ascending id, null ids last. Documents that repeat an id are candidates each.
    * Null and empty texts have no terms: such documents are never found, such queries find nothing.
    * Queries that repeat id and text are asked once; those that repeat an id with another text are ranked
      each by itself. A null id is an id. Other columns are ignored. Empty tables give no rows.
    """
    spark, docs, terms = index.blocks.sparkSession, index.docs, index.terms
    asked = queries.select(F.col(item_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).distinct()
    asked = stored(asked.mapInArrow(_asked, "id long, terms binary").where(F.length("terms") > 0), "asked")
    found, number = None, 0
    for group in _groups(asked):
        wanted = np.unique(np.concatenate([t for _, t in group]))
        shared = spark.sparkContext.broadcast(wanted)
        held = index.blocks.select("terms", "sizes").mapInArrow(lambda it, shared=shared: _rows_of(it, shared), "at long, df long")
        df = np.zeros(len(wanted), np.int64)
        for row in held.groupBy("at").agg(F.sum("df").alias("df")).toLocalIterator():
            df[row["at"]] = row["df"]
        weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        places = [np.searchsorted(wanted, t) for _, t in group]
        sent = [
            (number + i, own, wanted[p[df[p] > 0]], weight[p[df[p] > 0]])
            for i, ((own, _), p) in enumerate(zip(group, places, strict=True))
        ]
        number += len(group)
        ready = spark.sparkContext.broadcast(sent)
        rows = index.blocks.drop("block", "sizes").mapInArrow(
            lambda it, ready=ready: _searched(it, ready, docs, terms, k), _FOUND
        )
        rows = stored(rows, "found")
        shared.unpersist()
        ready.unpersist()
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        found = spark.createDataFrame([], _FOUND)
    best = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    some = found.withColumn("nth", F.row_number().over(Window.partitionBy("item", "part").orderBy(*best))).where(F.col("nth") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).where(F.col("rank") <= k)
    return ranked.select(F.col("query_id").alias("item_id"), "rank", "doc_id", "score")
