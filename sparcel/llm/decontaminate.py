"""Finding benchmark items in documents up to edits of words.

An item of m words is in a document if some run of its words is within ``floor(rate * m)`` edits of
the item. Documents stay where they are; the items go to them in blocks of bounded size.

1. Seeds choose the windows: with k edits, one of k + 1 disjoint pieces of the item stands in the
   document unchanged, so windows of the item's size start where such a piece says. This loses
   nothing; windows that no piece asks for cannot match.
2. Windows and items are embedded by the random walk of Chakraborty, Goldenberg and Koucky (STOC
   2016): output the current word at each step, and step on if a random bit of (step, word) says
   so. A few edits become a few Hamming differences.
3. Bit-sampling LSH: each table hashes a few sampled positions of an embedding. The number of tables
   (``TABLES``) is fixed and was measured on items of up to ``LONG`` words. The many edits of longer
   ones would be lost, so their windows skip 2 and 3.
4. Pairs that meet in a table, and the windows of longer items, are verified by the exact edit distance of the item to the best run of
   words around the window.

Words are runs of characters other than white space and ASCII punctuation, in lower case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sparcel.llm import hashing

RATE = 0.2
#: Independent walks, samples of each, positions in a sample.
WALKS, SAMPLES, POSITIONS = 8, 12, 2
TABLES = WALKS * SAMPLES
#: Items that are broadcast at once, by number and by words.
BLOCK_ITEMS, BLOCK_WORDS = 20_000, 2_000_000
#: Words that are searched at once.
RUN = 300_000
EDIT = 1 << 32
#: Items of more words are verified at every window that a seed chooses, at most so many cells of distances at once.
LONG, CELLS = 60, 1 << 20

_PUNCTUATION = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[list(_PUNCTUATION)] = 32
_rng = np.random.default_rng(7_2016)
_STEP = _rng.integers(0, 1 << 63, (WALKS, 1 << 10), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_AT = _rng.random((WALKS, SAMPLES, POSITIONS))
_COEF = _rng.integers(0, 1 << 63, POSITIONS + 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TABLE = np.arange(TABLES, dtype=np.uint64) * _COEF[-2]
_PIECE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_END = np.uint64(0x5DEECE66D)


def words(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of a string column."""
    low = pc.utf8_lower(column)
    if isinstance(low, pa.ChunkedArray):
        low = low.combine_chunks()
    raw, start, end = hashing.flat_bytes(low)
    large = pa.types.is_large_string(low.type)
    clean = pa.Array.from_buffers(
        low.type, len(low), [None, pa.py_buffer(np.append(start, end[-1:]).astype(np.int64 if large else np.int32)), pa.py_buffer(_BLANK[raw])]
    ) if len(low) and not low.null_count else None
    if clean is None:  # nulls leave holes: pack the values again
        parts = [_BLANK[raw[a:b]].tobytes() for a, b in zip(start, end, strict=True)]
        clean = pa.array(parts, pa.large_binary())
    yield from hashing.word_hashes(clean)


def _piece_hash(w: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    total = np.full(len(at), size, np.uint64)
    for k in range(size):
        total += w[at + k] * _PIECE[k % 64]
    return hashing.mix(total)


class Items:
    """The items of a block, ready to be searched for; its size is bounded by the block."""

    def __init__(self, ids: list, texts: list[str | None], rate: float = RATE):
        found = [(i, w) for i, (_, w) in zip(ids, words(pa.array(texts, pa.large_string())), strict=True) if len(w)]
        self.ids = [i for i, _ in found]
        self.size = np.array([len(w) for _, w in found], np.int64)
        self.edits = np.floor(rate * self.size + 1e-9).astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)
        self.words = np.concatenate([w for _, w in found]) if found else np.zeros(0, np.uint64)
        seeds: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for item, (m, k) in enumerate(zip(self.size, self.edits, strict=True)):
            cuts = (np.arange(k + 2) * m) // (k + 1)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                seeds.setdefault(int(b - a), []).append((self.start[item] + a, item, a))
        self.seeds = {}
        for size, rows in seeds.items():
            at, item, offset = (np.array(x, np.int64) for x in zip(*rows, strict=True))
            h = _piece_hash(self.words, at, size)
            order = np.argsort(h, kind="stable")
            seen = np.zeros(1 << 20, bool)
            seen[(h >> np.uint64(44)).astype(np.int64)] = True
            self.seeds[size] = (h[order], item[order], offset[order], seen)
        short = np.flatnonzero(self.size <= LONG)
        keys = embed_keys(self.words, self.start[short], self.size[short], self.start[short], self.start[short + 1])
        self.keys = keys.ravel()
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.key_item = self.keys[order], short[order // max(1, TABLES)]

    def windows(self, w: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, item) where a piece of the item stands; ``text`` numbers the text of each word."""
        starts, items = [], []
        for size, (hashes, item, offset, seen) in self.seeds.items():
            n = len(w) - size + 1
            if n <= 0:
                continue
            total = np.full(n, size, np.uint64)
            for k in range(size):
                total += w[k:k + n] * _PIECE[k % 64]
            total = hashing.mix(total)
            at = np.flatnonzero(seen[(total >> np.uint64(44)).astype(np.int64)])
            at = at[text[at] == text[at + size - 1]]
            low, high = np.searchsorted(hashes, total[at], "left"), np.searchsorted(hashes, total[at], "right")
            many = high - low
            row = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            starts.append(np.repeat(at, many) - offset[row])
            items.append(item[row])
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = np.unique(np.stack([np.concatenate(starts), np.concatenate(items)]), axis=1)
        return both[0], both[1]

    def search(self, w: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, item, distance, first word, end word) of matches in the texts ``w[bounds[i]:bounds[i + 1]]``."""
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        start, seed_item = self.windows(w, text)
        long = np.flatnonzero(self.size[seed_item] > LONG)
        long = long[np.argsort(self.size[seed_item[long]], kind="stable")]
        out, i = [], 0
        while i < len(long):  # few at once where they are long
            n = max(1, CELLS // int(2 * self.size[seed_item[long[min(i + 4096, len(long)) - 1]]]))
            s, item = start[long[i:i + min(n, 4096)]], seed_item[long[i:i + min(n, 4096)]]
            lo, hi, inside = self._bounds(s, self.size[item], text, bounds)
            out.append(self._verify(w, s, item, lo, hi, inside))
            i += len(s)
        short = self.size[seed_item] <= LONG
        start, seed_item = start[short], seed_item[short]
        for i in range(0, len(start), 4096):
            s, item = start[i:i + 4096], seed_item[i:i + 4096]
            m = self.size[item]
            lo, hi, inside = self._bounds(s, m, text, bounds)
            keys = embed_keys(w, s, m, lo, hi)
            flat = keys.ravel()
            low, high = np.searchsorted(self.keys, flat, "left"), np.searchsorted(self.keys, flat, "right")
            many = high - low
            hit = np.repeat(np.arange(len(flat)), many)
            row = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            pair = np.unique(np.stack([hit // TABLES, self.key_item[row]]), axis=1)
            if pair.shape[1]:
                out.append(self._verify(w, s[pair[0]], pair[1], lo[pair[0]], hi[pair[0]], inside[pair[0]]))
        if not out:
            return tuple(np.zeros(0, np.int64) for _ in range(5))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _bounds(self, s, m, text, bounds):
        """(first word, end word, number) of the texts of windows."""
        # a start may lie before its text by some words, but its window holds a seed of the text
        inside = self._own_text(s, m, text[np.clip(s + m // 2, 0, len(text) - 1)], bounds)
        return bounds[inside], bounds[inside + 1], inside

    @staticmethod
    def _own_text(s, m, guess, bounds):
        """The text that holds most of the window [s, s + m)."""
        best, most = guess, np.full(len(s), -1, np.int64)
        for d in (0, -1, 1):
            t = np.clip(guess + d, 0, len(bounds) - 2)
            share = np.minimum(s + m, bounds[t + 1]) - np.maximum(s, bounds[t])
            best, most = np.where(share > most, t, best), np.maximum(share, most)
        return best

    def _verify(self, w, start, item, lo, hi, text):
        """Edit distance of each item to the best run of words in its window, widened by the edits allowed."""
        m, k = self.size[item], self.edits[item]
        left, right = np.maximum(start - k, lo), np.minimum(start + m + k, hi)
        width, height = int((right - left).max()), int(m.max())
        cols = np.arange(width + 1)
        d = np.broadcast_to(cols.astype(np.int64), (len(m), width + 1)).copy()  # distance * EDIT + first word
        final = d.copy()
        inner = left[:, None] + cols[None, :-1]
        region = np.where(inner < right[:, None], w[np.minimum(inner, len(w) - 1)], _END)
        for i in range(height):
            live = i < m
            symbol = self.words[np.minimum(self.start[item] + i, len(self.words) - 1)]
            new = np.empty_like(d)
            new[:, 0] = d[:, 0] + EDIT
            new[:, 1:] = np.minimum(d[:, 1:] + EDIT, d[:, :-1] + np.where(region == symbol[:, None], 0, EDIT))
            new = np.minimum.accumulate(new - cols * EDIT, axis=1) + cols * EDIT
            d = new
            last = live & (i == m - 1)
            final[last] = d[last]
        final[cols[None, :] > (right - left)[:, None]] = np.iinfo(np.int64).max
        end = final.argmin(1)
        best = final[np.arange(len(m)), end]
        distance, first = best // EDIT, best % EDIT
        ok = distance <= k
        base = left - lo
        return text[ok], item[ok], distance[ok], (base + first)[ok], (base + end)[ok]


def embed_keys(w, start, size, lo, hi) -> np.ndarray:
    """(windows x TABLES) LSH keys of the embeddings of w[start:start + size], clipped to [lo, hi)."""
    if not len(start):
        return np.zeros((0, TABLES), np.uint64)
    length = 2 * size
    steps = int(length.max())
    keys = np.empty((len(start), TABLES), np.uint64)
    place = np.arange(len(start))
    for walk in range(WALKS):
        at = np.zeros(len(start), np.int64)
        seen = np.empty((steps, len(start)), np.uint64)
        for j in range(steps):
            pos = start + at
            live = (at < size) & (pos >= lo) & (pos < hi)
            symbol = np.where(live, w[np.clip(pos, 0, len(w) - 1)], _END)
            seen[j] = symbol
            at += ((symbol * _STEP[walk, j % 1024]) >> np.uint64(63)).astype(np.int64)
        for sample in range(SAMPLES):
            t = walk * SAMPLES + sample
            total = size.astype(np.uint64) * _COEF[-1] + _TABLE[t]
            for p in range(POSITIONS):
                total += seen[(_AT[walk, sample, p] * length).astype(np.int64), place] * _COEF[p]
            keys[:, t] = hashing.mix(total)
    return keys


def _runs(column: pa.Array) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Whole texts, gathered to runs of about RUN words."""
    rows, held, n = [], [], 0
    for row, w in words(column):
        rows.append(row)
        held.append(w)
        n += len(w)
        if n >= RUN:
            yield rows, np.concatenate(held), np.concatenate([[0], np.cumsum([len(x) for x in held])])
            rows, held, n = [], [], 0
    if n:
        yield rows, np.concatenate(held), np.concatenate([[0], np.cumsum([len(x) for x in held])])


def _best(items: Items, column: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, distance, first word, end word): the best match of each item in each text."""
    for rows, w, bounds in _runs(column):
        found = np.stack(items.search(w, bounds))
        order = np.lexsort((found[3], found[2], found[1], found[0]))
        found = found[:, order]
        new = np.ones(found.shape[1], bool)
        new[1:] = (found[0, 1:] != found[0, :-1]) | (found[1, 1:] != found[1, :-1])
        for t, item, distance, first, end in found[:, new].T.tolist():
            yield rows[t], item, distance, first, end


def item_blocks(items: DataFrame, item_id: str, text: str, rate: float) -> Iterator[Items]:
    """The items in blocks whose size is bounded by number and by words, whatever their number."""
    size = F.coalesce(F.size(F.split(text, r"\s+")), F.lit(0))
    n, total = items.agg(F.count(F.lit(1)), F.sum(size.cast("long"))).first()
    blocks = max(1, -(-n // BLOCK_ITEMS), -(-(total or 0) // BLOCK_WORDS))
    part = F.pmod(F.xxhash64(item_id, text), F.lit(blocks))
    for b in range(blocks):
        rows = (items if blocks == 1 else items.where(part == b)).select(item_id, text).collect()
        yield Items([r[0] for r in rows], [r[1] for r in rows], rate)


def find_items(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", rate: float = RATE,
) -> DataFrame:
    """(doc_id, item_id, n_words, distance, first_word, end_word): the best match of each item in each document.

    * ``distance`` counts inserted, deleted and replaced words, at most ``floor(rate * n_words)``;
      ``first_word`` and ``end_word`` bound the run in the document; ties go to the first run.
    * Null or wordless texts and items match nothing. Items of fewer than ``1 / rate`` words match
      exactly only.
    * Rows that repeat an id are searched one by one. Null ids are carried along. Other columns are ignored.
    * Empty tables give no rows.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([
        base.schema["doc_id"], T.StructField("item_id", items.schema[item_id].dataType),
        *T.StructType.fromDDL("n_words int, distance int, first_word int, end_word int").fields,
    ])
    arrow = to_arrow_schema(schema)
    found = None
    for block in item_blocks(items, item_id, item_text, rate):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            it = shared.value
            for batch in batches:
                hits = list(_best(it, batch.column(1))) if it.ids else []
                if not hits:
                    continue
                row, item, distance, first, end = zip(*hits, strict=True)
                columns = [
                    batch.column(0).take(pa.array(row)), pa.array([it.ids[x] for x in item], arrow.field(1).type),
                    *[pa.array(x, pa.int32()) for x in (it.size[list(item)], distance, first, end)],
                ]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], names=arrow.names)

        rows = base.mapInArrow(search, schema)
        found = rows if found is None else found.unionByName(rows)
    return found


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = RATE,
) -> DataFrame:
    """The documents in which no item is found, with all their columns; nothing is shuffled."""
    kept: Column = F.col(text).cast("string")
    for block in item_blocks(items, item_id, item_text, rate):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        names = docs.columns

        def clean(batches: Iterator[pa.RecordBatch], shared=shared, at=len(names)) -> Iterator[pa.RecordBatch]:
            it = shared.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                if it.ids:
                    keep[[hit[0] for hit in _best(it, batch.column(at))]] = False
                yield batch.filter(pa.array(keep)).select(list(range(at)))

        docs = docs.select(*docs.columns, kept.alias("__text")).mapInArrow(clean, docs.schema)
    return docs
