"""Unigram encoding and decoding with a SentencePiece vocabulary: Viterbi over a double-array trie.

A text is cut before every run of spaces that follows something else. No piece crosses such a cut (a
vocabulary with pieces that do is refused), so the best segmentation of a text is that of its units,
and a unit needs to be solved once per batch however often it occurs. Units of a batch are matched
against the trie and solved together, on flat arrays.

White space is written as in the vocabulary: one space goes in front of the text and each space is
the marker U+2581. A marker that stands in the text itself is encoded by bytes, so that decoding
gives back every text exactly. The vocabulary is read on the driver and broadcast (a few MB).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sparcel.llm import hashing

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
#: Bytes of text encoded at once, and the size from which a unit is solved by itself.
RUN, LONG_UNIT = 1 << 17, 400
#: Most bytes in the pieces of a vocabulary.
MAX_VOCABULARY = 1 << 26


class DoubleArray:
    """A trie of byte strings: node ``s`` has the child ``base[s] + byte`` if ``check`` of that is ``s``."""

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for key, number in keys.items():
            node = 0
            for byte in key:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    value.append(-1)
                node = children[node][byte]
            value[node] = number
        # the widest nodes find room first; a node with one child takes the next free place
        room = len(children) * 2 + 1024
        used = bytearray(room)
        used[0] = 1
        base, place, free = [0] * len(children), [0] * len(children), 1
        for node in sorted(range(len(children)), key=lambda x: -len(children[x])):
            kids = sorted(children[node])
            if not kids:
                break
            free = used.find(0, free)
            at = free
            while True:
                start = at - kids[0]
                if at + 512 > len(used):
                    used.extend(bytes(len(used)))
                if start > 0 and not any(used[start + c] for c in kids):
                    break
                at = used.find(0, at + 1)
            base[node] = start
            for c in kids:
                used[start + c] = 1
                place[children[node][c]] = start + c
        end = max(place) + 257
        self.base, self.check, self.final = np.zeros(end, np.int32), np.full(end, -1, np.int32), np.full(end, -1, np.int32)
        for node, kids in enumerate(children):
            own = place[node]
            self.base[own] = base[node]
            self.final[own] = value[node]
            for child in kids.values():
                self.check[place[child]] = own

    def matches(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
        """(index into ``start``, end, value) of every key that begins at ``data[start]`` and ends by ``end``; by length."""
        out = []
        who, at, node = np.arange(len(start)), start, np.zeros(len(start), np.int64)
        live = at < end
        who, at, node = who[live], at[live], node[live]
        while len(who):
            child = self.base[node] + data[at].astype(np.int64)
            ok = self.check[child] == node
            who, at, node = who[ok], at[ok] + 1, child[ok]
            found = self.final[node] >= 0
            out.append((who[found], at[found], self.final[node[found]]))
            ok = at < end[who]
            who, at, node = who[ok], at[ok], node[ok]
        if not out:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Vocabulary:
    """Pieces with their log scores, ready to encode and decode."""

    def __init__(self, pieces: list[tuple[bytes, float, str]], unknown: int = 0):
        """``pieces``: (bytes with spaces for markers, score, kind), kind one of normal, byte, other."""
        if sum(len(p) for p, _, _ in pieces) > MAX_VOCABULARY:
            raise ValueError("the vocabulary is too large to be broadcast")
        keys = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == "normal" and p}
        if any(b" " in p.lstrip(b" ") for p in keys):
            raise ValueError("a piece has white space after other characters")
        self.trie = DoubleArray(keys)
        self.score = np.array([s for _, s, _ in pieces], np.float64)
        self.unknown, self.unknown_score = unknown, min(s for _, s, kind in pieces if kind == "normal") - UNKNOWN_PENALTY
        self.byte = np.full(256, -1, np.int64)
        for i, (p, _, kind) in enumerate(pieces):
            if kind == "byte":
                self.byte[p[0]] = i
        if (self.byte < 0).any():
            raise ValueError("the vocabulary has no byte pieces")
        shown = [b"" if kind == "other" else p for p, _, kind in pieces]
        self.width = np.array([len(p) for p in shown], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.width)])
        self.bytes = np.frombuffer(b"".join(shown), np.uint8)
        self.is_byte = np.array([kind == "byte" for _, _, kind in pieces])

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """Read a model file (on the driver only)."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = []
        for i in range(model.get_piece_size()):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                pieces.append((bytes([int(text[3:5], 16)]), 0.0, "byte"))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                pieces.append((text.encode(), 0.0, "other"))
            else:
                pieces.append((text.replace(MARKER, " ").encode(), model.get_score(i), "normal"))
        return cls(pieces, model.unk_id())

    def solve(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best pieces of the units ``data[start:end]``: (ids, one unit after the other; how many; score)."""
        size = end - start
        first = np.concatenate([[0], np.cumsum(size + 1)])  # each unit has a place for its end
        owner = np.repeat(np.arange(len(start)), size)
        place = first[owner] + np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(size)])[:-1], size)
        byte_at = start[owner] + place - first[owner]
        head = (data[byte_at] & 0xC0) != 0x80
        owner, place, byte_at = owner[head], place[head], byte_at[head]
        lead = data[byte_at]
        char = 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
        who, to, piece = self.trie.matches(data, byte_at, end[owner])
        length = to - byte_at[who]
        single = np.zeros(len(place), bool)
        single[who[length == char[who]]] = True
        none = np.flatnonzero(~single)
        who = np.concatenate([who, none])
        length = np.concatenate([length, char[none]])
        cost = np.concatenate([self.score[piece], np.full(len(none), self.unknown_score)])
        piece = np.concatenate([piece, np.full(len(none), -1)])
        source = place[who]
        target = source + length
        best = np.full(first[-1], -np.inf)
        best[first[:-1]] = 0
        link = np.full(first[-1], -1, np.int64)  # the edge that reaches a place
        local = source - first[owner[who]]
        long_unit = size[owner[who]] > LONG_UNIT
        # all units step by step: edges by (place in the unit, length), so ties keep the earliest start
        few = np.flatnonzero(~long_unit)
        few = few[np.lexsort((length[few], local[few]))]
        key = local[few] * 64 + np.minimum(length[few], 63)
        cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(few)]])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            e = few[a:b]
            got = best[source[e]] + cost[e]
            better = got > best[target[e]]
            e, got = e[better], got[better]
            if len(e) and length[e[0]] >= 63 and len(np.unique(target[e])) < len(e):  # several lengths in one step
                for one, value in zip(e, got, strict=True):
                    if value > best[target[one]]:
                        best[target[one]], link[target[one]] = value, one
                continue
            best[target[e]] = got
            link[target[e]] = e
        many = np.flatnonzero(long_unit)
        many = many[np.lexsort((length[many], source[many]))]
        for e, s, t, c in zip(many.tolist(), source[many].tolist(), target[many].tolist(), cost[many].tolist(), strict=True):
            if (got := best[s] + c) > best[t]:
                best[t], link[t] = got, e
        # walk back, all units at once
        ids, units, orders = [], [], []
        at, unit, step = first[1:] - 1, np.arange(len(start)), 0
        live = at > first[unit]
        at, unit = at[live], unit[live]
        while len(at):
            e = link[at]
            ids.append(e)
            units.append(unit)
            orders.append(np.full(len(e), step))
            step += 1
            at = source[e]
            live = at > first[unit]
            at, unit = at[live], unit[live]
        score = best[first[1:] - 1]
        if not ids:
            return np.zeros(0, np.int64), np.zeros(len(start), np.int64), np.zeros(len(start))
        e, unit, order = np.concatenate(ids), np.concatenate(units), np.concatenate(orders)
        sort = np.lexsort((-order, unit))
        e, unit = e[sort], unit[sort]
        pieces = piece[e]
        gone = pieces < 0  # unknown characters become their bytes
        width = np.where(gone, length[e], 1)
        out = np.repeat(pieces, width)
        within = np.arange(len(out)) - np.repeat(np.cumsum(width) - width, width)
        where = np.repeat(byte_at[who[e]], width) + within
        lost = np.repeat(gone, width)
        out[lost] = self.byte[data[where[lost]]]
        return out, np.bincount(np.repeat(unit, width), minlength=len(start)), score

    def encode(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, tokens of each row, score of each row), in runs of rows that cover the column."""
        raw, start, end = hashing.flat_bytes(column)
        size = end - start
        i = 0
        while i < len(size):
            j = i + max(1, int(np.searchsorted(np.cumsum(size[i:i + 100_000]), RUN, "right")))
            j = min(j, len(size))
            yield self._encode([raw[a:b] for a, b in zip(start[i:j], end[i:j], strict=True)])
            i = j

    def _encode(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        space = np.array([32], np.uint8)
        data = np.concatenate([x for t in texts for x in ((space, t) if len(t) else (t,))]) if texts else np.zeros(0, np.uint8)
        length = np.array([len(t) + (len(t) > 0) for t in texts], np.int64)
        bounds = np.concatenate([[0], np.cumsum(length)])
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64), np.zeros(len(texts))
        blank = data == 32
        cut = blank.copy()
        cut[1:] &= ~blank[:-1]
        cut[bounds[:-1][length > 0]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(data))
        h = hashing.hash_spans(data, start, end)
        _, one, unit = np.unique(h, return_index=True, return_inverse=True)
        back = hashing.hash_spans(data[::-1], len(data) - end, len(data) - start)
        if (back[one][unit] != back).any():
            one = unit = np.arange(len(start))  # two units share a hash: solve every unit by itself
        ids, n, score = self.solve(data, start[one], end[one])
        begin = np.cumsum(n) - n
        many = n[unit]
        flat = np.repeat(begin[unit], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        text = np.searchsorted(bounds, start, "right") - 1
        return ids[flat], np.bincount(text, many, len(texts)).astype(np.int64), np.bincount(text, score[unit], len(texts))

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[bytes]:
        """Texts of token rows: pieces one after the other, without the space put in front of the text."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.width)):
            raise ValueError("a token is not in the vocabulary")
        width = self.width[ids]
        flat = np.repeat(self.offset[ids], width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        data = self.bytes[flat].tobytes()
        ends = np.concatenate([[0], np.cumsum(width)])[np.concatenate([[0], np.cumsum(n)])]
        return [data[a + (data[a:a + 1] == b" " and b > a):b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _output(df: DataFrame, extra: str) -> tuple[T.StructType, pa.Schema, list[str]]:
    fields = T.StructType.fromDDL(extra).fields
    kept = [f for f in df.schema.fields if f.name not in {x.name for x in fields}]
    schema = T.StructType([*kept, *fields])
    return schema, to_arrow_schema(schema), [f.name for f in kept]


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", check: bool = False) -> DataFrame:
    """Add ``token_ids``, ``n_tokens``, ``n_byte_tokens`` and ``score``, the sum of the log scores of the best path.

    ``check`` adds ``round_trip``: decoding the tokens, in the same task, gives the text back.

    * An empty text has no tokens, a null text null ids and no tokens; both have score 0.
    * Ties go to the path whose last piece starts first, at every position.
    * Invalid UTF-8 and characters outside the vocabulary become byte pieces.
    * Columns with the new names are replaced, others are kept. An empty table stays empty.
    """
    extra = ", round_trip boolean" if check else ""
    schema, arrow, kept = _output(df, "token_ids array<int>, n_tokens long, n_byte_tokens long, score double" + extra)
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            column, row = batch.column(len(kept)), 0
            for ids, n, score in v.encode(column):
                part = batch.slice(row, len(n))
                gone = np.asarray(column.slice(row, len(n)).is_null())
                row += len(n)
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(offsets, mask=np.append(gone, False)) if gone.any() else pa.array(offsets), pa.array(ids.astype(np.int32)))
                sums = np.concatenate([[0], np.cumsum(v.is_byte[ids])])
                columns = [*part.columns[:-1], tokens, pa.array(n), pa.array(sums[offsets[1:]] - sums[offsets[:-1]]), pa.array(score)]
                if check:
                    raw, start, end = hashing.flat_bytes(part.column(len(kept)))
                    columns.append(pa.array([x == raw[a:b].tobytes() for x, a, b in zip(v.decode(ids, n), start, end, strict=True)]))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return df.select(*kept, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: Vocabulary, tokens: str = "token_ids", text: str = "decoded") -> DataFrame:
    """Add the text of token ids. Null ids give a null text, no ids the empty text; an unknown id is an error.

    Byte pieces that do not form UTF-8 are replaced by U+FFFD. Encoded texts come back exactly.
    """
    schema, arrow, kept = _output(df, f"`{text}` string")
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            column = batch.column(len(kept))
            n = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
            ids = np.asarray(column.flatten()).astype(np.int64)
            at, row = 0, 0
            while row < len(n):
                stop = row + max(1, int(np.searchsorted(np.cumsum(n[row:row + 100_000]), RUN // 4, "right")))
                stop = min(stop, len(n))
                m = int(n[row:stop].sum())
                texts = [x.decode("utf-8", "replace") for x in v.decode(ids[at:at + m], n[row:stop])]
                out = pa.array(texts, pa.string(), mask=np.asarray(column.slice(row, stop - row).is_null()))
                columns = [*batch.slice(row, stop - row).columns[:-1], out]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
                at, row = at + m, stop

    return df.select(*kept, F.col(tokens).alias("__ids")).mapInArrow(run, schema)
