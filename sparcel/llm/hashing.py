"""Words, word hashes and shingles of a batch of texts, on flat numpy arrays.

Everything works on the bytes of an Arrow string column, so a batch costs a few passes over its
bytes whatever its words are. Long batches go through in pieces of whole texts, and a long text in
pieces that end at white space, so memory follows the piece, plus eight bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 21
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_ODD = np.random.default_rng(20240229).integers(1 << 62, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, start and end offset of each value of a string or binary column; null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    offs = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    start, end = offs[:-1], offs[1:].copy()
    if column.null_count:
        gone = np.asarray(column.is_null())
        end[gone] = start[gone]
    return raw, start, end


def word_spans(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of the words in ``data``, the texts of these lengths one after the other."""
    solid = ~_SPACE[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    first = np.empty(len(data), bool)
    first[0] = True
    np.logical_not(solid[:-1], out=first[1:])
    first[bounds[:-1][lengths > 0]] = True
    start = np.flatnonzero(first & solid)
    last = np.empty(len(data), bool)
    last[-1] = True
    np.logical_not(solid[1:], out=last[:-1])
    last[bounds[1:][lengths > 0] - 1] = True
    end = np.flatnonzero(last & solid) + 1
    return start, end, np.searchsorted(bounds, start, "right") - 1


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, eight bytes a step."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    size = end - start
    h = mix(size.astype(np.uint64) * _ODD[0] + _ODD[1])
    todo = np.arange(len(start))
    step = 0
    while len(todo):
        at = start[todo] + 8 * step
        left = np.minimum(size[todo] - 8 * step, 8)
        h[todo] = mix((h[todo] ^ (eight[at] & _MASKS[left])) * _ODD[2])
        step += 1
        todo = todo[size[todo] > 8 * step]
        if step > 64 and len(todo):  # few and very long: one hash call each
            import xxhash

            for i in todo:
                h[i] ^= np.uint64(xxhash.xxh64_intdigest(data[start[i]:end[i]].tobytes()))
            break
    return h


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return _LOWER[data]


def pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row numbers, bytes, lengths) of the column, about PIECE bytes at a time; one text may be cut at white space.

    The pieces of a cut text follow each other, each with the row number of the text.
    """
    raw, start, end = flat_bytes(column)
    size = end - start
    i = 0
    while i < len(size):
        if size[i] > PIECE:
            at = start[i]
            while at < end[i]:
                stop = min(at + PIECE, end[i])
                if stop < end[i]:
                    blank = np.flatnonzero(_SPACE[raw[at:stop]])
                    if len(blank):
                        stop = at + blank[-1] + 1
                    else:  # no white space: up to the next one
                        while stop < end[i] and not (more := np.flatnonzero(_SPACE[raw[stop:min(stop + PIECE, end[i])]])).size:
                            stop = min(stop + PIECE, end[i])
                        if stop < end[i]:
                            stop += more[0] + 1
                yield np.array([i]), raw[at:stop], np.array([stop - at])
                at = stop
            i += 1
            continue
        j = int(np.searchsorted(np.cumsum(size[i:i + 1_000_000]), PIECE, "right")) + i
        j = max(i + 1, min(j, len(size)))
        block = size[i:j]
        if len(over := np.flatnonzero(block > PIECE)):
            j = i + int(over[0])
            block = size[i:j]
        if (start[i + 1:j] == end[i:j - 1]).all():
            data = raw[start[i]:end[j - 1]]
        else:
            data = np.concatenate([raw[a:b] for a, b in zip(start[i:j], end[i:j], strict=True)])
        yield np.arange(i, j), data, block
        i = j


def word_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashes of its words in order, A-Z lowered), for every row of a column."""
    held, held_row = [], -1
    for rows, data, lengths in pieces(column):
        data = lowered(data)
        start, end, text = word_spans(data, lengths)
        h = hash_spans(data, start, end)
        cut = np.searchsorted(text, np.arange(len(rows) + 1))
        for k, row in enumerate(rows):
            own = h[cut[k]:cut[k + 1]]
            if row == held_row:
                held.append(own)
                continue
            if held:
                yield held_row, np.concatenate(held) if len(held) > 1 else held[0]
            held, held_row = [own], int(row)
    if held:
        yield held_row, np.concatenate(held) if len(held) > 1 else held[0]


def shingles(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of runs of ``width`` words; of all words together if there are fewer."""
    n = len(words)
    if n == 0:
        return words
    if n < width:
        return mix((words * _ODD[8:8 + n]).sum(keepdims=True) + _ODD[32 + n:33 + n])
    total = words[:n - width + 1] * _ODD[8]
    for k in range(1, width):
        total += words[k:n - width + 1 + k] * _ODD[8 + k]
    return np.unique(mix(total))


def set_keys(members: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit keys of a set of hashes."""
    a = mix(members ^ _ODD[40]).sum(dtype=np.uint64)
    b = mix(members ^ _ODD[41]).sum(dtype=np.uint64)
    both = mix(np.array([a, b], np.uint64) + np.uint64(len(members))).view(np.int64)
    return int(both[0]), int(both[1])
