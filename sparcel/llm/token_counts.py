"""Token counts of fields or sections, from one encoding of the whole document.

Encoding sections one by one would cut tokens at their borders and count other tokens than training
sees. Here a document is encoded once, tokens keep their offsets, and the token spans are joined to
the section spans by interval. A token that crosses a border goes, as a whole, to one section by an
explicit rule (``RULES``), so the counts of a document add up to its number of tokens:

* ``largest``: the section with most of its bytes; a tie goes to the earlier section,
* ``first``: the section in which its first byte that is in any section stands,
* ``last``: the same with its last byte.

Tokens that touch no section are counted for section -1, "outside".
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sparcel.llm import hashing

RULES = ("largest", "first", "last")
OUTSIDE = -1
#: Rows of a result batch.
ROWS = 100_000

_encodings: dict[int, tuple] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a byte-level vocabulary file (read on the driver, a few MB)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _encoding(shared, pattern: str):
    """The encoder and the width of its tokens, built once for a broadcast in a worker."""
    key = id(shared.value)
    if key not in _encodings:
        import tiktoken

        ranks = shared.value
        width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            width[rank] = len(token)
        encoder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _encodings[key] = (encoder, width, ranks)  # with the ranks, so that their id stays theirs
    return _encodings[key][:2]


def line_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the lines of a text, without the line feeds."""
    feeds = np.flatnonzero(data == 10)
    return np.concatenate([[0], feeds + 1]), np.append(feeds, len(data))


def allocate(token_ends: np.ndarray, start: np.ndarray, end: np.ndarray, rule: str = "largest") -> tuple[np.ndarray, np.ndarray]:
    """(section of each token or OUTSIDE, whether it crosses a border of its section).

    Tokens follow each other from byte 0 to ``token_ends``; sections are sorted and do not overlap.
    """
    if rule not in RULES:
        raise ValueError(f"the rule is one of {RULES}")
    n = len(token_ends)
    a, b = np.concatenate([[0], token_ends])[:-1].astype(np.int64), token_ends
    full = np.flatnonzero(end > start)  # an empty section takes no byte
    s, e = start[full], end[full]
    first = np.searchsorted(e, a, "right")  # sections that meet [a, b): first <= i < last
    last = np.searchsorted(s, b, "left")
    many = np.maximum(last - first, 0)
    token = np.repeat(np.arange(n), many)
    which = np.repeat(first, many) + np.arange(len(token)) - np.repeat(np.cumsum(many) - many, many)
    share = np.minimum(b[token], e[which]) - np.maximum(a[token], s[which])
    if rule == "largest":
        order = np.lexsort((which, -share, token))
    else:
        order = np.lexsort((which if rule == "first" else -which, token))
    token, which, share = token[order], which[order], share[order]
    head = np.ones(len(token), bool)
    head[1:] = token[1:] != token[:-1]
    section, crosses = np.full(n, OUTSIDE, np.int64), np.zeros(n, bool)
    section[token[head]] = full[which[head]]
    crosses[token[head]] = share[head] < (b - a)[token[head]]
    return section, crosses


def disjoint(start: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans sorted by start, clipped to the text and to what earlier spans leave."""
    start, end = np.clip(start, 0, size), np.clip(end, 0, size)
    taken = np.maximum.accumulate(np.concatenate([[0], end]))[:-1] if len(end) else end
    start = np.maximum(start, taken)
    return start, np.maximum(end, start)


def section_tokens(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, doc_id: str = "doc_id", text: str = "text",
    sections: str | None = None, rule: str = "largest", splitter: Callable = line_spans,
) -> DataFrame:
    """(doc_id, section, name, start_char, end_char, n_tokens, n_crossing), one row per section.

    ``sections`` names a column of ``array<struct<name, start, end>>`` with character offsets; without
    it the sections are what ``splitter`` finds in the bytes, by default the lines.

    * Sections are numbered from 0 by start; a character in several belongs to the first of them, and
      offsets beyond the text are cut. Empty sections have no tokens. ``section`` -1 appears if
      tokens touch no section, with null offsets.
    * A null text, or null sections, give no rows; an empty text has one empty line.
    * Rows that repeat an id give rows of their own; null ids are carried along; other columns are
      ignored. An empty table gives no rows.
    """
    if rule not in RULES:
        raise ValueError(f"the rule is one of {RULES}")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    columns = [F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")]
    base = docs.select(*columns, *([F.col(sections).alias("sections")] if sections else []))
    schema = T.StructType([
        base.schema["doc_id"], *T.StructType.fromDDL("section int, name string, start_char int, end_char int, n_tokens int, n_crossing int").fields,
    ])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, width = _encoding(shared, pattern)
        for batch in batches:
            raw, begin, stop = hashing.flat_bytes(batch.column(1))
            gone = np.asarray(batch.column(1).is_null())
            given = batch.column(2) if sections else None
            out, held = [], 0
            for row in range(batch.num_rows):
                if gone[row] or (given is not None and not given[row].is_valid):
                    continue
                data = raw[begin[row]:stop[row]]
                ids = encoder.encode_ordinary(data.tobytes().decode("utf-8", "replace")) if len(data) else []
                token_ends = np.cumsum(width[ids]) if ids else np.zeros(0, np.int64)
                heads = np.flatnonzero((data & 0xC0) != 0x80)  # byte of each character
                names = None
                if given is None:
                    start, end = splitter(data)
                else:
                    rows = sorted(given[row].as_py(), key=lambda x: (x["start"] or 0, x["end"] or 0))
                    names = [x["name"] for x in rows]
                    edge = np.append(heads, len(data))
                    start, end = (edge[np.clip(np.array([x[k] or 0 for x in rows], np.int64), 0, len(heads))] for k in ("start", "end"))
                start, end = disjoint(start, end, len(data))
                section, crosses = allocate(token_ends, start, end, rule)
                n = len(start)
                counts = np.bincount(section + 1, minlength=n + 1)
                over = np.bincount(section[crosses] + 1, minlength=n + 1)
                skip = 0 if counts[0] else 1
                chars = np.searchsorted(heads, np.stack([start, end]), "left")
                out.append((
                    np.full(n + 1 - skip, row), np.arange(-1 + skip, n), [*[None] * (1 - skip), *(names or [None] * n)],
                    np.append(np.full(1 - skip, -1), chars[0]), np.append(np.full(1 - skip, -1), chars[1]), counts[skip:], over[skip:],
                ))
                held += n + 1
                if held >= ROWS:
                    yield _result(batch, out, arrow)
                    out, held = [], 0
            if out:
                yield _result(batch, out, arrow)

    return base.mapInArrow(run, schema)


def _result(batch: pa.RecordBatch, out: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    row, section, _, first, last, n, over = (np.concatenate(x) if k != 2 else None for k, x in enumerate(zip(*out, strict=True)))
    names = [x for part in out for x in part[2]]
    outside = section < 0
    columns = [
        batch.column(0).take(pa.array(row)), pa.array(section), pa.array(names, pa.string()),
        pa.array(first, mask=outside), pa.array(last, mask=outside), pa.array(n), pa.array(over),
    ]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def with_fields(df: DataFrame, fields: list[str], between: str = "\n", text: str = "text", sections: str = "sections") -> DataFrame:
    """Put ``fields`` into one text, in order, and add their spans; null fields are empty.

    The new columns replace ones of their name, after the fields have been read.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]
    at, spans = F.lit(0), []
    for name, part in zip(fields, parts, strict=True):
        end = at + F.char_length(part)
        spans.append(F.struct(F.lit(name).alias("name"), at.alias("start"), end.alias("end")))
        at = end + F.lit(len(between))
    kept = [c for c in df.columns if c not in (text, sections)]
    return df.select(*kept, F.concat_ws(between, *parts).alias(text), F.array(*spans).alias(sections))


def with_sections(docs: DataFrame, spans: DataFrame, doc_id: str = "doc_id", sections: str = "sections") -> DataFrame:
    """Add the spans of a table (doc_id, name, start, end) to their documents; documents without spans get none.

    A document's spans are gathered in one row, as its text is.
    """
    own = spans.groupBy(F.col(doc_id).alias("__doc")).agg(F.collect_list(F.struct("name", "start", "end")).alias("__spans"))
    kept = [c for c in docs.columns if c != sections]
    return docs.join(own, F.col(doc_id) == F.col("__doc"), "left").select(
        *kept, F.coalesce("__spans", F.array().cast("array<struct<name:string,start:int,end:int>>")).alias(sections)
    )
