"""Quality of documents by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

One pass over the texts computes facts of each document. Every rule turns a fact into a vote: good, bad, or
none. What a document's votes are is a number below 3 ** len(RULES), so the votes of the whole corpus are
a table of fixed greatest size: counts of the patterns, which Spark sums up. On that table
expectation-maximisation fits a latent class model: documents are good or bad, and given the class each
rule has its own chances of voting good, bad or not at all. That is how often a rule is right, and a rule
that hardly ever errs on one side outweighs many that say little. No label is used. A document is kept if
the posterior probability of being good reaches one half, and the base rules, which always hold, pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sparcel.llm import hashing
from sparcel.llm.common import stored

#: Words of a window; windows found twice in a text make their words repeated ones.
WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Fewest words of a document, and most repeated words in a hundred: beyond them it goes, whatever the rules say.
LEAST_WORDS, MOST_REPEATED = 20, 30

#: Facts of a text. Lines are those with a word; ``n_stops`` of them end in ``.!?``; ``n_ascii`` letters are ASCII ones.
FACTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper", "n_ascii", "n_stops", "n_distinct"]
#: (numerator, denominator, bad below, good from, good up to, bad above); None: no such bound. Between a good and
#: a bad bound, and where the denominator is 0, the rule abstains.
RULES = {
    "length": ("n_words", None, 20, 50, 100_000, None),
    "word_length": ("word_chars", "n_words", 3.0, 3.8, 7.5, 11.0),
    "symbols": ("n_symbols", "n_words", None, None, 0.02, 0.10),
    "same_lines": ("n_dup_lines", "n_lines", None, None, 0.10, 0.30),
    "same_words": ("n_repeat_words", "n_words", None, None, 0.05, 0.20),
    "letters": ("n_letters", "word_chars", 0.70, 0.90, None, None),
    "capitals": ("n_upper", "n_ascii", None, None, 0.20, 0.40),
    "stops": ("n_stops", "n_lines", 0.10, 0.60, None, None),
    "variety": ("n_distinct", "n_words", 0.10, 0.30, None, None),
}
#: Chances of (none, bad, good) that the fit starts from, by class, and the weight of this start in documents.
START, START_WEIGHT = {"good": (0.15, 0.05, 0.80), "bad": (0.25, 0.40, 0.35)}, 20.0
#: Share of good documents at the start; rounds at most, and the change of the log likelihood a document that ends them.
GOOD, ROUNDS, ENOUGH = 0.8, 200, 1e-9

_SPACE, _STOP, _SYMBOL, _UPPER, _ASCII = (np.zeros(256, bool) for _ in range(5))
_SPACE[list(hashing.SPACES)] = True
_STOP[[ord(c) for c in ".!?"]] = True
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_UPPER[65:91] = True
_ASCII[65:91] = _ASCII[97:123] = True
_BYTE = np.arange(256)
#: Bytes that count for a fact. Code points count by their first byte; letters are ASCII ones and all beyond ASCII.
_TABLES = {
    "word_chars": ~_SPACE & ((_BYTE & 0xC0) != 0x80), "n_symbols": _SYMBOL, "n_letters": _ASCII | (_BYTE >= 0xC0),
    "n_upper": _UPPER, "n_ascii": _ASCII,
}
_GLUE = np.random.default_rng(20250811).integers(1 << 62, 1 << 63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def repeated_words(words: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Words of each text that lie in a window which the text has twice; ``words``: hashes in order, ``text`` of each."""
    out = np.zeros(texts, np.int64)
    n = len(words) - WINDOW + 1
    if n < 2:
        return out
    total = words[:n] * _GLUE[0]
    for k in range(1, WINDOW):
        total += words[k:n + k] * _GLUE[k]
    start = np.flatnonzero(text[:n] == text[WINDOW - 1:])
    window, own = hashing.mix(total[start]), text[start]
    order = np.lexsort((window, own))
    same = (window[order][1:] == window[order][:-1]) & (own[order][1:] == own[order][:-1])
    twice = np.zeros(len(start), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start[twice], 1)
    np.add.at(edge, start[twice] + WINDOW, -1)
    return out + np.bincount(text[np.cumsum(edge[:-1]) > 0], minlength=texts)


def _distinct(value: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
    """Distinct values of each of the n groups."""
    order = np.lexsort((value, own))
    first = np.ones(len(order), bool)
    first[1:] = (value[order][1:] != value[order][:-1]) | (own[order][1:] != own[order][:-1])
    return np.bincount(own[order][first], minlength=n)


def _lines(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, whether it ends in a stop) of every line that has a word."""
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    breaks = np.flatnonzero(data == 10)
    text = np.searchsorted(bounds, breaks, "right") - 1
    own = np.sort(np.concatenate([np.arange(len(lengths)), text]))
    # a text of k newlines has k + 1 starts and as many ends, which pair up in order
    begin, end = (
        pos[np.lexsort((pos, of))] for pos, of in (
            (np.concatenate([bounds[:-1], breaks + 1]), np.concatenate([np.arange(len(lengths)), text])),
            (np.concatenate([bounds[1:], breaks]), np.concatenate([np.arange(len(lengths)), text])),
        )
    )
    solid = np.flatnonzero(~_SPACE[data])
    last = np.searchsorted(solid, end, "left") - 1
    worded = np.flatnonzero((last >= 0) & (solid[np.maximum(last, 0)] >= begin)) if len(solid) else np.zeros(0, np.int64)
    own, begin, end, last = own[worded], begin[worded], end[worded], last[worded]
    return own, hashing.hash_spans(data, begin, end), _STOP[data[solid[last]]] if len(solid) else np.zeros(0, bool)


def _line_parts(raw: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in parts of whole lines."""
    at = 0
    while at < len(raw):
        stop = min(at + hashing.PIECE, len(raw))
        if stop < len(raw):
            breaks = np.flatnonzero(raw[at:stop] == 10)
            while not len(breaks) and stop < len(raw):
                more = min(stop + hashing.PIECE, len(raw))
                breaks, stop = np.flatnonzero(raw[stop:more] == 10) + (stop - at), more
            stop = at + int(breaks[-1]) + 1 if len(breaks) else len(raw)
        yield raw[at:stop]
        at = stop


def text_facts(column: pa.Array) -> dict[str, np.ndarray]:
    """FACTS of every text of a column; null is a text without words."""
    n = len(column)
    facts = {name: np.zeros(n, np.int64) for name in FACTS}
    raw, first, end = hashing.flat_bytes(column)
    held: list[np.ndarray] = []
    done = 0

    def add_words(rows: np.ndarray, words: np.ndarray, own: np.ndarray) -> None:
        facts["n_words"][rows] = np.bincount(own, minlength=len(rows))
        facts["n_repeat_words"][rows] = repeated_words(words, own, len(rows))
        facts["n_distinct"][rows] = _distinct(words, own, len(rows))

    def add_lines(rows: np.ndarray, lines: list[tuple]) -> None:
        own, value, stop = (np.concatenate(x) for x in zip(*lines, strict=True))
        facts["n_lines"][rows] = np.bincount(own, minlength=len(rows))
        facts["n_dup_lines"][rows] = facts["n_lines"][rows] - _distinct(value, own, len(rows))
        facts["n_stops"][rows] = np.bincount(own[stop], minlength=len(rows))

    for rows, data, lengths in hashing.pieces(column):
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        for name, table in _TABLES.items():
            total = np.concatenate([[0], np.cumsum(table[data])])
            facts[name][rows] += total[bounds[1:]] - total[bounds[:-1]]
        begin, stop, own = hashing.word_spans(data, lengths)
        words = hashing.hash_spans(data, begin, stop)
        row = int(rows[0])
        if len(rows) == 1 and lengths[0] < end[row] - first[row]:  # a part of a long text
            held.append(words)
            done += int(lengths[0])
            if done == end[row] - first[row]:
                words = np.concatenate(held)
                add_words(rows, words, np.zeros(len(words), np.int64))
                add_lines(rows, [_lines(part, np.array([len(part)])) for part in _line_parts(raw[first[row]:end[row]])])
                held, done = [], 0
            continue
        add_words(rows, words, own)
        add_lines(rows, [_lines(data, lengths)])
    return facts


def _with_facts(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(..., text) -> (..., facts)."""
    for batch in batches:
        facts = text_facts(batch.column(batch.num_columns - 1))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(facts[name]) for name in FACTS)], schema=schema)


def document_facts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, FACTS) of every row of ``docs``."""
    rows = docs.select(F.col(doc_id).alias(doc_id), F.col(text).cast("string").alias("__text"))
    schema = T.StructType([rows.schema[0], *(T.StructField(name, T.LongType()) for name in FACTS)])
    arrow = pa.schema([pa.field(f.name, f.type, True) for f in to_arrow_schema(schema)])
    return rows.mapInArrow(lambda it: _with_facts(it, arrow), schema)


def vote(name: str) -> Column:
    """Vote of a rule on facts: 0 none, 1 bad, 2 good."""
    up, down, bad_below, good_from, good_to, bad_above = RULES[name]
    value = F.col(up).cast("double")
    if down is not None:
        value = F.when(F.col(down) > 0, value / F.col(down))
    bad, good = F.lit(False), F.lit(True)
    if bad_below is not None:
        bad = bad | (value < bad_below)
    if bad_above is not None:
        bad = bad | (value > bad_above)
    if good_from is not None:
        good = good & (value >= good_from)
    if good_to is not None:
        good = good & (value <= good_to)
    return F.when(value.isNull(), 0).when(bad, 1).when(good, 2).otherwise(0)


def pattern() -> Column:
    """All votes as one number, a digit of base 3 each."""
    total = F.lit(0)
    for name in RULES:
        total = total * 3 + vote(name)
    return total


def votes_of(patterns: np.ndarray) -> np.ndarray:
    """(patterns x rules) votes."""
    return (patterns[:, None] // 3 ** np.arange(len(RULES) - 1, -1, -1)) % 3


def fit_votes(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log odds good : bad, as an array (rules + 1) x 3: of every vote, and in the last row of the classes.

    Expectation-maximisation on ``counts`` documents of each pattern. The start is part of every
    estimate with the weight of START_WEIGHT documents, so chances stay within (0, 1), and no documents give
    the start itself.
    """
    votes = votes_of(patterns)
    chance = np.array([[START[c]] * len(RULES) for c in ("good", "bad")])  # class x rule x vote
    start, share = START_WEIGHT * chance, np.array([GOOD, 1 - GOOD])
    rule = np.arange(len(RULES))
    before, total = -np.inf, counts.sum()
    for _ in range(ROUNDS if total else 0):
        log = np.log(share)[:, None] + np.log(chance)[:, rule, votes].sum(2)
        top = log.max(0)
        both = top + np.log(np.exp(log - top).sum(0))
        weight = np.exp(log - both) * counts
        for v in range(3):
            chance[:, :, v] = start[:, :, v] + weight @ (votes == v)
        chance /= chance.sum(2, keepdims=True)
        share = weight.sum(1) + START_WEIGHT * np.array([GOOD, 1 - GOOD])
        share /= share.sum()
        now = float((both * counts).sum()) / total
        if abs(now - before) < ENOUGH:
            break
        before = now
    odds = np.log(chance[0]) - np.log(chance[1])
    if odds[:, 2].sum() < odds[:, 1].sum():  # good is the class that rules call good
        odds, share = -odds, share[::-1]
    return np.vstack([odds, np.full(3, np.log(share[0]) - np.log(share[1]))])


def fit(facts: DataFrame) -> np.ndarray:
    """``fit_votes`` on the votes of all rows of ``facts``; what comes to the driver are counts of patterns."""
    rows = facts.select(pattern().alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()
    return fit_votes(np.array([r["pattern"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.float64))


def quality(odds: np.ndarray) -> Column:
    """Posterior probability of being good, of a row of facts."""
    total = F.lit(float(odds[-1, 0]))
    for name, own in zip(RULES, odds, strict=False):
        v = vote(name)
        total = total + F.when(v == 0, float(own[0])).when(v == 1, float(own[1])).otherwise(float(own[2]))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def grade(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, FACTS, quality, base_failed, kept) of every row of ``docs``.

    Words are runs of anything but white space (space, tab to carriage return). ``word_chars`` are their
    code points, ``n_symbols`` characters of SYMBOLS, ``n_dup_lines`` lines with a word that are equal to an
    earlier line, ``n_repeat_words`` words in windows of 8 words that the text has twice or more.
    ``base_failed``: fewer than 20 words, or more than 30 % of them repeated. ``quality`` is the posterior
    probability that a document is good, ``kept`` that it is at least one half and the base rules hold.

    * Null, empty and blank texts have no words: they fail. Rules whose share has no denominator abstain.
    * Rows that repeat an id count as documents of their own; a null id stays. Other columns are ignored.
    * An empty table gives no rows. Words, lines and windows are compared by 64-bit hashes.
    """
    facts = stored(document_facts(docs, doc_id, text), "facts")
    odds = fit(facts)
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    return facts.select(doc_id, *FACTS, quality(odds).alias("quality"), failed.alias("base_failed")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)
    )
