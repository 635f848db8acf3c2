"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads segments of a text forwards and backwards, gives every byte a probability for each
language, and a document the mean over its letters. It is trained here, in numpy, by backpropagation
through time on a bounded sample of labelled documents (``DOCS`` per language, ``WINDOWS`` segments
of each). Every byte of every document is then labelled, in batches of segments inside one map over
the table: nothing is shuffled, and memory does not depend on the length of a text.
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

SEGMENT = 96
HIDDEN = 8
#: Bounds of the sample that the driver trains on: documents per language (about), segments of each, and documents in all:
#: with more than TOTAL / DOCS languages there are fewer documents of each.
DOCS, WINDOWS, TOTAL = 400, 4, 80_000
UPDATES, BATCH, RATE = 420, 128, 0.015
#: Segments that are labelled at once.
BLOCK = 2048
UNDETERMINED = "und"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_SPACE_BYTE = 32  # fills up the last segment of a text


def held_out(doc_id: Column) -> Column:
    """Documents kept from training: CRC-32 of the id as text leaves 1 modulo 3. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def segments(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text numbers, bytes (SEGMENT x n), bytes that are text) for all segments of the texts, BLOCK at a time."""
    many = -(-size // SEGMENT)
    owner = np.repeat(np.arange(len(size)), many)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    for i in range(0, len(owner), BLOCK):
        text = owner[i:i + BLOCK]
        at = within[i:i + BLOCK] * SEGMENT + np.arange(SEGMENT)[:, None]
        real = at < size[text]
        x = np.where(real, raw[np.where(real, start[text] + at, 0)], _SPACE_BYTE).astype(np.uint8)
        yield text, x, real


class Network:
    """Weights of both directions and of the output; ``labels`` are the languages in order."""

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 6):
        rng = np.random.default_rng(seed)
        self.labels, h, c = labels, hidden, len(labels)
        self.hidden = h

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.w = {}
        for d in "fb":
            self.w[d + "x"] = normal(3 * h, 256, scale=0.3)
            self.w[d + "u"] = normal(3 * h, h, scale=h ** -0.5)
            self.w[d + "a"] = np.zeros((3 * h, 1), np.float32)
            self.w[d + "c"] = np.zeros((h, 1), np.float32)
            self.w[d + "v"] = normal(c, h, scale=h ** -0.5)
        self.w["o"] = np.zeros((c, 1), np.float32)

    def _states(self, d: str, x: np.ndarray, keep: bool):
        """Hidden states (steps, hidden, n) of one direction, and what training needs of each step."""
        h, steps = self.hidden, range(len(x))
        wx, u, c = self.w[d + "x"] + self.w[d + "a"], self.w[d + "u"], self.w[d + "c"]
        state = np.zeros((h, x.shape[1]), np.float32)
        states, saved = np.empty((len(x), h, x.shape[1]), np.float32), {}
        for t in steps if d == "f" else reversed(steps):
            a, g = np.take(wx, x[t], axis=1), u @ state
            gate = a[:2 * h]
            gate += g[:2 * h]
            gate *= 0.5
            np.tanh(gate, out=gate)
            gate += 1
            gate *= 0.5
            z, r = gate[:h], gate[h:]
            un = g[2 * h:]
            un += c
            n = a[2 * h:]
            n += r * un
            np.tanh(n, out=n)
            if keep:
                saved[t] = (state, z, r, n, un)
            state = state - n
            state *= z
            state += n
            states[t] = state
        return states, saved

    def _probabilities(self, hf, hb):
        logits = self.w["fv"] @ hf + self.w["bv"] @ hb + self.w["o"]
        logits -= logits.max(1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(1, keepdims=True)
        return logits

    def label(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (steps, languages, n) of every position of segments ``x`` (steps, n)."""
        return self._probabilities(self._states("f", x, False)[0], self._states("b", x, False)[0])

    def gradients(self, x: np.ndarray, real: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over the positions that are text, and its derivatives."""
        h = self.hidden
        hf, sf = self._states("f", x, True)
        hb, sb = self._states("b", x, True)
        p = self._probabilities(hf, hb)
        n = max(1, real.sum())
        at = np.arange(x.shape[1])
        loss = -(np.log(p[:, y, at] + 1e-9) * real).sum() / n
        p[:, y, at] -= 1
        p *= (real / n)[:, None, :].astype(np.float32)
        grad = {"o": p.sum((0, 2))[:, None]}
        for d, states, saved in (("f", hf, sf), ("b", hb, sb)):
            g = {k: np.zeros_like(self.w[d + k]) for k in "xuac"}
            grad[d + "v"] = np.einsum("tcn,thn->ch", p, states, optimize=True)
            into = self.w[d + "v"].T @ p
            u, dh = self.w[d + "u"], np.zeros_like(states[0])
            steps = range(len(x))
            for t in reversed(steps) if d == "f" else steps:
                prev, z, r, c, un = saved[t]
                dh = dh + into[t]
                dan = dh * (1 - z) * (1 - c * c)
                daz = dh * (prev - c) * z * (1 - z)
                dar = dan * un * r * (1 - r)
                da = np.concatenate([daz, dar, dan])
                du = np.concatenate([daz, dar, dan * r])
                hot = np.zeros((x.shape[1], 256), np.float32)
                hot[at, x[t]] = 1
                g["x"] += da @ hot
                g["a"] += da.sum(1, keepdims=True)
                g["u"] += du @ prev.T
                g["c"] += du[2 * h:].sum(1, keepdims=True)
                dh = dh * z + u.T @ du
            grad |= {d + k: v for k, v in g.items()}
        return float(loss), grad

    def train(self, x: np.ndarray, real: np.ndarray, y: np.ndarray, updates: int = UPDATES, seed: int = 1) -> list[float]:
        """Adam over shuffled batches, about as many updates for any sample; returns the mean loss of each epoch."""
        epochs = -(-updates // -(-len(y) // BATCH))
        rng, step, losses = np.random.default_rng(seed), 0, []
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        s = {k: np.zeros_like(v) for k, v in self.w.items()}
        for epoch in range(epochs):
            order, total = rng.permutation(len(y)), []
            rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for i in range(0, len(order), BATCH):
                b = order[i:i + BATCH]
                loss, grad = self.gradients(x[:, b], real[:, b], y[b])
                total.append(loss)
                norm = np.sqrt(sum(float((v ** 2).sum()) for v in grad.values()))
                clip, step = min(1.0, 1.0 / (norm + 1e-9)), step + 1
                for k, v in grad.items():
                    v = v * clip
                    m[k] = 0.9 * m[k] + 0.1 * v
                    s[k] = 0.99 * s[k] + 0.01 * v * v
                    self.w[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
            losses.append(float(np.mean(total)))
        return losses

    def classify(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(language number, pooled probability) of each text; -1 and 0 where no byte is of a letter."""
        if not self.labels:
            return np.full(len(column), -1), np.zeros(len(column))
        raw, start, end = hashing.flat_bytes(column)
        total, n = np.zeros((len(start), len(self.labels))), np.zeros(len(start))
        for text, x, real in segments(raw, start, end - start):
            letters = real & _LETTER[x]
            p = (self.label(x) * letters[:, None, :]).sum(0)
            for k in range(len(self.labels)):
                total[:, k] += np.bincount(text, p[k], len(start))
            n += np.bincount(text, letters.sum(0), len(start))
        share = total / np.maximum(n, 1)[:, None]
        best = share.argmax(1)
        return np.where(n > 0, best, -1), np.where(n > 0, np.clip(share.max(1), 0, 1), 0.0)


def sample(docs: DataFrame, doc_id: str, text: str, lang: str, per_language: int = DOCS) -> list[tuple[str, bytes]]:
    """About ``per_language`` documents of each language, picked by a hash of the id; WINDOWS spread segments of each."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}") & ~held_out(F.col(doc_id)))
    counts = stored(known.groupBy(F.col(lang).alias("__lang")).agg(F.count(F.lit(1)).alias("__n")), "languages")
    labels = counts.count()
    if not labels:
        return []
    share = min(float(per_language), TOTAL / labels)
    draw = (F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    chance = F.least(F.lit(1.0), F.lit(share) / F.col("__n"))
    data = F.encode(F.col(text), "utf-8")
    step = F.greatest((F.octet_length(F.col(text)) / F.lit(float(WINDOWS))).cast("int"), F.lit(1))
    cuts = F.array(*[F.substring(data, step * i + 1, F.lit(SEGMENT)) for i in range(WINDOWS)])
    # the documents stay where they are, whatever their languages
    drawn = known.join(F.broadcast(counts) if labels <= TOTAL else counts, F.col(lang) == F.col("__lang")).where(draw < chance)
    rows = drawn.select(F.col(lang), F.explode(cuts).alias("cut"), F.xxhash64(F.col(doc_id).cast("string")).alias("h"))
    bound = 4 * WINDOWS * (int(share * labels) + 1)
    return [(r[0], bytes(r[1])) for r in sorted(rows.limit(bound).collect(), key=lambda r: (r[0], r[2], r[1])) if r[1]]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Network:
    """Train on the documents that are not held out and have a language."""
    rows = sample(docs, doc_id, text, lang)
    labels = sorted({r[0] for r in rows})
    network = Network(labels)
    if len(labels) > 1:
        x = np.full((SEGMENT, len(rows)), _SPACE_BYTE, np.uint8)
        real = np.zeros((SEGMENT, len(rows)), bool)
        for i, (_, cut) in enumerate(rows):
            x[:len(cut), i] = np.frombuffer(cut, np.uint8)
            real[:len(cut), i] = True
        network.train(x, real, np.array([labels.index(r[0]) for r in rows]))
    return network


def identify(
    docs: DataFrame, network: Network, doc_id: str = "doc_id", text: str = "text",
    predicted: str = "lang_pred", score: str = "score",
) -> DataFrame:
    """Add ``held_out``, the language and its pooled probability; only ``text`` is looked at.

    * Null texts and texts without a letter are ``und`` with score 0. Short texts are labelled like any other.
    * If nothing could be learned, every text is ``und``; with one language, that is the answer.
    * Equal probabilities go to the language that sorts first. Equal texts get equal answers.
    * Columns with the new names are replaced, others are kept. An empty table stays empty.
    """
    new = [T.StructField("held_out", T.BooleanType()), T.StructField(predicted, T.StringType()), T.StructField(score, T.DoubleType())]
    kept = [f for f in docs.schema.fields if f.name not in {x.name for x in new}]
    schema = T.StructType([*kept, *new])
    arrow = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(network)
    names = [f.name for f in kept]
    prepared = docs.select(
        *names, held_out(F.col(doc_id)).alias("__held"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("__letter"),
        F.col(text).cast("string").alias("__text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            k = len(names)
            best, share = net.classify(batch.column(k + 2))
            lost = ~np.asarray(batch.column(k + 1)) | (best < 0)
            labels = pa.array([UNDETERMINED if a else net.labels[b] for a, b in zip(lost, best, strict=True)], pa.string())
            columns = [*batch.columns[:k], batch.column(k), labels, pa.array(np.where(lost, 0.0, share))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return prepared.mapInArrow(run, schema)
