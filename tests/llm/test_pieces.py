import math
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparcel.llm import pieces
from sparcel.llm.queries import TOKENIZERS


def small(seed=0, n=60):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcé ") for _ in range(rng.randrange(1, 5))) for _ in range(n)}
    words = {w.lstrip(" ") and " " * (len(w) - len(w.lstrip(" "))) + w.strip(" ").replace(" ", "") or w for w in words}
    rows = [(b"<unk>", 0.0, "other")] + [(bytes([i]), 0.0, "byte") for i in range(256)]
    return pieces.Vocabulary(rows + [(w.encode(), -rng.randrange(1, 40) / 4, "normal") for w in sorted(words)])


def brute(v, table, text):
    """Best score of a text by plain dynamic programming over its characters."""
    if not text:
        return 0.0
    s = " " + text
    best = [0.0] + [-math.inf] * len(s)
    for i in range(len(s)):
        single = False
        for j in range(i + 1, min(len(s), i + 20) + 1):
            if (p := table.get(s[i:j].encode())) is not None:
                single |= j == i + 1
                best[j] = max(best[j], best[i] + p)
        if not single:
            best[i + 1] = max(best[i + 1], best[i] + v.unknown_score)
    return best[-1]


def encoded(v, texts):
    out = []
    for ids, n, score in v.encode(pa.array(texts, pa.string())):
        ends = np.cumsum(n)
        out += [(ids[e - k:e], s) for e, k, s in zip(ends, n, score, strict=True)]
    return out


def scores(v):
    return {v.bytes[v.offset[i]:v.offset[i + 1]].tobytes(): v.score[i] for i in range(257, len(v.width))}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 5), st.lists(st.text(alphabet="abcé zß\n▁", max_size=40), max_size=8))
def test_best_path_and_round_trip(seed, texts):
    v = small(seed)
    table = scores(v)
    for text, (ids, score) in zip(texts, encoded(v, texts), strict=True):
        assert abs(score - brute(v, table, text)) < 1e-6
        assert v.decode(ids, np.array([len(ids)]))[0].decode() == text


def test_long_units_are_alike(monkeypatch):
    v = small(3)
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcé") for _ in range(n)) for n in (390, 401, 5000)] + ["a" * 100_000, "z" * 1000]
    one = encoded(v, texts)
    monkeypatch.setattr(pieces, "LONG_UNIT", 10**9)
    for (a, s), (b, t), text in zip(one, encoded(v, texts), texts, strict=True):
        assert list(a) == list(b) and abs(s - t) < 1e-6
        assert v.decode(a, np.array([len(a)]))[0].decode() == text


def test_trie_finds_every_key():
    keys = {bytes([i, j]): i * 7 + j for i in range(0, 256, 5) for j in range(i % 3, 256, 3)} | {b"\x00": 9000, b"\xff\xff\xff": 9001}
    trie = pieces.DoubleArray(keys)
    for key, value in keys.items():
        data = np.frombuffer(key + b"\x01\x02", np.uint8)
        _, end, found = trie.matches(data, np.array([0]), np.array([len(data)]))
        want = sorted((len(k), v) for k, v in keys.items() if data.tobytes().startswith(k))
        assert sorted(zip(end.tolist(), found.tolist(), strict=True)) == want
        assert (len(key), value) in want


def test_public_vocabulary(spark):
    v = pieces.Vocabulary.read(f"{TOKENIZERS}/piece_bpe_32k.model")
    texts = ["Hello world", "", None, "  two  spaces ", "tab\tline\r\n", "日本 ﬁ 🙂 \x00", "▁ marker", "word " * 5000, "Hello world"]
    df = spark.createDataFrame([(i, t, "x", 1.0) for i, t in enumerate(texts)], "id int, text string, decoded string, score double")
    out = pieces.decode(pieces.encode(df, v), v)
    assert out.columns == ["id", "text", "token_ids", "n_tokens", "n_byte_tokens", "score", "decoded"]
    rows = {r.id: r for r in out.collect()}
    for i, t in enumerate(texts):
        assert rows[i].decoded == t
        assert (rows[i].token_ids is None) == (t is None) and rows[i].n_tokens == len(rows[i].token_ids or [])
    assert rows[0].token_ids == rows[8].token_ids and rows[1].token_ids == []
    table = scores(v)
    assert abs(rows[0].score - brute(v, table, texts[0])) < 1e-6
    assert pieces.encode(df.limit(0), v).count() == 0
    checked = pieces.encode(df, v, check=True)
    assert checked.columns == ["id", "text", "decoded", "token_ids", "n_tokens", "n_byte_tokens", "score", "round_trip"]
    assert all(r.round_trip and r.token_ids == rows[r.id].token_ids for r in checked.collect())


def test_refused():
    with pytest.raises(ValueError, match="white space"):
        pieces.Vocabulary([(bytes([i]), 0.0, "byte") for i in range(256)] + [(b"a b", -1.0, "normal")])
    with pytest.raises(ValueError, match="not in the vocabulary"):
        small().decode(np.array([10**6]), np.array([1]))
