import zlib

import numpy as np
import pyarrow as pa
import pytest

from sparcel.llm import langid
from sparcel.llm.queries import QUERIES


def test_gradients_are_the_derivatives():
    net = langid.Network(["a", "b", "c"], hidden=3, seed=2)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (7, 5)).astype(np.uint8)
    real = rng.random((7, 5)) < 0.8
    y = rng.integers(0, 3, 5)
    _, grad = net.gradients(x, real, y)
    for name, w in net.w.items():
        for i in rng.choice(w.size, min(6, w.size), replace=False):
            at = np.unravel_index(i, w.shape)
            if name.endswith("x"):
                at = (at[0], x[rng.integers(7), rng.integers(5)])
            old, eps = w[at], 1e-2
            w[at] = old + eps
            up = net.gradients(x, real, y)[0]
            w[at] = old - eps
            down = net.gradients(x, real, y)[0]
            w[at] = old
            assert abs((up - down) / (2 * eps) - grad[name][at]) < 2e-3, name


def test_states_do_not_depend_on_the_block(monkeypatch):
    net = langid.Network(["a", "b"])
    texts = pa.array(["some text " * 300, "", None, "x", "é" * 97, "12 34"], pa.string())
    one = net.classify(texts)
    monkeypatch.setattr(langid, "BLOCK", 3)
    two = net.classify(texts)
    assert (one[0] == two[0]).all() and np.allclose(one[1], two[1], atol=1e-5)
    assert one[0].tolist()[1:3] == [-1, -1] and one[0][5] == -1


@pytest.fixture(scope="module")
def predicted(spark, data):
    return QUERIES["op6_recurrent_language"](spark, data).toPandas(), spark.read.parquet(f"{data}/documents.parquet").toPandas()


def test_held_out_accuracy(predicted):
    out, docs = predicted
    assert sorted(out["doc_id"]) == sorted(docs["doc_id"])
    both = out.merge(docs, on="doc_id")
    assert (both["held_out"] == [zlib.crc32(str(d).encode()) % 3 == 1 for d in both["doc_id"]]).all()
    held = both[both["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.95
    assert both["score"].between(0, 1).all()


def test_odd_rows(spark):
    rows = [(i, "the quick brown fox and the dog", "en", 0) for i in range(40)] + [(100 + i, "der schnelle braune fuchs und die katze", "de", 0) for i in range(40)]
    rows += [(200, None, "en", 0), (201, "", None, 0), (202, "12 --", "de", 0), (None, "the dog", "en", 0), (203, "日本", None, 0), (203, "the fox " * 20_000, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    net = langid.fit(docs)
    assert net.labels == ["de", "en"]
    out = langid.identify(docs, net)
    assert out.columns == ["doc_id", "text", "lang", "held_out", "lang_pred", "score"]
    got = [(r.doc_id, r.lang_pred, r.score) for r in out.collect()]
    assert len(got) == len(rows)
    assert [g for g in got if g[0] in (200, 201, 202)] == [(200, "und", 0.0), (201, "und", 0.0), (202, "und", 0.0)]
    assert all(lang != "und" for d, lang, _ in got if d is None or d == 203)
    assert ("en" in [lang for d, lang, _ in got if d == 203])
    blank = docs.where("doc_id = 202")
    assert langid.identify(docs, langid.fit(blank)).where("lang_pred <> 'und'").count() == 0
    assert langid.identify(docs.limit(0), net).count() == 0


def plain_gru(net, text):
    """The network byte by byte, in plain Python numbers: (label, mean probability over the bytes of letters)."""
    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    h, total, n = net.hidden, np.zeros(len(net.labels)), 0
    data = text.encode()
    for at in range(0, len(data), langid.SEGMENT):
        cut = data[at:at + langid.SEGMENT]
        cut += bytes([32]) * (langid.SEGMENT - len(cut))
        states = {}
        for d in "fb":
            w = {k: net.w[d + k].astype(float) for k in "xuac"}
            state = np.zeros(h)
            places = range(len(cut)) if d == "f" else reversed(range(len(cut)))
            for t in places:
                a = w["x"][:, cut[t]] + w["a"][:, 0]
                g = w["u"] @ state
                z, r = sigmoid(a[:h] + g[:h]), sigmoid(a[h:2 * h] + g[h:2 * h])
                new = np.tanh(a[2 * h:] + r * (g[2 * h:] + w["c"][:, 0]))
                state = (1 - z) * new + z * state
                states[d, t] = state
        for t, byte in enumerate(cut[:len(data) - at]):
            if chr(byte).isalpha() and byte < 128 or byte >= 128:
                logits = net.w["fv"].astype(float) @ states["f", t] + net.w["bv"].astype(float) @ states["b", t] + net.w["o"][:, 0]
                p = np.exp(logits - logits.max())
                total += p / p.sum()
                n += 1
    return (int(total.argmax()), total.max() / n) if n else (-1, 0.0)


def test_against_a_plain_network():
    net = langid.Network(["a", "b", "c"], seed=7)
    texts = ["some words, and more of them " * 9, "Größe und Maß", "x", "12 34", "", "été " * 60]
    best, share = net.classify(pa.array(texts))
    for text, b, s in zip(texts, best.tolist(), share.tolist(), strict=True):
        want = plain_gru(net, text)
        assert b == want[0] and abs(s - want[1]) < 1e-4


def test_equal_probabilities_go_to_the_first_label():
    net = langid.Network(["a", "b"])
    for name in ("fv", "bv"):
        net.w[name][1] = net.w[name][0]
    best, share = net.classify(pa.array(["word"]))
    assert best.tolist() == [0] and abs(share[0] - 0.5) < 1e-6


def test_any_number_of_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "TOTAL", 500)
    rows = [(i, f"text of language number {i % 250} and so on", f"l{i % 250:03d}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = langid.sample(docs, "doc_id", "text", "lang")
    labels = {r[0] for r in drawn}
    assert 120 < len(labels) <= 250 and 200 < len(drawn) / langid.WINDOWS < 900
