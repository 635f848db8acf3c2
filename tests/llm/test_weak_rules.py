import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sparcel.llm import weak_rules
from sparcel.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_facts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    letters = [c for c in text if c.isascii() and c.isalpha()]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_letters": len(letters) + sum(not c.isascii() for c in text), "n_upper": sum(c.isupper() for c in letters),
        "n_ascii": len(letters), "n_stops": sum(WORD.findall(x)[-1][-1] in ".!?" for x in lines), "n_distinct": len(set(words)),
    }


def check_facts(texts, kind=None):
    found = weak_rules.text_facts(pa.array(texts, kind or pa.string()))
    for i, text in enumerate(texts):
        assert {k: int(v[i]) for k, v in found.items()} == plain_facts(text), repr(text)[:80]


TEXTS = [
    None, "", " \n\t ", "\n\none\n\n", "a", "a b c d e f g h", "a b c d e f g h a b c d e f g h i", "x " * 9, "x " * 8, "\nx\n", "x\n",
    "same line.\nsame line.\n same line.\nother!\nsame line.", "É é # | <b> 100%\rSo? \x0b", "ÀÉ. Ü!\n\n日本語。 x", "A. \n b\t\nc!",
]


def test_facts():
    rng = random.Random(1)
    words = ["one", "two", "three.", "É", "#", "X!", "\n", "\n\n", " \t"]
    texts = TEXTS + [" ".join(rng.choices(words[:rng.randrange(2, 10)], k=rng.randrange(0, 60))) for _ in range(300)]
    check_facts(texts)
    check_facts(texts[3:], pa.large_string())
    sliced = weak_rules.text_facts(pa.array(texts)[5:40])
    assert sliced["n_words"].tolist() == [plain_facts(t)["n_words"] for t in texts[5:40]]


def test_long_texts(monkeypatch):
    monkeypatch.setattr(weak_rules.hashing, "PIECE", 64)
    rng = random.Random(2)
    words = ["one", "two", "three.", "É", "#", "X!", "\n", "\n\n", " \t", "l" * 150]
    check_facts(TEXTS + [" ".join(rng.choices(words, k=rng.randrange(0, 200))) for _ in range(80)] + ["w" * 500, "w " * 400, "\n" * 200])


def plain_fit(votes, rounds):
    """The same estimates, document by document."""
    chance = {c: [list(weak_rules.START[c]) for _ in weak_rules.RULES] for c in ("good", "bad")}
    share = {"good": weak_rules.GOOD, "bad": 1 - weak_rules.GOOD}
    for _ in range(rounds):
        weights = []
        for vote in votes:
            p = {c: share[c] * np.prod([chance[c][r][v] for r, v in enumerate(vote)]) for c in chance}
            weights.append({c: p[c] / sum(p.values()) for c in p})
        for c in chance:
            for r in range(len(weak_rules.RULES)):
                sums = [20 * weak_rules.START[c][v] + sum(w[c] for w, vote in zip(weights, votes, strict=True) if vote[r] == v) for v in range(3)]
                chance[c][r] = [x / sum(sums) for x in sums]
        sums = {c: 20 * (0.8 if c == "good" else 0.2) + sum(w[c] for w in weights) for c in chance}
        share = {c: sums[c] / sum(sums.values()) for c in sums}
    odds = [[np.log(chance["good"][r][v] / chance["bad"][r][v]) for v in range(3)] for r in range(len(weak_rules.RULES))]
    return np.array([*odds, [np.log(share["good"] / share["bad"])] * 3])


def test_fit_against_a_plain_one(monkeypatch):
    monkeypatch.setattr(weak_rules, "ROUNDS", 12)
    monkeypatch.setattr(weak_rules, "ENOUGH", 0)
    rng = random.Random(3)
    good = [[rng.choices((0, 1, 2), (10, 3, 87))[0] for _ in weak_rules.RULES] for _ in range(150)]
    bad = [[rng.choices((0, 1, 2), (20, 50, 30))[0] for _ in weak_rules.RULES] for _ in range(40)]
    votes = good + bad
    numbers, counts = np.unique([int("".join(map(str, v)), 3) for v in votes], return_counts=True)
    assert (weak_rules.votes_of(numbers) < 3).all()
    assert np.allclose(weak_rules.fit_votes(numbers, counts.astype(float)), plain_fit(votes, 12))


def test_accuracies_are_found():
    rng = np.random.default_rng(4)
    n, rules = 40_000, len(weak_rules.RULES)
    good = rng.random(n) < 0.85
    right = np.linspace(0.98, 0.6, rules)
    votes = np.where(rng.random((n, rules)) < right, np.where(good, 2, 1)[:, None], np.where(good, 1, 2)[:, None])
    votes[rng.random((n, rules)) < 0.2] = 0
    numbers, counts = np.unique((votes * 3 ** np.arange(rules - 1, -1, -1)).sum(1), return_counts=True)
    odds = weak_rules.fit_votes(numbers, counts.astype(float))
    assert np.abs(odds[:-1, 2] - np.log(right / (1 - right))).max() < 0.4
    score = odds[-1, 0] + odds[np.arange(rules), votes].sum(1)
    assert ((score >= 0) == good).mean() > 0.985


@pytest.mark.parametrize("empty", [False, True])
def test_edges(spark, empty):
    rows = [] if empty else [(t, i % 7 or None, 3, True) for i, t in enumerate(TEXTS + ["Good words make a fine text, all in all. " * 2] * 2)]
    df = spark.createDataFrame(rows, "text string, doc_id long, n_words int, kept boolean")
    found = weak_rules.grade(df)
    assert found.columns == ["doc_id", *weak_rules.FACTS, "quality", "base_failed", "kept"]
    got = sorted((repr(r.doc_id), r.n_words, r.n_repeat_words, r.base_failed) for r in found.collect())
    want = []
    for t, d, _, _ in rows:
        f = plain_facts(t)
        want.append((repr(d), f["n_words"], f["n_repeat_words"], f["n_words"] < 20 or 100 * f["n_repeat_words"] > 30 * f["n_words"]))
    assert got == sorted(want)


def test_verdict_against_labels(spark, data):
    docs, labels = table(spark, data.replace("sf0.001", "sf0.01"), "documents"), table(spark, data.replace("sf0.001", "sf0.01"), "labels")
    rows = weak_rules.grade(docs).join(labels, "doc_id").where("NOT base_failed").collect()
    good = [r.kept for r in rows if r[-2] == 1]
    bad = [r.kept for r in rows if r[-2] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1
