import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sparcel.llm import treap_index

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, length = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    out = []
    for item, text in set(items):
        found = []
        for d, c in counts:
            m = 50 + (50 * sum(c.values()) * n_docs) // length if length else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 20 * m))
                for w in set(terms(text)) if w in c
            )
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def run(spark, docs, items, k=50):
    d = spark.createDataFrame([(t, i, "x", 5) for i, t in docs], "text string, doc_id long, rank string, score int")
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    found = treap_index.search(treap_index.build_index(d), q, k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted([tuple(r) for r in found.collect()], key=repr)


def corpus(n, seed=1):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(300)] + ["Été", "x-y", "日本 語", "the"]
    weights = [1 / (i + 1) for i in range(len(names))]
    return [(i, " ".join(rng.choices(names, weights, k=rng.randrange(0, 80)))) for i in range(n)]


@pytest.mark.parametrize("size, together, wide", [(4096, 256, 1 << 22), (7, 3, 1 << 22), (50, 4, 64)])
def test_equals_brute_force(spark, monkeypatch, size, together, wide):
    # the corpus is one partition a core, so blocks of 7 give many blocks a task
    monkeypatch.setattr(treap_index, "BLOCK", size)
    docs, items = corpus(400), [(i, t) for i, t in corpus(30, 2)]
    assert sorted(run_local(docs, items, together, wide), key=repr) == brute(docs, items, 10)
    assert run(spark, docs, items, 10) == brute(docs, items, 10)


def run_local(docs, items, together, wide, k=10):
    """Blocks and descent without Spark, with other bounds than those that workers have."""
    counts = [Counter(terms(t)) for _, t in docs]
    n_docs, length = sum(1 for c in counts if c), sum(sum(c.values()) for c in counts)
    schema = [pa.array([d for d, _ in docs], pa.int64()), pa.array([t for _, t in docs])]
    posting = [x for x in treap_index.term_counts(schema[1])]
    doc, term, count = treap_index._summed(*(np.concatenate(x) for x in zip(*[p[1:] for p in posting], strict=True)))
    lengths = np.array([sum(c.values()) for c in counts])
    df = Counter(w for c in counts for w in c)
    found = []
    old = treap_index.TOGETHER, treap_index.WIDE
    treap_index.TOGETHER, treap_index.WIDE = together, wide
    try:
        bests = {item: treap_index.Best(k) for item in items}
        for a in range(0, len(docs), treap_index.BLOCK):
            b = min(len(docs), a + treap_index.BLOCK)
            mine = (doc >= a) & (doc < b)
            ids = np.array([d for d, _ in docs[a:b]])
            block = treap_index.Block(
                treap_index.build_block(ids.tolist(), lengths[a:b], doc[mine] - a, term[mine], count[mine], n_docs, length), n_docs, length)
            for (item, text), best in bests.items():
                own = sorted(set(terms(text)) & set(df))
                hashes = {w: next(x[2] for x in treap_index.term_counts(pa.array([w])))[0] for w in own}
                weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) for w in own], np.int64)
                treap_index.descend(block, np.array([hashes[w] for w in own], np.uint64), weight, best, ids, np.zeros(len(ids), bool))
        for (item, _), best in bests.items():
            found += [(item, r, int(d), int(s)) for r, (d, s) in enumerate(zip(best.id, best.score, strict=True), 1)]
    finally:
        treap_index.TOGETHER, treap_index.WIDE = old
    return found


def test_bounds_cut_ranges(monkeypatch):
    monkeypatch.setattr(treap_index, "TOGETHER", 1)
    rng = np.random.default_rng(3)
    n = 4096
    doc = np.arange(n)
    count = np.where(doc == 777, 90, rng.integers(1, 3, n))
    block = treap_index.Block(
        treap_index.build_block(doc.tolist(), np.full(n, 100), doc, np.full(n, 5, np.uint64), count, n, 100 * n), n, 100 * n)
    best = treap_index.Best(1)
    split = treap_index.descend(block, np.array([5], np.uint64), np.array([10]), best, doc, np.zeros(n, bool))
    assert best.id.tolist() == [777] and split == 12


def test_edges(spark):
    long = "alpha " * 600_000 + "omega"
    docs = [
        (3, "Alpha beta"), (1, "alpha BETA"), (None, "alpha beta"), (2, None), (4, ""), (5, " ., !"), (6, long), (1, "alpha beta"),
        (7, "É é alpha\x00beta"), (8, "gamma"),
    ]
    items = [(1, "alpha beta"), (1, "alpha beta"), (None, "gamma é"), (2, None), (3, "..."), (4, "nowhere"), (5, "omega")]
    assert run(spark, docs, items) == brute(docs, items, 50)
    assert run(spark, docs, [(1, "alpha"), (1, "gamma")]) == brute(docs, [(1, "alpha"), (1, "gamma")], 50)
    assert run(spark, [], items) == [] and run(spark, docs, []) == []
    assert run(spark, [(1, None)], items) == []


def test_groups_of_queries(spark, monkeypatch):
    monkeypatch.setattr(treap_index, "QUERIES", 4)
    docs, items = corpus(60, 5), corpus(11, 6)
    assert run(spark, docs, items, 3) == brute(docs, items, 3)
