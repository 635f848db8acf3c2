import random
import re
import time
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sparcel.llm import common, hashing, ngram_join

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return [w.lower() if w.isascii() else bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in WORD.findall((text or "").encode())]


def shingle_set(text):
    w = words(text)
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    where, root = defaultdict(list), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for j in where[g]:
                shared[j] += 1
            where[g].append(i)
        for j, o in shared.items():
            if 100 * o >= 80 * (len(s) + len(sets[j]) - o):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted([(d, len(sets[i]), low.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)], key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(t, d, 1, "x") for d, t in rows], "text string, doc_id long, n int, id string")
    return sorted([tuple(r) for r in ngram_join.ngram_components(df).collect()], key=repr)


def test_word_hashes():
    texts = ["", None, "One  two\tone\x0b", "é" * 50_000 + " Z", " ", "a b c", "x" * 9 + " " + "x" * 8, "w " * 2_000_000, "ONE"]
    rows = dict(hashing.word_hashes(pa.array(texts, pa.string())))
    known = {}
    for i, t in enumerate(texts):
        w = words(t)
        assert len(rows[i]) == len(w)
        for h, word in list(zip(rows[i], w, strict=True))[:50]:
            assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)
    sliced = dict(hashing.word_hashes(pa.array(texts, pa.large_string())[2:5]))
    assert all((sliced[k] == rows[k + 2]).all() for k in range(3))


def test_edge_cases(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [
        (5, base), (4, base.upper()), (None, base), (9, base + " extra"), (8, ""), (7, ""), (6, None), (3, "a b"), (2, "A  b\n"),
        (11, "a b c"), (None, "lonely words only here now"), (5, base), (5, "something else that is not alike at all"), (12, "   "),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_chains_and_copies(spark):
    rng = random.Random(4)
    vocabulary = [f"t{i}" for i in range(400)]
    rows = []
    for k in range(40):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(4, 120))]
        for _ in range(rng.randrange(1, 12)):
            w = list(w)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                w += [rng.choice(vocabulary) for _ in range(rng.randrange(6))]
            rows.append((1000 - len(rows), " ".join(w)))
    common = " ".join(vocabulary[:30])
    rows += [(2000 + i, f"{common} own{i} words{i}") for i in range(60)]
    assert run(spark, rows) == brute(rows)


def test_threshold_is_exact(spark):
    # 8 of 10 n-grams shared is exactly 0.8
    shared = [f"s{i}" for i in range(12)]
    rows = [(1, " ".join(["a", *shared])), (2, " ".join([*shared, "b"])), (3, " ".join(["c", *shared, "d"]))]
    assert run(spark, rows) == brute(rows)


def test_one_of_each(spark):
    base = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(3, base), (1, base), (2, "other"), (None, base), (4, None)], "doc_id long, text string")
    assert sorted(r.doc_id for r in ngram_join.one_of_each(df).collect()) == [1, 2, 4]


@pytest.mark.parametrize("n", [1, 4, 5, 6, 10, 101])
def test_need(n):
    assert ngram_join._need(n, (80, 100)) == int(np.ceil(n * 0.8 - 1e-9))


def test_groups_around_the_crowded_limit(spark, monkeypatch):
    # n-grams with 2 rows, a few, and just over the limit; only the last go through the rounds
    seen = []
    leaders = ngram_join._leader_pairs
    monkeypatch.setattr(ngram_join, "_leader_pairs", lambda rows, *rest: seen.append(rows.agg({"rows": "min"}).first()[0]) or leaders(rows, *rest))
    rng = random.Random(11)
    rows = []
    for size in [2, 2, 2, 3, 4, 7, 8, 9, 10, 30]:
        base = [f"g{size}x{len(rows)}w{i}" for i in range(60)]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(1, 5)):
                w[rng.randrange(len(w))] = f"edit{rng.random()}"
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)
    assert all(low > ngram_join.CROWDED for low in seen)


def test_shuffle_files_go_with_their_step(spark):
    # what is written before a step ends is gone after it; outside nothing changes
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {f for f in blocks.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}

    def step():
        spark.range(1000, numPartitions=4).repartition(4, "id").write.format("noop").mode("overwrite").save()

    with common.shuffles_removed(spark):
        at = shuffles()
        step()
        for _ in range(50):  # files are deleted in the background
            if shuffles() <= at:
                break
            time.sleep(0.1)
        assert shuffles() <= at
    assert spark.conf.get(key, None) == before
    step()
    assert shuffles() - at


def test_sketch_and_filters_are_no_wider_than_needed(spark):
    # on the driver: a byte a counter while no count is larger, two when one is; filters follow their keys
    half = ngram_join.PART // 2

    def sketch(parts):
        rows = [(p, np.array([*x, *[0] * (ngram_join.PART - len(x))]).astype(kind).tobytes()) for p, x, kind in parts]
        return ngram_join._sketch(spark.createDataFrame([(None, None), *rows], "part int, counts binary"))

    small = sketch([(1, [3] * half, "u1"), (1, [200], "u1")])
    assert small.dtype == np.uint8 and small[ngram_join.PART] == 203 and small.sum(dtype=int) == 3 * half + 200
    wide = sketch([(0, [200], "u1"), (0, [200], "u1"), (1, [7], "u1")])
    assert wide.dtype == np.uint16 and wide[0] == 400 and wide[ngram_join.PART] == 7
    top = sketch([(2, [0xFFFFFFFF], "u4"), (2, [5], "u1")])
    assert top.dtype == np.uint32 and top.max() == 0xFFFFFFFF
    assert ngram_join._bits(0) == 64 * ngram_join.BLOOM_PART and ngram_join._bits(1 << 40) == ngram_join.BLOOM
    assert ngram_join._bits(100_000) == 1 << 21
    keys = spark.range(5000).selectExpr("xxhash64(id) AS key")
    words = ngram_join._bloom(keys, ngram_join._bits(5000))
    bits = ngram_join._bloom_bits(np.array([r.key for r in keys.collect()]), 64 * len(words))
    assert ((words[bits >> 6] >> (bits & 63).astype(np.uint64)) & np.uint64(1)).all()


def test_many_partitions_take_few_tasks(spark):
    # steps on rows of a few numbers, and the rounds of components, do not start a task for each shuffle partition
    rng = random.Random(5)
    rows = []
    for size in [2, 3, 40]:
        base = [f"p{size}w{i}" for i in range(60)]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(1, 5)):
                w[rng.randrange(len(w))] = f"edit{rng.random()}"
            rows.append((len(rows), " ".join(w)))
    sc, n = spark.sparkContext, 60
    conf = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        sc.setJobGroup("few-tasks", "")
        assert run(spark, rows) == brute(rows)
        tracker = sc.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("few-tasks") for s in tracker.getJobInfo(j).stageIds}
        tasks = sum(i.numCompletedTasks for s in stages if (i := tracker.getStageInfo(s)))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert 0 < tasks < 60 * n


@pytest.mark.parametrize("few", [0, 1 << 14])
def test_texts_are_found_by_keys_or_by_a_filter(spark, monkeypatch, few):
    monkeypatch.setattr(ngram_join, "FEW", few)
    rng = random.Random(6)
    base = [f"k{i}" for i in range(50)]
    rows = []
    for i in range(25):
        w = [*base[: 20 + i], *(f"own{i}x{j}" for j in range(rng.randrange(4)))]
        rows.append((i, " ".join(w)))
    assert run(spark, rows) == brute(rows)
