import random
import re

import numpy as np
import pyarrow as pa

from sparcel.llm import decontaminate

WORD = re.compile(r"[^\s!-/:-@\[-`{-~]+")


def brute(text, item, rate=0.2):
    """Smallest edit distance of the item to a run of words of the text, or None above the limit."""
    w, x = WORD.findall((text or "").lower()), WORD.findall((item or "").lower())
    if not x:
        return None
    row = [0] * (len(w) + 1)
    for i, c in enumerate(x):
        new = [i + 1]
        for j, d in enumerate(w):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    best = min(row)
    return best if best <= int(rate * len(x) + 1e-9) else None


def edited(rng, words, k):
    w = list(words)
    for _ in range(k):
        p = rng.randrange(len(w))
        op = rng.choice("sid")
        if op == "s":
            w[p] = f"zz{rng.random()}".replace(".", "")
        elif op == "i":
            w.insert(p, f"yy{rng.randrange(10**6)}")
        elif len(w) > 2:
            del w[p]
    return w


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60)))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "!!! ..."), (103, items[7][1])]
    docs = []
    for d in range(150):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(120))]
        if d % 2:
            x = rng.choice(items[:40])[1].split()
            at = rng.randrange(len(w) + 1)
            w[at:at] = edited(rng, x, rng.randrange(int(len(x) * 0.3) + 1))
        text = " ".join(w)
        docs.append((d, text.upper().replace(" V1", ",  v1") if d % 3 == 0 else text))
    docs += [(500, None), (501, ""), (None, items[3][1]), (1, items[5][1]), (1, items[5][1]), (502, " ".join(vocabulary * 5000) + " " + items[9][1])]
    return docs, items


def test_against_brute_force(spark):
    docs, items = corpus()
    df = spark.createDataFrame([(d, t, "x", 3) for d, t in docs], "doc_id long, text string, item_id string, distance int")
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = [tuple(r) for r in decontaminate.find_items(df, bench).collect()]
    texts = {}
    for d, t in docs:
        texts.setdefault(d, []).append(t)
    want = []
    for d, t in docs:
        if d == 502:
            t = " ".join(t.split()[-200:])
        for i, x in items:
            if (k := brute(t, x)) is not None:
                want.append((d, i, k))
    found = {(d, i, k) for d, i, _, k, _, _ in got}
    assert found <= set(want), "every match is exact"
    assert len(found) >= 0.99 * len(set(want))
    assert len(got) >= 0.99 * len(want)
    for d, i, n, k, first, end in got:
        for t in texts[d]:
            w = WORD.findall((t or "").lower())
            run = " ".join(w[first:end])
            if brute(run, dict(items)[i]) == k:
                assert len(WORD.findall(dict(items)[i])) == n
                break
        else:
            raise AssertionError((d, i))


def test_recall_at_the_limit():
    rng = random.Random(9)
    items = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(14, 60))) for _ in range(50)]
    block = decontaminate.Items(list(range(50)), items)
    found = tried = 0
    for i, x in enumerate(items * 4):
        w = x.split()
        text = " ".join(["a"] * 40 + edited(rng, w, int(0.2 * len(w))) + ["b"] * 40)
        if brute(text, x) is None:
            continue
        tried += 1
        (_, h), = decontaminate.words(__import__("pyarrow").array([text]))
        found += i % 50 in block.search(h, np.array([0, len(h)]))[1]
    assert tried > 150 and found / tried >= 0.98


def test_drop_keeps_columns_and_clean_rows(spark):
    docs, items = corpus(2)
    df = spark.createDataFrame([(d, t, d, "s") for d, t in docs], "doc_id long, text string, __text long, source string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    out = decontaminate.drop_contaminated(df.withColumnRenamed("__text", "n"), bench)
    assert out.columns == ["doc_id", "text", "n", "source"]
    want = sum(all(brute(t, x) is None for _, x in items) for d, t in docs if d != 502)
    assert abs(out.count() - want) <= 1


def test_blocks_and_empty(spark, monkeypatch):
    docs, items = corpus(3)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    whole = sorted(map(tuple, decontaminate.find_items(df, bench).collect()), key=repr)
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 15)
    assert sorted(map(tuple, decontaminate.find_items(df, bench).collect()), key=repr) == whole
    assert decontaminate.find_items(df.limit(0), bench).count() == 0
    assert decontaminate.find_items(df, bench.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(df, bench.limit(0)).count() == len(docs)


def test_long_items_at_the_limit():
    rng = random.Random(11)
    for m in (100, 400):
        items = [[f"w{rng.randrange(3000)}" for _ in range(m)] for _ in range(12)]
        texts = []
        for item in items:  # deletions only, as many as are allowed
            gone = set(rng.sample(range(m), m // 5))
            filler = [[f"f{rng.randrange(500)}" for _ in range(40)] for _ in range(2)]
            texts.append(" ".join(filler[0] + [x for i, x in enumerate(item) if i not in gone] + filler[1]))
        held = decontaminate.Items(list(range(12)), [" ".join(x) for x in items])
        found = {(row, item) for row, item, *_ in decontaminate._best(held, pa.array(texts))}
        assert found == {(i, i) for i in range(12)}
