import re

import corpus_pipeline
from sparcel.llm import langid, pieces
from sparcel.llm.queries import TOKENIZERS

WORD = re.compile(r"[^\s!-/:-@\[-`{-~]+")


def brute_lines(docs):
    seen, out = set(), {}
    for d, t in sorted(docs.items()):
        rows, hit = t.split("\n"), set()
        for i in range(len(rows) - 2):
            w = tuple(rows[i:i + 3])
            if all(not x.strip(" ") for x in w):
                continue
            if w in seen:
                hit |= {i, i + 1, i + 2}
            seen.add(w)
        if len(hit) < len(rows):
            out[d] = "\n".join(x for i, x in enumerate(rows) if i not in hit)
    return out


def brute_near(docs):
    def words(t):
        return re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in t.encode()))

    sets = {}
    for d, t in docs.items():
        w = words(t)
        sets[d] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    root, where = {d: d for d in docs}, {}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d in sorted(docs):
        shared = {}
        for g in sets[d]:
            for e in where.setdefault(g, []):
                shared[e] = shared.get(e, 0) + 1
            where[g].append(d)
        for e, o in shared.items():
            if 100 * o >= 80 * (len(sets[d]) + len(sets[e]) - o):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return {d: t for d, t in docs.items() if find(d) == d}


def holds(text, items, rate=0.2):
    w = WORD.findall(text.lower())
    for x in items:
        row = [0] * (len(w) + 1)
        for i, c in enumerate(x):
            new = [i + 1]
            for j, d in enumerate(w):
                new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
            row = new
        if min(row) <= int(rate * len(x) + 1e-9):
            return True
    return False


def test_stages_against_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    found = {r.doc_id: r for r in langid.identify(docs, langid.fit(docs)).collect()}
    kept = {d: r.text for d, r in found.items() if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SHARE}
    assert len(kept) > 0.97 * len(found)
    near = brute_near(brute_lines(kept))
    items = [WORD.findall((r.text or "").lower()) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    want = {d for d, t in near.items() if not holds(t, items)}
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, data).collect()}
    assert set(out) == want
    assert all(r.round_trip for r in out.values())
    v = pieces.Vocabulary.read(f"{TOKENIZERS}/piece_bpe_32k.model")
    import numpy as np

    for d in sorted(out)[:20]:
        ids = np.array(out[d].token_ids)
        assert v.decode(ids, np.array([len(ids)]))[0].decode() == near[d] and out[d].n_tokens == len(ids)


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard", "decontamination", "pieces"]


def test_odd_documents(spark, data):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "12 34", None, "s", 5), (None, "the words of a text in the end", "en", None, 7)]
    rows += [(10 + i, "the quick brown fox jumps over the lazy dog of the house", "en", "s", 1) for i in range(6)]
    rows += [(30 + i, f"der schnelle fuchs nummer {i} und die katze im garten mit dem hund", "de", "s", 1) for i in range(6)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == corpus_pipeline.COLUMNS, name
        assert stage(spark, docs.limit(0), data).count() == 0, name
        if name == "language_id":
            assert {r.doc_id for r in out.collect()} & {1, 2, 3} == set()
        elif name in ("line_dedup", "decontamination"):
            assert out.count() == len(rows), name
