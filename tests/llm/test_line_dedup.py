import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparcel.llm import line_dedup

SCHEMA = "doc_id long, text string, n_lines string, __pos int"


def brute(rows):
    """Texts after dedup, by (id, text)."""
    seen, out = set(), {}
    for d, t in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = t.split("\n")
        hit = set()
        for i in range(len(lines) - 2):
            w = tuple(lines[i:i + 3])
            if all(not x.strip(" ") for x in w):
                continue
            if w in seen:
                hit |= {i, i + 1, i + 2}
            seen.add(w)
        out[d, t] = "\n".join(x for i, x in enumerate(lines) if i not in hit)
    return out


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "old", 5) for d, t in rows], SCHEMA)
    return line_dedup.dedup_lines(df)


def check(spark, rows):
    out = run(spark, rows)
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    want = brute(rows)
    assert got == sorted(((d, want.get((d, t))) for d, t in rows), key=repr)
    return out


def test_cases(spark):
    rows = [
        (1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (3, "a\nb\nc\nd"), (4, "a\nb"), (5, None), (6, ""), (7, "\n\n\n\n\n"),
        (8, "p\np\np\np\nq"), (9, "b\nc\nd\nb\nc\nd"), (None, "x\na\nb"), (3, "a\nb\nc\nd"), (10, "\n\n\nz"), (11, "u\n\n\nz"),
    ]
    out = check(spark, rows)
    assert out.columns == ["doc_id", "text", "__pos", "n_lines", "n_removed"]
    counts = {r.doc_id: (r.n_lines, r.n_removed) for r in out.collect()}
    assert counts[2] == (5, 3) and counts[3] == (4, 4) and counts[5] == (0, 0) and counts[6] == (1, 0)


def test_long_text_is_linear(spark):
    body = "\n".join(f"line {i % 5000}" for i in range(60_000))
    check(spark, [(1, body), (2, body[:100_000])])


def test_empty_table(spark):
    assert run(spark, []).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 10**6))
def test_random(spark, seed):
    rng = random.Random(seed)
    check(spark, [(i, "\n".join(rng.choice("abc ") for _ in range(rng.randrange(12)))) for i in range(25)])
