import random

import numpy as np
import pytest
import tiktoken

from sparcel.llm import queries, token_counts


@pytest.fixture(scope="module")
def ranks():
    return token_counts.read_ranks(f"{queries.TOKENIZERS}/byte_bpe_50k.tiktoken")


def brute(ends, start, end, rule):
    """Section of every token by counting its bytes one by one."""
    out, at = [], 0
    for stop in ends:
        owner = [next((i for i, (a, b) in enumerate(zip(start, end, strict=True)) if a <= x < b), -1) for x in range(at, stop)]
        own = [o for o in owner if o >= 0]
        if not own:
            out.append((-1, False))
        else:
            best = own[0] if rule == "first" else own[-1] if rule == "last" else max(sorted(set(own)), key=own.count)
            out.append((best, owner.count(best) < stop - at))
        at = stop
    return out


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_allocation(rule):
    rng = random.Random(3)
    for _ in range(300):
        size = rng.randrange(40)
        ends = np.array(sorted({*rng.sample(range(1, size + 1), rng.randrange(size)), size}) if size else [], np.int64)
        marks = sorted(rng.randrange(size + 1) for _ in range(2 * rng.randrange(5)))
        start, end = np.array(marks[::2], np.int64), np.array(marks[1::2], np.int64)
        section, crosses = token_counts.allocate(ends, start, end, rule)
        assert list(zip(section.tolist(), crosses.tolist(), strict=True)) == brute(ends.tolist(), start.tolist(), end.tolist(), rule)


def test_lines(spark, ranks):
    encoder = tiktoken.Encoding("t", pat_str=queries.BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["one two\n\n\n  three  \nfour", "", None, "ééé日本\n日本", "\n", "no feed", "word " * 30_000 + "\nlast", "one two\n\n\n  three  \nfour"]
    df = spark.createDataFrame([(i if i != 5 else None, t, 7) for i, t in enumerate(texts)], "doc_id int, text string, section int")
    out = token_counts.section_tokens(df, ranks, queries.BYTE_PATTERN).toPandas()
    for i, t in enumerate(texts):
        rows = out[out["doc_id"].isna()] if i == 5 else out[out["doc_id"] == i]
        if t is None:
            assert rows.empty
            continue
        assert rows["n_tokens"].sum() == len(encoder.encode_ordinary(t))
        lines = rows[rows["section"] >= 0].sort_values("section")
        assert [t[int(r.start_char):int(r.end_char)] for r in lines.itertuples()] == t.split("\n")
    assert token_counts.section_tokens(df.limit(0), ranks, queries.BYTE_PATTERN).count() == 0


def test_fields_and_tables(spark, ranks):
    df = spark.createDataFrame([(1, "A title", "Body é text", "x"), (2, None, "", "y"), (3, "t", "b", "z")], "doc_id long, title string, text string, sections string")
    joined = token_counts.with_fields(df, ["title", "text"])
    assert joined.columns == ["doc_id", "title", "text", "sections"]
    out = token_counts.section_tokens(joined, ranks, queries.BYTE_PATTERN, sections="sections").toPandas()
    got = out[(out["doc_id"] == 1) & (out["section"] >= 0)]
    assert list(got["name"]) == ["title", "text"] and list(got["start_char"]) == [0, 8] and list(got["end_char"]) == [7, 19]
    assert (out[out["doc_id"] == 2]["n_tokens"].sum()) == 1
    spans = spark.createDataFrame([(1, "b", 4, 100), (1, "a", 0, 6), (3, "c", 0, 0)], "doc_id long, name string, start int, end int")
    out = token_counts.section_tokens(token_counts.with_sections(df, spans), ranks, queries.BYTE_PATTERN, sections="sections").toPandas()
    one = out[(out["doc_id"] == 1) & (out["section"] >= 0)]
    assert list(one["name"]) == ["a", "b"] and list(one["start_char"]) == [0, 6] and list(one["end_char"]) == [6, 11]
    assert list(out[out["doc_id"] == 3].sort_values("section")["n_tokens"]) == [1, 0]
    with pytest.raises(ValueError, match="rule"):
        token_counts.section_tokens(df, ranks, queries.BYTE_PATTERN, rule="other")
