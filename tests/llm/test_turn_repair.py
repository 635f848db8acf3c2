import hashlib
import itertools
import random
import re
import zlib

import pytest

from sparcel.llm import turn_repair

BLANK = " \t\n\x0b\x0c\r"


def kinds_of(rows):
    """Kinds and counts of the turns (role, text) in order, as the contract words them."""
    seen, kinds, count = set(), "", dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    for role, text in rows:
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not text.strip(BLANK):
            kinds, fault = kinds + "x", "blank"
        elif (role, text) in seen:
            kinds, fault = kinds + "x", "duplicate"
        elif text.rstrip(BLANK)[-1] not in ".!?":
            kinds, fault = kinds + letter, "truncated"
        else:
            kinds, fault = kinds + letter.upper(), None
        seen.add((role, text))
        if fault:
            count[fault] += 1
    count["illegal"] = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return kinds, count


def cheapest(kinds):
    """Turn by turn with all (cost, audit) of each place, no spans."""
    def insertions(best):
        for _ in range(3):
            for p, (c, a) in list(best.items()):
                q, new = (3 if p == 2 else 2), (c + 5, a + "I")
                if q not in best or new < best[q]:
                    best[q] = new
        return best

    best = insertions({0: (0, "")})
    for k in kinds:
        out = {}
        for p, (c, a) in best.items():
            options = [(p, c + 2, a + "D")]
            if k != "x":
                more = 5 * k.islower()
                options += [(3 if p == 2 else 2, c + 1 + more, a + "R")]
                q = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}.get((k.lower(), p))
                if q is not None:
                    options.append((q, c + more, a + "K"))
            for q, *new in options:
                if q not in out or tuple(new) < out[q]:
                    out[q] = tuple(new)
        best = insertions(out)
    return min(best[p] for p in (0, 3) if p in best)


def all_edits(kinds):
    """Every sequence of edits with at most three insertions at a place, checked by the pattern."""
    best = None
    for edits in itertools.product(*[["D"] if k == "x" else ["D", "K", "Ru", "Ra"] for k in kinds]):
        for inserted in itertools.product(("", "u", "a", "ua", "au"), repeat=len(kinds) + 1):
            for order in (0, 1):  # the insertions of a gap stand before or after the deletions next to them
                text, audit, cost = "", "", 0
                for i, gap in enumerate(inserted):
                    if order == 0:
                        text, audit, cost = text + gap, audit + "I" * len(gap), cost + 5 * len(gap)
                    if i < len(kinds):
                        e, k = edits[i], kinds[i]
                        audit += e[0]
                        cost += {"D": 2, "K": 0, "R": 1}[e[0]] + (5 if e != "D" and k.islower() else 0)
                        text += "" if e == "D" else k.lower() if e == "K" else e[1]
                    if order == 1:
                        text, audit, cost = text + gap, audit + "I" * len(gap), cost + 5 * len(gap)
                if re.fullmatch("(s?(ua)+)?", text) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


def repaired(audit, rows):
    out, place, rows = [], 0, iter(rows)
    for e in audit:
        role, text = ("", "") if e == "I" else next(rows)
        if e == "D":
            continue
        if e in "RI":
            role = "assistant" if len(out) > place and (len(out) - place) % 2 else "user"
        elif role[:1] == "s":
            place = 1
        out.append(f"{role}:{text}")
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def brute(table):
    convs = {}
    for conv, turn, role, text in table:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs.setdefault(conv, []).extend([(turn is not None, turn or 0, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (*r[:3], hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
        turns = [r[1] for r in rows if r[0]]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        rows = [r[2:] for r in rows]
        kinds, count = kinds_of(rows)
        cost, audit = cheapest(kinds)
        out.append((conv, gaps, *count.values(), cost, audit, repaired(audit, rows)))
    return sorted(out, key=repr)


def run(spark, table):
    df = spark.createDataFrame([(r, c, t, n, 1, "x") for c, n, r, t in table], "role string, conv_id long, text string, turn long, cost int, kind string")
    found = turn_repair.repair(turn_repair.damaged(df))
    assert found.columns == ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted([tuple(r) for r in found.collect()], key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_cells_against_all_edits(n):
    every = ["".join(kinds) for kinds in itertools.product("SUAoax", repeat=n)]
    for kinds in random.Random(n).sample(every, min(36, len(every))):
        assert turn_repair.cheapest(turn_repair.parse_span(kinds)) == cheapest(kinds) == all_edits(kinds)


def test_spans_are_joined():
    rng = random.Random(2)
    for n in (5, 11, 12, 13, 40, 200):
        for _ in range(12):
            kinds = "".join(rng.choices("SUAOsuaox", [1, 6, 6, 1, 1, 2, 2, 1, 2], k=n))
            parser = turn_repair.Parser()
            assert turn_repair.cheapest(parser.parse(kinds)) == cheapest(kinds)
            cut = rng.randrange(n + 1)
            halves = [parser.parse(kinds[:cut]), parser.parse(kinds[cut:])]
            assert turn_repair.cheapest(turn_repair.joined(halves)) == cheapest(kinds)


def test_conversations(spark):
    rng = random.Random(7)
    roles, texts = ["user", "assistant", "system", "User", "", "tool", None], ["Yes.", "No!", "Perhaps", "", " \t", "a. b", "Ok?\n", "Ünd. ", None]
    table = [
        (conv, turn, rng.choices(roles, [9, 9, 2, 1, 1, 1, 1])[0], rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.random()}.")
        for conv in [None, *range(150)] for turn in rng.sample([None, *range(12)], rng.randrange(1, 11))
    ]
    table += rng.sample(table, 60)  # rows that repeat, and other rows of the same turn
    table += [(c, t, "assistant", "Another one.") for c, t, _, _ in rng.sample(table, 40)]
    assert run(spark, table) == brute(table)
    assert run(spark, []) == []
    dropped = [c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    nothing = hashlib.sha256(b"").hexdigest()
    assert run(spark, [(c, 0, "user", "Hello.") for c in dropped]) == sorted([(c, 0, 0, 0, 0, 0, 0, "", nothing) for c in dropped], key=repr)


def test_one_long_conversation_over_partitions(spark):
    rng = random.Random(9)
    table = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", f"{t}!"])) for t in range(4000)]
    table += [(2, t, "ua"[t % 2], f"{t}.") for t in range(7)] + [(1, 77, "user", "Same.")] * 500
    assert run(spark, table) == brute(table)
