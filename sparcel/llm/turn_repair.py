"""Repair of damaged conversations by weighted CYK parsing.

The language of a conversation is ``(s?(ua)+)?`` over the initials of its roles. The repair grammar is in
Chomsky normal form: a nonterminal ``pq`` stands for all ways to edit a span of turns so that what is left
leads the language from place p to place q (nothing yet, after s, after u, after a). ``pq`` yields a single
turn (kept, given another role, deleted), an inserted turn, or the pair ``pr rq``. A cell of the parse
table holds for each nonterminal the least (cost, audit), the audit being the initials of the edits in
order; cells are filled bottom-up by span length, over all ways to cut a span in two, and are closed
under insertions on either side. Of two audits of equal cost over one span neither begins with the
other (it would have one more insertion, so cost more), so the least of the parts gives the least whole.

On Spark the turns are sorted by ranges of (conversation, turn), so a conversation of any length spreads over
the partitions. A partition parses spans of up to SPAN turns by CYK and joins the cells of neighbouring
spans pairwise, again bottom-up; what leaves it is one cell a conversation, with one character a turn, as
the result has. Cells of a conversation that crosses partitions are joined the same way. Turns are
told apart by digests until then; texts move once, sorted, and stream past the audit of their
conversation into the hash of the repaired one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sparcel.llm.common import stored

#: Turns of a span that is parsed as a whole, and spans whose cells are remembered in a task.
SPAN, REMEMBERED = 12, 1 << 15
#: Costs of the edits, and of a truncated turn that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
KEEP_, REROLE_, DELETE_, INSERT_ = "K", "R", "D", "I"
#: White space: all that is not one of these is text.
BLANKS = " \t\n\x0b\x0c\r"

#: Where each initial leads from the places of ``(s?(ua)+)?``: 0 start, 1 after s, 2 after u, 3 after a.
STEPS = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
FINAL = (0, 3)
#: The nonterminals, and the rules pq -> pr rq.
PAIRS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
_AT = {pair: i for i, pair in enumerate(PAIRS)}
RULES = [(i, _AT[p, r], _AT[r, q]) for i, (p, q) in enumerate(PAIRS) for r in range(4) if (p, r) in _AT and (r, q) in _AT]

#: Kinds of turns: S, U, A, O (another role) and in lower case the truncated ones; x has to be deleted.
DELETED = "x"

Cell = list


def _inserted() -> Cell:
    """Cell of an empty span: any insertions."""
    cell: Cell = [None] * len(PAIRS)
    for p in range(4):
        place, cost, audit = p, 0, ""
        while _AT.get((p, place)) is not None and cell[_AT[p, place]] is None:
            cell[_AT[p, place]] = (cost, audit)
            place = next(q for (s, at), q in STEPS.items() if at == place and s != "s")
            cost, audit = cost + INSERT, audit + INSERT_
    return cell


def join_cells(left: Cell, right: Cell) -> Cell:
    """Cell of two neighbouring spans, from theirs."""
    out: Cell = [None] * len(PAIRS)
    for i, a, b in RULES:
        x, y = left[a], right[b]
        if x is not None and y is not None:
            cost = x[0] + y[0]
            had = out[i]
            if had is None or cost < had[0] or (cost == had[0] and x[1] + y[1] < had[1]):
                out[i] = (cost, x[1] + y[1])
    return out


EMPTY = _inserted()


def closed(cell: Cell) -> Cell:
    """The cell with insertions on both sides."""
    return join_cells(join_cells(EMPTY, cell), EMPTY)


def turn_cell(kind: str) -> Cell:
    """Cell of a single turn."""
    cell: Cell = [None] * len(PAIRS)
    for p in range(4):
        options = [(p, DELETE, DELETE_)]
        if kind != DELETED:
            more = TRUNCATED if kind.islower() else 0
            if (kind.lower(), p) in STEPS:
                options.append((STEPS[kind.lower(), p], more, KEEP_))
            options += [(q, REROLE + more, REROLE_) for (s, at), q in STEPS.items() if at == p and s != "s"]
        for q, cost, audit in options:
            i = _AT[p, q]
            if cell[i] is None or (cost, audit) < cell[i]:
                cell[i] = (cost, audit)
    return closed(cell)


_TURNS = {kind: turn_cell(kind) for kind in "SUAOsuao" + DELETED}


def parse_span(kinds: str) -> Cell:
    """CYK over all spans of ``kinds``, by length."""
    n = len(kinds)
    table = {(i, i + 1): _TURNS[k] for i, k in enumerate(kinds)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            best: Cell = [None] * len(PAIRS)
            for cut in range(i + 1, i + length):
                left, right = table[i, cut], table[cut, i + length]
                for at, a, b in RULES:
                    x, y = left[a], right[b]
                    if x is None or y is None:
                        continue
                    cost, had = x[0] + y[0], best[at]
                    if had is None or cost < had[0] or (cost == had[0] and x[1] + y[1] < had[1]):
                        best[at] = (cost, x[1] + y[1])
            table[i, i + length] = closed(best)
    return table[0, n] if n else EMPTY


class Parser:
    """Cells of any number of turns in a row: spans by CYK, then neighbours pairwise, bottom-up."""

    def __init__(self):
        self.known: dict[str, Cell] = {}

    def span(self, kinds: str) -> Cell:
        cell = self.known.get(kinds)
        if cell is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            cell = self.known[kinds] = parse_span(kinds)
        return cell

    def parse(self, kinds: str) -> Cell:
        return joined([self.span(kinds[i:i + SPAN]) for i in range(0, len(kinds), SPAN)])


def joined(cells: list[Cell]) -> Cell:
    while len(cells) > 1:
        cells = [join_cells(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else EMPTY


def cheapest(cell: Cell) -> tuple[int, str]:
    return min(cell[_AT[0, q]] for q in FINAL if cell[_AT[0, q]] is not None)


def damaged(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows after damage, as (conv, turn, role, text, copies); dropped rows have no copies. Nulls count as a space."""
    key = F.concat(F.coalesce(F.col(conv_id).cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col(turn).cast("string"), F.lit(" ")))
    kind = F.crc32(key) % 20
    plain = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    return turns.select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), kind.alias("kind"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), plain.alias("text"),
    ).select(
        "conv", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, F.lit(0)).when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )


def _digest(role: Column, text: Column) -> Column:
    """Digest of role and text; the length keeps them apart."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def turn_facts(rows: DataFrame) -> DataFrame:
    """(conv, turn, digest, kind, copies, repeated): distinct rows of each turn without their texts.

    ``kind``: s, u, a by the first character of the role, o for others; then b if the text is blank, t if it is
    truncated, else a space. ``repeated``: a turn with a smaller number has the same role and text.
    """
    end = F.rtrim("text", F.lit(BLANKS))
    first = F.substring("role", 1, 1)
    letter = F.when(first.isin("s", "u", "a"), first).otherwise(F.lit("o"))
    whole = F.substring(end, -1, 1).isin(".", "!", "?")
    kind = F.concat(letter, F.when(end == "", F.lit("b")).when(whole, F.lit(" ")).otherwise(F.lit("t")))
    facts = (
        rows.select("conv", "turn", "role", _digest(F.col("role"), F.col("text")).alias("digest"), kind.alias("kind"), "copies")
        .groupBy("conv", "turn", "role", "digest").agg(F.any_value("kind").alias("kind"), F.sum("copies").alias("copies"))
    )
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    several = (
        facts.where("copies > 0").groupBy("conv", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select(F.col("conv").alias("c"), F.col("digest").alias("d"), "first")
    )
    return facts.join(several, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left").select(
        "conv", "turn", "role", "digest", "kind", "copies", (F.col("first").isNotNull() & (F.col("first") != place)).alias("repeated"),
    )


class _Run:
    """Turns of one conversation that follow each other in a partition."""

    def __init__(self, parser: Parser, conv, number: int):
        self.parser, self.conv, self.number = parser, conv, number
        self.cells: list[tuple[int, Cell]] = []
        self.open = ""
        self.first = self.last = self.low = self.high = None
        self.counts = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal", "rows"), 0)

    def add(self, turn, kind: str, copies: int, repeated: bool) -> None:
        if not copies:
            return
        initial, fault = kind
        c = self.counts
        if turn is not None:
            if self.low is None:
                self.low = turn
            c["turns"] += turn != self.high
            self.high = turn
        pair = (self.last or "") + initial
        c["illegal"] += (self.last is not None and pair not in ("su", "ua", "au")) + (copies - 1)
        self.first = self.first or initial
        self.last = initial
        c["rows"] += copies
        if fault == "b":
            c["blank"] += copies
            more = DELETED * copies
        else:
            c["duplicate"] += copies - 1 + repeated
            c["truncated"] += fault == "t" and not repeated
            letter = initial if fault == "t" else initial.upper()
            more = (DELETED if repeated else letter) + DELETED * (copies - 1)
        self.open += more
        while len(self.open) >= SPAN:
            self.push(self.open[:SPAN])
            self.open = self.open[SPAN:]

    def push(self, kinds: str) -> None:
        """Cells of equal numbers of spans are joined as soon as both are there."""
        self.cells.append((1, self.parser.span(kinds)))
        while len(self.cells) > 1 and self.cells[-1][0] == self.cells[-2][0]:
            (n, left), (_, right) = self.cells[-2:]
            self.cells[-2:] = [(2 * n, join_cells(left, right))]

    def row(self) -> dict:
        cells = [c for _, c in self.cells] + ([self.parser.span(self.open)] if self.open else [])
        cell = joined(cells)
        return {
            "conv": self.conv, "number": self.number, "first": self.first, "last": self.last, "low": self.low, "high": self.high, **self.counts,
            "costs": [None if x is None else x[0] for x in cell], "audits": [None if x is None else x[1] for x in cell],
        }


_CELL = "number long, first string, last string, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, rows long, costs array<long>, audits array<string>"


def _parsed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted facts -> one row for each conversation of the partition."""
    from pyspark import TaskContext

    number, parser, run, out, size = TaskContext.get().partitionId(), Parser(), None, [], 0
    for batch in batches:
        for conv, *fact in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if run is None or run.conv != conv:
                if run is not None:
                    out.append(run.row())
                    size += 20 + out[-1]["rows"]
                run = _Run(parser, conv, number)
            run.add(*fact)
            if size > 1 << 18:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, size = [], 0
    if run is not None:
        out.append(run.row())
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _ended(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Cells sorted by (conv, number) -> the cheapest repair of each conversation, and what its turns have."""
    held: list[dict] = []

    def close() -> dict:
        rows = [r for r in held if r["rows"]]
        cost, audit = cheapest(joined([[None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"], strict=True)] for r in rows]))
        total = {k: sum(r[k] for r in rows) for k in ("turns", "blank", "duplicate", "truncated", "illegal", "rows")}
        for left, right in zip(rows, rows[1:], strict=False):
            total["illegal"] += left["last"] + right["first"] not in ("su", "ua", "au")
            # null turns stand first, so a missing bound of the right side means that the left has none either
            total["turns"] -= right["low"] is not None and left["high"] == right["low"]
        low = next((r["low"] for r in rows if r["low"] is not None), None)
        high = next((r["high"] for r in reversed(rows) if r["high"] is not None), None)
        gaps = 0 if low is None else int(high) - int(low) + 1 - total["turns"]
        return {
            "conv": held[0]["conv"], "gaps": gaps, **{k: total[k] for k in ("blank", "duplicate", "truncated", "illegal")},
            "cost": cost, "audit": audit,
        }

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if held and held[0]["conv"] != row["conv"]:
                out.append(close())
                held = []
            held.append(row)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if held:
        yield pa.RecordBatch.from_pylist([close()], schema=schema)


class _Repaired:
    """Hash of the repaired turns of one conversation, fed turn by turn."""

    def __init__(self, row: dict):
        self.row, self.at, self.place, self.hash, self.glue = row, 0, 0, hashlib.sha256(), b""

    def emit(self, role: str, text: str) -> None:
        self.hash.update(self.glue + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.glue = b"\n"

    def step(self, role: str, text: str) -> None:
        """Take the edits up to the next one that takes a turn, and that turn."""
        audit = self.row["audit"]
        while self.at < len(audit):
            edit = audit[self.at]
            self.at += 1
            if edit == KEEP_:
                self.place = STEPS[role[:1], self.place]
                self.emit(role, text)
            elif edit != DELETE_:
                letter, self.place = next((s, q) for (s, at), q in STEPS.items() if at == self.place and s != "s")
                self.emit({"u": "user", "a": "assistant"}[letter], "" if edit == INSERT_ else text)
            if edit != INSERT_:
                break

    def close(self) -> dict:
        self.step("", "")  # only insertions can be left
        return {**self.row, "repaired_sha256": self.hash.hexdigest()}


def _hashed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted (result row, then turns of the conversation) -> the result row with the hash of the repaired turns.

    A conversation passes by turn after turn; only its audit and the state of the hash are kept.
    """
    state = None
    for batch in batches:
        out = []
        columns = [batch.column(n).to_pylist() for n in ("result", "role", "text", "copies")]
        own = [batch.column(n).to_pylist() for n in schema.names[:-1]]
        for i, (is_result, role, text, copies) in enumerate(zip(*columns, strict=True)):
            if is_result:
                if state is not None:
                    out.append(state.close())
                state = _Repaired({n: x[i] for n, x in zip(schema.names, own, strict=False)})
            else:
                for _ in range(copies):
                    state.step(role, text)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if state is not None:
        yield pa.RecordBatch.from_pylist([state.close()], schema=schema)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows``: (conv, turn, role, text, copies) as ``damaged`` gives them, role and text without nulls.
    Turns of a conversation are taken in the order of ``turn``, nulls first; of equal turns by role, then
    by a digest of role and text, so that copies stand together. A turn is blank (nothing but white space), else
    a duplicate (role and text seen before), else truncated (its last character that is not white space is
    none of ``.!?``), else without fault. Edits: keep (0), give the role user or assistant (1), delete (2;
    blank and duplicate turns must go), insert an empty turn of user or assistant (5); a truncated turn
    that stays costs 5. ``audit`` has the initials of the cheapest edits that lead to
    ``(s?(ua)+)?``, the least in ASCII order of equal cost.

    * Conversations without copies of any row (all dropped) have zeros, an empty audit and the hash of nothing.
    * Null ids are a conversation. Gaps leave out null turns, and are 0 where all are null.
    * Roles go by their first character, as it is written; an empty role has none.
    * Other columns are ignored. An empty table gives no rows.
    * No conversation is gathered: its turns may lie in many partitions. The result has a character a turn, and
      the hash, which is sequential by nature, is taken by one task as the turns stream by.
    """
    rows = rows.withColumn("turn", F.col("turn").cast("long"))
    facts = turn_facts(rows)
    conv = rows.schema["conv"]
    order = ["conv", "turn", "role", "digest"]
    cell = T.StructType([conv, *T.StructType.fromDDL(_CELL).fields])
    cell_schema = _nullable(cell)
    cells = (
        facts.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv", "turn", "kind", "copies", "repeated")
        .mapInArrow(lambda it: _parsed(it, cell_schema), cell)
    )
    result = T.StructType([conv, *T.StructType.fromDDL("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string").fields])
    result_schema = _nullable(result)
    ends = cells.repartition("conv").sortWithinPartitions("conv", "number").mapInArrow(lambda it: _ended(it, result_schema), result)
    ends = stored(ends, "repairs")
    names = [f.name for f in result.fields]
    texts = rows.where("copies > 0").select("conv", "turn", "role", "text", "copies", _digest(F.col("role"), F.col("text")).alias("digest"))
    both = ends.withColumn("result", F.lit(True)).unionByName(texts.withColumn("result", F.lit(False)), allowMissingColumns=True)
    final = T.StructType([*result.fields, T.StructField("repaired_sha256", T.StringType())])
    final_schema = _nullable(final)
    return (
        both.repartition("conv").sortWithinPartitions("conv", F.desc("result"), "turn", "role", "digest")
        .select(*names, "result", "role", "text", "copies")
        .mapInArrow(lambda it: _hashed(it, final_schema), final)
    )


def _nullable(schema: T.StructType) -> pa.Schema:
    return pa.schema([pa.field(f.name, f.type, True) for f in to_arrow_schema(schema)])
