"""Repair of conversation structure: generalised LR parsing of role sequences with weighted edits.

A conversation's rows, by turn, should read as the role grammar ``T -> empty | P``, ``P -> s u a | u a | P u a`` over
the initials of system, user and assistant. Before each row, and after the last, empty turns may be inserted (cost 5 each);
a row is kept (0), gets the role user or assistant (1) or is deleted (2). Blank and duplicate rows must be deleted;
a truncated row that stays costs 5 more.

The parser runs the grammar's LR tables over all edits at once. Its graph-structured stack has, after each row, one
vertex for each stack top, linked to the vertex before; stacks of equal top are merged, the least (cost, audit) stays, an
audit being the edits' initials so far. In this grammar a top fixes the stack below it, so merging loses nothing; and no
audit of a row's vertices begins another, so their order, one number each, settles all later ties.

Conversations of any length are parsed in pieces: rows are sorted over all tasks by range, and runs of at most ``CHUNK``
rows of a conversation become chunks. A chunk's costs and audit order from each top before it to each top after it form
a small matrix; matrices are folded along a conversation, which fixes the tops between chunks, and each chunk is then
parsed alone between its two. That gives the same edits as one pass over all rows.

``repair`` returns the edits, one row each and in order, with the turns that they leave; and a report per conversation.

Defined results: null roles and texts are one space; rows of null id form one conversation; null turns come first, ties
are ordered by role, then by the text's digest, and equal rows stay side by side. A role of other (or no) initial is
never kept. An empty table gives empty results. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import spans  # noqa: F401  (also sees to it that this package's functions travel by value)
from .tables import checked_broadcast, written

#: Rows and bytes of text of a chunk.
CHUNK, CHUNK_BYTES = 2000, 4 << 20
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Faults of a row, in the order in which they count.
NONE, BLANK, DUPLICATE, CUT = range(4)
ROLES = {"u": "user", "a": "assistant"}

# ---- the grammar's LR tables ----------------------------------------------------------------------------------

#: Shifts: (state, role initial) -> state. States 6 to 8 only reduce; 0 (nothing) and 4 (P) accept.
SHIFT = {(0, "s"): 1, (0, "u"): 3, (1, "u"): 2, (2, "a"): 6, (3, "a"): 7, (4, "u"): 5, (5, "a"): 8}
#: Symbols that a reduction to P takes off the stack, and the state that P leads to.
REDUCE, GOTO_P = {6: 3, 7: 2, 8: 3}, {0: 4}
#: The stack below each top that a row can leave.
STACKS = {0: (0,), 1: (0, 1), 2: (0, 1, 2), 3: (0, 3), 4: (0, 4), 5: (0, 4, 5)}
ACCEPTING, N = (0, 4), len(STACKS)
_NEVER = 1 << 60


def step(top: int, initial: str) -> int | None:
    """The top after shifting a role and reducing as long as possible."""
    state = SHIFT.get((top, initial))
    if state is None:
        return None
    stack = [*STACKS[top], state]
    while stack[-1] in REDUCE:
        del stack[-REDUCE[stack[-1]]:]
        stack.append(GOTO_P[stack[-1]])
    return stack[-1]


@cache
def inserts(top: int) -> tuple[tuple[int, str], ...]:
    """(top, inserted roles) reachable by inserts alone; more than two lead back to where they began."""
    found, last = [(top, "")], [(top, "")]
    for _ in range(2):
        last = [(q, roles + r) for p, roles in last for r in ROLES if (q := step(p, r)) is not None]
        found += last
    return tuple(found)


@cache
def actions(fault: int, initial: str) -> tuple[tuple[int, int, int, str, str], ...]:
    """Ways over a row: (top before, top after, cost, edits, roles given), the best of each two tops."""
    best: dict[tuple[int, int], tuple[int, str, str]] = {}
    for p in STACKS:
        for q, put in inserts(p):
            ways = [(q, DELETE, "D", "")]
            if fault not in (BLANK, DUPLICATE):
                more = TRUNCATED * (fault == CUT)
                ways += [(to, more, "K", "") for to in [step(q, initial)] if to is not None]
                ways += [(to, more + REROLE, "R", r) for r in ROLES if (to := step(q, r)) is not None]
            for to, cost, edit, role in ways:
                way = (cost + INSERT * len(put), "I" * len(put) + edit, put + role)
                best[p, to] = min(best.get((p, to), way), way)
    return tuple((p, q, *way) for (p, q), way in sorted(best.items()))


@cache
def endings() -> tuple[tuple[int, int, int, str, str], ...]:
    """Ways from the last row's tops to an accepting one, as ``actions``."""
    ways = [(p, q, INSERT * len(put), "I" * len(put), put) for p in STACKS for q, put in inserts(p) if q in ACCEPTING]
    return tuple(min((w for w in ways if w[0] == p and w[1] == q), key=lambda w: w[2:4])
                 for p in STACKS for q in ACCEPTING if any(w[:2] == (p, q) for w in ways))


class Stack:
    """The graph-structured stack over one run of rows, begun at one top."""

    def __init__(self, top: int = 0) -> None:
        self.cost, self.order = {top: 0}, {top: 0}  # of each vertex of the last row: cost, and its audit's place among them
        self.links: list[dict[int, tuple[int, str, str]]] = []  # for each row: top -> (top before, edits, roles given)

    def push(self, ways) -> None:
        best: dict[int, tuple[int, int, str]] = {}
        link = {}
        for p, q, cost, edits, roles in ways:
            if p in self.cost:
                way = (self.cost[p] + cost, self.order[p], edits)
                if q not in best or way < best[q]:
                    best[q], link[q] = way, (p, edits, roles)
        self.cost = {q: way[0] for q, way in best.items()}
        self.order = {q: i for i, q in enumerate(sorted(best, key=lambda q: best[q][1:]))}
        self.links.append(link)

    def path(self, top: int) -> list[tuple[str, str]]:
        """(edits, roles given) of each row on the way to ``top``."""
        out = []
        for link in reversed(self.links):
            top, edits, roles = link[top]
            out.append((edits, roles))
        return out[::-1]


def parse(rows, top: int = 0) -> Stack:
    """The stack after rows of (fault, initial)."""
    stack = Stack(top)
    for fault, initial in rows:
        stack.push(actions(fault, initial if initial in "sua" and initial else "-"))
    return stack


# ---- faults ---------------------------------------------------------------------------------------------------

_LEGAL = {"su", "ua", "au"}
_WHITE = " \t\n\v\f\r"


def _judged(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text, tie, digest and fault of every row. ``tie`` numbers rows of a written table."""
    rows = written(turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                                F.coalesce(F.col(text), F.lit(" ")).alias("text")), "turns")
    rows = rows.withColumns({"tie": F.monotonically_increasing_id(), "digest": F.md5(F.col("text").cast("binary"))})
    # the first row of each repeated (conversation, role, text); nulls are least in a struct, so null turns come first
    firsts = rows.groupBy("conv", "role", "digest").agg(F.min(F.struct("turn", "tie")).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = written(firsts.where("n > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"),
                                                  F.col("first.tie").alias("first")), "repeated-turns")
    met = rows.join(checked_broadcast(firsts), F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                    & (F.col("digest") == F.col("d")), "left")
    core = F.expr(f"rtrim('{_WHITE}', text)")
    fault = F.when(core == "", BLANK).when(F.col("first") != F.col("tie"), DUPLICATE) \
        .when(~F.substring(core, -1, 1).isin(".", "!", "?"), CUT).otherwise(NONE)
    return met.select("conv", "turn", "role", "text", "tie", "digest", fault.alias("fault"))


# ---- chunks ---------------------------------------------------------------------------------------------------

def _chunks(rows: DataFrame, chunk: int) -> DataFrame:
    """Rows in order as chunks: conv, chunk (ascending along a conversation), and lists of turns, roles, texts, faults."""
    order = ["conv", "turn", "role", "digest", "tie"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order) \
        .select("conv", "turn", "role", "text", "fault", F.monotonically_increasing_id().alias("seq"))
    out = T.StructType([rows.schema["conv"], *T.StructType.fromDDL("chunk long").fields,
                        T.StructField("turns", T.ArrayType(rows.schema["turn"].dataType)),
                        *T.StructType.fromDDL("roles array<string>, texts array<string>, faults array<int>").fields])
    arrow = to_arrow_schema(out)

    def run(batches):
        conv, held, size = None, [], 0

        def flush():
            turns, roles, texts, faults, seq = zip(*held)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((conv, seq[0], turns, roles, texts, faults), arrow)],
                                              schema=arrow)

        for batch in batches:
            for c, *row in zip(*[x.to_pylist() for x in batch.columns]):
                if held and (c != conv or len(held) >= chunk or size >= CHUNK_BYTES):
                    yield flush()
                    held, size = [], 0
                conv = c
                held.append(row)
                size += len(row[2])
        if held:
            yield flush()

    return ordered.mapInArrow(run, out)


_SUMMARY = ("chunk long, n int, costs array<long>, orders array<int>, first string, last string, illegal long, blank long, "
            "duplicate long, truncated long, least long, most long, distinct long, first_turn long, last_turn long")


def _rows_of(batch: pa.RecordBatch, schema: pa.Schema) -> list[dict]:
    return [dict(zip(schema.names, row)) for row in zip(*[x.to_pylist() for x in batch.columns])]


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)


def _summaries(chunks: DataFrame) -> DataFrame:
    """What the fold needs of each chunk: its matrix, its counts, its border rows."""
    out = T.StructType([chunks.schema["conv"], *T.StructType.fromDDL(_SUMMARY).fields])
    schema = to_arrow_schema(out)
    names = ["conv", "chunk", "turns", "roles", "faults"]

    def summary(c: dict) -> dict:
        initials = [r[:1] for r in c["roles"]]
        rows = list(zip(c["faults"], initials))
        costs, orders = [], []
        for top in STACKS:
            stack = parse(rows, top)
            costs += [stack.cost.get(q, _NEVER) for q in STACKS]
            orders += [stack.order.get(q, 0) for q in STACKS]
        turns = [t for t in c["turns"] if t is not None]
        return {"conv": c["conv"], "chunk": c["chunk"], "n": len(rows), "costs": costs, "orders": orders,
                "first": initials[0], "last": initials[-1], "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),
                "blank": c["faults"].count(BLANK), "duplicate": c["faults"].count(DUPLICATE), "truncated": c["faults"].count(CUT),
                "least": min(turns, default=None), "most": max(turns, default=None), "distinct": len(set(turns)),
                "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None}

    def run(batches):
        for batch in batches:
            yield _batch([summary(dict(zip(names, row))) for row in zip(*[x.to_pylist() for x in batch.columns])], schema)

    return chunks.select(names).mapInArrow(run, out)


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class _Fold:
    """One conversation's summaries, in order: tops between its chunks, and its report."""

    def __init__(self) -> None:
        self.stack, self.chunks = Stack(), []
        self.count = dict.fromkeys(("illegal", "blank", "duplicate", "truncated", "distinct"), 0)
        self.last = self.last_turn = self.least = self.most = None

    def add(self, s: dict) -> None:
        ways = [(p, q, s["costs"][p * N + q], s["orders"][p * N + q], "") for p in STACKS for q in STACKS
                if s["costs"][p * N + q] < _NEVER]
        self.stack.push(ways)  # an order among ways from one top stands for their edits
        self.chunks.append(s["chunk"])
        for k in self.count:
            self.count[k] += s[k]
        self.count["illegal"] += self.last is not None and self.last + s["first"] not in _LEGAL
        self.count["distinct"] -= self.last_turn is not None and self.last_turn == s["first_turn"]
        self.last = s["last"]
        if s["least"] is not None:
            self.last_turn, self.most = s["last_turn"], s["most"]
            self.least = s["least"] if self.least is None else self.least

    def rows(self, conv) -> list[dict]:
        """Of each chunk the tops before and after it; the last one's also has the end's top and the report."""
        ends = Stack()
        ends.cost, ends.order = self.stack.cost, self.stack.order
        ends.push(endings())
        end = min(ends.cost, key=lambda q: (ends.cost[q], ends.order[q]))
        before, _, put = ends.links[0][end]
        tops = [before]
        for link in reversed(self.stack.links):
            tops.append(link[tops[-1]][0])
        tops.reverse()
        none = dict.fromkeys(_COUNTS)
        out = [{"conv": conv, "chunk": c, "before": a, "after": b, "put": None, **none} for c, a, b in zip(self.chunks, tops, tops[1:])]
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.count["distinct"]
        out[-1] |= {"put": put, "gaps": gaps, "cost": ends.cost[end], **{k: self.count[k] for k in _COUNTS if k in self.count}}
        return out


def _folded(summaries: DataFrame) -> DataFrame:
    """conv, chunk, tops ``before`` and ``after`` it; on a conversation's last chunk roles ``put`` at the end, and its report."""
    out = T.StructType([summaries.schema["conv"], *T.StructType.fromDDL(
        "chunk long, before int, after int, put string, gaps long, blank long, duplicate long, truncated long, illegal long, "
        "cost long").fields])
    schema, names = to_arrow_schema(out), to_arrow_schema(summaries.schema)

    def run(batches):
        conv, fold, done = None, None, []
        for batch in batches:
            for s in _rows_of(batch, names):
                if fold is not None and s["conv"] != conv:
                    done += fold.rows(conv)
                    fold = None
                if len(done) >= 5000:
                    yield _batch(done, schema)
                    done = []
                conv, fold = s["conv"], fold or _Fold()
                fold.add(s)
        if fold is not None:
            done += fold.rows(conv)
        if done:
            yield _batch(done, schema)

    return summaries.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(run, out)


def _edits(chunks: DataFrame, folded: DataFrame) -> DataFrame:
    """The edits of every chunk, parsed between its tops."""
    tops = folded.select(F.col("chunk").alias("c"), "before", "after", "put")
    both = chunks.join(tops, F.col("chunk") == F.col("c")).select("conv", "chunk", "turns", "roles", "texts", "faults", "before", "after", "put")
    out = T.StructType([chunks.schema["conv"], *T.StructType.fromDDL("chunk long, place int, edit string").fields,
                        T.StructField("turn", chunks.schema["turns"].dataType.elementType),
                        *T.StructType.fromDDL("role string, text string").fields])
    schema = to_arrow_schema(out)

    def rows(conv, chunk, turns, roles, texts, faults, before, after, put):
        path = parse(zip(faults, [r[:1] for r in roles]), before).path(after)
        made = []
        for turn, role, text, (edits, given) in zip(turns, roles, texts, path):
            given = list(given)
            for e in edits:
                now = ROLES[given.pop(0)] if e in "IR" else None if e == "D" else role
                made.append((e, None if e == "I" else turn, now, "" if e == "I" else None if e == "D" else text))
        made += [("I", None, ROLES[r], "") for r in put or ""]
        return [{"conv": conv, "chunk": chunk, "place": i, "edit": e, "turn": t, "role": r, "text": x} for i, (e, t, r, x) in enumerate(made)]

    def run(batches):
        for batch in batches:
            done = []
            for row in zip(*[x.to_pylist() for x in batch.columns]):
                done += rows(*row)
                if len(done) >= CHUNK:
                    yield _batch(done, schema)
                    done = []
            if done:
                yield _batch(done, schema)

    return both.mapInArrow(run, out)


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(edits, report), both written.

    edits: conv, (chunk, place) in order, edit (K, R, D or I), turn (null where inserted), and the role and text of the
    turn that it leaves (null where deleted). report: conv, gaps, blank, duplicate, truncated, illegal, cost.
    """
    chunks = written(_chunks(_judged(turns, conv, turn, role, text), chunk), "turn-chunks")
    folded = written(_folded(_summaries(chunks)), "folded-chunks")
    edits = written(_edits(chunks, folded), "turn-edits")
    return edits, folded.where("cost IS NOT NULL").select("conv", *_COUNTS)


def digests(edits: DataFrame) -> DataFrame:
    """conv, audit (the edits' initials) and repaired_sha256 (of the repaired ``role:text``, joined by newlines).

    Edits stream through in order, so a long conversation's texts are never held together.
    """
    out = T.StructType([edits.schema["conv"], *T.StructType.fromDDL("audit string, repaired_sha256 string").fields])
    schema = to_arrow_schema(out)

    def run(batches):
        conv, audit, digest, some, done = None, [], None, False, []
        for batch in batches:
            for c, edit, role, text in zip(*[x.to_pylist() for x in batch.columns]):
                if digest is not None and c != conv:
                    done.append({"conv": conv, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()})
                    digest = None
                if digest is None:
                    conv, audit, digest, some = c, [], hashlib.sha256(), False
                audit.append(edit)
                if edit != "D":
                    digest.update(f"{chr(10) * some}{role}:{text}".encode())
                    some = True
            if done:
                yield _batch(done, schema)
                done = []
        if digest is not None:
            yield _batch([{"conv": conv, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], schema)

    ordered = edits.repartition("conv").sortWithinPartitions("conv", "chunk", "place")
    return ordered.select("conv", "edit", "role", "text").mapInArrow(run, out)
