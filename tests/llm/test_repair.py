import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tarnlake.llm import conversation_repair as repair
from tarnlake.llm.queries import QUERIES, damaged

LEGAL = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, edit string, place int, conv string"


def judged(rows):
    """(fault, role, text) in order of one conversation's (turn, role, text)."""
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    rows = sorted(((t is not None, t or 0, r, md5(x), x) for t, r, x in rows))
    seen, out = set(), []
    for _, _, r, _, x in rows:
        core = x.strip(" \t\n\v\f\r")
        fault = "blank" if not core else "duplicate" if (r, x) in seen else "truncated" if core[-1] not in ".!?" else ""
        seen.add((r, x))
        out.append((fault, r, x))
    return out


def cheapest(rows):
    """(cost, audit, repaired): Dijkstra's idea over all rows, states being the roles so far cut to what the grammar needs."""
    def after(state, role):  # role sequences that can still become legal, by what they end with
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, role))

    best = {"": (0, "", ())}

    def put(into, state, way):
        if state is not None and (state not in into or way < into[state]):
            into[state] = way

    def with_inserts(now):
        for _ in range(3):
            for state, (c, a, out) in list(now.items()):
                for role in ("user", "assistant"):
                    put(now, after(state, role[0]), (c + 5, a + "I", (*out, f"{role}:")))
        return now

    for fault, role, text in rows:
        new = {}
        for state, (c, a, out) in with_inserts(best).items():
            put(new, state, (c + 2, a + "D", out))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                put(new, after(state, role[:1]), (c + more, a + "K", (*out, f"{role}:{text}")))
                for r in ("user", "assistant"):
                    put(new, after(state, r[0]), (c + more + 1, a + "R", (*out, f"{r}:{text}")))
        best = new
    best = with_inserts(best)
    return min(best[s] for s in ("", "a") if s in best)


def exhaustive(rows, most=2):
    """(cost, audit, repaired) by trying every sequence of edits with up to ``most`` inserts at a place."""
    found = []
    puts = [p for n in range(most + 1) for p in itertools.product(("user", "assistant"), repeat=n)]
    ways = []
    for fault, role, text in rows:
        mine = [(2, "D", ())]
        if fault not in ("blank", "duplicate"):
            more = 5 * (fault == "truncated")
            mine += [(more, "K", ((role, text),)), *[(more + 1, "R", ((r, text),)) for r in ("user", "assistant")]]
        ways.append([(5 * len(p) + c, "I" * len(p) + e, (*[(r, "") for r in p], *out)) for p in puts for c, e, out in mine])
    ways.append([(5 * len(p), "I" * len(p), tuple((r, "") for r in p)) for p in puts])
    for path in itertools.product(*ways):
        out = [x for _, _, o in path for x in o]
        if all(r[:1] and r[:1] in "sua" for r, _ in out) and LEGAL.match("".join(r[0] for r, _ in out)):
            found.append((sum(c for c, _, _ in path), "".join(e for _, e, _ in path), tuple(f"{r}:{x}" for r, x in out)))
    return min(found)


def expected(conv, rows):
    turns = [t for t, _, _ in rows if t is not None]
    faults = judged(rows)
    cost, audit, out = cheapest(faults)
    initials = [r[:1] for _, r, _ in faults]
    count = lambda f: sum(x[0] == f for x in faults)
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"), count("duplicate"), count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


TEXTS = ["Fine.", "Fine. ", "cut", "", " \n", "What?", "Yes!", "no end\t", "é。", " "]
ROLES = ["user", "user", "user", "assistant", "assistant", "assistant", "system", "tool", " ", "", "sys", "Assistant"]


def conversations(n, longest, seed):
    r = random.Random(seed)
    return {i: [(r.choice([None, *range(longest)]), r.choice(ROLES), r.choice(TEXTS) if r.random() < 0.6 else f"{r.random()}.")
                for _ in range(r.randrange(1, longest + 1))] for i in range(n)}


def found(spark, table, **kw):
    rows = [(c, t, r, x, "e", 1, "c") for c, mine in table.items() for t, r, x in mine]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(3)
    edits, report = repair.repair(turns, **kw)
    both = report.join(repair.digests(edits).withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c")))
    return sorted(map(tuple, both.drop("c").collect()), key=str)


def test_reference_agrees_with_trying_all_edits():
    for rows in conversations(60, 3, 5).values():
        assert cheapest(judged(rows)) == exhaustive(judged(rows))


@pytest.mark.parametrize("chunk", [1, 3, 2000])
def test_equals_a_search_over_all_edits(spark, chunk):
    table = conversations(60, 9, 7) | {1000: conversations(1, 400, 8)[0], None: conversations(1, 12, 9)[0]}
    assert found(spark, table, chunk=chunk) == sorted((expected(c, rows) for c, rows in table.items()), key=str)


def test_edits_are_the_repaired_conversation(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "user", "Well then."), (1, 3, "assistant", "cut off"),
            (1, 4, "user", "Bye."), (1, 5, "assistant", "Bye.")]
    edits, report = repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    left = [(r.edit, r.turn, r.role, r.text) for r in edits.orderBy("chunk", "place").collect()]
    assert left == [("K", 0, "system", "Be kind."), ("K", 1, "user", "Hello?"), ("R", 2, "assistant", "Well then."),
                    ("D", 3, None, None), ("K", 4, "user", "Bye."), ("K", 5, "assistant", "Bye.")]
    assert report.select("cost", "truncated", "illegal").collect() == [(3, 1, 1)]


def test_null_and_long_rows_and_empty_table(spark):
    rows = [(None, None, None, None), (None, None, None, None), (1, 0, "user", "long " * 50_000 + "."), (1, 1, "assistant", None), (2, 1, None, "x.")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    edits, report = repair.repair(turns)
    table = {}
    for c, t, r, x in rows:
        table.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    both = report.join(repair.digests(edits).withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    assert sorted(map(tuple, both.collect()), key=str) == sorted((expected(c, r) for c, r in table.items()), key=str)
    edits, report = repair.repair(turns.limit(0))
    assert edits.count() == report.count() == 0 and repair.digests(edits).count() == 0


def damage(rows):
    for c, t, r, x in rows:
        c, t, r, x = (" " if v is None else v for v in (c, t, r, x))
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        if kind == 1:
            x = ""
        elif kind == 2:
            x = re.sub("[.!?]", "", x)
        elif kind == 4:
            r = "user"
        if kind:
            yield from [(c, t, r, x)] * (1 + (kind == 3))


def test_query_equals_the_search_on_the_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left = list(damage(rows))
    assert sorted(left) == sorted(map(tuple, damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()))
    want = []
    for conv in {c for c, *_ in rows}:
        mine = [(t, r, x) for c, t, r, x in left if c == conv]
        want.append(expected(conv, mine) if mine else (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))
    assert sorted(map(tuple, QUERIES["op12_conversation_repair"](spark, sf).collect())) == sorted(want)
