"""Transcript parsing by a hidden Markov model over lines, and canonical rendering of the turns it recovers.

A transcript is a conversation's records in order, cut into lines. The model's states are (role, begins a turn) and
(role, goes on); a line's features are its speaker marker, whether it starts a record, its length, how many lines
follow in the record, and how it ends. Transitions and emissions are counted from records whose role is known;
the role column is used for nothing else. Viterbi paths are found on integer log probabilities (millionths).

A conversation of any length is decoded in pieces: records are sorted over all tasks by range, and runs of at most
``CHUNK`` lines become chunks. A chunk's best scores between each state before it and each state at its end form a
small max-plus matrix. Scanning these matrices forwards and then backwards fixes the states at chunk borders, and
each chunk is decoded alone between them, which gives the same path as one Viterbi run.

Each run of lines of a record that belongs to one turn becomes a row: its role, whether it begins a turn, its lines
without a marker of that role, and its canonical form, ``<|role|>`` on a line of its own before the text if it begins a turn. Rows
in (turn, place, piece) order, joined by newlines, are the rendered conversation.

Defined results: a null or empty text is one empty line; a null turn comes first; ties of turn are ordered by text,
then repeated rows stay side by side; null ids form one conversation; a null role teaches nothing. Without any known
role the role is null and every record begins a turn; more than ``ROLES`` known roles raise an error. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import spans  # noqa: F401  (also sees to it that this package's functions travel by value)
from .tables import written

CHUNK = 2000
#: Known roles that the model takes at most; more are refused.
ROLES = 32
#: Speaker markers and the kinds they are told apart by.
MARKERS = {"user": 1, "human": 1, "customer": 1, "question": 1, "q": 1,
           "assistant": 2, "ai": 2, "bot": 2, "agent": 2, "answer": 2, "a": 2, "system": 3, "instructions": 3}
_MARKER = re.compile(r"\s*[\[<*#|]*\s*(" + "|".join(MARKERS) + r")\s*[\]>*|]*\s*:\s*", re.IGNORECASE)
#: Values of each feature: marker, starts a record, words, lines after it in the record, ending.
SIZES = (4, 2, 8, 4, 4)
_AT = np.cumsum([0, *SIZES])
_NEVER = -(1 << 50)


def features(line: str, place: int, n_lines: int) -> tuple[int, ...]:
    """Index of each feature's value among all values."""
    marker = _MARKER.match(line)
    words = min(7, len(line.split()).bit_length())
    ending = {"?": 1, ".": 2, ":": 3}.get(line.rstrip()[-1:], 0)
    values = (MARKERS[marker[1].lower()] if marker else 0, int(place == 0), words, min(3, n_lines - place - 1), ending)
    return tuple(int(a) + v for a, v in zip(_AT, values))


# ---- chunks -----------------------------------------------------------------------------------------------

def _chunks(rows: DataFrame, chunk: int) -> DataFrame:
    """Ordered records as chunks: conv, chunk (ascending along a conversation), records, roles, texts."""
    order = ["conv", "turn", "text", "tie"]
    sorted_rows = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order) \
        .sortWithinPartitions(*order).withColumn("seq", F.monotonically_increasing_id())
    out = T.StructType([rows.schema["conv"], *T.StructType.fromDDL("chunk long").fields,
                        T.StructField("turns", T.ArrayType(rows.schema["turn"].dataType)),
                        *T.StructType.fromDDL("roles array<string>, texts array<string>").fields])
    arrow = to_arrow_schema(out)

    def run(batches):
        conv, held, lines = None, [], 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip((conv, held[0][0], *[[r[i] for r in held] for i in (1, 2, 3)]), arrow)],
                names=arrow.names)

        for batch in batches:
            for c, *record in zip(*[x.to_pylist() for x in batch.columns]):
                n = (record[3] or "").count("\n") + 1
                if held and (c != conv or lines + n > chunk):
                    yield flush()
                    held, lines = [], 0
                conv = c
                held.append(record)
                lines += n
        if held:
            yield flush()

    return sorted_rows.select("conv", "seq", "turn", "role", "text").mapInArrow(run, out)


# ---- the model --------------------------------------------------------------------------------------------

class Hmm:
    """start, move[from, to] and emit[state, feature value]; states 2k and 2k + 1 are role k beginning and going on."""

    def __init__(self, roles: Sequence[str], counts: np.ndarray) -> None:
        """counts: rows are states, and last the start; columns are the states moved to, then feature values."""
        self.roles, s = list(roles), 2 * len(roles)
        self.states = s
        move = counts[:, :s] + 0.1
        self.move = self._logs(move / move.sum(axis=1, keepdims=True)) if s else np.zeros((1, 0), np.int64)
        seen = counts[:s, s:] + 0.1
        for a, b in zip(_AT[:-1], _AT[1:]):
            seen[:, a:b] /= seen[:, a:b].sum(axis=1, keepdims=True)
        self.emit = self._logs(seen)

    @staticmethod
    def _logs(p: np.ndarray) -> np.ndarray:
        return np.rint(1e6 * np.log(p)).astype(np.int64)

    def emissions(self, texts: Sequence[str | None]) -> np.ndarray:
        """Score of each line in each state."""
        lines = [features(x, i, len(part)) for t in texts for part in [(t or "").split("\n")] for i, x in enumerate(part)]
        return self.emit[:, np.array(lines)].sum(axis=2).T

    def matrix(self, texts: Sequence[str | None]) -> np.ndarray:
        """Best score from each state before the lines (last: the start) to each state of the last line."""
        emissions = self.emissions(texts)
        best = self.move + emissions[0]
        for e in emissions[1:]:
            best = (best[:, :, None] + self.move[None, :-1, :]).max(axis=1) + e
        return best

    def path(self, texts: Sequence[str | None], before: int, last: int) -> list[int]:
        """The best states of the lines between a state before them and the state of the last line."""
        emissions = self.emissions(texts)
        best, back = self.move[before] + emissions[0], []
        for e in emissions[1:]:
            step = best[:, None] + self.move[:-1]
            back.append(step.argmax(axis=0))
            best = step.max(axis=0) + e
        states = [last]
        for b in reversed(back):
            states.append(int(b[states[-1]]))
        return states[::-1]


def fit(chunks: DataFrame, learns: Column, n_roles: int = ROLES) -> Hmm:
    """The model of the chunks that ``learns`` holds for. Counts cover all their records, and all their roles."""
    known = chunks.where(learns)
    names = known.select(F.explode("roles").alias("role")).where("role IS NOT NULL").distinct().limit(n_roles + 1).collect()
    if len(names) > n_roles:
        raise ValueError(f"more than {n_roles} known roles; map them to fewer")
    roles = sorted(r[0] for r in names)
    s, width = 2 * len(roles), 2 * len(roles) + int(_AT[-1])
    number = {r: 2 * k for k, r in enumerate(roles)}

    def count(batches):
        """Sums of a task; and where its chunks begin and end, for the moves from one chunk to the next."""
        total = np.zeros((s + 1, width), np.int64)
        for batch in batches:
            for role_list, texts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                state = None
                for role, text in zip(role_list, texts):
                    lines = (text or "").split("\n")
                    if role not in number:
                        state = None
                        continue
                    for i, line in enumerate(lines):
                        now = number[role] + (i > 0)
                        if state is not None:
                            total[state, now] += 1
                        total[now, [s + f for f in features(line, i, len(lines))]] += 1
                        state = now
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], names=["cell", "n"])

    total = np.zeros((s + 1) * width)
    for cell, n in known.select("roles", "texts").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():
        total[cell] = n
    total = total.reshape(s + 1, width)
    # moves between a chunk's last line and the next chunk's first, and the starts of conversations
    ends = known.select("conv", "chunk", F.element_at("roles", 1).alias("first"), F.element_at("roles", -1).alias("last"),
                        F.instr(F.element_at("texts", -1), "\n").alias("more"))
    nxt = _next_in_conversation(ends)
    for first, last, more, n in nxt.groupBy("first", "last", "more").count().collect():
        if first in number:
            if more is None:
                total[s, number[first]] += n
            elif last in number:
                total[number[last] + more, number[first]] += n
    return Hmm(roles, total)


def _next_in_conversation(ends: DataFrame) -> DataFrame:
    """first of each chunk, with last and more (0 or 1) of the chunk before it; both null at a start."""
    def run(batches):
        conv, last = object(), None
        for batch in batches:
            out = []
            for c, first, final, more in zip(*[x.to_pylist() for x in batch.columns]):
                same = c == conv
                out.append((first, last[0] if same else None, last[1] if same else None))
                conv, last = c, (final, int((more or 0) > 0))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.string()),
                                              pa.array([r[2] for r in out], pa.int32())], names=["first", "last", "more"])

    return ends.repartition("conv").sortWithinPartitions("conv", "chunk") \
        .select("conv", "first", "last", "more").mapInArrow(run, "first string, last string, more int")


# ---- decoding ---------------------------------------------------------------------------------------------

def _borders(chunks: DataFrame, model: Hmm) -> DataFrame:
    """chunk, before and last: the best path's states around each chunk. Scans hold one vector at a time."""
    s, conv_type = model.states, chunks.schema["conv"]
    some = T.StructType([conv_type, *T.StructType.fromDDL("chunk long, matrix array<long>, alpha array<long>").fields])
    start = [_NEVER] * s + [0]

    def matrices(batches):
        for batch in batches:
            m = [model.matrix(t).ravel().tolist() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(m, pa.list_(pa.int64())),
                                              pa.array([[]] * len(m), pa.list_(pa.int64()))], names=some.names)

    def forwards(batches):
        conv, alpha = object(), None
        for batch in batches:
            out = []
            for c, m in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if c != conv:
                    conv, alpha = c, start
                out.append(list(alpha))
                best = (np.array(alpha)[:, None] + np.array(m).reshape(s + 1, s)).max(axis=0)
                alpha = [*best.tolist(), _NEVER]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.list_(pa.int64()))], names=some.names)

    def backwards(batches):
        conv, state = object(), None
        for batch in batches:
            out = []
            for c, m, a in zip(*[batch.column(i).to_pylist() for i in (0, 2, 3)]):
                paths = np.array(a)[:, None] + np.array(m).reshape(s + 1, s)
                last = int(paths.max(axis=0).argmax()) if c != conv else state
                conv, state = c, int(paths[:, last].argmax())
                out.append((state, last))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([x[0] for x in out], pa.int32()),
                                              pa.array([x[1] for x in out], pa.int32())], names=["chunk", "before", "last"])

    scored = chunks.select("conv", "chunk", "texts").mapInArrow(matrices, some).repartition("conv")
    ahead = scored.sortWithinPartitions("conv", "chunk").mapInArrow(forwards, some)
    return ahead.sortWithinPartitions("conv", F.desc("chunk")).mapInArrow(backwards, "chunk long, before int, last int")


def without_marker(line: str, role: str | None) -> str:
    """A turn's first line without its speaker marker, if that is a marker of the turn's role; another's is content."""
    found = _MARKER.match(line)
    name = (role or "").strip().lower()
    if not found or MARKERS[found[1].lower()] != MARKERS.get(name):
        return line
    return line[found.end():]


def pieces(texts: Sequence[str | None], states: Sequence[int], roles: Sequence[str]):
    """record, piece, role, whether it begins a turn, text and rendered form."""
    at = 0
    for r, text in enumerate(texts):
        lines = (text or "").split("\n")
        of = states[at:at + len(lines)] if len(roles) else [0, *[1] * (len(lines) - 1)]
        at += len(lines)
        cuts = [0, *[i for i in range(1, len(lines)) if of[i] % 2 == 0 or of[i] // 2 != of[i - 1] // 2], len(lines)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            begins = k > 0 or of[a] % 2 == 0
            part = lines[a:b]
            role = roles[of[a] // 2] if len(roles) else None
            if begins:
                part = [without_marker(part[0], role), *part[1:]]
            body = "\n".join(part)
            yield r, k, role, begins, body, f"<|{role or 'unknown'}|>\n{body}" if begins else body


def parse(records: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
          learns: Column | None = None, chunk: int = CHUNK) -> DataFrame:
    """A row for each piece: conv, turn, place (of the record, ascending along the conversation), piece, role, begins,
    text, rendered.

    ``learns``, over the column ``conv``, picks the conversations whose roles are learnt from; by default all.
    """
    rows = records.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"),
                          F.col(text).alias("text"))
    chunks = written(_chunks(rows, chunk), "chunks")
    model = fit(chunks, F.lit(True) if learns is None else learns)
    if model.states:
        ready = chunks.join(_borders(chunks, model), "chunk")
    else:
        ready = chunks.withColumns({"before": F.lit(0), "last": F.lit(0)})
    out = T.StructType([chunks.schema["conv"], rows.schema["turn"], *T.StructType.fromDDL(
        "place long, piece int, role string, begins boolean, text string, rendered string").fields])
    arrow = to_arrow_schema(out)

    def run(batches):
        for batch in batches:
            rows = []
            for c, chunk, turns, texts, before, last in zip(*[x.to_pylist() for x in batch.columns]):
                states = model.path(texts, before, last) if model.states else []
                rows += [(c, turns[r], chunk + r, k, *rest) for r, k, *rest in pieces(texts, states, model.roles)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], names=arrow.names)

    return ready.select("conv", "chunk", "turns", "texts", "before", "last").mapInArrow(run, out)
