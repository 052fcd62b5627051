"""Hierarchical multi-length packing of tokenised documents.

Windows of the longest context are cut off long documents first. What is left of each document is routed to
the smallest context size (tier) that holds it. Tiers are packed from the longest down: a window starts with a
piece of its tier, and its gap is filled from shorter tiers, by the longest piece that fits, or else by cutting
the shortest piece that does not; the rest of a cut piece is routed again. So every window is filled to its
size, a power of two, and only the last one of a task is padded. Sequences are then dealt to step groups,
always to the group with the fewest tokens, from the longest tier down.

Documents are tokenised and packed in the task that reads them, ``GROUP`` tokens at a time, so nothing is
shuffled and memory is bounded; pieces of an unfinished window go on to the next group of the task.

Defined results: a null or empty text is a document of its end token alone; repeated rows and repeated or null
ids are documents of their own; an empty table gives an empty result. Sequence ids are unique, not dense: they
hold the task's number in their upper bits.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import spans
from .wordpieces import encoder, turns

TIERS = (2048, 1024, 512, 256)
#: Tokens packed together, tokens of a step, and the end-of-document id.
GROUP, STEP, END_ID = 1_000_000, 65_536, 1
PIECES = ("start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, "
          "step_id long")

Piece = tuple[int, int, int]  # document, start, length


class _Shelf:
    """Pieces by length, with the lengths in stock as the bits of one number."""

    def __init__(self) -> None:
        self.by_length: dict[int, list[Piece]] = {}
        self.stock = 0

    def put(self, piece: Piece) -> None:
        self.by_length.setdefault(piece[2], []).append(piece)
        self.stock |= 1 << piece[2]

    def _take(self, length: int) -> Piece:
        pieces = self.by_length[length]
        piece = pieces.pop()
        if not pieces:
            self.stock &= ~(1 << length)
        return piece

    def longest(self, most: int) -> Piece | None:
        there = self.stock & ((1 << most + 1) - 1)
        return self._take(there.bit_length() - 1) if there else None

    def shortest_over(self, length: int) -> Piece | None:
        there = self.stock >> length + 1
        return self._take((there & -there).bit_length() + length) if there else None


def pack_pieces(lengths: Sequence[int], carried: Sequence[Piece] = (), tiers: Sequence[int] = TIERS
                ) -> tuple[list[list[Piece]], list[Piece]]:
    """Full sequences of the documents 0.. with these lengths and of carried pieces; pieces left over.

    What is left over is shorter than the smallest tier.
    """
    top, shelf, full = tiers[0], _Shelf(), []
    for piece in carried:
        shelf.put(piece)
    for doc, n in enumerate(lengths):
        full.extend([(doc, at, top)] for at in range(0, n - top + 1, top))
        if n % top:
            shelf.put((doc, n - n % top, n % top))
    left = sum(k * len(v) for k, v in shelf.by_length.items())
    for tier, below in zip(tiers, [*tiers[1:], 0]):
        while left >= tier and (below == 0 or shelf.stock >> below + 1):
            window, gap = [], tier
            while gap:
                piece = shelf.longest(gap)
                if piece is None:
                    doc, start, length = shelf.shortest_over(gap)
                    shelf.put((doc, start + gap, length - gap))
                    piece = (doc, start, gap)
                window.append(piece)
                gap -= piece[2]
            full.append(window)
            left -= tier
    return full, [p for pieces in shelf.by_length.values() for p in pieces]


def _steps(sizes: Sequence[int], step: int) -> list[int]:
    """A step group for each sequence: the one with the fewest tokens so far, longest sequences first."""
    heap = [(0, k) for k in range(-(-sum(sizes) // step))]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        tokens, k = heap[0]
        heapq.heapreplace(heap, (tokens + sizes[i], k))
        out[i] = k
    return out


def pack(docs: DataFrame, definition: str, keep: Sequence[str] = ("doc_id",), text: str = "text",
         tiers: Sequence[int] = TIERS, group: int = GROUP, step: int = STEP, end_id: int = END_ID) -> DataFrame:
    """A row for each piece: ``keep`` columns of its document and a struct ``__found`` of PIECES.

    ``definition`` is the tokenizer's JSON. ``ids`` are the piece's token ids, little-endian unsigned 32-bit.
    Pieces of a sequence have adjoining offsets from 0; ``tier`` is the context size the sequence is padded to.
    """
    sent = docs.sparkSession.sparkContext.broadcast(definition)
    kept = [f for c in keep for f in docs.schema.fields if f.name == c]
    out = T.StructType([*kept, T.StructField("__found", T.StructType.fromDDL(PIECES))])
    arrow = to_arrow_schema(out)
    kinds = arrow.field("__found").type
    end = end_id.to_bytes(4, "little")

    def run(batches) -> Iterator[pa.RecordBatch]:
        encode = encoder(sent.value).encode_column
        task = TaskContext.get().partitionId() << 36
        sequences = steps = 0

        def flush(ids, columns, carried, last):
            nonlocal sequences, steps
            full, rest = pack_pieces([len(x) // 4 for x in ids[len(carried):]],
                                     [(i - len(carried), s, n) for i, (s, n) in enumerate(carried)], tiers)
            if last and rest:
                full.append(rest)
                rest = []
            group_of = _steps([sum(p[2] for p in w) for w in full], step)
            rows = [[] for _ in kinds]
            take = []
            for k, window in enumerate(full):
                offset, size = 0, sum(p[2] for p in window)
                tier = size if size in tiers else tiers[0]
                for doc, start, n in window:
                    doc += len(carried)
                    take.append(doc)
                    for column, value in zip(rows, (start, n, ids[doc][4 * start:4 * (start + n)], len(ids[doc]) // 4,
                                                    task + sequences + k, offset, tier, task + steps + group_of[k])):
                        column.append(value)
                    offset += n
            sequences += len(full)
            steps += 1 + max(group_of, default=-1)
            batch = None
            if take:
                found = pa.StructArray.from_arrays([pa.array(x, k.type) for x, k in zip(rows, kinds)], fields=list(kinds))
                batch = pa.RecordBatch.from_arrays([*[c.take(pa.array(take)) for c in columns], found], names=arrow.names)
            docs_left = [doc + len(carried) for doc, _, _ in rest]
            return batch, ([ids[d] for d in docs_left], [c.take(pa.array(docs_left, pa.int64())) for c in columns],
                           [(s, n) for _, s, n in rest])

        ids: list[bytes] = []
        parts: list[list[pa.Array]] = [[pa.array([], f.type)] for f in list(arrow)[:-1]]
        carried: list[tuple[int, int]] = []
        held = 0
        for batch in batches:
            texts = spans.Text(batch.column(0))
            for lo, hi in turns(np.diff(texts.at).tolist(), 2 * spans.BLOCK):
                new = [x.tobytes() + end for x in encode(texts.rows(lo, hi))]
                ids += new
                held += sum(map(len, new)) // 4
                for part, column in zip(parts, batch.columns[1:]):
                    part.append(column.slice(lo, hi - lo))
                if held >= group:
                    made, (ids, columns, carried) = flush(ids, [pa.concat_arrays(p) for p in parts], carried, False)
                    parts, held = [[c] for c in columns], 0
                    if made is not None:
                        yield made
        if ids:
            made, _ = flush(ids, [pa.concat_arrays(p) for p in parts], carried, True)
            yield made
        spans.release()

    return docs.select(F.col(text).alias("__text"), *[F.col(f.name) for f in kept]).mapInArrow(run, out)
