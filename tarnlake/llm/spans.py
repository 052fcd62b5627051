"""Words and hashes of whole Arrow batches of text, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of text handled at once; a longer text is a block of its own.
BLOCK = 1 << 20
#: Separators of the two word definitions: white space, and all ASCII but letters and digits.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_ALNUM = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)

_U = np.uint64
_BYTE = np.random.default_rng(20).integers(0, 2**64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15


def per_process(name: str) -> dict:
    """A dictionary that lives as long as the Python process, across the tasks that it runs."""
    store = sys.modules.setdefault("_kept_between_tasks", types.ModuleType("_kept_between_tasks"))
    return store.__dict__.setdefault(name, {})


def release() -> None:
    """Gives freed memory back to the system; the process may serve other tasks for long."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64."""
    kept = per_process("powers")
    if len(kept.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            kept[name] = np.concatenate([[_U(1)], np.full(size - 1, base, np.uint64)]).cumprod(dtype=np.uint64)
    return kept["up"][:n], kept["down"][:n]


class Text:
    """The strings of a column as one byte array; null counts as empty."""

    def __init__(self, column: pa.Array) -> None:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column.cast(pa.large_string()), "")
        _, ends, data = column.buffers()
        self.at = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
        self.data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.data, self.at = self.data[self.at[0]:self.at[-1]], self.at - self.at[0]

    def __len__(self) -> int:
        return len(self.at) - 1

    def rows(self, lo: int, hi: int) -> Text:
        """The rows from lo to before hi."""
        part = object.__new__(Text)
        part.data, part.at = self.data[self.at[lo]:self.at[hi]], self.at[lo:hi + 1] - self.at[lo]
        return part

    def strings(self) -> list[str]:
        raw = self.data.tobytes()
        return [raw[a:b].decode() for a, b in zip(self.at[:-1].tolist(), self.at[1:].tolist())]

    def blocks(self, most: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, row after the last, bytes, offsets) of runs of rows of at most ``most`` bytes or one row."""
        lo = 0
        while lo < len(self):
            hi = max(lo + 1, int(np.searchsorted(self.at, self.at[lo] + most, "right")) - 1)
            yield lo, hi, self.data[self.at[lo]:self.at[hi]], self.at[lo:hi + 1] - self.at[lo]
            lo = hi


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that do not cross the offsets ``at``."""
    n = len(inside)
    before, after = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    before[1:], after[:-1] = inside, inside
    before[at], after[at] = False, False
    return np.flatnonzero(inside & ~before[:-1]), np.flatnonzero(inside & ~after[1:]) + 1


def running(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums of 64-bit values, from which ``between`` hashes any stretch of them."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(len(values) + 1)[0][:len(values)], out=total[1:])
    return total


def between(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the stretches from ``starts`` to before ``ends``."""
    return mix((total[ends] - total[starts]) * _powers(len(total))[1][starts] + mix((ends - starts).astype(np.uint64)))


def without_one(total: np.ndarray, starts: np.ndarray, ends: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``between`` as it would be if the value at ``gone`` were not there."""
    down = _powers(len(total) + 1)[1]
    left = (total[gone] - total[starts]) * down[starts] + (total[ends] - total[gone + 1]) * down[starts + 1]
    return mix(left + mix((ends - starts - 1).astype(np.uint64)))


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans."""
    return between(running(_BYTE[data]), starts, ends)


def row_of(at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row of each span, and for each row the index of its first span (one more at the end)."""
    first = np.searchsorted(starts, at)
    return np.repeat(np.arange(len(at) - 1), np.diff(first)), first


def ngram_hash(words: np.ndarray, first: np.ndarray, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n consecutive words at each word, and whether these lie in one row."""
    keys = mix(np.arange(1, n + 1, dtype=np.uint64) * _U(_BASE) + _U(seed)) | _U(1)
    out = np.zeros(len(words), np.uint64)
    whole = np.zeros(len(words), bool)
    if len(words) >= n:
        out[:len(words) - n + 1] = sum(words[k:len(words) - n + 1 + k] * keys[k] for k in range(n))
        whole[:len(words) - n + 1] = True
        for k in range(1, n):
            ends = first[1:] - k
            whole[ends[ends >= first[:-1]]] = False
    return mix(out), whole


def signed(x: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as Spark longs, bit by bit."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def per_text(df: DataFrame, fn: Callable[..., list], ddl: str, keep: Sequence[str], name: str = "__found",
             text: str = "text", also: Sequence[str] = ()) -> DataFrame:
    """The columns ``keep`` and a struct column ``name`` that ``fn`` makes of each row's text.

    Results stand in a struct, so that input columns of the same names do no harm. ``fn`` gets a
    batch of texts, and of the columns ``also``, and returns one array for each field of ``ddl``, in that order.
    """
    kept = [f for c in keep for f in df.schema.fields if f.name == c]
    out = T.StructType([*kept, T.StructField(name, T.StructType.fromDDL(ddl))])
    arrow = to_arrow_schema(out)
    kinds, n = arrow.field(name).type, len(also)

    def run(batches):
        for batch in batches:
            made = [pa.array(x, kinds[i].type) if not isinstance(x, pa.Array) else x.cast(kinds[i].type)
                    for i, x in enumerate(fn(Text(batch.column(0)), *batch.columns[1:1 + n]))]
            found = pa.StructArray.from_arrays(made, fields=list(kinds))
            yield pa.RecordBatch.from_arrays([*batch.columns[1 + n:], found], names=arrow.names)
        pa.default_memory_pool().release_unused()  # the process may serve other tasks for long

    columns = [F.col(text).alias("__text"), *[F.col(c).alias(f"__also{i}") for i, c in enumerate(also)]]
    return df.select(*columns, *[F.col(f.name) for f in kept]).mapInArrow(run, out)
