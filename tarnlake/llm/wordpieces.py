"""Words and token ids of whole texts with a word-splitting public tokenizer."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from . import spans
from .spans import per_process

#: How the tokenizer splits lower-cased text of the characters in _PLAIN. Fixed values of the vocabulary file.
_PIECE = re.compile(r"[a-zß-öø-ÿœ]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\sa-z0-9ß-öø-ÿœ]+")
#: Other characters, and the marker of special tokens, take the tokenizer's own path.
_PLAIN = "\t\n\r -~À-ÿŒœ–—‘’“”…€"
_OTHER = re.compile(f"[^{_PLAIN}]")
_PLAIN_BYTES = bytes(b for b in range(256) if _OTHER.match(chr(b)) is None)
_WORD_END = "</w>"
_SPACE = re.compile(r"\s")
#: Words remembered, and characters taken at once.
CACHE, SLICE = 80_000, 1 << 20
#: Places of the encoder's table of words (a power of two), and the ids that they have room for.
PLACES, KEPT_IDS = 1 << 19, 1 << 21
#: Bytes of text encoded at once, so that the powers for hashing have no more than 2^19 places.
ENCODED = (1 << 19) - 1024


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """Parts of a text, cut only before white space, which no token crosses."""
    at = 0
    while len(text) - at > size:
        cut = _SPACE.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def turns(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items whose sizes come to ``most`` or little over."""
    lo = held = 0
    for i, size in enumerate(sizes, 1):
        held += size
        if held >= most:
            yield lo, i
            lo, held = i, 0
    if lo < len(sizes):
        yield lo, len(sizes)


def plain(text: str) -> bool:
    """Whether _PIECE splits the text as the tokenizer does."""
    if "<|" in text:
        return False
    try:
        return not text.encode("latin-1").translate(None, _PLAIN_BYTES)
    except UnicodeEncodeError:
        return _OTHER.search(text) is None


class Splitter:
    """Words of a text as the tokenizer normalises and splits it."""

    def __init__(self, definition: str) -> None:
        self.tokenizer = Tokenizer.from_str(definition)

    def words(self, text: str) -> Iterator[list[str]]:
        """The words, in lists of bounded length."""
        for part in slices(text):
            if plain(part):
                yield _PIECE.findall(part.lower())
            else:  # the tokenizer's own steps; special tokens are ordinary text here
                normal = self.tokenizer.normalizer.normalize_str(part)
                yield [normal[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]


def _byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """Class of each ASCII byte (0 space, 1 letter, 2 digit, 3 sign) and whether it is a plain character."""
    kind = np.full(256, 3, np.int8)
    kind[[0x09, 0x0A, 0x0D, 0x20]] = 0
    kind[[b for b in range(128) if chr(b).isalpha()]] = 1
    kind[[b for b in range(128) if chr(b).isdigit()]] = 2
    return kind, np.array([b < 0x80 and b in _PLAIN_BYTES for b in range(256)])


_KIND, _PLAIN_ASCII = _byte_classes()
#: Second and third bytes of the plain signs that take three bytes.
_SIGNS = [tuple(c.encode()[1:]) for c in "–—‘’“”…€"]


def _after(data: np.ndarray, k: int) -> np.ndarray:
    """The byte k places on (0 past the end)."""
    out = np.zeros_like(data)
    out[:len(data) - k] = data[k:]
    return out


def plain_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What _PIECE finds in whole texts: lower-cased bytes, starts and ends of words, and the rows that are not plain."""
    n = len(data)
    if not n:
        return data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    one, two = _after(data, 1), _after(data, 2)
    low, kind, good = spans.LOWER[data], _KIND[data], _PLAIN_ASCII[data]
    # two bytes: U+00C0 to U+00FF, and the ligature oe
    lead = np.flatnonzero(data == 0xC3)
    second = one[lead]
    good[lead] = good[lead + 1] = True
    low[lead + 1] = np.where((second <= 0x9E) & (second != 0x97), second + 0x20, second)
    kind[lead] = kind[lead + 1] = np.where((second == 0x97) | (second == 0xB7), 3, 1)
    lead = np.flatnonzero((data == 0xC5) & ((one == 0x92) | (one == 0x93)))
    good[lead] = good[lead + 1] = True
    low[lead + 1] = 0x93
    kind[lead] = kind[lead + 1] = 1
    # three bytes: signs
    lead = np.flatnonzero(data == 0xE2)
    lead = lead[np.logical_or.reduce([(one[lead] == x) & (two[lead] == y) for x, y in _SIGNS])]
    good[lead] = good[lead + 1] = good[lead + 2] = True
    bad = np.flatnonzero(~good | ((data == 0x3C) & (one == 0x7C)))
    other = np.unique(np.searchsorted(at, bad, "right") - 1)

    before = np.zeros(n, np.int8)
    before[1:] = kind[:-1]
    first = at[:-1][at[:-1] < at[1:]]
    before[first] = 0
    start = (kind != 0) & ((kind != before) | (kind == 2))
    # an apostrophe that starts a word takes s, t, m, d, re, ve or ll with it
    mark = np.flatnonzero((data == 0x27) & start)
    if len(mark):
        x, y = _after(low, 1)[mark], _after(low, 2)[mark]
        row_end = at[np.searchsorted(at, mark, "right")]
        single = np.isin(x, list(b"stmd")) & (mark + 1 < row_end)
        double = (((x == 0x72) & (y == 0x65)) | ((x == 0x76) & (y == 0x65)) | ((x == 0x6C) & (y == 0x6C))) & (mark + 2 < row_end)
        for hit, size in ((single, 1), (double, 2)):
            m = mark[hit]
            start[m + 1] = False
            past = m + 1 + size
            past = past[past < n]
            start[past] |= kind[past] != 0
    border = np.append(np.flatnonzero(start | (kind == 0)), n)
    begins = start[border[:-1]]
    return low, border[:-1][begins], border[1:][begins], other


class Encoder:
    """Ids as ``tokenizers`` gives them without special tokens, as little-endian unsigned 32-bit numbers.

    Texts are cut into the tokenizer's own words, whole batches at a time. Words are told by a 64-bit hash of their bytes
    and looked up in a table with one place for each value of the hash's low bits; words that are not there are encoded
    together, told apart by the word-end mark of their last token, and take their places. A word that has lost its place
    is encoded again, so the table's size changes no id. Texts with rare characters are encoded as they are.
    """

    def __init__(self, definition: str) -> None:
        self.tokenizer = Tokenizer.from_str(definition)
        vocab = json.loads(definition)["model"]["vocab"]
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith(_WORD_END)]] = True
        self._forget()

    def _forget(self) -> None:
        """An empty table. No place holds a hash that belongs there: its low bits are another place's."""
        self.hash = np.arange(PLACES, dtype=np.uint64) ^ np.uint64(1)
        self.start, self.size = np.zeros(PLACES, np.int32), np.zeros(PLACES, np.int32)
        self.ids, self.used = np.zeros(KEPT_IDS, "<u4"), 0

    def _learn(self, text: str, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of n words parted by spaces, and how many each has."""
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) == n:
            return ids, np.diff(ends, prepend=0)
        each = [np.frombuffer(self._whole(word), "<u4") for word in text.split(" ")]
        return np.concatenate(each), np.array([len(x) for x in each])

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _block(self, data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        low, starts, ends, other = plain_words(data, at)
        if len(other):  # their words are not the tokenizer's
            mine = np.ones(len(starts), bool)
            for a, b in zip(np.searchsorted(starts, at[other]), np.searchsorted(starts, at[other + 1])):
                mine[a:b] = False
            starts, ends = starts[mine], ends[mine]
        hashed = spans.span_hash(low, starts, ends)
        if self.used > KEPT_IDS // 8 * 7:
            self._forget()
        place = (hashed & np.uint64(PLACES - 1)).astype(np.int64)
        first, n = self.start[place], self.size[place]
        missing = np.flatnonzero(self.hash[place] != hashed)
        if len(missing):
            new, where, which = np.unique(hashed[missing], return_index=True, return_inverse=True)
            where = missing[where]
            length = ends[where] - starts[where] + 1
            stop = np.cumsum(length)
            joined = low[np.minimum(np.repeat(starts[where] - (stop - length), length) + np.arange(stop[-1]), len(low) - 1)]
            joined[stop - 1] = 0x20
            ids, size = self._learn(joined[:-1].tobytes().decode(), len(new))
            if self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(len(ids), "<u4")])
            self.ids[self.used:self.used + len(ids)] = ids
            start = (self.used + np.cumsum(size) - size).astype(np.int32)
            self.used += len(ids)
            there = place[where]
            self.hash[there] = new  # of two words for one place the later stays, in all three arrays
            self.start[there], self.size[there] = start, size
            first[missing], n[missing] = start[which], size[which]
        total = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        ids = self.ids[np.repeat(first - total[:-1], n) + np.arange(total[-1])]
        cuts = total[np.searchsorted(starts, at)].tolist()
        out = [ids[x:y] for x, y in zip(cuts, cuts[1:])]
        for r in other.tolist():
            text = data[at[r]:at[r + 1]].tobytes().decode()
            out[r] = np.frombuffer(b"".join(map(self._whole, slices(text))), "<u4")
        return out

    def encode_column(self, texts: spans.Text) -> list[np.ndarray]:
        """The ids of each text. Texts of several blocks are cut before white space."""
        out: list[np.ndarray] = []
        for lo, hi, data, at in texts.blocks(ENCODED):
            if hi == lo + 1 and len(data) > 2 * spans.BLOCK:
                parts = spans.Text(pa.array(list(slices(data.tobytes().decode(), spans.BLOCK // 2)), pa.string()))
                longest = int(np.diff(parts.at).max())
                made = self._block(data, at) if longest > 2 * spans.BLOCK else self.encode_column(parts)
                out.append(np.concatenate(made))
            else:
                out += self._block(data, at)
        return out

    def encode_all(self, texts: Sequence[str | None]) -> list[bytes]:
        return [x.tobytes() for x in self.encode_column(spans.Text(pa.array(texts, pa.string())))]


def encoder(definition: str) -> Encoder:
    """The process's encoder for a tokenizer definition: what it has learnt serves its later tasks too."""
    made = per_process("encoders")
    key = hash(definition)
    if key not in made:
        made[key] = Encoder(definition)
    return made[key]
