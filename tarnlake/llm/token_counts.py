"""Word-piece token counts by a linear longest-match automaton.

Greedy longest-match-first pieces of a word are what a trie walk gives if it starts again after every piece. The
automaton needs no second look at a character: a node whose next character has no edge has a failure link, to the
node that stands for what is left unmatched once the longest pieces are popped off its front, together with the
number of pieces popped. Links and numbers are computed once for the whole vocabulary, breadth first, so a word of
n characters takes at most 2n steps and no piece is ever built.

The vocabulary has pieces that end a word, marked by a suffix; a letter with the mark is a letter of its own, so
such a piece fits nowhere else. A word in which some stretch has no piece counts as one unknown token.

Words are the tokenizer's own, and each distinct word of a group of texts is counted once.

Defined results: null, empty and blank texts have no words and no tokens; repeated rows are counted apart;
an empty table gives an empty result. Extra columns pass through.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from . import spans
from .wordpieces import CACHE, SLICE, Splitter, turns

FIELDS = "n_words long, n_tokens long, n_unknown long"

def ending(word: str) -> str:
    """The word with its last letter replaced by the one that stands for that letter at a word's end."""
    return word[:-1] + chr(ord(word[-1]) + 0x10000)


class LongestMatch:
    """Trie with failure links and popped-piece counts over a vocabulary of pieces."""

    def __init__(self, pieces: Iterable[str]) -> None:
        self.edges: list[dict[str, int]] = [{}]
        self.piece = [False]
        for piece in pieces:
            node = 0
            for ch in piece:
                after = self.edges[node].get(ch)
                if after is None:
                    after = self.edges[node][ch] = len(self.edges)
                    self.edges.append({})
                    self.piece.append(False)
                node = after
            self.piece[node] = node > 0
        n = len(self.edges)
        self.fail, self.popped = [-1] * n, [0] * n
        level = [0]
        while level:
            below = []
            for node in level:
                for ch, child in self.edges[node].items():
                    below.append(child)
                    if self.piece[child]:  # the whole path is one piece; nothing is left
                        self.fail[child], self.popped[child] = 0, 1
                        continue
                    state, count = self.fail[node], self.popped[node]
                    while state >= 0 and ch not in self.edges[state]:
                        count += self.popped[state]
                        state = self.fail[state]
                    if state >= 0:
                        self.fail[child], self.popped[child] = self.edges[state][ch], count
            level = below

    def count(self, word: str) -> int:
        """Greedy pieces of a word, or -1 if it cannot be cut into pieces."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node = total = 0
        for ch in word:
            after = edges[node].get(ch)
            while after is None:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return -1
                after = edges[node].get(ch)
            node = after
        while node > 0:
            total += popped[node]
            node = fail[node]
        return total if node == 0 else -1


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Counter:
    """Token counts of texts for a byte-level word vocabulary with word-end marks."""

    def __init__(self, definition: str) -> None:
        self.splitter = Splitter(definition)
        vocab = json.loads(definition)["model"]["vocab"]
        mark = json.loads(definition)["model"]["end_of_word_suffix"]
        special = {t["content"] for t in json.loads(definition)["added_tokens"]}
        self.match = LongestMatch(sorted(ending(w.removesuffix(mark)) if w.endswith(mark) else w
                                         for w in vocab if w not in special))
        self.letters = byte_letters()
        self.known: dict[str, int] = {}

    def _count(self, word: str) -> int:
        return self.match.count(ending("".join([self.letters[b] for b in word.encode()])))

    def count_all(self, texts: Sequence[str | None]) -> list[tuple[int, int, int]]:
        """Words, tokens and unknown words of each text."""
        out = []
        for lo, hi in turns([len(t or "") for t in texts], SLICE):
            for text in texts[lo:hi]:
                n = total = unknown = 0
                for words in self.splitter.words(text or ""):
                    if len(self.known) > CACHE:
                        self.known.clear()
                    for word in set(words).difference(self.known):
                        self.known[word] = self._count(word)
                    counts = list(map(self.known.__getitem__, words))
                    bad = counts.count(-1)
                    n += len(words)
                    total += sum(counts) + 2 * bad  # an unknown word is one token
                    unknown += bad
                out.append((n, total, unknown))
        return out


def _counter(definition: str) -> Counter:
    made = spans.per_process("counters")
    key = hash(definition)
    if key not in made:
        made[key] = Counter(definition)
    return made[key]


def token_counts(docs: DataFrame, definition: str, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and a struct ``__found`` of FIELDS. ``definition`` is the tokenizer's JSON; only its
    vocabulary and its way of splitting words are used, not its merges."""
    sent = docs.sparkSession.sparkContext.broadcast(definition)

    def count(texts: spans.Text) -> list:
        rows = _counter(sent.value).count_all(texts.strings())
        return [list(x) for x in zip(*rows)] if rows else [[], [], []]

    return spans.per_text(docs, count, FIELDS, keep, text=text)
