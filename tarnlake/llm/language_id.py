"""Language identification, words first, with back-off to ever shorter character n-grams.

The model knows every word of the learning documents, and for orders 4 down to 1 every n-gram of their distinct
words (with marks at both ends). A known word scores its log frequency in each language. At each place of an unseen
word the longest known n-gram is taken, and the log frequencies of the places are added up, each divided by its
order because longer n-grams overlap more. A text's score for a language is the sum over its words plus the log
share of the language among the learning documents, in integer millionths so that it is the same in any order; the
answer is the highest, the smaller name on ties, with its posterior probability.

The counts stay tables. Only the names met most often, up to ``HOT``, are sent to the tasks, which score them at
once; a document's other words, counted per document, are joined to the whole word table, and those words that are
not in it, by the n-grams that were not sent, to the whole n-gram table. How many names are sent has no influence
on the result. ``n_words`` and ``n_grams`` bound what is known for a language, if given.

Defined results: null texts and texts without letters are ``und`` with score 0, and so is every text if nothing
could be learnt; nothing is learnt from null texts, null languages or null ids; a null id is not held out;
repeated rows count each time; empty tables give empty results. Extra columns pass through ``predict``.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Sequence
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import spans
from .tables import checked_broadcast, written
from .wordpieces import slices

#: Words, and n-grams of all orders, whose scores are sent to the tasks; and their greatest length.
HOT, HOT_LENGTH = 100_000, 64
ORDERS = (4, 3, 2, 1)
#: Names counted in a task, and letters read for them, before the counts are sent.
COMBINED, READ = 200_000, 64_000_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased. (Word characters that are numbers, such as fractions, may stand in one.)"""
    return [w for part in slices(text or "") for w in _WORD.findall(part.lower())]


def grams_of(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def _batch(counts: dict[tuple, Counter], names: Sequence[str]) -> pa.RecordBatch:
    """A row for each counted name; the first columns are the parts of its key."""
    size = [len(c) for c in counts.values()]
    keys = [pa.array(values, pa.int32() if name == "k" else pa.string()).take(pa.array(np.repeat(np.arange(len(size)), size)))
            for name, values in zip(names, list(zip(*counts)) or [()] * len(names))]
    return pa.RecordBatch.from_arrays(
        [*keys, pa.array([x for c in counts.values() for x in c], pa.string()),
         pa.array([n for c in counts.values() for n in c.values()], pa.int64())], names=[*names, "name", "n"])


def _word_counts(batches):
    """Counts are combined over the whole task, and sent when they come to ``COMBINED`` names or ``READ`` letters were read."""
    counts: dict[tuple, Counter] = {}
    read = 0

    def sent() -> pa.RecordBatch:
        for c in counts.values():
            for w in [w for w in c if not any(map(str.isalpha, w))]:
                del c[w]
        return _batch(counts, ["lang"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.setdefault((lang,), Counter()).update(words_of(text))
            if (read := read + len(text)) > READ:
                yield sent()
                counts, read = {}, 0
        if sum(map(len, counts.values())) > COMBINED:
            yield sent()
            counts, read = {}, 0
    yield sent()


def _gram_counts(batches):
    """Likewise."""
    counts: dict[tuple, Counter] = {}
    read = 0
    for batch in batches:
        marked: dict[str, list[str]] = {}
        for lang, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            marked.setdefault(lang, []).append(f"^{word}$")
            read += len(word)
        for lang, words in marked.items():
            for n in ORDERS:
                counts.setdefault((lang, n), Counter()).update([w[i:i + n] for w in words for i in range(len(w) - n + 1)])
        if read > READ or sum(map(len, counts.values())) > COMBINED:
            yield _batch(counts, ["lang", "k"])
            counts, read = {}, 0
    yield _batch(counts, ["lang", "k"])


class Model:
    """Languages in name order, their log shares, and tables of k (0 for words), name, n and scores in each language."""

    def __init__(self, langs: Sequence[tuple[str, int]], words: DataFrame, grams: DataFrame) -> None:
        self.langs = [name for name, _ in langs]
        docs = np.array([n for _, n in langs], float)
        self.prior = np.rint(1e6 * np.log(docs / docs.sum())).astype(np.int64) if len(langs) else np.zeros(0, np.int64)
        self.word_table, self.gram_table = words, grams

    @cached_property
    def words(self) -> dict[str, np.ndarray]:
        """All words, on the driver: to look into small models."""
        return {r[0]: np.array(r[1]) for r in self.word_table.select("name", "scores").collect()}

    @cached_property
    def grams(self) -> dict[int, dict[str, np.ndarray]]:
        """All n-grams by order, likewise."""
        rows = self.gram_table.select("k", "name", "scores").collect()
        return {k: {r[1]: np.array(r[2]) for r in rows if r[0] == k} for k in ORDERS}


def _most_met(table: DataFrame, limit: int) -> pa.Table:
    """k, name and scores of the names with the highest counts, ``limit`` at most, by levels of counts."""
    some = table.where(F.length("name") <= HOT_LENGTH).withColumn("level", F.floor(8 * F.log2("n")))
    least = above = None
    for level, n in sorted(some.groupBy("level").count().collect(), reverse=True):
        if (above := (above or 0) + n) > limit:
            break
        least = level
    return some.where(F.lit(False) if least is None else F.col("level") >= least).select("k", "name", "scores").toArrow()


class Scorer:
    """What a task scores by itself: words sent to it, and places of unseen words as far as the n-grams sent decide."""

    def __init__(self, model: Model) -> None:
        words, grams = _most_met(model.word_table, HOT), _most_met(model.gram_table, HOT)
        self.prior, width = model.prior, len(model.langs)
        # row 0 is for words without letters, row 1 for those to be joined
        self.row = {w: i for i, w in enumerate(words["name"].to_pylist(), 2)}
        self.table = np.zeros((len(self.row) + 2, width), np.int64)
        self.table[2:] = words["scores"].combine_chunks().flatten().to_numpy().reshape(-1, width)
        self.gram = {g: i for i, g in enumerate(zip(grams["k"].to_pylist(), grams["name"].to_pylist()))}
        self.gram_scores = grams["scores"].combine_chunks().flatten().to_numpy().reshape(-1, width)

    def score(self, text: str | None) -> tuple[np.ndarray, bool, Counter]:
        """The score by prior and words sent, whether there are letters, and the counts of the other words."""
        total, letters, rest = self.prior.copy(), False, Counter()
        for part in slices(text or ""):
            words = _WORD.findall(part.lower())
            new = {w: int(any(map(str.isalpha, w))) for w in set(words).difference(self.row)}
            if new:
                rows = np.fromiter((new[w] if w in new else self.row[w] for w in words), np.int64, len(words))
                rest.update(w for w in words if new.get(w))
            else:
                rows = np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))
            letters = letters or bool(rows.any())
            total += self.table[rows].sum(axis=0)
        return total, letters, rest

    def unseen(self, word: str) -> tuple[np.ndarray, list[tuple[int, int, str, list[int]]]]:
        """The back-off score by n-grams sent; and place, order and longer n-gram to look up, with what it would replace."""
        total, tries = np.zeros_like(self.prior), []
        marked = f"^{word}$"
        for i in range(len(marked)):
            longer, found = [], np.zeros_like(total)
            for k in ORDERS:
                if i + k <= len(marked):
                    at = self.gram.get((k, marked[i:i + k]))
                    if at is not None:
                        found = self.gram_scores[at]
                        break
                    longer.append(k)
            total += found
            less = found.tolist() if longer else []
            tries += [(i, k, marked[i:i + k], less) for k in longer]
        return total, tries


def learns(key: str) -> F.Column:
    """Whether a document is one to learn from: the CRC-32 of its id as text leaves 0 or 2 when divided by 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 != 1, F.lit(False))


def _most(counts: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` names of each language and order with the highest counts, ties by a hash, then by name.

    Whole levels are taken as long as they fit; only the border level goes on, by hash cells, and its border cell by name.
    """
    by, taken, border = ["lang", "k"], [], counts.withColumn("room", F.lit(limit).cast("long"))
    for rank in (-F.col("n"), F.shiftrightunsigned(F.xxhash64("name"), 48)):
        border = border.withColumn("at", rank)
        level = border.groupBy(*by, "at", "room").agg(F.count(F.lit(1)).alias("names"))
        above = F.sum("names").over(Window.partitionBy(*by).orderBy("at")) - F.col("names")
        level = level.withColumn("room", F.col("room") - above).where("room > 0")
        met = border.drop("room").join(checked_broadcast(written(level, "count-levels")), [*by, "at"])
        taken.append(met.where("names <= room").select(counts.columns))
        border = met.where("names > room").select(*counts.columns, "room")
    nth = F.row_number().over(Window.partitionBy(*by).orderBy("name"))
    return reduce(DataFrame.union, taken, border.where("room > 0").withColumn("nth", nth).where("nth <= room").select(counts.columns))


def _known(counts: DataFrame, langs: Sequence[str], limit: int | None) -> DataFrame:
    """k, name, n and scores of the names counted: log frequencies smoothed by one for each name."""
    if limit is not None:
        # a name known through one language has its true count in each
        names = written(_most(counts, limit).select("k", "name").distinct(), "known-names")
        counts = counts.join(names, ["k", "name"], "left_semi")
    each = [F.sum(F.when(F.col("lang") == name, F.col("n")).otherwise(0)) for name in langs]
    known = written(counts.groupBy("k", "name").agg(F.sum("n").alias("n"), F.array(*each).cast("array<long>").alias("counts")), "language-names")
    sums = {r[0]: r[2:] for r in known.groupBy("k").agg(F.count(F.lit(1)), *[
        F.count(F.lit(1)) + F.sum(F.col("counts")[i]) for i in range(len(langs))]).collect()}
    scores = []
    for i in range(len(langs)):
        of = F.lit(None)
        for k, total in sums.items():
            of = F.when(F.col("k") == k, 1e6 / max(k, 1) * F.log((F.col("counts")[i] + 1) / F.lit(float(total[i])))).otherwise(of)
        scores.append(F.rint(of).cast("long"))
    return known.select("k", "name", "n", F.array(*scores).cast("array<long>").alias("scores"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", n_words: int | None = None, n_grams: int | None = None) -> Model:
    """The model of the documents given: all their words and n-grams, or the most frequent of each language and order."""
    there = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = there.mapInArrow(_word_counts, "lang string, name string, n long")
    words = written(counted.groupBy("lang", F.lit(0).alias("k"), "name").agg(F.sum("n").alias("n")), "language-words")
    grams = words.select("lang", "name").mapInArrow(_gram_counts, "lang string, k int, name string, n long")
    grams = written(grams.groupBy("lang", "k", "name").agg(F.sum("n").alias("n")), "language-grams")
    langs = sorted(tuple(r) for r in there.groupBy("lang").count().collect())
    names = [name for name, _ in langs]
    return Model(langs, _known(words, names, n_words), _known(grams, names, n_grams))


def _plus(total: str, more: str) -> F.Column:
    return F.when(F.col(more).isNull(), F.col(total)).otherwise(F.zip_with(total, more, lambda x, y: x + y))


def _unseen(words: DataFrame, model: Model, scorer) -> DataFrame:
    """name and scores of distinct words that were not learnt, by the longest known n-gram at each place."""
    width = range(len(model.langs))
    out = "name string, base array<long>, tries array<struct<place: int, k: int, gram: string, less: array<long>>>"
    kinds = to_arrow_schema(T.StructType.fromDDL(out))

    def run(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            made = [scorer().unseen(w) for w in names]
            tries = [[dict(zip(("place", "k", "gram", "less"), t)) for t in m[1]] for m in made]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((names, [m[0] for m in made], tries), kinds)],
                                             names=kinds.names)

    tried = written(words.mapInArrow(run, out), "language-unseen")
    grams = model.gram_table.select("k", F.col("name").alias("gram"), "scores")
    longest = tried.select("name", F.explode("tries").alias("t")).select("name", "t.*").join(grams, ["k", "gram"]) \
        .groupBy("name", "place").agg(F.max_by(F.struct("scores", "less"), "k").alias("m"))
    more = longest.groupBy("name").agg(F.array(*[F.sum(F.col("m.scores")[i] - F.col("m.less")[i]) for i in width]).alias("more"))
    return tried.join(more, "name", "left").select("name", _plus("base", "more").alias("scores"))


def predict(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and a struct ``__found``: lang_pred and score. Only the text is read."""
    if not model.langs:
        return spans.per_text(docs, lambda texts: [["und"] * len(texts), [0.0] * len(texts)], "lang_pred string, score double", keep, text=text)
    sent, name = docs.sparkSession.sparkContext.broadcast(Scorer(model)), uuid.uuid4().hex

    def scorer() -> Scorer:
        made = spans.per_process("scorers")
        if made.get("name") != name:
            made.update(name=name, it=sent.value)
        return made["it"]

    def run(texts: spans.Text) -> list:
        rows = [scorer().score(t) for t in texts.strings()]
        return [[r[0] for r in rows], [r[1] for r in rows], [[{"name": w, "n": n} for w, n in r[2].items()] for r in rows]]

    first = spans.per_text(docs, run, "total array<long>, letters boolean, rest array<struct<name: string, n: long>>", keep, "__first", text)
    first = written(first.withColumn("__row", F.monotonically_increasing_id()), "language-documents")
    rest = first.select("__row", F.explode("__first.rest").alias("w")).select("__row", "w.name", "w.n")
    asked = written(rest.select("name").distinct().join(model.word_table.select("name", "scores"), "name", "left"), "language-asked")
    scored = asked.where("scores IS NOT NULL").unionByName(_unseen(asked.where("scores IS NULL").select("name"), model, scorer))
    sums = rest.join(scored, "name").groupBy("__row").agg(
        F.array(*[F.sum(F.col("n") * F.col("scores")[i]) for i in range(len(model.langs))]).alias("__more"))
    done = first.join(sums, "__row", "left").withColumn("__total", F.col("__first.total"))
    done = done.withColumn("__total", _plus("__total", "__more")).withColumn("__best", F.array_max("__total"))
    best = F.element_at(F.array(*map(F.lit, model.langs)), F.array_position("__total", F.col("__best")).cast("int"))
    odds = F.aggregate("__total", F.lit(0.0), lambda acc, x: acc + F.exp((x - F.col("__best")) / 1e6))
    letters = F.col("__first.letters")
    return done.select(*keep, F.struct(F.when(letters, best).otherwise("und").alias("lang_pred"),
                                       F.when(letters, 1 / odds).otherwise(0.0).alias("score")).alias("__found"))
