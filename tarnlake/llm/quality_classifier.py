"""Quality classification by co-training of a text view and a metadata view.

*Text view*: which of ``WORD_BUCKETS`` hashed words and runs of signs occur in a document. *Metadata view*: source, language and the
document's shape, without its words: binned size, line length, word length, and shares of symbols, capitals,
digits, punctuation and repeated words. The tables link no web page to a document, so these columns of the
documents stand for page metadata. Each view is a naive Bayes classifier of log odds; log odds not clearly
different from zero (by a likelihood-ratio test at ``MIN_Z`` standard deviations) count as zero. A long text holds every common word, so evidence
of words for the good class counts up to ``MOST_GOOD``; evidence against it is not bounded.

The first round counts labelled documents. In every later round each view labels the unlabelled documents it is
confident of, and these are added to the labelled ones in the *other* view's counts. One fifth of the labelled
documents is kept out of all counts; on it each view's log odds are calibrated (Platt) after every round, and
confidence is a calibrated probability. The score is the probability from both views, combined as independent evidence.

Every pass reads all documents, and each task sends one sum for each feature, so rounds cost the same passes at
any size, and only tables of fixed size reach the driver.

Defined results: null and empty texts have no words and metadata of their own; null source or language is a value
of its own; labels that are null, or differ for one id, are not used; labels without documents neither; repeated
rows count each time; without labels of both kinds every score is 0.5; empty tables give empty results. Extra
columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .tables import checked_broadcast

WORD_BUCKETS, META_BUCKETS = 1 << 17, 1 << 12
ROUNDS, CONFIDENT, MIN_Z, MOST_GOOD = 2, 0.97, 4.0, 4.0
#: Bins of the log odds from -LIMIT to LIMIT in which calibration counts documents.
BINS, LIMIT = 400, 40.0
FIELDS = "score double, text_score double, meta_score double, good boolean"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>{}[]\\~^_=+@")] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b".,;:!?\"'()-")] = True


def _bucket(name: str, value: object) -> int:
    return zlib.crc32(f"{name}={value}".encode()) % META_BUCKETS


def _views(texts: spans.Text, source: list, lang: list):
    """For each block: first row, row after the last, (row, word bucket) pairs, meta buckets by row."""
    for lo, hi, data, at in texts.blocks():
        rows = hi - lo
        low = spans.LOWER[data]
        pairs = []
        for inside in (spans.NOT_ALNUM[low] & ~spans.WHITE[low], ~spans.NOT_ALNUM[low]):
            starts, ends = spans.runs(inside, at)
            row, first = spans.row_of(at, starts)
            hashed = spans.span_hash(low, starts, ends)
            pairs.append(row.astype(np.int64) * WORD_BUCKETS + (hashed % np.uint64(WORD_BUCKETS)).astype(np.int64))
        pair = np.unique(np.concatenate(pairs))
        which, bucket = pair // WORD_BUCKETS, pair % WORD_BUCKETS

        n_words, n_bytes = np.diff(first), np.diff(at)
        distinct = np.bincount(which, minlength=rows)
        share = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[at]) / np.maximum(n_bytes, 1)
        lines = np.diff(np.concatenate([[0], np.cumsum(data == 0x0A)])[at]) + 1
        binned = {
            "size": np.log2(n_words + 1), "line": np.log2(n_words / lines + 1),
            "length": n_bytes / np.maximum(n_words, 1) / 2, "repeat": 10 * (1 - distinct / np.maximum(n_words, 1)),
            "symbol": 200 * share(_SYMBOL[data]), "capital": 20 * share((data >= 0x41) & (data <= 0x5A)),
            "digit": 50 * share((data >= 0x30) & (data <= 0x39)), "mark": 40 * share(_PUNCT[data])}
        binned = {k: np.minimum(v, 20).astype(int).tolist() for k, v in binned.items()}
        meta = np.array([[_bucket("source", source[lo + i]), _bucket("lang", lang[lo + i]),
                          *[_bucket(k, v[i]) for k, v in binned.items()]] for i in range(rows)], np.int64)
        yield lo, hi, which, bucket, meta


class View:
    """Log odds of the presence of each feature."""

    def __init__(self, counts: np.ndarray, docs: np.ndarray) -> None:
        """counts: documents of class 0 and 1 that hold each feature; docs: documents of each class."""
        if min(docs) == 0:
            self.weight, self.prior = np.zeros(counts.shape[1]), 0.0
            return
        p = (counts + 0.5) / (docs[:, None] + 1)
        weight = np.log(p[1] / p[0])

        def fit(k, n):  # log likelihood of k of n at their own rate
            rate = k / n
            return k * np.log(np.maximum(rate, 1e-300)) + (n - k) * np.log(np.maximum(1 - rate, 1e-300))

        clear = 2 * (fit(counts[0], docs[0]) + fit(counts[1], docs[1]) - fit(counts.sum(axis=0), docs.sum()))
        self.weight = np.where(clear >= MIN_Z**2, weight, 0.0)
        self.prior = float(np.log(docs[1] / docs[0]))


def _odds(views: tuple[View, View], which, bucket, meta) -> tuple[np.ndarray, np.ndarray]:
    weight = views[0].weight[bucket]
    good = np.minimum(np.bincount(which, np.maximum(weight, 0), len(meta)), MOST_GOOD)
    text = views[0].prior + good + np.bincount(which, np.minimum(weight, 0), len(meta))
    return np.clip(text, -LIMIT, LIMIT), np.clip(views[1].prior + views[1].weight[meta].sum(axis=1), -LIMIT, LIMIT)


class Classifier:
    """Both views and what turns their log odds into calibrated logits."""

    def __init__(self, views: tuple[View, View], platt: list[tuple[float, float]], base: float) -> None:
        self.views, self.platt, self.base = views, platt, base

    def logits(self, which, bucket, meta) -> list[np.ndarray]:
        return [a * x + b for x, (a, b) in zip(_odds(self.views, which, bucket, meta), self.platt)]

    def scores(self, which, bucket, meta) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        by_text, by_meta = self.logits(which, bucket, meta)
        p = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return p(by_text + by_meta - self.base), p(by_text), p(by_meta)


def _labelled(docs: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Documents with __label 0 or 1 (null: none) and __held, whether the label is kept for calibration."""
    one = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key) \
        .agg(F.min(label).alias("__label"), F.max(label).alias("__other")).where("__label = __other").select(key, "__label")
    joined = docs.join(checked_broadcast(one), key, "left")
    return joined.select(*[joined[c] for c in docs.columns], F.col("__label").cast("int").alias("__label"),
                         F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False)).alias("__held"))


def _sums(rows: DataFrame, work) -> dict[int, int]:
    """Sum over all tasks of the arrays that ``work`` fills for each batch; a cell for each number."""
    def run(batches):
        total = None
        for batch in batches:
            made = work(batch)
            total = made if total is None else total + made
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    return dict(rows.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect())


def _filled(sums: dict[int, int], size: int) -> np.ndarray:
    flat = np.zeros(size)
    flat[list(sums)] = list(sums.values())
    return flat


_WIDE = WORD_BUCKETS + 1  # features of a class, and last the number of its documents
_META = META_BUCKETS + 1


def _count(model: Classifier | None, confident: float):
    """Counts of both views: labelled documents, and those that the other view is confident of."""
    limit = np.log(confident / (1 - confident))

    def work(batch: pa.RecordBatch) -> np.ndarray:
        total = np.zeros(2 * _WIDE + 2 * _META, np.int64)
        label = batch.column(3).fill_null(-1).to_numpy()
        held = batch.column(4).to_numpy(zero_copy_only=False).astype(bool)
        for lo, hi, which, bucket, meta in _views(spans.Text(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            known = np.where(held[lo:hi] & (label[lo:hi] >= 0), -2, label[lo:hi])
            for_text, for_meta = known.copy(), known.copy()
            if model is not None:
                by_text, by_meta = model.logits(which, bucket, meta)
                free = known == -1
                for mine, odds in ((for_text, by_meta), (for_meta, by_text)):
                    mine[free & (odds >= limit)] = 1
                    mine[free & (odds <= -limit)] = 0
            for c in (0, 1):
                at, mine = c * _WIDE, for_text == c
                total[at:at + WORD_BUCKETS] += np.bincount(bucket[mine[which]], minlength=WORD_BUCKETS)
                total[at + WORD_BUCKETS] += mine.sum()
                at, mine = 2 * _WIDE + c * _META, for_meta == c
                total[at:at + META_BUCKETS] += np.bincount(meta[mine].ravel(), minlength=META_BUCKETS)
                total[at + META_BUCKETS] += mine.sum()
        return total

    return work


def _histogram(views: tuple[View, View]):
    """Held-out labelled documents by view, class and bin of log odds."""
    def work(batch: pa.RecordBatch) -> np.ndarray:
        total = np.zeros((2, 2, BINS), np.int64)
        label = batch.column(3).fill_null(-1).to_numpy()
        for lo, hi, which, bucket, meta in _views(spans.Text(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            for v, odds in enumerate(_odds(views, which, bucket, meta)):
                place = np.minimum(((odds + LIMIT) * BINS / (2 * LIMIT)).astype(int), BINS - 1)
                for c in (0, 1):
                    total[v, c] += np.bincount(place[label[lo:hi] == c], minlength=BINS)
        return total.ravel()

    return work


def _platt(counts: np.ndarray) -> tuple[float, float]:
    """a, b of sigmoid(a * odds + b) by Newton's method on binned counts, smoothed by half a document at each end."""
    x = np.concatenate([(np.arange(BINS) + 0.5) * 2 * LIMIT / BINS - LIMIT, [-LIMIT, LIMIT]]) / LIMIT
    bad, good = (np.concatenate([counts[c], [0.5, 0.5]]) for c in (0, 1))
    design, w = np.stack([x, np.ones_like(x)]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(w @ design, -30, 30)))
        gradient = design @ (good - (good + bad) * p) - 1e-3 * w
        hessian = (design * ((good + bad) * p * (1 - p))) @ design.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / LIMIT), float(w[1])


def _inputs(docs: DataFrame, text: str, meta: Sequence[str]) -> list[F.Column]:
    columns = {f.name for f in docs.schema.fields}
    return [F.col(text).alias("text"), *[(F.col(m) if m in columns else F.lit(None)).cast("string").alias(f"__m{i}")
                                         for i, m in enumerate(meta)]]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label",
        meta: Sequence[str] = ("source", "lang"), rounds: int = ROUNDS, confident: float = CONFIDENT) -> Classifier:
    """``labels``: key and 0 or 1. One pass over the documents for each round and one before them, each followed by
    one over the labelled documents held out."""
    rows = _labelled(docs.select(F.col(key), *_inputs(docs, text, meta)), labels, key, label).drop(key)
    held = rows.where("__held AND __label IS NOT NULL")
    model = None
    for _ in range(rounds + 1):
        flat = _filled(_sums(rows, _count(model, confident)), 2 * _WIDE + 2 * _META)
        wide, narrow = flat[:2 * _WIDE].reshape(2, -1), flat[2 * _WIDE:].reshape(2, -1)
        views = (View(wide[:, :-1], wide[:, -1]), View(narrow[:, :-1], narrow[:, -1]))
        counts = _filled(_sums(held, _histogram(views)), 4 * BINS).reshape(2, 2, BINS)
        n = counts[0].sum(axis=1)
        if min(n) == 0:  # nothing to calibrate with
            return Classifier(views, [(1.0, 0.0) if min(wide[:, -1]) else (0.0, 0.0)] * 2, views[0].prior)
        model = Classifier(views, [_platt(c) for c in counts], float(np.log(n[1] / n[0])))
    return model


def classify(docs: DataFrame, model: Classifier, keep: Sequence[str] = ("doc_id",), text: str = "text",
             meta: Sequence[str] = ("source", "lang")) -> DataFrame:
    """``keep`` columns and a struct ``__found``: score (probability of good), each view's own, and good (0.5 or more)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: spans.Text, source: pa.Array, lang: pa.Array) -> list:
        parts = [sent.value.scores(which, bucket, about) for _, _, which, bucket, about in
                 _views(texts, source.to_pylist(), lang.to_pylist())]
        score, by_text, by_meta = (np.concatenate(x) for x in zip(*parts)) if parts else ([], [], [])
        return [score, by_text, by_meta, np.asarray(score) >= 0.5]

    return spans.per_text(docs.withColumns({f"__m{i}": c for i, c in enumerate(_inputs(docs, text, meta)[1:])}),
                          run, FIELDS, keep, text=text, also=[f"__m{i}" for i in range(len(meta))])
