"""Quality rules: countable base rules and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed n-grams of four UTF-8 bytes are counted over all documents: one over the
raw corpus, one over its trusted part. A document's score is the sum of log(p_trusted / p_raw) over its
n-grams, divided by their number. Ratios are kept in millionths, as integers, so that a score and its
comparison with the threshold come out the same however rows are dealt to tasks.

Defined results: a null or empty text has no words, score 0, and fails the base rules; a text of under four
bytes has score 0; repeated rows are rated apart and count each time; without any trusted document the
trusted multinomial is the raw one and every score is 0; an empty table gives an empty result. Null ids are
never trusted. Extra columns pass through ``rate`` untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .tables import with_flag

#: Buckets of the hashed n-grams; the model is two counts for each.
BUCKETS = 1 << 16
#: Least length-normalised ratio of a kept document, in nats for an n-gram.
THRESHOLD = -0.5
WINDOW, MIN_WORDS, MAX_REPEAT_PCT = 8, 20, 30
FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, score double, kept boolean")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _grams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at each byte, and whether it lies in one text."""
    n = len(data)
    bucket, whole = np.zeros(n, np.int32), np.zeros(n, bool)
    if n >= 4:
        d = data.astype(np.uint32)
        code = d[:-3] | d[1:-2] << np.uint32(8) | d[2:-1] << np.uint32(16) | d[3:] << np.uint32(24)
        bucket[:n - 3] = (code * np.uint32(0x9E3779B1) ^ code >> np.uint32(15)) * np.uint32(0x85EBCA77) >> np.uint32(16)
        whole[:n - 3] = True
        for k in (1, 2, 3):
            ends = at[1:] - k
            whole[ends[ends >= at[:-1]]] = False
    return bucket, whole


def gram_counts(docs: DataFrame, trusted: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """bucket, n_trusted, n_raw over all documents; each task sends its sums once."""
    def count(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            mine = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            for lo, hi, data, at in spans.Text(batch.column(0)).blocks():
                bucket, whole = _grams(data, at)
                total[1] += np.bincount(bucket[whole], minlength=BUCKETS)
                of_trusted = whole & np.repeat(mine[lo:hi], np.diff(at))
                total[0] += np.bincount(bucket[of_trusted], minlength=BUCKETS)
        at = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0][at]), pa.array(total[1][at])],
                                         names=["bucket", "n_trusted", "n_raw"])

    flagged = with_flag(docs.select(key, text), trusted, key, "__trusted").select(text, "__trusted")
    parts = flagged.mapInArrow(count, "bucket long, n_trusted long, n_raw long")
    return parts.groupBy("bucket").agg(F.sum("n_trusted").alias("n_trusted"), F.sum("n_raw").alias("n_raw"))


def fit(docs: DataFrame, trusted: DataFrame, text: str = "text", key: str = "doc_id") -> np.ndarray:
    """Log ratio of each bucket in millionths. Only BUCKETS rows of sums reach the driver.

    Each multinomial is smoothed by one n-gram in each bucket.
    """
    count = np.ones((2, BUCKETS))
    for b, t, r in gram_counts(docs, trusted, text, key).collect():
        count[:, b] += t, r
    if count[0].sum() == BUCKETS:
        return np.zeros(BUCKETS, np.int64)
    p = count / count.sum(axis=1, keepdims=True)
    return np.rint(1e6 * np.log(p[0] / p[1])).astype(np.int64)


def _per_row(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[at])


def rules(texts: spans.Text, ratio: np.ndarray, threshold: float) -> list[np.ndarray]:
    """The arrays of FIELDS for a batch."""
    parts = []
    for _, _, data, at in texts.blocks():
        rows = len(at) - 1
        starts, ends = spans.runs(~spans.WHITE[data], at)
        row, first = spans.row_of(at, starts)
        n_words = np.diff(first)
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        word_chars = np.bincount(row, chars[ends] - chars[starts], rows).astype(np.int64)

        from_, to = spans.runs(data != 0x0A, at)
        with_word = np.searchsorted(starts, to) > np.searchsorted(starts, from_)
        from_, to = from_[with_word], to[with_word]
        line_row, _ = spans.row_of(at, from_)
        line = pd.Series(spans.mix(spans.span_hash(data, from_, to) + spans.mix(line_row.astype(np.uint64))))
        dup_lines = np.bincount(line_row[line.duplicated().to_numpy()], minlength=rows)

        hashed = spans.span_hash(data, starts, ends)
        window, whole = spans.ngram_hash(hashed, first, WINDOW)
        window = spans.mix(window + spans.mix(row.astype(np.uint64)))[whole]
        again = np.flatnonzero(whole)[pd.Series(window).duplicated(keep=False).to_numpy()]
        cover = np.zeros(len(starts) + 1, np.int64)
        np.add.at(cover, again, 1)
        np.add.at(cover, again + WINDOW, -1)
        repeat = np.bincount(row[np.cumsum(cover[:-1]) > 0], minlength=rows)

        bucket, ok = _grams(data, at)
        n_grams = np.maximum(_per_row(ok, at), 1)
        total = _per_row(np.where(ok, ratio[bucket], 0), at)
        failed = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PCT * n_words)
        kept = ~failed & (total >= np.int64(round(threshold * 1e6)) * n_grams)
        parts.append([n_words, word_chars, _per_row(_SYMBOL[data], at), dup_lines, repeat, failed,
                      total / n_grams / 1e6, kept])
    return [np.concatenate(x) for x in zip(*parts)] if parts else [[] for _ in range(8)]


def rate(docs: DataFrame, trusted: DataFrame, keep: Sequence[str] = ("doc_id",), threshold: float = THRESHOLD,
         text: str = "text", key: str = "doc_id") -> DataFrame:
    """``keep`` columns of every document and a struct ``__found`` of FIELDS.

    ``trusted`` holds the ids of the trusted documents. Two passes over the texts, no shuffle of texts if the
    trusted ids are few enough to broadcast.
    """
    ratio = fit(docs, trusted, text, key)
    return spans.per_text(docs, lambda t: rules(t, ratio, threshold), FIELDS, keep, text=text)
