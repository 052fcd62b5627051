"""Small tables with the awkward rows that every operator must take."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words string, kept string, score string"


def words(seed, n, vocabulary=400):
    r = random.Random(seed)
    return [f"{r.choice('bcdfglmnprst')}{r.choice('aeiou')}{r.choice('lmnrst')}{r.randrange(vocabulary)}" for _ in range(n)]


def awkward():
    """(doc_id, text): null, empty and blank texts, long and repeated rows, null ids, ties, scripts and odd bytes."""
    base = " ".join(words(1, 120))
    return [
        (1, base), (2, base), (3, base.upper()), (3, base.upper()), (4, None), (5, ""), (6, " \n\t\x0b\x0c\r\n "),
        (7, "one two"), (8, "One TWO"), (None, base), (None, None), (9, " ".join(words(2, 60_000, 10**6))),
        (10, "日本語のテキスト ñandú Straße ﬁ İstanbul   x́ <|endoftext|> ½ ² '"),
        (11, "\n".join([" ".join(words(3, 12))] * 5)), (12, "x" * 30_000), (13, "### $$$ %%% &&& ||| <<<"),
        (14, base.replace(" ", "  ", 7) + " tail"), (15, "\x00\x1f\x7f\x85 a b"), (16, "word " * 300)]


def frame(spark, rows):
    """Rows of (doc_id, text) with other columns, some of them named as results are."""
    return spark.createDataFrame([(i, t, "en", None if i == 7 else "s", None if t is None else len(t), "a", "b", "c")
                                  for i, t in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)
