"""Relational TF-IDF and dictionary lemmatisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse_space, drop_emoji, strip_markup, terms, words
from ..sources.scratch import written
from .skew import skew_join

# Noun suffixes and their replacements, tried in this order.
NOUN_SUFFIXES = (
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
)


def tfidf(docs: DataFrame, doc_id: str, text: str, max_features: int = 15_000) -> DataFrame:
    """Smoothed, length-normalised TF-IDF as rows (doc_id, term, tf, tfidf).

    The vocabulary is the ``max_features`` terms with the highest total count, ties in term
    order.  Documents are partitioned by id before they are split into terms, so counting
    terms and the norm per document need no shuffle of the far larger term rows; only
    per-task term totals are shuffled.  Terms outside the vocabulary are dropped before anything is
    counted per document, and those inside go by their number in it, so these counts have short keys.
    """
    # explode_outer: a plain explode would make Spark infer filters that run the expressions again.
    # The null test on the id is what the join below would add; stated here, both reads are alike.
    tokens = docs.where(F.col(doc_id).isNotNull()).select(
        doc_id, terms(F.col(text)).alias("__terms")).repartition(doc_id)
    placed = tokens.select(doc_id, F.explode_outer("__terms").alias("term")).where(F.col("term").isNotNull())
    n_docs = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    totals = placed.groupBy("term").agg(F.count(F.lit(1)).alias("total")).orderBy(F.desc("total"), F.asc("term")).limit(max_features)
    # at most max_features rows
    vocabulary = totals.select("term", F.row_number().over(Window.orderBy(F.desc("total"), F.asc("term"))).alias("__n")).limit(max_features)
    tf = placed.join(vocabulary, "term").groupBy(doc_id, "__n").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("__n").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log((1 + n_docs) / (1 + F.col("df"))) + 1
    weights = vocabulary.join(df, "__n").select("__n", "term", idf.alias("idf")).limit(max_features)  # so Spark knows that they are few
    raw = tf.join(weights, "__n").select(
        doc_id, "term", "tf", (F.col("tf") * F.col("idf")).alias("w"))
    # The rows of a document are its distinct terms, at most max_features.
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(doc_id)))
    return raw.select(doc_id, "term", "tf", (F.col("w") / norm).alias("tfidf"))


def _detached(word: Column) -> Column:
    """The word with each matching suffix replaced."""
    forms = []
    for old, new in NOUN_SUFFIXES:
        stem = F.substr(word, F.lit(1), F.length(word) - len(old))
        forms.append(F.when(word.endswith(old), F.concat(stem, F.lit(new))))
    return F.filter(F.array(*forms), lambda f: f.isNotNull())


def _shortened(word: Column, most: int) -> Column:
    """A word cut by its rules until it is hardly longer than ``most``; longer forms are in no dictionary of such words.

    Only "s" and "ses" leave a form that another rule fits, so one form is carried along, whatever the word's length.
    """
    def cut(form: Column) -> Column:
        left = F.length(form) - F.when(form.endswith("ses"), 2).otherwise(1)
        return F.when((F.length(form) > most) & form.endswith("s"), F.substr(form, F.lit(1), left)).otherwise(form)

    steps = F.sequence(F.lit(1), F.greatest(F.length(word) - most, F.lit(1)))
    return F.when((F.length(word) > most) & word.endswith("s"), F.aggregate(steps, word, lambda form, _: cut(form))).otherwise(word)


def lemma_table(vocabulary: DataFrame, dictionary: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """Rows (word, lemma) for the words whose lemma differs from the word.

    Candidates are the word and its suffix-detached forms; of those in ``dictionary`` the
    shortest wins.  Forms are detached again while none is found, until no suffix fits.
    ``exceptions`` has rows (word, lemma) for irregular words and comes before the rules.
    Unknown words are left out, so they stay as they are.

    A frontier of unresolved (word, form) pairs is joined with the dictionary, one level of detaching a pass; each pass is
    a written table. Words leave it when a form is found or no suffix fits, and words longer than any in the
    dictionary enter it shortened, so there are fewer passes than letters in the longest dictionary word.
    """
    known = written(dictionary.select(F.col("word").alias("form")).where("form IS NOT NULL").distinct(), "dictionary")
    longest = known.agg(F.coalesce(F.max(F.length("form")), F.lit(0))).first()[0]
    w = F.col("word")
    frontier = vocabulary.select("word").where(w.isNotNull()).distinct().select("word", _shortened(w, longest + 2).alias("form"))
    found = None
    frontier = written(frontier, "lemma-frontier")
    while not frontier.isEmpty():
        hits = frontier.join(known, "form").groupBy("word").agg(F.min_by("form", F.length("form")).alias("lemma"))
        hits = written(hits, "lemmas-found")
        found = hits if found is None else found.unionByName(hits)
        # explode_outer: a plain explode would make Spark infer filters that make the forms again
        nxt = frontier.join(hits.select("word"), "word", "left_anti").select("word", F.explode_outer(_detached(F.col("form"))).alias("form"))
        frontier = written(nxt.where(F.col("form").isNotNull()).distinct(), "lemma-frontier")
    found = vocabulary.select("word", F.lit(None).cast("string").alias("lemma")).limit(0) if found is None else found
    if exceptions is not None:
        irregular = exceptions.select("word", "lemma").groupBy("word").agg(F.min("lemma").alias("lemma"))
        found = found.join(irregular, "word", "left_anti").unionByName(irregular)
    return found.where(F.col("word") != F.col("lemma"))


def lemmatize(docs: DataFrame, doc_id: str, text: str, lemmas: DataFrame) -> DataFrame:
    """Replace the words of a text by their lemmas; rows (doc_id, text).

    Only the distinct words of a document meet the lemma table, and only words that change
    come back, as one small map per document.
    """
    tokens = docs.select(doc_id, words(F.col(text)).alias("__words"))
    seen = tokens.select(doc_id, F.explode_outer(F.array_distinct("__words")).alias("word")).where(
        F.col("word").isNotNull())
    changed = skew_join(seen, lemmas, "word").groupBy(doc_id).agg(
        F.map_from_entries(F.collect_set(F.struct("word", "lemma"))).alias("__map"))
    replaced = F.transform("__words", lambda t: F.coalesce(F.col("__map")[t], t))
    out = F.when(F.col("__map").isNull(), F.col("__words")).otherwise(replaced)
    return tokens.join(changed, doc_id, "left").select(doc_id, F.array_join(out, " ").alias(text))


def clean_lemmatized(docs: DataFrame, doc_id: str, text: str, dictionary: DataFrame,
                     exceptions: DataFrame | None = None, strict_emoji: bool = False) -> DataFrame:
    """Full cleaning in order: markup and punctuation, lemmas, then emoji; rows (doc_id, text).

    A word with an emoji is unknown to the dictionary, keeps its form and loses the emoji afterwards.
    """
    bare = docs.select(doc_id, collapse_space(strip_markup(F.col(text))).alias(text))
    vocabulary = bare.select(F.explode_outer(words(F.col(text))).alias("word"))
    done = lemmatize(bare, doc_id, text, lemma_table(vocabulary, dictionary, exceptions))
    return done.withColumn(text, drop_emoji(F.col(text), strict_emoji))
