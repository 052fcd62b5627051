"""Text cleaning, labels, TF-IDF and lemmatisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnlake.functions.text import clean_text, sentiment_label, words
from tarnlake.operators import textstats as ops

from .proxies import ctes, proxy
from .registry import query, table

SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_SPACE = SPACE.replace("[", "[^", 1)
EMOJI = (r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2702}-\x{27B0}"
         r"\x{24C2}-\x{1F251}]+")
# Fixed values, as in the library.
PUNCT = "@#!?+&*[]-%.:/();$=><|{}^''`_"


def sql_lower_markup(expr: str) -> str:
    no_url = f"regexp_replace(lower({expr}), 'http{NOT_SPACE}+', '', 'g')"
    no_tag = f"regexp_replace({no_url}, '<.*?>', '', 'g')"
    bare = f"translate({no_tag}, '{PUNCT}', '')"
    return f"trim(regexp_replace({bare}, '{SPACE}+', ' ', 'g'))"


def sql_clean(expr: str) -> str:
    return f"regexp_replace({sql_lower_markup(expr)}, '{EMOJI}', '', 'g')"


@query("text_clean", f"""
select 'page' kind, page_id id, {sql_clean("url || ' ' || html")} as "text" from pages
union all select 'document', doc_id, {sql_clean('"text"')} from documents
union all select 'turn', conv_id * 1000 + turn, {sql_clean('"text"')} from conversations""")
def text_clean(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.concat_ws(" ", "url", "html").alias("text"))
    docs = table(spark, sf_dir, "documents").select(F.lit("document"), "doc_id", "text")
    turns = table(spark, sf_dir, "conversations").select(
        F.lit("turn"), F.col("conv_id") * 1000 + F.col("turn"), "text")
    return pages.union(docs).union(turns).withColumn("text", clean_text(F.col("text")))


@query("text_score_map", f"""
with {ctes("p_order_review")} select review_id, review_score::bigint review_score,
  case when review_score <= 3 then 'negative' else 'positive' end label from p_order_review""")
def text_score_map(spark, sf_dir):
    return proxy(spark, sf_dir, "p_order_review").select(
        "review_id", "review_score", sentiment_label(F.col("review_score")).alias("label"))


def sql_tfidf(max_features: int) -> str:
    return f"""
with docs as (select doc_id, {sql_clean('"text"')} body from documents),
tokens as (select doc_id, unnest(regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}_]{{2,}}')) term from docs),
tf as (select doc_id, term, count(*) tf from tokens group by 1, 2),
vocabulary as (select term, sum(tf) total, count(*) df from tf group by term order by total desc, term limit {max_features}),
raw as (select tf.doc_id, tf.term, tf.tf, tf.tf * (ln((1 + (select count(*) from docs)) / (1 + v.df)) + 1) w
  from tf join vocabulary v on tf.term = v.term),
norms as (select doc_id, sqrt(sum(w * w)) norm from raw group by doc_id)
select raw.doc_id, raw.term, raw.tf, round(w / norm, 8) tfidf from raw join norms on raw.doc_id = norms.doc_id"""


@query("text_tfidf", sql_tfidf(15000))
def text_tfidf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", clean_text(F.col("text")).alias("body"))
    return ops.tfidf(docs, "doc_id", "body", 15000).withColumn("tfidf", F.round("tfidf", 8))


RULES = (("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
         ("men", "man"), ("ies", "y"))


_RULES_SQL = ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(RULES, 1))


@query("text_lemmatize", f"""
with recursive toks as (select doc_id, string_split(body, ' ') ws from (
    select doc_id, {sql_lower_markup('"text"')} body from documents)),
words as (select distinct unnest(ws) word from toks),
dictionary as (select distinct unnest(string_split({sql_clean('"text"')}, ' ')) form from benchmark),
rules(i, old, new) as (values {_RULES_SQL}),
candidates(word, lvl, path, form) as (select word, 0, []::int[], word from words
  union all select word, lvl + 1, list_append(path, i), left(form, length(form) - length(old)) || new
  from candidates join rules on suffix(form, old)),
best as (select word, form from (select c.*, row_number() over (partition by word order by lvl, length(c.form), path) rn
  from candidates c join dictionary d on c.form = d.form) where rn = 1),
placed as (select doc_id, unnest(ws) word, generate_subscripts(ws, 1) pos from toks)
select doc_id, regexp_replace(string_agg(coalesce(best.form, placed.word), ' ' order by pos), '{EMOJI}', '', 'g') as "text"
from placed left join best on placed.word = best.word group by doc_id""")
def text_lemmatize(spark, sf_dir):
    """Cleaned in the full order: markup, lemmas, emoji. The words of the benchmark texts serve as the dictionary."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bench = table(spark, sf_dir, "benchmark").select(clean_text(F.col("text")).alias("text"))
    dictionary = bench.select(F.explode_outer(words(F.col("text"))).alias("word"))
    return ops.clean_lemmatized(docs, "doc_id", "text", dictionary)
