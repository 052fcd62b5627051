"""The registered queries of this package, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bottom_k, chat_format, conversation_repair, decontaminate, language_id, line_dedup, ngram_join, packing, quality_classifier,
               quality_rules, ranked_search, token_counts, training_order)
from .tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled good and not toxic."""
    return read(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_rules.rate(docs, trusted_ids(spark, sf_dir)).select("doc_id", F.col("__found.*"))


def tokenizer_json(path: str | None = None) -> str:
    """The definition of a tokenizer, by default the public one with word ends."""
    import public_tokenizers

    with open(path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.pack(docs, tokenizer_json())
    found = F.col("__found")
    return pieces.select("doc_id", found["start"].alias("start"), found["length"].alias("length"),
                         F.crc32(found["ids"]).alias("ids_crc32"), found["doc_tokens"].alias("doc_tokens"),
                         found["sequence_id"].alias("sequence_id"), found["offset"].alias("offset"),
                         found["tier"].cast("long").alias("tier"), found["step_id"].alias("step_id"))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"))


_WORDS = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{word}')"


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    found = F.col("__found")
    return judged.select("doc_id", found["n_words"].alias("n_words"), found["n_hit"].alias("n_hit"),
                         F.size(found["items"]).cast("long").alias("n_items"),
                         F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
                         found["contaminated"].alias("contaminated"))


ORACLES["op9_decontamination"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {d} AS w FROM documents),
b AS (SELECT row_number() OVER () AS i, item_id, {b} AS w FROM benchmark),
bw AS (SELECT i, item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[k:k + 12], ' ') AS s FROM bw),
lengths AS (SELECT DISTINCT n FROM windows),
dw AS (SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS s
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, lengths WHERE len(w) >= n)),
found AS (SELECT r, k, dw.n, item_id FROM dw JOIN windows ON dw.n = windows.n AND dw.s = windows.s),
hit AS (SELECT r, count(*) AS n_hit FROM
        (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(k, k + n)) AS p FROM found)) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(cast(item_id AS varchar), ',' ORDER BY cast(item_id AS varchar)) AS l
        FROM (SELECT DISTINCT r, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
""".format(d=_WORDS.format(text="text", word=r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
           b=_WORDS.format(text="text", word=r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")).strip()


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes_of(read(spark, sf_dir, "documents"))


ORACLES["op1_ngram_join"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, {d} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') || CASE WHEN len(w) < 5 THEN '#' ELSE '' END AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id
          GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN size p ON a = p.doc_id JOIN size q ON b = q.doc_id
          WHERE 100 * k >= 80 * (p.n + q.n - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, least(d.doc_id, coalesce(min(b), d.doc_id)) AS component_id
FROM d LEFT JOIN size USING (doc_id) LEFT JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id
""".format(d=_WORDS.format(text="text", word=r"[^\x20\x09-\x0D]+")).strip()


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", F.col("__found.n_lines").alias("n_lines"), F.col("__found.n_removed").alias("n_removed"),
                       F.md5(F.col("text").cast("binary")).alias("text_md5"))


ORACLES["op7_line_dedup"] = r"""
WITH raw AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i - 1 AS line, ls[i] AS t FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM raw)),
w AS (SELECT doc_id, line, t, {d} AS w FROM l),
p AS (SELECT doc_id, line, w, array_to_string(w, ' ') AS s FROM w WHERE len(w) > 0),
u AS (SELECT s, any_value(w) AS w, min((doc_id, line)) AS first FROM p GROUP BY s),
v AS (SELECT s, first, i, array_to_string(w[:i - 1] || w[i + 1:], ' ') AS k
      FROM (SELECT s, w, first, unnest(range(1, len(w) + 1)) AS i FROM u WHERE len(w) >= 5)),
near AS (SELECT s FROM (SELECT s, first, min(first) OVER (PARTITION BY i, k) AS other FROM v) WHERE other < first
         UNION SELECT v.s FROM v JOIN u ON v.k = u.s WHERE u.first < v.first AND len(u.w) >= 5
         UNION SELECT u.s FROM v JOIN u ON v.k = u.s WHERE v.first < u.first AND len(u.w) >= 5),
gone AS (SELECT doc_id, line FROM p JOIN u USING (s) WHERE (doc_id, line) <> first OR s IN (SELECT s FROM near))
SELECT l.doc_id, count(*) AS n_lines, count(gone.line) AS n_removed,
       md5(coalesce(string_agg(t, chr(10) ORDER BY l.line) FILTER (gone.line IS NULL), '')) AS text_md5
FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.line = gone.line GROUP BY l.doc_id
""".format(d=_WORDS.format(text="t", word=r"[^\x20\x09-\x0D]+")).strip()


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), tokenizer_json()).select("doc_id", F.col("__found.*"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    learns = language_id.learns("doc_id")
    model = language_id.fit(docs.where(learns))
    held_out = F.col("doc_id").isNotNull() & ~learns
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), F.col("__found.lang_pred").alias("lang_pred"),
                        F.col("__found.score").alias("score"))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good: labelled of high quality and not toxic."""
    docs = read(spark, sf_dir, "documents")
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int").alias("label")
    model = quality_classifier.fit(docs, read(spark, sf_dir, "labels").select("doc_id", good))
    return quality_classifier.classify(docs, model).select(
        "doc_id", *[F.round(f"__found.{c}", 9).alias(c) for c in ("score", "text_score", "meta_score")],
        F.col("__found.good").alias("good"))


@query
def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each slot of the written shards: where it is, a digest of its ids as read back, and its first document."""
    shards, manifest = training_order.materialise(read(spark, sf_dir, "documents"), tokenizer_json(), key=20240117)
    back = training_order.read_slots(spark, shards).select("slot", F.crc32("ids").alias("ids_crc32"))
    return manifest.join(back, "slot").select("slot", "shard", "byte_offset", "ids_crc32",
                                              F.col("first_key").alias("first_doc_id"), "n_tokens")


@query
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles are learnt from two thirds of the conversations and recovered in all."""
    found = chat_format.parse(read(spark, sf_dir, "conversations"), learns=language_id.learns("conv"))
    return found.select(F.col("conv").alias("conv_id"), "turn", "place", F.col("piece").cast("long").alias("piece"),
                        F.col("role").alias("role_pred"), "begins", "rendered")


@query
def op11_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom_k.near_duplicates(read(spark, sf_dir, "documents"))


ORACLES["op11_bottom_k"] = ("SELECT *, doc_id = component_id AS kept FROM (" + ORACLES["op1_ngram_join"].replace(
    "100 * k >= 80 * ", "100 * k >= 85 * ") + ")")


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.build(read(spark, sf_dir, "documents"))
    found = ranked_search.search(index, read(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", F.col("found").alias("doc_id"), "score")


ORACLES["op13_ranked_search"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {d} AS w FROM documents),
st AS (SELECT count(*) AS n_docs, cast(sum(len(w)) AS bigint) AS n_all FROM d WHERE len(w) > 0),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
f AS (SELECT t, cast(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS bigint) AS wt FROM p, st GROUP BY t),
b AS (SELECT row_number() OVER () AS i, item_id, {d} AS w FROM benchmark),
q AS (SELECT i, t, count(*) AS k FROM (SELECT i, unnest(w) AS t FROM b) GROUP BY i, t),
m AS (SELECT r, doc_id, 25 + (75 * len(w) * n_docs) // n_all AS m FROM d, st WHERE len(w) > 0),
s AS (SELECT i, r, cast(sum(k * wt * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS bigint) AS score
      FROM q JOIN f USING (t) JOIN p USING (t) JOIN m USING (r) GROUP BY i, r),
o AS (SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
      FROM s JOIN m USING (r) WHERE score > 0)
SELECT item_id, cast(rank AS int) AS rank, doc_id, score FROM o JOIN b USING (i) WHERE rank <= 10
""".format(d=_WORDS.format(text="text", word=r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).strip()


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut, repeated or given to the user, by a hash of conversation and turn."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), times)).alias("copy")) \
        .drop("copy")


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of every conversation of the damaged table, the audit of its edits and a digest of the repaired turns."""
    turns = read(spark, sf_dir, "conversations")
    edits, report = conversation_repair.repair(damaged(turns))
    texts = conversation_repair.digests(edits).withColumnRenamed("conv", "c")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = turns.select("conv_id").distinct().join(report, F.col("conv_id").eqNullSafe(F.col("conv")), "left") \
        .join(texts, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    return found.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
