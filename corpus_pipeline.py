"""From raw documents to packed training sequences: five stages, each a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarnlake.llm import decontaminate, line_dedup, ngram_join, quality_rules
from tarnlake.llm.queries import packed, trusted_ids
from tarnlake.llm.tables import read, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    rated = quality_rules.rate(docs, trusted_ids(spark, sf_dir), keep=docs.columns)
    return rated.where("__found.kept").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand, equal or nearly so, earlier in the corpus; documents left without words go."""
    return line_dedup.without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a twentieth or more of their words in benchmark passages."""
    judged = decontaminate.contamination(docs, read(spark, sf_dir, "benchmark"), keep=docs.columns)
    return judged.where("NOT __found.contaminated").select(docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return packed(docs)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("ngram_join", near_duplicates),
          ("decontamination", decontaminated), ("packing", sequences)]
#: The ratio's hashes, tokens and packing are not for SQL; tests compare each stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
