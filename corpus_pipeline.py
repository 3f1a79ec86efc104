"""Cleaning of a corpus: toxic documents, repeated lines, near duplicates and benchmark leaks go; the rest is encoded.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; all but the last return the columns of
``documents``. Rows with null columns stay in unless a stage's rule rejects them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import bpe, decontaminate, line_dedup, ngram_join, toxicity
from tessella.llm.queries import table, vocabulary
from tessella.session import save


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier toxic than not go; the model is fitted on the labelled rows outside the held-out fold."""
    out = toxicity.held_out("doc_id", 5, 0)
    model = toxicity.fit(docs.where(~out), table(spark, sf_dir, "labels").where(~out))
    return toxicity.score(docs, model).where("toxicity < 0.5").select(*docs.columns)


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated line runs lose their later copies; ``n_chars`` follows. A document of which nothing but white space is left
    was a copy as a whole and goes; one that lost no line stays, empty or not."""
    done = line_dedup.dedup(docs)
    done = done.where((F.size("removed_lines") == 0) | (F.regexp_replace("text", r"\s+", "") != "")).select(*docs.columns)
    return done.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else done


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates stays, the one with the smallest id."""
    return ngram_join.keep_one(docs).select(*docs.columns)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark windows go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def stage_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it."""
    done = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), vocabulary())
    return done.select(
        "doc_id",
        "lang",
        "source",
        F.size("token_ids").cast("long").alias("n_tokens"),
        "token_ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"),
    )


STAGES = [
    ("toxicity", stage_toxicity),
    ("line_dedup", stage_line_dedup),
    ("near_duplicates", stage_near_duplicates),
    ("decontaminate", stage_decontaminate),
    ("encode", stage_encode),
]

#: The first stage is a fitted model, which SQL can't express; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
    return docs
