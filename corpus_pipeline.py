"""Corpus pipeline: language ID, toxicity, near-duplicates, decontamination, BPE.

``STAGES`` lists (name, function) in order. Each function takes (spark, docs,
sf_dir) and returns a frame; ``run`` writes each result as Parquet in the shared
folder and rereads it as the next stage's ``docs``, so a lost executor repeats
at most one stage. All stages but the last return the columns of ``documents``.

Edge cases, per stage: a null or letterless text is rejected by the language
stage; null labels are not learned from; every row has its own verdict in the
near-duplicate and decontamination stages (by id and text), so rows without id
are copies or leaks like any others, and where an id repeats a clean text stays
when another goes; an empty table passes through as empty. Extra columns pass
through every filtering stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundtrail.llm import bpe, decontam, language, neardup, toxicity
from fundtrail.llm.labelled import fold
from fundtrail.llm.registry import tokenizer_path
from fundtrail.llm.rows import row_key, without_rows
from fundtrail.session import materialize, release, scratch

TOXIC_SCORE = 0.7


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is one of those learned."""
    profiles = language.fit_profiles(docs, learn_from=fold("doc_id", 5) != 0)
    return language.filter_language(docs, profiles)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that score under ``TOXIC_SCORE``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit_toxicity(docs, labels, learn_from=fold("doc_id", 3) != 1)
    return toxicity.filter_toxicity(docs, model, TOXIC_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document (the smallest id) of each near-duplicate group: five words, similarity 0.8."""
    return neardup.drop_near_duplicates(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents without a benchmark item."""
    keyed = docs.select(row_key().alias("row"), "text")
    leaks = decontam.find_leaks(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="row")
    return without_rows(docs, leaks.select("row.*").distinct())


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the check that they decode again."""
    out = bpe.encode_decode(docs, tokenizer_path())
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("bpe", tokens),
]

# Classifiers, banding and BPE are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scratch(spark) as keep:  # a stage's own tables go when its result is written
            after = keep(materialize(stage(spark, docs, sf_dir), f"pipeline-{name}"))
        release(docs)
        docs = after
    return docs
