"""Labelled samples: which rows a model may learn from, and a bounded number of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_SPACE = 1 << 20


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(0)).cast("int")


def bounded_sample(rows: DataFrame, label_col: str, id_col: str, bound: int) -> DataFrame:
    """(id, label) of about ``bound`` rows of each label value, or all rows where a label has no more.

    Rows are chosen by a hash of their id, so the choice does not depend on
    order or partitioning. The size is bounded by the parameter at every input
    size; it is a sample for fitting models only.
    """
    keyed = rows.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col), F.col(label_col)
    )
    counts = keyed.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    place = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), F.lit(SAMPLE_SPACE))
    return (
        keyed.join(F.broadcast(counts), label_col)
        .where(place * F.col("_n") < F.lit(bound * SAMPLE_SPACE))
        .select(id_col, label_col)
    )


def sample_texts(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, _y, text) with one text per sampled id, so that rows are bounded like ids.

    Where rows of an id have different texts, the one with the smallest hash
    stands for all; the choice does not depend on order or partitioning.
    """
    rows = docs.select(F.col(id_col), F.col(text_col)).join(F.broadcast(chosen), id_col)
    least = F.min_by(F.col(text_col), F.struct(F.xxhash64(text_col), F.sha2(F.col(text_col), 256)))
    return rows.groupBy(id_col, "_y").agg(least.alias(text_col))


def binary_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """One row per id with label 0 or 1; repeated rows of an id count as 1 if any says 1."""
    return (
        labels.select(F.col(id_col), F.col(label_col).cast("int").alias("_y"))
        .where(F.col(id_col).isNotNull() & F.col("_y").isin(0, 1))
        .groupBy(id_col)
        .agg(F.max("_y").alias("_y"))
    )
