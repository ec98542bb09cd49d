"""Verdicts on rows: a row is known by its id and a hash of its text, so rows that share an id, or have none, each get their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for a null id; sorts behind every other.
NO_ID = (1 << 63) - 1


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """struct(id, mark), both never null."""
    return F.struct(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(F.col(text_col)).alias("mark")
    )


def _with_rows(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    """Rows of ``docs`` whose key is (left_semi) or is not (left_anti) in ``keys`` (id, mark)."""
    wanted = keys.select(F.col("id").alias("i"), F.col("mark").alias("m")).alias("_keys")
    mine = docs.alias("_docs")
    id_value, text = F.col(f"_docs.`{id_col}`"), F.col(f"_docs.`{text_col}`")
    same = (F.coalesce(id_value.cast("long"), F.lit(NO_ID)) == F.col("_keys.i")) & (F.xxhash64(text) == F.col("_keys.m"))
    return mine.join(wanted, same, how).select("_docs.*")


def without_rows(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return _with_rows(docs, keys, id_col, text_col, "left_anti")


def only_rows(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return _with_rows(docs, keys, id_col, text_col, "left_semi")
