"""Registered queries of the training-data operators: thin, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundtrail.llm import ballcodes, bpe, counts, decontam, language, licenses, neardup, pages, quality, toxicity, urls, vectors, whitening
from fundtrail.llm.labelled import fold
from fundtrail.llm.oracle import ball_codes_sql

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Fixed rules of the url query.
URL_RULES = [
    urls.UrlRule("com", "/", "allow"),
    urls.UrlRule("example.com", "/en/", "block"),
    urls.UrlRule("www.example.com", "/en/", "allow"),
    urls.UrlRule("net", "/es/", "block"),
    urls.UrlRule("net", "/fr/", "block"),
]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer file of the registered queries; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_read(spark, sf_dir, "documents"))
    words = F.transform("base", lambda b: b["word"])
    base = F.transform("base", lambda b: b["label"])
    every = F.concat(base, F.transform("detections", lambda d: d["label"]))
    sure = F.transform("detections", lambda d: d["confidence"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(every)), ",").alias("labels"),
        F.coalesce(
            F.greatest(F.array_max(sure), F.when(F.size("base") > 0, licenses.PLAIN_CONFIDENCE)), F.lit(0.0)
        ).alias("score"),
        F.size("detections").cast("long").alias("n_detections"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(_read(spark, sf_dir, "documents"), tokenizer_path())
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(_read(spark, sf_dir, "pages"), URL_RULES)


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"), size=3, percent=85)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    model = quality.fit_quality(docs, labels, learn_from=fold("doc_id", 3) != 1)
    return quality.score_quality(docs, model).select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_read(spark, sf_dir, "embeddings"), threshold=0.9)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontam.find_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return leaks.withColumn("similarity", 1 - F.col("edits") / F.col("item_words"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    profiles = language.fit_profiles(docs, learn_from=fold("doc_id", 5) != 0)
    return language.predict_language(docs, profiles).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score"
    )


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_text(_read(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(docs, labels, learn_from=fold("doc_id", 3) != 1)
    return toxicity.score_toxicity(docs, model).select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = counts.count_tokens(_read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op12_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ballcodes.ball_codes(_read(spark, sf_dir, "embeddings"))
    digits = F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return ballcodes.with_label_errors(found.rows).select(
        F.col("id").alias("vec_id"),
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(found.books.sha256 if found.books else None).cast("string").alias("codebooks_sha256"),
    )


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _read(spark, sf_dir, "embeddings")
    model = whitening.fit_whitening(embeddings)
    out = whitening.whiten(embeddings, model)
    explained = F.array(*map(F.lit, model.explained)) if model and model.explained else F.array().cast("array<double>")
    return out.select(
        "vec_id",
        "component",
        F.lit(model.n if model else 0).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"),
        "whitened",
        F.get(explained, F.col("component") - 1).alias("explained"),
        F.lit(model.identity_error if model else None).cast("double").alias("identity_error"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_bpe": op2_bpe,
        "op3_url_filter": op3_url_filter,
        "op4_minhash_dedup": op4_minhash_dedup,
        "op5_quality": op5_quality,
        "op6_embedding_dedup": op6_embedding_dedup,
        "op7_decontamination": op7_decontamination,
        "op8_language_id": op8_language_id,
        "op9_html_text": op9_html_text,
        "op10_toxicity": op10_toxicity,
        "op11_token_counts": op11_token_counts,
        "op12_ball_codes": op12_ball_codes,
        "op13_embedding_whitening": op13_embedding_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {"op12_ball_codes": ball_codes_sql()}
