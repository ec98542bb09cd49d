"""Language ID, toxicity and quality: held-out accuracy, folds, and odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundtrail.llm import language, quality, registry, toxicity
from fundtrail.llm.labelled import binary_labels, bounded_sample, fold, sample_texts
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.helpers import has_letter, odd_documents


def area(scores, labels):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(len(scores))
    ones = labels == 1
    n = ones.sum()
    return (rank[ones].sum() - n * (n - 1) / 2) / (n * (len(labels) - n))


def test_folds_and_samples(spark):
    ids = spark.range(500).withColumnRenamed("id", "doc_id").withColumn("y", F.col("doc_id") % 2)
    rows = ids.select("doc_id", fold("doc_id", 5).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in rows)
    few = bounded_sample(ids, "y", "doc_id", 50).groupBy("y").count().collect()
    assert all(20 <= r["count"] <= 90 for r in few)
    assert bounded_sample(ids, "y", "doc_id", 500).count() == 500
    odd = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1), (3, 5), (4, 0)], "doc_id long, toxic int")
    assert sorted(tuple(r) for r in binary_labels(odd, "doc_id", "toxic").collect()) == [(1, 1), (4, 0)]


def test_language_held_out(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    rows = registry.op8_language_id(spark, SF_MID).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def brute_ngrams(text):
    """Counts of 1- to 3-grams with one break for every run of other characters."""
    from collections import Counter

    chars, out = ["_"], Counter()
    for c in (text or "").lower() + "\n":
        if c.isalpha():
            chars.append(c)
        elif chars[-1] != "_":
            chars.append("_")
    if len(chars) == 1:
        return out
    for k in range(1, len(chars)):
        out[chars[k - 1] + chars[k]] += 1
        if chars[k] != "_":
            out[chars[k]] += 1
            out[chars[k - 1] + chars[k] + chars[k + 1]] += 1
    return out


def test_ngrams_equal_plain_counts():
    texts = ["Hello, world! hello", "", "123", "é漢字 é\tÉ", "a", "...b...", "x y  z"]
    text, gram, counts = language._ngram_counts([t.lower() for t in texts])
    mask = (1 << 21) - 1
    name = lambda g: "".join("_" if c == 1 else chr(c) for c in ((g >> 42) & mask, (g >> 21) & mask, g & mask) if c)
    for k, t in enumerate(texts):
        mine = {name(int(g)): int(n) for i, g, n in zip(text, gram, counts, strict=True) if i == k}
        assert mine == dict(brute_ngrams(t))


def test_out_of_place_distance():
    order = lambda t: [g for g, _ in sorted(brute_ngrams(t).items(), key=lambda x: (-x[1], code(x[0])))]

    def code(g):
        n = 0
        for c in g:
            n = n << 21 | (1 if c == "_" else ord(c))
        return n

    profiles = {"aa": "abc abc abd", "bb": "xyz xy x abc"}
    ranked = {k: {code(g): r for r, g in enumerate(order(t)[:20])} for k, t in profiles.items()}
    grams = np.array(sorted({g for p in ranked.values() for g in p}))
    ranks = np.array([[p.get(int(g), -1) for p in ranked.values()] for g in grams])
    texts = ["abc xyz", "zzz", "ab ab"]
    away, n = language._distances(texts, grams, ranks, 20)
    for k, t in enumerate(texts):
        top = order(t)[:20]
        for j, p in enumerate(ranked.values()):
            assert away[k, j] == sum(abs(p[code(g)] - r) if code(g) in p else 20 for r, g in enumerate(top))
        assert n[k] == len(top)


def test_language_odd_rows(spark):
    docs = odd_documents(spark)
    profiles = language.fit_profiles(docs)
    assert sorted(profiles) == ["en", "fr"]
    for r in language.predict_language(docs, profiles).join(docs.select("doc_id", "text"), "doc_id").collect():
        assert (r["lang_pred"] == "und") == (not has_letter(r["text"]))
        assert (r["score"] == 0) == (r["lang_pred"] == "und")
    kept = language.filter_language(docs, profiles)
    assert kept.columns == docs.columns
    assert all(has_letter(r["text"]) for r in kept.collect())
    empty = docs.limit(0)
    assert language.fit_profiles(empty) == {}
    assert language.predict_language(docs, {}).where("lang_pred <> 'und'").count() == 0
    assert language.predict_language(empty, profiles).count() == 0
    assert set(language.predict_language(docs, {"en": profiles["en"]}).where("score > 0").toPandas()["score"]) == {1.0}


@pytest.mark.parametrize("op,label", [("op10_toxicity", "toxic"), ("op5_quality", "quality")])
def test_held_out_classification(spark, op, label):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    rows = registry.queries()[op](spark, SF_MID).collect()
    assert len(rows) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    limit = {"toxic": 0.7, "quality": 0.5}[label]
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= limit)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    score, y = np.array(held).T
    assert area(score, y) > 0.93
    assert np.mean((score >= limit) == y) > 0.9


@pytest.mark.parametrize("module,fit,score", [(toxicity, "fit_toxicity", "score_toxicity"), (quality, "fit_quality", "score_quality")])
def test_odd_rows(spark, module, fit, score):
    docs = odd_documents(spark)
    column = "toxic" if module is toxicity else "quality"
    labels = spark.createDataFrame(
        [(1, 1), (2, 1), (9, 0), (7, 0), (8, 0), (4, 0), (None, 1), (10, None), (99, 1)], f"doc_id long, {column} int"
    )
    model = getattr(module, fit)(docs, labels)
    rows = getattr(module, score)(docs, model).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    same = {r["score"] for r in rows if r["doc_id"] in (1, 2)}
    assert len(same) == 1
    assert len({r["score"] for r in rows if r["doc_id"] in (3, 4)}) == 1  # null counts as empty
    none = getattr(module, fit)(docs, labels.limit(0))
    assert {r["score"] for r in getattr(module, score)(docs, none).collect()} == {0.0 if module is toxicity else 0.5}
    assert getattr(module, score)(docs.limit(0), model).count() == 0


def test_repeated_ids_stay_bounded(spark):
    """One id on thousands of rows gives the driver one text, the same in any order."""
    rows = spark.range(3000).selectExpr("1L as doc_id", "concat('text ', id) as text")
    docs = rows.union(spark.createDataFrame([(2, None), (2, None), (3, "a")], "doc_id long, text string"))
    chosen = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, _y int")
    first = sorted(tuple(r) for r in sample_texts(docs, chosen, "doc_id", "text").collect())
    again = sorted(tuple(r) for r in sample_texts(docs.repartition(7), chosen, "doc_id", "text").collect())
    assert first == again and [r[0] for r in first] == [1, 2] and first[1][2] is None


def test_sample_places_are_bounded(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    sample = docs.selectExpr("doc_id as _key", "cast(doc_id % 2 as int) as _y", "text as _text")
    rows = toxicity._sparse_rows(sample, "_text", np.arange(0, 1 << toxicity.PLACE_BITS, 32))
    sizes = {r["_key"]: r["n"] for r in rows.collect()}
    assert all(len(r["row"]) == 4 * r["n"] for r in rows.collect())
    total = sum(sizes.values())
    assert toxicity._within(rows, total).count() == len(sizes)
    half = [r["n"] for r in toxicity._within(rows, total // 2).collect()]
    assert total // 2 - max(sizes.values()) <= sum(half) <= total // 2
    assert toxicity._within(rows, 0).count() == 0 or sum(r["n"] for r in toxicity._within(rows, 0).collect()) == 0


def test_toxic_filter_keeps_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    kept = toxicity.filter_toxicity(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
    scores = toxicity.score_toxicity(docs, model)
    assert kept.count() == scores.where("score < 0.7").count()
