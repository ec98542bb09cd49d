"""Language ID by rank-order profiles of character n-grams.

A profile ranks the most frequent 1- to 3-grams of a language's training
texts; a document's most frequent n-grams are ranked the same way. The
out-of-place distance adds, over the document's ranked n-grams, how far each
is from its rank in the profile (the profile size where it is missing). The
nearest language wins, the alphabetically first on a tie.

N-grams are taken from letters only, lower-cased; every other run of
characters is one word break, which takes part in 2- and 3-grams. Profiles
come from one Spark aggregate; only the profiles (a few hundred rows per
language) reach the driver. Prediction is one pass over the texts.

Edge cases: a null text, or one without a letter, is ``und`` with score 0;
training rows with null text, language or id are skipped; with no profile
every text is ``und``; with one language the score is 1. Texts are never cut.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundtrail.llm.labelled import bounded_sample

PROFILE_SIZE = 300
SAMPLE_PER_LANGUAGE = 3_000
UNKNOWN = "und"
BLOCK_CHARS = 1 << 17
_CHAR_BITS = 21

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _letters


def _text_blocks(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """(first row, end row, lower-cased texts) for runs of whole texts; only one run is held as Python text."""
    low, size, part = 0, 0, []
    for i in range(len(column)):
        text = (column[i].as_py() or "").lower()
        part.append(text)
        size += len(text)
        if size >= BLOCK_CHARS:
            yield low, i + 1, part
            low, size, part = i + 1, 0, []
    if part:
        yield low, len(column), part


def _ngram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, n-gram, count), sorted by text and n-gram, for the n-grams of 1 to 3 characters.

    An n-gram is an integer of three 21-bit places: 0 is no character, 1 a word
    break, anything else a letter's code point.
    """
    # a line break closes every text, so no n-gram runs from one text into the next
    chars = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    is_letter = _letter_table()[chars]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # of a run of other characters, the first stays as the break
    codes, owner = np.where(is_letter, chars, 1)[keep], owner[keep]
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # the block's own small alphabet keeps the sort keys short
    alphabet = np.flatnonzero(np.bincount(codes))
    alphabet = np.concatenate([[0], alphabet]).astype(np.int64)
    lookup = np.zeros(int(alphabet[-1]) + 1, np.int64)
    lookup[alphabet] = np.arange(len(alphabet))
    short = lookup[codes]
    bits = int(len(alphabet)).bit_length()
    if 3 * bits + len(texts).bit_length() > 62 and len(texts) > 1:
        half = len(texts) // 2
        (ta, ga, ca), (tb, gb, cb) = _ngram_counts(texts[:half]), _ngram_counts(texts[half:])
        return np.concatenate([ta, tb + half]), np.concatenate([ga, gb]), np.concatenate([ca, cb])
    base = owner << (3 * bits)
    start = np.ones(len(short), bool)
    start[1:] = owner[1:] != owner[:-1]
    first = lookup[1]
    before = np.empty_like(short)
    before[1:] = short[:-1]
    before[start] = first
    letter = short != first
    after = np.append(short[1:], first)
    keys = np.concatenate(
        [
            (base | short)[letter],
            base | (before << bits) | short,
            (base | (before << (2 * bits)) | (short << bits) | after)[letter],
        ]
    )
    keys.sort()
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(keys)))
    keys = keys[at]
    mask = (1 << bits) - 1
    gram = (
        (alphabet[(keys >> (2 * bits)) & mask] << (2 * _CHAR_BITS))
        | (alphabet[(keys >> bits) & mask] << _CHAR_BITS)
        | alphabet[keys & mask]
    )
    return keys >> (3 * bits), gram, counts


def fit_profiles(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    learn_from: Column | None = None,
    profile_size: int = PROFILE_SIZE,
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
) -> dict[str, dict[int, int]]:
    """Language -> n-gram -> rank (from 0).

    ``sample_per_language`` bounds the training texts of each language (chosen
    by a hash of the id); ``learn_from`` says which rows may be used.
    """
    rows = docs if learn_from is None else docs.where(learn_from)
    chosen = bounded_sample(rows, lang_col, id_col, sample_per_language).distinct()
    # the text column is read next to its own language, not through a join
    sample = (
        rows.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
        .where("_lang is not null and _text is not null")
        .join(
            F.broadcast(chosen.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"))),
            ["_id", "_lang"],
            "left_semi",
        )
        .select("_lang", "_text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.asarray(batch.column("_lang").to_pylist(), dtype=object)
            for a, b, part in _text_blocks(batch.column("_text")):
                text, gram, counts = _ngram_counts(part)
                for lang in sorted(set(langs[a:b])):
                    mine = langs[a:b][text] == lang
                    grams, place = np.unique(gram[mine], return_inverse=True)
                    sums = np.bincount(place, weights=counts[mine], minlength=len(grams)).astype(np.int64)
                    yield pa.RecordBatch.from_pydict({"lang": [lang] * len(grams), "gram": grams, "n": sums})

    counted = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < profile_size)
    profiles: dict[str, dict[int, int]] = {}
    for row in top.select("lang", "gram", "rank").collect():
        profiles.setdefault(row["lang"], {})[row["gram"]] = row["rank"]
    return dict(sorted(profiles.items()))


def _distances(
    part: list[str], grams: np.ndarray, ranks: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Out-of-place distance of each text to each profile, and the n-grams ranked for each text."""
    n, langs = len(part), ranks.shape[1]
    text, gram, counts = _ngram_counts(part)
    top = np.int64(counts.max(initial=0) + 1)
    order = np.argsort(text * top + (top - counts), kind="stable")  # ties by n-gram
    text, gram = text[order], gram[order]
    place = np.arange(len(text)) - np.searchsorted(text, np.arange(n))[text]
    ranked = place < size
    text, gram, place = text[ranked], gram[ranked], place[ranked]
    at = np.minimum(np.searchsorted(grams, gram), max(0, len(grams) - 1))
    known = grams[at] == gram
    out = np.empty((n, langs))
    for k in range(langs):
        there = np.where(known, ranks[at, k], -1)
        away = np.where(there >= 0, np.abs(there - place), size)
        out[:, k] = np.bincount(text, weights=away, minlength=n)
    return out, np.bincount(text, minlength=n)


def _predictor(profiles: dict[str, dict[int, int]], profile_size: int):
    """A function from texts to (language names, scores)."""
    names = sorted(profiles)
    grams = np.array(sorted({g for p in profiles.values() for g in p}), dtype=np.int64)
    ranks = np.full((len(grams), len(names)), -1, np.int64)
    for k, name in enumerate(names):
        mine = profiles[name]
        ranks[np.searchsorted(grams, np.fromiter(mine, np.int64, len(mine))), k] = list(mine.values())
    label = np.array(names + [UNKNOWN], dtype=object)

    def predict(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pred, score = np.full(len(texts), len(names)), np.zeros(len(texts))
        if names:
            for a, b, part in _text_blocks(texts):
                away, n = _distances(part, grams, ranks, profile_size)
                near = np.sort(away, axis=1)
                if len(names) > 1:
                    sure = np.where(near[:, 1] > 0, near[:, 1] / np.maximum(near[:, 0] + near[:, 1], 1e-12), 0.5)
                else:
                    sure = np.ones(len(part))
                pred[a:b] = np.where(n > 0, np.argmin(away, axis=1), len(names))
                score[a:b] = np.where(n > 0, sure, 0.0)
        return label[pred], score

    return predict


def predict_language(
    docs: DataFrame,
    profiles: dict[str, dict[int, int]],
    id_col: str = "doc_id",
    text_col: str = "text",
    profile_size: int = PROFILE_SIZE,
) -> DataFrame:
    """(id, lang_pred, score): nearest profile; score is second / (first + second) distance, from 0.5 to 1."""
    predict = _predictor(profiles, profile_size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score = predict(batch.column("_text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(pred.tolist(), pa.string()), pa.array(score)],
                ["_id", "lang_pred", "score"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        run, f"_id {kind}, lang_pred string, score double"
    )
    return found.withColumnRenamed("_id", id_col)


def filter_language(
    docs: DataFrame,
    profiles: dict[str, dict[int, int]],
    text_col: str = "text",
    languages: list[str] | None = None,
    profile_size: int = PROFILE_SIZE,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is in one of ``languages`` (default: any learned one).

    A text that is ``und`` or lies exactly between two languages is rejected.
    """
    predict = _predictor(profiles, profile_size)
    wanted = set(profiles if languages is None else languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score = predict(batch.column(text_col))
            keep = np.fromiter((p in wanted for p in pred), bool, len(pred)) & (score > 0.5)
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
