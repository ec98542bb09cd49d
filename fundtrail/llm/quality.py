"""Quality: nearest-neighbour voting over latent-semantic vectors.

A text's terms are hashed byte 3-grams of its whole text (case and punctuation
kept) and pairs of equal neighbouring words; a term weighs log(1 + count) times
its inverse document frequency. A singular value decomposition of the labelled sample's
weights gives latent-semantic directions. The sample's vectors, centred and
scaled to length one, are sent to all tasks; every document's vector is
compared with all of them by exact cosine products in blocks, and the nearest
ones vote with their labels, weighted by similarity and by how many labelled
texts a sampled one stands for.

The sample is bounded by ``sample_per_label``, so the broadcast and the work
per document do not grow with the input. Fitting uses the sampled texts only;
scoring is one pass without a shuffle.

Edge cases: an id on several rows gives one text to the sample; a null or empty text has no terms; its vector is the mean's
opposite like that of any text without known terms, and it is scored by the
same vote. Null labels or ids are not learned from. Without any label every
text scores 0.5. Texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundtrail.llm.labelled import binary_labels, bounded_sample, sample_texts
from fundtrail.llm.textblocks import TOKEN_BYTES, blocks, run_hashes, runs

TERM_BITS = 11
TERMS = 1 << TERM_BITS
DIRECTIONS = 48
NEIGHBOURS = 25
SAMPLE_PER_LABEL = 2_500
BLOCK_TEXTS = 1024
#: similarity ** SHARPNESS is a neighbour's weight
SHARPNESS = 4


@dataclass
class QualityModel:
    idf: np.ndarray
    centre: np.ndarray
    directions: np.ndarray  # (TERMS, DIRECTIONS)
    vectors: np.ndarray  # (labelled texts, DIRECTIONS), length one
    labels: np.ndarray
    odds: tuple[float, float]  # labelled texts for each sampled text, by label


def _term_counts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(texts, TERMS) counts."""
    texts = len(offs) - 1
    n = len(data)
    keys = []
    if n >= 3:
        wide = data.astype(np.uint32)
        code = wide[:-2] | (wide[1:-1] << 8) | (wide[2:] << 16)
        place = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - TERM_BITS)).astype(np.int64)
        owner = np.repeat(np.arange(texts), np.diff(offs))
        inside = owner[:-2] == owner[2:]
        keys.append(owner[:-2][inside] * TERMS + place[inside])
    starts, ends, first = runs(data, offs, TOKEN_BYTES)
    if len(starts) > 1:
        words = run_hashes(data, starts, ends)
        owner = np.repeat(np.arange(texts), np.diff(first))
        twice = np.flatnonzero((words[1:] == words[:-1]) & (owner[1:] == owner[:-1]))
        # all pairs of equal neighbours are one term, whatever the word
        keys.append(owner[twice] * TERMS + 1)
    if not keys:
        return np.zeros((texts, TERMS), np.float32)
    return np.bincount(np.concatenate(keys), minlength=texts * TERMS).reshape(texts, TERMS).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length > 0, length, 1)


def _weights(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(counts) * idf)


def _sample_counts(sample: DataFrame, text_col: str) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offs in blocks(batch.column("_text")):
                counts = _term_counts(data, offs)
                rows = [np.log1p(row).astype(np.float16).tobytes() for row in counts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_key").slice(a, b - a), batch.column("_y").slice(a, b - a), pa.array(rows, pa.binary())],
                    ["_key", "_y", "row"],
                )

    return sample.select(
        F.col("_key").cast("string").alias("_key"), "_y", F.col(text_col).alias("_text")
    ).mapInArrow(count, "_key string, _y int, row binary")


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    learn_from: Column | None = None,
    sample_per_label: int = SAMPLE_PER_LABEL,
) -> QualityModel | None:
    """Latent-semantic vectors of at most about ``sample_per_label`` labelled texts of each label."""
    known = binary_labels(labels, id_col, label_col)
    if learn_from is not None:
        known = known.where(learn_from)
    chosen = bounded_sample(known, "_y", id_col, sample_per_label)
    sample = sample_texts(docs, chosen, id_col, text_col)
    table = _sample_counts(sample.withColumnRenamed(id_col, "_key"), text_col).toArrow().sort_by("_key")
    if not table.num_rows:
        return None
    y = table.column("_y").to_numpy()
    logs = np.frombuffer(b"".join(table.column("row").to_pylist()), np.float16).reshape(-1, TERMS).astype(np.float32)
    idf = np.log((1 + len(y)) / (1 + (logs > 0).sum(axis=0))).astype(np.float32) + 1
    weights = _unit(logs * idf)
    # labels of unequal number count alike when the directions are chosen
    centre = np.mean([weights[y == k].mean(axis=0) for k in np.unique(y)], axis=0).astype(np.float32)
    centred = weights - centre
    values, basis = np.linalg.eigh((centred.T @ centred).astype(np.float64))
    order = np.argsort(values)[::-1][: min(DIRECTIONS, len(y))]
    directions = basis[:, order].astype(np.float32)
    every = {row["_y"]: row["count"] for row in known.groupBy("_y").count().collect()}  # at most two rows
    odds = tuple(every.get(k, 0) / max(1, (y == k).sum()) for k in (0, 1))
    return QualityModel(idf, centre, directions, _unit(centred @ directions), y.astype(np.float32), odds)


def _vote(model: QualityModel, vectors: np.ndarray) -> np.ndarray:
    """Share of the neighbours' weight that label 1 has; a sampled text stands for all labelled ones of its label."""
    out = np.empty(len(vectors))
    k = min(NEIGHBOURS, len(model.labels))
    for a in range(0, len(vectors), BLOCK_TEXTS):
        near = vectors[a : a + BLOCK_TEXTS] @ model.vectors.T
        at = np.argpartition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k :]
        weight = np.clip(np.take_along_axis(near, at, axis=1), 0, 1).astype(np.float64) ** SHARPNESS + 1e-9
        y = model.labels[at]
        good, bad = (weight * y).sum(axis=1) * model.odds[1], (weight * (1 - y)).sum(axis=1) * model.odds[0]
        out[a : a + BLOCK_TEXTS] = good / (good + bad)
    return out


def score_quality(
    docs: DataFrame, model: QualityModel | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score from 0 to 1) of every row's whole text."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.full(batch.num_rows, 0.5)
            if model is not None:
                for a, b, data, offs in blocks(batch.column("_text")):
                    for i in range(0, b - a, BLOCK_TEXTS):
                        cuts = offs[i : min(b - a, i + BLOCK_TEXTS) + 1]
                        weights = _weights(_term_counts(data[cuts[0] : cuts[-1]], cuts - cuts[0]), model.idf)
                        vectors = _unit((weights - model.centre) @ model.directions)
                        out[a + i : a + i + len(cuts) - 1] = _vote(model, vectors)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(out)], ["_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        score, f"_id {kind}, score double"
    )
    return scored.withColumnRenamed("_id", id_col)
