"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct byte n-grams (4, 6 and 8 bytes) of its whole
lower-cased text, hashed into a fixed number of places. Labelled texts give
each place a log-count ratio r = log(share of toxic texts with it / share of
clean texts with it); the
places with the largest |r| and enough support stay. A logistic regression
is then fitted on the features scaled by r, so a text scores
sigmoid(bias + sum of w * r over its places).

Counting runs as one Spark aggregate over the sampled labelled texts. The
driver gets the kept places and the sample's sparse rows, both bounded by
parameters; scoring is one pass over the texts without a shuffle.

Edge cases: an id on several rows gives one text to the sample; a null or empty text has no features and scores sigmoid(bias);
null labels or ids are not learned from; without labels of both kinds every
text scores 0. Texts are never cut. Other columns pass through or are dropped
as the functions say, and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundtrail.llm.labelled import binary_labels, bounded_sample, sample_texts
from fundtrail.llm.textblocks import LOWER, U64, blocks
from fundtrail.session import materialize, release

SIZES = (4, 6, 8)
PLACE_BITS = 20
MAX_PLACES = 1 << 15
MIN_TEXTS = 4
SAMPLE_PER_LABEL = 6_000
#: Places of all sampled texts together that the regression gets (some 40 bytes each on the driver).
MAX_SAMPLE_PLACES = 20_000_000
L2 = 1.0
_GOLDEN = 0x9E3779B97F4A7C15


@dataclass
class ToxicityModel:
    weights: np.ndarray  # float32, one per place; 0 where a place is not used
    bias: float
    constant: float | None = None  # score of every text when only one kind of label was seen


def _places(data: np.ndarray, offs: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of the distinct n-grams whose place is wanted, in ascending order."""
    low = LOWER[data].astype(U64)
    n = len(low)
    found = []
    code = low.copy()
    for size in range(2, max(SIZES) + 1):
        if n < size:
            break
        code = code[: n - size + 1] | (low[size - 1 :] << U64(8 * (size - 1)))
        if size not in SIZES:
            continue
        place = ((code + U64(size)) * U64(_GOLDEN)) >> U64(64 - PLACE_BITS)
        at = np.flatnonzero(wanted[place])
        if not len(at):
            continue
        text = np.searchsorted(offs, at, side="right") - 1
        inside = at + size <= offs[text + 1]
        found.append((text[inside].astype(U64) << U64(PLACE_BITS)) | place[at[inside]])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = np.unique(np.concatenate(found))
    return (keys >> U64(PLACE_BITS)).astype(np.int64), (keys & U64((1 << PLACE_BITS) - 1)).astype(np.int64)


def _count_places(sample: DataFrame, text_col: str) -> DataFrame:
    """(place, toxic texts, clean texts) over the sampled texts; place -1 has the numbers of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.ones(1 << PLACE_BITS, bool)
        totals = np.zeros((2, 1 << PLACE_BITS), np.int64)
        texts = np.zeros(2, np.int64)
        for batch in batches:
            y = np.asarray(batch.column("_y"))
            texts += np.bincount(y, minlength=2)
            for a, b, data, offs in blocks(batch.column("_text")):
                text, place = _places(data, offs, every)
                for kind in (0, 1):
                    totals[kind] += np.bincount(place[y[a:b][text] == kind], minlength=1 << PLACE_BITS)
        used = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_pydict({"place": used, "toxic": totals[1][used], "clean": totals[0][used]})
        yield pa.RecordBatch.from_pydict({"place": [-1], "toxic": texts[1:], "clean": texts[:1]})

    counted = sample.select(F.col(text_col).alias("_text"), "_y").mapInArrow(
        count, "place long, toxic long, clean long"
    )
    return counted.groupBy("place").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _sparse_rows(sample: DataFrame, text_col: str, kept: np.ndarray) -> DataFrame:
    """(_key, _y, n, places as bytes) of the sampled texts; places are positions in ``kept``, n is their number."""
    wanted = np.zeros(1 << PLACE_BITS, bool)
    wanted[kept] = True
    position = np.cumsum(wanted) - 1

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = np.asarray(batch.column("_y"))
            for a, b, data, offs in blocks(batch.column("_text")):
                text, place = _places(data, offs, wanted)
                cuts = np.searchsorted(text, np.arange(b - a + 1))
                local = position[place].astype(np.int32)
                rows = [local[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_key").slice(a, b - a),
                        pa.array(y[a:b].astype(np.int32)),
                        pa.array(np.diff(cuts), pa.int64()),
                        pa.array(rows, pa.binary()),
                    ],
                    ["_key", "_y", "n", "row"],
                )

    return sample.select("_key", F.col(text_col).alias("_text"), "_y").mapInArrow(
        extract, "_key long, _y int, n long, row binary"
    )


def _within(rows: DataFrame, bound: int) -> DataFrame:
    """The sparse rows in order of their key's hash, as long as they hold at most ``bound`` places together.

    Only (key, n) of the bounded sample is read to find where to stop; with
    fewer places every row stays.
    """
    total = rows.agg(F.sum("n").alias("n")).first()["n"] or 0
    if total <= bound:
        return rows
    place = F.xxhash64("_key", F.lit("places"))
    sizes = rows.select(place.alias("at"), "n").toPandas().sort_values("at")
    inside = sizes["at"][sizes["n"].cumsum() <= bound]
    return rows.where(place <= F.lit(int(inside.max()))) if len(inside) else rows.limit(0)


def _logistic(cols: np.ndarray, rows: np.ndarray, y: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights (already times ``scale``) and bias of an L2-regularised logistic regression, by Adam."""
    n, d = len(y), len(scale)
    value = scale[cols]
    target = y.astype(np.float64)
    w, bias = np.zeros(d), 0.0
    m, v, mb, vb = np.zeros(d), np.zeros(d), 0.0, 0.0
    for step in range(1, 201):
        z = np.bincount(rows, weights=w[cols] * value, minlength=n) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        residual = (p - target) / n
        g = np.bincount(cols, weights=residual[rows] * value, minlength=d) + L2 / n * w
        gb = residual.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.1 if step <= 120 else 0.02
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        bias -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.99**step)) + 1e-8)
    return w * scale, float(bias)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    learn_from: Column | None = None,
    sample_per_label: int = SAMPLE_PER_LABEL,
    max_places: int = MAX_PLACES,
    max_sample_places: int = MAX_SAMPLE_PLACES,
) -> ToxicityModel:
    """Learn from labelled texts; ``learn_from`` says which ids of ``labels`` may be used.

    ``sample_per_label`` bounds the texts of each label (chosen by a hash of
    the id), ``max_places`` the features that the regression sees and
    ``max_sample_places`` the features of all its texts together.
    """
    known = binary_labels(labels, id_col, label_col)
    if learn_from is not None:
        known = known.where(learn_from)
    chosen = bounded_sample(known, "_y", id_col, sample_per_label)
    # one scan of the documents; counting and extracting read the bounded sample
    sample = sample_texts(docs, chosen, id_col, text_col).select(
        F.xxhash64(id_col).alias("_key"), "_y", F.col(text_col).alias("_text")
    )
    sample, text_col = materialize(sample, "toxicity-sample"), "_text"

    counts = _count_places(sample, text_col)
    counts = materialize(counts, "toxicity-counts")
    texts = counts.where("place = -1").select("toxic", "clean").first()
    if not texts or not texts["toxic"] or not texts["clean"]:
        release(counts)
        release(sample)
        return ToxicityModel(np.zeros(1 << PLACE_BITS, np.float32), 0.0, constant=0.0)
    ratio = F.log((F.col("toxic") + 1.0) / (texts["toxic"] + 2.0)) - F.log(
        (F.col("clean") + 1.0) / (texts["clean"] + 2.0)
    )
    top = (
        counts.where((F.col("place") >= 0) & (F.col("toxic") + F.col("clean") >= MIN_TEXTS))
        .withColumn("r", ratio)
        .orderBy(F.abs("r").desc(), "place")
        .limit(max_places)
        .select("place", "r")
        .toPandas()
        .sort_values("place")
    )
    kept, scale = top["place"].to_numpy(np.int64), top["r"].to_numpy(np.float64)
    sparse = materialize(_sparse_rows(sample, text_col, kept), "toxicity-rows")
    table = _within(sparse, max(max_sample_places, max_places)).toArrow().sort_by("_key")
    y = table.column("_y").to_numpy()
    packed = [np.frombuffer(row.as_py(), np.int32) for row in table.column("row")]
    for written in (counts, sample, sparse):
        release(written)
    rows = np.repeat(np.arange(len(packed)), [len(p) for p in packed])
    cols = np.concatenate(packed) if packed else np.zeros(0, np.int32)
    fitted, bias = _logistic(cols, rows, y, scale)
    weights = np.zeros(1 << PLACE_BITS, np.float32)
    weights[kept] = fitted
    return ToxicityModel(weights, bias)


def _scorer(model: ToxicityModel):
    """A function from a string column to scores."""
    used = np.flatnonzero(model.weights)
    used_weights = model.weights[used].astype(np.float64)
    bias, constant = model.bias, model.constant

    def prepare():
        weights = np.zeros(1 << PLACE_BITS)
        weights[used] = used_weights
        wanted = weights != 0

        def score(column: pa.Array) -> np.ndarray:
            if constant is not None:
                return np.full(len(column), constant)
            out = np.zeros(len(column))
            for a, b, data, offs in blocks(column):
                text, place = _places(data, offs, wanted)
                out[a:b] = np.bincount(text, weights=weights[place], minlength=b - a)
            return 1 / (1 + np.exp(-np.clip(out + bias, -700, 700)))

        return score

    return prepare


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score from 0 to 1) of every row's whole text."""
    prepare = _scorer(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = prepare()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(score(batch.column("_text")))], ["_id", "score"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        run, f"_id {kind}, score double"
    )
    return scored.withColumnRenamed("_id", id_col)


def filter_toxicity(docs: DataFrame, model: ToxicityModel, limit: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score under ``limit``."""
    prepare = _scorer(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = prepare()
        for batch in batches:
            yield batch.filter(pa.array(score(batch.column(text_col)) < limit))

    return docs.mapInArrow(run, docs.schema)
