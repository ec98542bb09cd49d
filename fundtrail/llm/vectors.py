"""Near-duplicate vectors by an inverted multi-index.

* Equal vectors form one class with a count; one member per class goes on.
* Two independent codebooks, one per vector half, are fitted on a bounded
  sample. Their product is a grid of cells; every class is indexed in its cell.
* Each class is also a query. Multi-sequence traversal visits the cells in
  order of the summed distances of both halves. A pair is found when one of its
  vectors visits the cell of the other; the number of visits is calibrated, on
  vectors that the codebooks were not fitted on, so that a pair at exactly the
  threshold is found with the target recall (closer pairs more surely).
* A found link counts at both ends: a class keeps the list of the cells that it
  visits, so that whoever reaches it can tell whether it will reach back.
* A cell's members are parted by a few random-hyperplane bits when it is large.
  Each part is known as a ball: a pivot, the largest angle to it, and a count.
  By the triangle inequality of angles many visits are settled by the ball
  alone (all members are near enough, or none is), so a dense group of any size
  costs one comparison per visitor.
* Other visits are verified exactly, by double-precision products of blocks of
  at most ``BLOCK`` visitors and members. A block returns link counts per
  visitor and the smallest id that each vector reaches in it, never the pairs.

Edge cases: vectors that are null, zero, or hold null or non-finite components
link with nothing; vectors of different lengths do not link, and every length
has codebooks and cells of its own (few lengths are expected: the driver keeps
two codebooks for each); rows that repeat an id count as vectors of their own, each linked by its own
components: classes are numbered, and ids only name the components at the end;
rows without id link with nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtrail.llm.components import connected_components
from fundtrail.session import materialize, scratch

#: Vectors of a length that its codebooks are fitted on: so many, and so many for each code at least.
SAMPLE = 4_096
SAMPLE_PER_CODE = 16
#: Further vectors that the number of visits is calibrated on.
HELD_OUT = 2_048
CELL_MEMBERS = 256
#: Codes of a half at most (a grid of a million cells).
MAX_CODES = 1_024
TARGET_RECALL = 0.98
#: A cell's key is its place in the grid plus this many times the vectors' length.
GRID = 1 << 32
BLOCK = 1_024
#: Parts of a cell aim at so many members.
PART_MEMBERS = 4_096
PLANES = 20
#: Angles this near to a bound are not trusted to it but computed.
SLACK = 1e-6


def _unit_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, size, digest, v): unit vectors as bytes of doubles; digest and v are null where unusable."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, packed, sizes = [], [], []
            for row in batch.column("_v").to_pylist():
                good = row is not None and len(row) > 0 and all(x is not None for x in row)
                x = np.array(row, np.float64) if good else np.zeros(1)
                with np.errstate(over="ignore"):
                    length = np.linalg.norm(x)
                if np.isfinite(x).all() and not np.isfinite(length):
                    x = x / np.abs(x).max()
                    length = np.linalg.norm(x)
                good = good and np.isfinite(x).all() and length > 0
                unit = (x / length).tobytes() if good else None
                packed.append(unit)
                sizes.append(len(x) if good else None)
                # the raw components, so that only equal vectors share a class
                digests.append(hashlib.blake2b((x + 0.0).tobytes(), digest_size=16).digest() if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()), pa.array(packed, pa.binary())],
                ["id", "size", "digest", "v"],
            )

    kind = vectors.schema[id_col].dataType.simpleString()
    return vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_v")).mapInArrow(
        build, f"id {kind}, size int, digest binary, v binary"
    )


def _matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, size)


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.argmin(_distances(x, centres), axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        counts = np.bincount(nearest, minlength=len(centres))
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)[None], 0)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(length, rows whose vectors have that length)."""
    sizes = np.asarray(pc.binary_length(batch.column("v"))) // 8
    for size in np.unique(sizes).tolist():
        yield size, batch.filter(pa.array(sizes == size))


def _codes(members: int) -> int:
    return int(np.clip(round(np.sqrt(members / CELL_MEMBERS)), 2, MAX_CODES))


class MultiIndex:
    """Codebooks of both halves, the number of visits, and the planes that part large cells."""

    def __init__(self, sample: np.ndarray, members: int, threshold: float, target: float = TARGET_RECALL):
        rng = np.random.default_rng(11)
        self.size = sample.shape[1]
        self.half = self.size // 2
        codes = _codes(members)
        held = min(HELD_OUT, len(sample) // 3)
        fit = sample[held:]
        self.books = [_k_means(fit[:, : self.half], codes, rng), _k_means(fit[:, self.half :], codes, rng)]
        self.planes = rng.standard_normal((self.size, PLANES))
        self.visits = self._calibrate(sample[:held] if held else sample, threshold, target, rng)

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _distances(x[:, : self.half], self.books[0]), _distances(x[:, self.half :], self.books[1])

    def cells(self, x: np.ndarray) -> np.ndarray:
        first, second = self.halves(x)
        return np.argmin(first, axis=1) * len(self.books[1]) + np.argmin(second, axis=1)

    def _ranks(self, x: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many cells each row of ``x`` visits before the cell of the same row of ``other``."""
        first, second = self.halves(x)
        i, j = np.divmod(self.cells(other), len(self.books[1]))
        rows = np.arange(len(x))
        reach = first[rows, i] + second[rows, j]
        second = np.sort(second, axis=1)
        return np.array(
            [np.searchsorted(b, r - a).sum() for a, b, r in zip(first, second, reach, strict=True)], np.int64
        )

    def partners(self, x: np.ndarray, threshold: float, rng: np.random.Generator) -> np.ndarray:
        """For every row a unit vector at exactly the threshold, in a random direction."""
        noise = rng.standard_normal(x.shape)
        noise -= (noise * x).sum(axis=1, keepdims=True) * x
        length = np.linalg.norm(noise, axis=1, keepdims=True)
        return threshold * x + np.sqrt(1 - threshold**2) * noise / np.where(length > 0, length, 1)

    def _calibrate(self, x: np.ndarray, threshold: float, target: float, rng: np.random.Generator) -> int:
        """Visits with which one vector of a pair at the threshold reaches the other with the target recall."""
        x = np.tile(x, (-(-HELD_OUT // len(x)), 1))
        partner = self.partners(x, threshold, rng)
        return int(np.quantile(np.minimum(self._ranks(x, partner), self._ranks(partner, x)), target)) + 1

    def traverse(self, x: np.ndarray) -> np.ndarray:
        """(rows, visits) cells in order of the summed distance of both halves.

        The cell at place (a, b) of the two sorted lists has (a + 1) * (b + 1) - 1
        cells before it at least, so only places with a small product matter.
        """
        first, second = self.halves(x)
        order = [np.argsort(d, axis=1, kind="stable") for d in (first, second)]
        near = [np.take_along_axis(d, o, axis=1) for d, o in zip((first, second), order, strict=True)]
        far = min(second.shape[1], self.visits)
        a, b = np.divmod(np.arange(min(first.shape[1], self.visits) * far), far)
        within = (a + 1) * (b + 1) <= self.visits
        a, b = a[within], b[within]
        sums = near[0][:, a] + near[1][:, b]
        best = np.argsort(sums, axis=1, kind="stable")[:, : self.visits]
        rows = np.arange(len(x))[:, None]
        return order[0][rows, a[best]] * second.shape[1] + order[1][rows, b[best]]


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def _least_labels(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id of each row's and column's component in a bipartite link matrix."""
    left, right = left.copy(), right.copy()
    top = np.iinfo(np.int64).max
    while True:
        new_left = np.minimum(left, np.where(near, right[None, :], top).min(axis=1, initial=top))
        new_right = np.minimum(right, np.where(near, new_left[:, None], top).min(axis=0, initial=top))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def _unreturned(near: np.ndarray, own: np.ndarray, many: np.ndarray, visits: list[np.ndarray]) -> np.ndarray:
    """Per member, the rows of the visitors linked with it whose cell (``own``) is not among the cells it visits."""
    i, j = np.nonzero(near)
    reaches = np.concatenate([np.zeros(0, np.int64), *(k * GRID + v.astype(np.int64) for k, v in enumerate(visits))])
    once = ~np.isin(j * GRID + own[i], reaches)
    out = np.zeros(near.shape[1], np.int64)
    np.add.at(out, j[once], many[i[once]])
    return out


def _verify_blocks(threshold: float):
    """Exact comparison of one block of visitors with one block of members."""

    def compare(group: pa.Table) -> pa.Table:
        visitor = group.column("visitor").to_numpy()
        ids, many = group.column("rep").to_numpy(), group.column("m").to_numpy()
        x = _matrix(group.column("v"), len(group.column("v")[0].as_py()) // 8)
        q, k = np.flatnonzero(visitor), np.flatnonzero(~visitor)
        near = x[q] @ x[k].T >= threshold
        near &= ids[q][:, None] != ids[k][None, :]
        q, k = q[near.any(axis=1)], k[near.any(axis=0)]
        near = near[near.any(axis=1)][:, near.any(axis=0)]
        own = group.column("own").take(pa.array(q)).to_numpy().astype(np.int64)
        visits = [np.array(v, np.int64) for v in group.column("visits").take(pa.array(k)).to_pylist()]
        to, members_to = _least_labels(near, ids[q], ids[k])
        n = np.concatenate([near @ many[k], _unreturned(near, own, many[q], visits)])
        return pa.table(
            {
                "rep": np.concatenate([ids[q], ids[k]]),
                "n": n,
                "other": np.concatenate([to, members_to]),
            }
        )

    return compare


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9
) -> DataFrame:
    """(id, n_links, component_id, kept) per row: links are pairs of rows with cosine >= ``threshold``."""
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType
    with scratch(spark) as keep:
        rows = keep(materialize(_unit_rows(vectors, id_col, vector_col), "vectors"))
        # numbers of their own (fixed once written), as an id may stand on rows of several classes
        classes = keep(
            materialize(
                rows.where("size is not null and id is not null")
                .groupBy("size", "digest")
                .agg(F.min(F.col("id").cast("long")).alias("least"), F.count(F.lit(1)).alias("m"), F.first("v").alias("v"))
                .select(F.monotonically_increasing_id().alias("rep"), "size", "digest", "least", "m", "v"),
                "classes",
            )
        )
        members = {r["size"]: r["count"] for r in classes.groupBy("size").count().collect()}
        if members:
            links = keep(materialize(_find_links(classes, members, threshold), "links"))
            counts = links.groupBy("rep").agg(F.sum("n").alias("n"))
            edges = links.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b"))
            parts = connected_components(edges)
        else:
            counts = spark.createDataFrame([], "rep long, n long")
            parts = spark.createDataFrame([], "node long, component long")
        # the smallest id of each component
        linked = keep(materialize(parts.withColumnRenamed("node", "rep").join(classes.select("rep", "least"), "rep"), "linked"))
        names = keep(materialize(linked.groupBy("component").agg(F.min("least").alias("name")), "names"))
    named = (
        classes.join(counts, "rep", "left")
        .join(linked.join(names, "component").select("rep", "name"), "rep", "left")
        .select(
            "digest",
            (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"),
            F.coalesce("name", "least").alias("component_id"),
        )
    )
    out = rows.withColumn("digest", F.when(F.col("id").isNotNull(), F.col("digest"))).join(named, "digest", "left")
    component = F.coalesce(F.col("component_id").cast(kind), F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )


def _fit(classes: DataFrame, members: dict[int, int], threshold: float) -> dict[int, MultiIndex]:
    """An index per vector length, fitted on a bounded sample of its vectors."""
    whole = 1 << 20
    shares = [
        (size, int(np.ceil(whole * min(1.0, (max(SAMPLE, SAMPLE_PER_CODE * _codes(n)) + HELD_OUT) / n))))
        for size, n in members.items()
    ]
    rates = classes.sparkSession.createDataFrame(shares, "size int, share long")
    # by digest: the numbers of classes may differ from run to run
    place = F.pmod(F.xxhash64("digest", F.lit(3)), F.lit(whole))
    taken = classes.join(F.broadcast(rates), "size").where(place < F.col("share")).select("size", "digest", "v").toArrow()
    taken = taken.sort_by("digest")
    out = {}
    for size, n in members.items():
        mine = taken.filter(pc.equal(taken.column("size"), size))
        out[size] = MultiIndex(_matrix(mine.column("v"), size), n, threshold)
    return out


def _find_links(classes: DataFrame, members: dict[int, int], threshold: float) -> DataFrame:
    """(rep, n, other): link counts of classes (to be summed), and edges of their components (``other`` may be null)."""
    indexes = _fit(classes, members, threshold)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for size, batch in _by_length(whole):
                index = indexes[size]
                for k in range(0, batch.num_rows, BLOCK):
                    rows = batch.slice(k, BLOCK)
                    x = _matrix(rows.column("v"), size)
                    sides = (x @ index.planes > 0) @ (1 << np.arange(PLANES))
                    own, cells = index.cells(x), index.traverse(x)
                    ends = np.arange(len(cells) + 1, dtype=np.int32) * cells.shape[1]
                    visits = pa.ListArray.from_arrays(pa.array(ends), pa.array(cells.ravel().astype(np.int32)))
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, pa.array(own.astype(np.int32)), pa.array(own + size * GRID), pa.array(sides), visits],
                        ["rep", "m", "v", "own", "cell", "sides", "visits"],
                    )

    indexed = materialize(
        classes.select("rep", "m", "v").mapInArrow(
            assign, "rep long, m long, v binary, own int, cell long, sides long, visits array<int>"
        ),
        "cells",
    )
    sizes = indexed.groupBy("cell").agg(F.count(F.lit(1)).alias("held")).withColumn(
        "bits", F.least(F.greatest(F.ceil(F.log2(F.col("held") / PART_MEMBERS)), F.lit(0)), F.lit(PLANES)).cast("int")
    )
    parted = indexed.join(sizes.select("cell", "bits"), "cell").withColumn(
        "part", F.expr("sides % shiftleft(1L, bits)")
    )
    parted = materialize(parted.select("rep", "m", "v", "visits", "cell", "part"), "parts")
    pivots = parted.groupBy("cell", "part").agg(
        F.min(F.struct("rep", "v")).alias("pivot"), F.count(F.lit(1)).alias("held"), F.sum("m").alias("total")
    )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for size, batch in _by_length(whole):
                angle = _angle((_matrix(batch.column("v"), size) * _matrix(batch.column("pivot"), size)).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("cell"), batch.column("part"), pa.array(angle)], ["cell", "part", "angle"]
                )

    angles = parted.join(pivots.select("cell", "part", F.col("pivot.v").alias("pivot")), ["cell", "part"])
    radius = (
        angles.select("cell", "part", "v", "pivot")
        .mapInArrow(spread, "cell long, part long, angle double")
        .groupBy("cell", "part")
        .agg(F.max("angle").alias("radius"))
    )
    balls = materialize(
        pivots.join(radius, ["cell", "part"]).select(
            "cell", "part", F.col("pivot.v").alias("pivot"), F.col("pivot.rep").alias("first"), "held", "total", "radius"
        ),
        "balls",
    )
    probes = indexed.select("rep", "m", "v", "own", (F.col("cell") - F.col("own")).alias("_base"), F.explode("visits").alias("_to"))
    probes = probes.select("rep", "m", "v", "own", (F.col("_base") + F.col("_to")).alias("cell"))

    limit = float(np.arccos(threshold))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """state 1: linked with the whole ball; 2: to be verified; visits out of reach go."""
        for whole in batches:
            for size, batch in _by_length(whole):
                angle = _angle((_matrix(batch.column("v"), size) * _matrix(batch.column("pivot"), size)).sum(axis=1))
                radius = np.asarray(batch.column("radius"))
                state = np.where(angle + radius < limit - SLACK, 1, np.where(angle - radius > limit + SLACK, 0, 2))
                keep = pa.array(state > 0)
                out = batch.drop_columns(["pivot", "radius"]).append_column("state", pa.array(state.astype(np.int32)))
                yield out.filter(keep)

    settled = probes.join(balls, "cell").select(
        "rep", "m", "v", "own", "cell", "part", "first", "held", "total", "pivot", "radius"
    )
    settled = materialize(
        settled.mapInArrow(
            settle,
            "rep long, m long, v binary, own int, cell long, part long, first long, held long, total long, state int",
        ),
        "visits",
    )
    # a visitor inside a ball that it is wholly linked with does not count its own class
    own = parted.select("rep", "cell", "part", F.lit(1).alias("inside"))
    whole = (
        settled.where("state = 1")
        .select("rep", "m", "cell", "part", "first", "total")
        .join(own, ["rep", "cell", "part"], "left")
        .select(
            "rep",
            (F.col("total") - F.when(F.col("inside") == 1, F.col("m")).otherwise(0)).alias("n"),
            F.col("first").alias("other"),
        )
    )
    # members of such a ball count the visitors that they do not visit in turn
    inbound = settled.where("state = 1").groupBy("cell", "part", "own").agg(F.sum("m").alias("n"))
    unreturned = (
        parted.select("rep", "visits", "cell", "part")
        .join(inbound, ["cell", "part"])
        .where(~F.array_contains("visits", F.col("own")))
        .select("rep", "n", F.lit(None).cast("long").alias("other"))
    )
    # a ball that some visitor reaches wholly holds together only through that visitor: its members get an edge each
    reached = settled.where("state = 1").groupBy("cell", "part").agg(F.min("rep").alias("hub"))
    inner = parted.join(reached, ["cell", "part"]).select("rep", F.lit(0).cast("long").alias("n"), F.col("hub").alias("other"))

    open_visits = settled.where("state = 2")
    blocks = F.ceil(F.col("held") / BLOCK).cast("long")
    waiting = open_visits.groupBy("cell", "part").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("visitor_blocks"), F.max(blocks).alias("member_blocks")
    )
    salt = F.xxhash64("rep", F.lit(9))
    visitors = open_visits.join(waiting, ["cell", "part"]).select(
        "cell", "part", "rep", "m", "v", "own", F.lit(None).cast("array<int>").alias("visits"), F.lit(True).alias("visitor"),
        F.pmod(salt, F.col("visitor_blocks")).alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("member_blocks") - 1)).alias("j"),
    )
    held = parted.join(waiting, ["cell", "part"]).select(
        "cell", "part", "rep", "m", "v", F.lit(None).cast("int").alias("own"), "visits", F.lit(False).alias("visitor"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("visitor_blocks") - 1)).alias("i"),
        F.pmod(salt, F.col("member_blocks")).alias("j"),
    )
    verified = (
        visitors.union(held)
        .groupBy("cell", "part", "i", "j")
        .applyInArrow(_verify_blocks(threshold), "rep long, n long, other long")
    )
    return verified.union(whole).union(unreturned).union(inner)
