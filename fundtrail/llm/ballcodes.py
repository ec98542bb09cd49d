"""Product codes of vectors, learned by ball k-means on integer vectors.

Vectors become integers, ``floor(scale * x)``, and are cut into equal
consecutive parts. Each part position has a codebook that starts as that part of
the vectors with the smallest ids. A round gives every part to its nearest entry
(squared Euclidean distance, ties to the lower index) and replaces each entry by
``floor(sum / count)`` of its parts, component by component; an entry without
parts stays. After the last round the parts are assigned once more.

Assignment is exact but compares few entries, by the balls of the entries. The
ball of an entry holds the parts it was last given; its radius is their largest
distance.

* Neighbours: only entries whose distance to entry i is at most twice i's radius
  can be nearest to a part of its ball.
* Stable core: a part nearer to its entry than half the way to the nearest
  neighbour stays where it is; nothing is compared.
* Annular rings: any other part is compared only with those neighbours that lie
  within twice its own distance from entry i, the nearest first; parts of
  like rings share one block of distances.

The tests are made on squared integers and keep equal distances in, so ties are
decided as by comparing all entries.

In Spark: the integer vectors with the codes of the last round are written to
the shared folder every round (the table of the round before is then deleted).
A task sends one row per part position and entry that it saw (sums, count,
largest distance), which Spark adds up; entries, and the new radius bounds
(old radius plus how far the entry moved), are all that comes to the driver.

Edge cases: rows whose vector is null or holds null, NaN or infinite components
are left out. Vectors are expected to be of one length that the parts divide;
that is the most frequent such length (the shorter on a tie), and rows of any
other length are returned with a null code and error and count nowhere. Fewer
vectors than entries give a smaller codebook. Repeated ids are rows of their
own, ordered by their vector where the first entries are chosen; rows without id
come after all others there. Vectors of length 0 have code 0 everywhere. An
empty table gives no rows. Integers beyond 2**26 in size are refused, as their
distances may not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtrail.session import materialize, release

MAX_COMPONENT = 1 << 26
#: Parts whose numbers of candidates fall between the same two of these share a block.
RINGS = (4, 16, 64)


def finite(vector_col: str):
    """The vector is there and has neither null nor NaN nor infinite components."""
    value = "CAST(x AS DOUBLE)"
    return F.expr(
        f"`{vector_col}` IS NOT NULL AND forall(`{vector_col}`, x -> x IS NOT NULL AND NOT isnan({value})"
        f" AND abs({value}) < CAST('Infinity' AS DOUBLE))"
    )


def common_length(vectors: DataFrame, vector_col: str, multiple_of: int = 1) -> int | None:
    """The most frequent vector length (the shorter on a tie), or None without vectors."""
    sizes = vectors.groupBy(F.size(vector_col).alias("n")).count().where(F.col("n") % multiple_of == 0)
    first = sizes.orderBy(F.desc("count"), "n").first()
    return None if first is None else first["n"]


@dataclass(frozen=True)
class Codebooks:
    """Entries of every part position and the squared radius bounds of their balls.

    ``entries`` has the shape (parts, entries, components of a part). ``reach``
    (parts, entries) is the largest squared distance that a part last given to the entry can have
    from it, or None before the first assignment.
    """

    entries: np.ndarray
    reach: np.ndarray | None = None

    @property
    def parts(self) -> int:
        return self.entries.shape[0]

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def moved(self, sums: np.ndarray, counts: np.ndarray, reach: np.ndarray) -> Codebooks:
        """The next codebooks, from the sums and counts of the parts of each entry."""
        used = counts > 0
        entries = np.where(used[..., None], sums // np.maximum(counts, 1)[..., None], self.entries)
        step = ((entries - self.entries) ** 2).sum(axis=2)
        # rounded up, so that the bound holds
        bound = np.ceil((np.sqrt(reach.astype(np.float64)) + np.sqrt(step.astype(np.float64))) ** 2 * (1 + 1e-12)) + 1
        return Codebooks(entries, bound.astype(np.int64))


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows of x, entries) of integer vectors."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * top * top * max(x.shape[1], 1) < 1 << 53:  # every sum below is a whole number that a double holds
        x, entries = x.astype(np.float64), entries.astype(np.float64)
    out = (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)[None]
    return out.astype(np.int64)


class PartAssigner:
    """Nearest entries of the parts of one position."""

    def __init__(self, entries: np.ndarray, reach: np.ndarray | None):
        self.entries = entries
        if reach is None:
            return
        between = squared_distances(entries, entries)
        np.fill_diagonal(between, -1)  # the entry itself comes first
        # neighbours of each entry, nearest first, as far as its ball asks
        self.order = np.argsort(between, axis=1, kind="stable")
        self.gaps = np.take_along_axis(between, self.order, axis=1)
        self.neighbours = np.array([np.searchsorted(g, 4 * r, side="right") for g, r in zip(self.gaps, reach, strict=True)])

    def assign(self, x: np.ndarray, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, int]:
        """(entry, squared distance) of each row of x, and the number of distances computed.

        ``own`` is the entry of each row in the last round; without it all entries are compared.
        """
        if own is None:
            distances = squared_distances(x, self.entries)
            best = np.argmin(distances, axis=1)
            return best, distances[np.arange(len(x)), best], distances.size
        best = own.astype(np.int64)
        least = ((x - self.entries[best]) ** 2).sum(axis=1)
        compared = len(x)
        order = np.argsort(best, kind="stable")
        cuts = np.searchsorted(best[order], np.arange(len(self.entries) + 1))
        for i in np.flatnonzero(np.diff(cuts)):
            rows = order[cuts[i] : cuts[i + 1]]
            gaps = self.gaps[i, : self.neighbours[i]]
            # candidates of a row: the entry itself and the neighbours within twice its distance
            reach = np.searchsorted(gaps, 4 * least[rows], side="right")
            ring = np.searchsorted(RINGS, reach)
            for r in np.unique(ring[reach > 1]):
                some = (ring == r) & (reach > 1)  # the others are in the stable core
                members = rows[some]
                candidates = np.sort(self.order[i, : reach[some].max()])
                distances = squared_distances(x[members], self.entries[candidates])
                compared += distances.size
                at = np.argmin(distances, axis=1)
                best[members], least[members] = candidates[at], distances[np.arange(len(members)), at]
        return best, least, compared


def _assigners(books: Codebooks) -> list[PartAssigner]:
    return [
        PartAssigner(books.entries[p], None if books.reach is None else books.reach[p]) for p in range(books.parts)
    ]


def _assign_rows(rows: DataFrame, books: Codebooks) -> DataFrame:
    """One round over (id, label, x, code): the rows with new codes and distances (kind 0), and per
    task and entry the sums, count and largest distance of its parts (kind 1)."""
    parts, entries, size = books.entries.shape
    base = rows.select("id", "label", "x", "code")
    schema = base.select(
        F.lit(0).alias("kind"),
        "*",
        F.lit(None).cast("long").alias("error"),
        F.lit(None).cast("int").alias("slot"),
        F.lit(None).cast("array<long>").alias("sums"),
        F.lit(None).cast("long").alias("n"),
        F.lit(None).cast("long").alias("reach"),
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigners = _assigners(books)
        sums = np.zeros((parts * entries, size), np.int64)
        counts = np.zeros(parts * entries, np.int64)
        reach = np.zeros(parts * entries, np.int64)
        out_schema = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = batch.column("x")
            x = np.asarray(column.flatten()).reshape(n, parts, size).astype(np.int64)
            old = batch.column("code")
            own = None if old.null_count else np.frombuffer(b"".join(old.to_pylist()), np.uint8).reshape(n, parts)
            code = np.zeros((n, parts), np.uint8)
            error = np.zeros(n, np.int64)
            for p, assigner in enumerate(assigners):
                best, least, _ = assigner.assign(x[:, p], None if own is None else own[:, p])
                code[:, p] = best
                error += least
                slots = p * entries + best
                np.add.at(sums, slots, x[:, p])
                counts += np.bincount(slots, minlength=len(counts))
                np.maximum.at(reach, slots, least)
            packed = code.tobytes()
            empty = pa.nulls(n)
            done = pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(n, np.int32)),
                    batch.column("id"),
                    batch.column("label"),
                    column,
                    pa.array([packed[k : k + parts] for k in range(0, n * parts, parts)], pa.binary()),
                    pa.array(error),
                    empty.cast(pa.int32()),
                    empty.cast(pa.list_(pa.int64())),
                    empty.cast(pa.int64()),
                    empty.cast(pa.int64()),
                ],
                schema.names,
            )
            out_schema = done.schema
            yield done
        if out_schema is None:
            return
        slots = np.flatnonzero(counts)
        arrays = [pa.nulls(len(slots), f.type) for f in out_schema]
        arrays[0] = pa.array(np.ones(len(slots), np.int32))
        arrays[6:] = [
            pa.array(slots.astype(np.int32)),
            pa.array(sums[slots].tolist(), pa.list_(pa.int64())),
            pa.array(counts[slots]),
            pa.array(reach[slots]),
        ]
        yield pa.RecordBatch.from_arrays(arrays, schema=out_schema)

    return base.mapInArrow(run, schema)


def _totals(round_table: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums, counts and largest distances of every entry: entries x (components + 1) rows at most come back."""
    parts, entries, size = shape
    seen = round_table.where("kind = 1").select("slot", "reach", F.posexplode(F.concat("sums", F.array("n"))).alias("k", "v"))
    found = seen.groupBy("slot", "k").agg(F.sum("v").alias("v"), F.max("reach").alias("reach")).toArrow()
    slot, k, v, far = (found.column(c).to_numpy() for c in ("slot", "k", "v", "reach"))
    sums, reach = np.zeros((parts * entries, size + 1), np.int64), np.zeros(parts * entries, np.int64)
    sums[slot, k] = v
    reach[slot] = far
    counts = sums[:, size].reshape(parts, entries)
    return sums[:, :size].reshape(shape), counts, reach.reshape(parts, entries)


def _integers(vectors: DataFrame, vector_col: str, scale: int) -> DataFrame:
    x = F.transform(vector_col, lambda c: F.floor(c.cast("double") * scale))
    return vectors.withColumn("x", x)


@dataclass(frozen=True)
class BallCodes:
    """The result: rows (id, label, code array<int>, error) and the codebooks (None without vectors)."""

    rows: DataFrame
    books: Codebooks | None


def ball_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
) -> BallCodes:
    """Codes and errors of every usable vector, and the codebooks they stand for; see the module."""
    if not 1 <= entries <= 256:
        raise ValueError("entries: 1 to 256, as a code is one byte")
    usable = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v")
    ).where(finite("v"))
    length = common_length(usable, "v", parts)
    kinds = {f.name: f.dataType for f in usable.schema.fields}
    if length is None:
        none = usable.select("id", "label", F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error"))
        return BallCodes(none, None)
    whole = _integers(usable.where(F.size("v") == length), "v", scale).select("id", "label", "x")
    largest = whole.select(F.max(F.array_max(F.transform("x", F.abs)))).first()[0]
    if largest is not None and largest > MAX_COMPONENT:
        raise ValueError(f"a component of {largest} after scaling: beyond {MAX_COMPONENT} distances may not fit a long")
    whole = whole.select("id", "label", F.col("x").cast("array<int>").alias("x"))
    first = whole.orderBy(F.col("id").asc_nulls_last(), "x").select("x").limit(entries).collect()
    start = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, length // parts)
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)))
    rows = whole.withColumn("code", F.lit(None).cast("binary"))
    last = None
    for turn in range(rounds + 1):
        table = materialize(_assign_rows(rows, books), f"ball-codes-{turn}")
        if last is not None:
            release(last)  # its only reader was the table just written
        last, rows = table, table.where("kind = 0")
        if turn < rounds:
            books = books.moved(*_totals(table, books.entries.shape))
    # a code is the bytes of its entry numbers
    numbers = [F.conv(F.hex(F.substring("code", p + 1, 1)), 16, 10).cast("int") for p in range(parts)]
    out = rows.select("id", "label", F.array(*numbers).alias("code"), "error")
    odd = usable.where(F.size("v") != length)
    out = out.unionByName(
        odd.select("id", "label", F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error"))
    )
    return BallCodes(out.select(F.col("id").cast(kinds["id"]), "label", "code", "error"), books)


def with_label_errors(rows: DataFrame) -> DataFrame:
    """Add ``label_error``: the errors summed over the rows of equal label, nulls together.

    The sums are added up on the map side and written, so Spark knows their
    bytes when it plans the join: a small table is broadcast, a large one
    shuffled, where AQE may split a frequent label.
    """
    sums = materialize(rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return rows.join(sums, rows["label"].eqNullSafe(sums["_label"]), "left").drop("_label")
