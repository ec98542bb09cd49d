"""Nearest earlier and later rows of the same key, without one task per busy key.

``lag``/``lead`` over ``Window.partitionBy(key)`` sends every row of a key to
one task; a key holding a third of the data would then be one task's work. Here
every key is cut into chunks of at most ``chunk_rows`` rows, the same in every run:

1. ``deal``: the input is written once. Rows are counted per key, and for keys
   with more than ``chunk_rows`` rows per *cell* (an hour) too; the running total
   of a busy key's cells names their chunks. Only a cell that is over-full itself
   is sorted: its rows are shuffled by ranges of (keys, time, tie), written, and
   cut by place, so that rows of one instant are cut like any others. All other
   rows take their chunk from the table of cells, without a shuffle where that is small.
2. ``stream_neighbors``: windows run inside (keys, chunk). What a chunk needs
   from the others is the last matching row before it and the first after it;
   each chunk gives one row with its first and last, a window over those rows
   (one per chunk) carries them on, and one join brings them back. A key that is
   not cut has nothing to carry: its rows are not read for that.

A *stream* is a condition on rows: neighbours are looked up among the rows that
meet it (sends only, run ends only, ...). The result does not depend on
``chunk_rows`` or the partitioning. Rows with a null time are no neighbours and
have none; they stay in the frame, for aggregates that count all rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundtrail.functions.params import DEFAULT_CHUNK_ROWS
from fundtrail.session import materialize

CHUNK = "_chunk"
#: An hour in microseconds.
CELL = 3_600_000_000
NO_TIME = -(1 << 62)
#: The cell in the chunk name of a key that is not cut.
UNCUT = -1


@dataclass(frozen=True)
class Stream:
    """Rows that meet the SQL condition ``rows``; ``prev``/``next`` name the columns to bring along."""

    rows: str = "TRUE"
    prev: tuple[str, ...] = ()
    next: tuple[str, ...] = ()


def deal(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tie: str,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    cell: int = CELL,
    written: bool = False,
) -> DataFrame:
    """Add ``_chunk``: chunks of a key follow its (order, tie) order and hold at most ``chunk_rows`` rows.

    ``order`` is a whole number (microseconds); ``cell`` is the length of a cell in its unit.
    ``written`` says that ``df`` reads written files, so that running it again is cheap;
    else it is written first and its plan runs once. A chunk is named by the place
    of its cells and, in an over-full cell, the place of its rows; the one chunk of a key
    that is not cut, by the cell ``UNCUT``.
    """
    keys = list(keys)
    rows = df if written else materialize(df, "undealt")
    # cells of up to half a chunk fill a chunk until the next one begins
    half = max(1, int(chunk_rows) // 2)
    many = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > int(chunk_rows)).drop("_n")
    many = materialize(many, "busy-keys")
    # rows without a time come first
    placed = rows.withColumn("_cell", F.coalesce(F.floor(F.col(order) / F.lit(cell)).cast("long"), F.lit(NO_TIME)))
    per_cell = _null_safe(placed.select(*keys, "_cell"), many, keys, "left_semi")
    per_cell = per_cell.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = per_cell.select(
        *keys,
        "_cell",
        (F.col("_n") > half).alias("_full"),
        F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / F.lit(half)).cast("long").alias("_at"),
    )
    # written, so that Spark knows their bytes when it plans the joins
    cells = materialize(cells, "cells")
    found = _null_safe(placed, cells, [*keys, "_cell"], "left")
    name = F.struct(F.coalesce("_at", F.lit(UNCUT)).alias("cell"), F.lit(0).cast("long").alias("place")).alias(CHUNK)
    usual = found.where(~F.coalesce(F.col("_full"), F.lit(False))).select(*df.columns, name)
    full = _null_safe(placed, cells.where("_full"), [*keys, "_cell"], "inner")
    sort = [*keys, order, tie]
    ranged = full.repartitionByRange(*sort).sortWithinPartitions(*sort)
    # ascending inside a partition and from partition to partition
    place = F.floor(F.monotonically_increasing_id() / F.lit(half)).cast("long") + 1
    cut = ranged.select(*df.columns, F.struct(F.col("_at").alias("cell"), place.alias("place")).alias(CHUNK))
    return usual.unionByName(materialize(cut, "full-cells"))


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys that may be null; the columns of ``left``, then those of ``right`` beside the keys."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def stream_neighbors(
    dealt: DataFrame, keys: Sequence[str], order: str, tie: str, streams: Mapping[str, Stream], first: str = "prev"
) -> DataFrame:
    """Add ``{name}_prev_{column}`` / ``{name}_next_{column}`` for every stream, null at the ends.

    ``dealt`` comes from ``deal`` with the same keys (further columns may have
    been added); one window partition is one chunk. ``first`` is the side that is
    looked up first: rows that an earlier call left in the order of that side are not
    sorted again (the order of ``next`` runs backwards). It does not change the result.
    """
    keys = list(keys)
    chunk = [*keys, CHUNK]
    w = Window.partitionBy(*chunk)
    before = w.orderBy(F.col(order).asc_nulls_first(), F.col(tie).asc()).rowsBetween(Window.unboundedPreceding, -1)
    after = w.orderBy(F.col(order).desc_nulls_last(), F.col(tie).desc()).rowsBetween(Window.unboundedPreceding, -1)

    def found(stream: Stream, columns: Sequence[str]):
        row = F.struct(F.col(order).alias("_o"), F.col(tie).alias("_t"), *[F.col(c).alias(f"c_{c}") for c in columns])
        return F.when(F.col(order).isNotNull() & F.expr(stream.rows), row)

    sides = [(n, s, side, cols) for n, s in streams.items() for side, cols in (("prev", s.prev), ("next", s.next)) if cols]
    inside = [
        F.last(found(s, cols), ignorenulls=True).over(before if side == "prev" else after).alias(f"_in_{n}_{side}")
        for n, s, side, cols in sorted(sides, key=lambda x: x[2] != first)
    ]
    ends = [
        (F.max if side == "prev" else F.min)(found(s, cols)).alias(f"_end_{n}_{side}") for n, s, side, cols in sides
    ]
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.col(CHUNK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = [
        F.last(f"_end_{n}_{side}", ignorenulls=True).over(earlier if side == "prev" else later).alias(f"_by_{n}_{side}")
        for n, _, side, _ in sides
    ]
    some = F.expr(" OR ".join(f"_by_{n}_{side} IS NOT NULL" for n, _, side, _ in sides))
    # the test of the chunk's name reaches below the plan of ``dealt``, so that only keys in chunks are summarised
    cut = dealt.where(F.col(f"{CHUNK}.cell") != F.lit(UNCUT))
    carry = cut.groupBy(*chunk).agg(*ends).select(*chunk, *carried).where(some)
    joined = dealt.select("*", *inside).join(carry, chunk, "left")
    out = [F.col(c) for c in dealt.columns]
    for n, _, side, cols in sides:
        near = F.coalesce(f"_in_{n}_{side}", f"_by_{n}_{side}")
        out += [F.when(F.col(order).isNotNull(), near[f"c_{c}"]).alias(f"{n}_{side}_{c}") for c in cols]
    return joined.select(*out)
