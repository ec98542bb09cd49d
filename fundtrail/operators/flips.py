"""Send/pay pairs close in time at one location, counted without forming pairs.

The plain definition joins a location's send legs to its pay legs of the same
customer and keeps pairs at most ``seconds`` apart. A busy (location, customer)
makes that join quadratic, so the count is taken from running totals instead:

    pairs(key) = sum over send legs s of  P(s + T) - P(s - T, strictly)

where P(x) counts the key's pay legs at or before x. Each send leg becomes two
probes (s - T and s + T). Probes and pay legs of one key, instant and kind become one
row with a weight before anything is ordered, so a million legs of one instant are
added up where they lie. The weighted rows are cut into chunks
(``operators.neighbors.deal``), a running count of pay legs inside each chunk
gives the inner part of P, and a running total over the key's per-chunk pay
counts gives the part from earlier chunks. Nothing grows with the number of
pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundtrail.functions.params import BURST_GAP_SECONDS, DEFAULT_CHUNK_ROWS
from fundtrail.operators.neighbors import CHUNK, deal

_US = 1_000_000


def pair_counts(
    legs: DataFrame, keys: Sequence[str], seconds: float, chunk_rows: int = DEFAULT_CHUNK_ROWS
) -> DataFrame:
    """Per key: number of (send, pay) row pairs with ``|t_send - t_pay| <= seconds``.

    ``legs`` carries ``keys``, ``role`` and ``leg_us``; rows with a null key part
    or time are ignored (nulls never match). Every key seen on either side is
    returned, with 0 when it has no pair.
    """
    keys = list(keys)
    span = int(seconds * _US)
    timed = " AND ".join(f"`{k}` IS NOT NULL" for k in [*keys, "leg_us"])
    # Order of kinds at equal times: a low probe (0) counts pays strictly before
    # it, then come the pays (1), then high probes (2) that count them.
    entries = F.expr(
        "CASE WHEN role = 'send' THEN array("
        f"named_struct('t', leg_us - {span}L, 'k', 0, 'w', 0, 'sign', -1),"
        f"named_struct('t', leg_us + {span}L, 'k', 2, 'w', 0, 'sign', 1))"
        " ELSE array(named_struct('t', leg_us, 'k', 1, 'w', 1, 'sign', 0)) END"
    )
    events = legs.where(timed).select(*keys, F.explode(entries).alias("e"))
    weighted = events.groupBy(*keys, F.col("e.t").alias("_t"), F.col("e.k").alias("_k")).agg(
        F.sum("e.w").alias("_w"), F.sum("e.sign").alias("_sign")
    )
    x = deal(weighted, keys, "_t", "_k", chunk_rows)
    running = Window.partitionBy(*keys, CHUNK).orderBy("_t", "_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_chunk = (
        x.withColumn("_run", F.sum("_w").over(running))
        .groupBy(*keys, CHUNK)
        .agg(
            F.sum("_w").alias("_pays"),
            F.sum(F.col("_sign") * F.col("_run")).alias("_inside"),
            F.sum("_sign").alias("_net"),
        )
    )
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    per_chunk = per_chunk.withColumn("_before", F.coalesce(F.sum("_pays").over(earlier), F.lit(0)))
    return per_chunk.groupBy(*keys).agg(
        F.sum(F.col("_inside") + F.col("_net") * F.col("_before")).cast("long").alias("pairs")
    )


def location_flips(
    legs: DataFrame, seconds: float = BURST_GAP_SECONDS, chunk_rows: int = DEFAULT_CHUNK_ROWS
) -> DataFrame:
    """Per location: flipped_txns_count (send/pay pairs of one customer within
    ``seconds``) and flipped_customer_count (customers with such a pair)."""
    pairs = pair_counts(legs, ["entity_id", "own_customer"], seconds, chunk_rows)
    return pairs.groupBy("entity_id").agg(
        F.sum("pairs").cast("long").alias("flipped_txns_count"),
        F.count_if(F.col("pairs") > 0).alias("flipped_customer_count"),
    )
