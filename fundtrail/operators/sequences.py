"""Order-based features: repeats, intervals, bursts, flips and rapid fire.

All of them need the previous or next row of a key in time order (ties broken
by ``mtcn``), which comes from ``stream_neighbors``: a busy key is cut into
chunks. Features are then row flags and a ``groupBy`` with map-side combining.

Look-back spans: a span keeps the legs dated after ``as_of_date - cut-off``,
which is a suffix of each key's time-ordered history. Within the suffix the
next row is the same as in the full history, and the previous row is the same
when it lies inside the span too. So one ordered pass serves all spans: a
gap counts in a span only when both of its rows are in it.

Bursts: a row belongs to a burst when the gap to its previous or to its next
row is at most the threshold; the burst count is the number of such rows
(the count of gaps within the threshold plus the count of rows that open a
run of such gaps).

Legs without a time have no place in the order: they are no neighbours and
count in none of these features.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundtrail.functions.columns import dbl, span_sql
from fundtrail.functions.params import (
    BURST_GAP_SECONDS,
    CUSTOMER_FLIP_SECONDS,
    DEFAULT_CHUNK_ROWS,
    RAPID_FIRE_SECONDS,
)
from fundtrail.operators.neighbors import CHUNK, Stream, deal, stream_neighbors
from fundtrail.session import as_written, is_written

SPANS_FULL = (("", None),)
KEYS = ("entity_id", "as_of_date")
_US = 1_000_000


def burst_sql(prev_ok: str, gap_seconds: float, prev: str = "prev_", nxt: str = "next_") -> str:
    """Row is within ``gap_seconds`` of its previous (if ``prev_ok``) or next row."""
    limit = int(gap_seconds * _US)
    return (
        f"(({prev_ok}) AND {prev}leg_us IS NOT NULL AND leg_us - {prev}leg_us <= {limit})"
        f" OR ({nxt}leg_us IS NOT NULL AND {nxt}leg_us - leg_us <= {limit})"
    )


def run_end() -> Column:
    """Last timed row of a run of equal counterparties; a null counterparty ends a run."""
    return F.expr(
        "leg_us IS NOT NULL AND (next_leg_us IS NULL OR other_customer IS NULL"
        " OR next_other_customer IS NULL OR next_other_customer <> other_customer)"
    )


def _of_role(side: str, column: str, prefix: str = "") -> Column:
    return F.expr(
        f"CASE WHEN role = 'send' THEN send{prefix}_{side}_{column} ELSE pay{prefix}_{side}_{column} END"
        f" AS {prefix.lstrip('_') + '_' if prefix else ''}{side}_{column}"
    )


def _ages(spans, prev: str = "prev_") -> tuple[str, str]:
    with_age = any(c is not None for _, c in spans)
    return ("age_days", f"{prev}age_days") if with_age else ("0", "0")


# ---------------------------------------------------------------- customers


def role_neighbors(
    legs: DataFrame, keys: Sequence[str] = KEYS, chunk_rows: int = DEFAULT_CHUNK_ROWS, prev: Sequence[str] = ()
) -> DataFrame:
    """All legs, each with its neighbours of any role (``all_prev_*``) and of its own
    role (``prev_*``, ``next_*``); ``prev`` names further columns of the leg before.

    Legs that were dealt before (``deal`` by the same keys, or by a part of them
    that comes first in time order) keep their chunks.
    """
    x = legs if CHUNK in legs.columns else deal(legs, keys, "leg_us", "mtcn", chunk_rows, written=is_written(legs))
    before, nxt = ("leg_us", "amount", *prev), ("leg_us", "other_customer")
    x = stream_neighbors(
        x,
        keys,
        "leg_us",
        "mtcn",
        {
            "all": Stream(prev=("leg_us", *prev)),
            "send": Stream("role = 'send'", before, nxt),
            "pay": Stream("role = 'pay'", before, nxt),
        },
    )
    x = x.select("*", *[_of_role("prev", c) for c in before], *[_of_role("next", c) for c in nxt])
    return x.drop(*[f"{r}_{s}_{c}" for r in ("send", "pay") for s, cols in (("prev", before), ("next", nxt)) for c in cols])


def customer_neighbors(
    legs: DataFrame, keys: Sequence[str] = KEYS, chunk_rows: int = DEFAULT_CHUNK_ROWS
) -> DataFrame:
    """``role_neighbors`` with those among the send run ends (``end_*``)."""
    if "age_days" not in legs.columns:
        legs = as_written(legs.withColumn("age_days", F.lit(0)), legs)
    x = role_neighbors(legs, keys, chunk_rows, ("age_days",))
    x = x.withColumn("run_end", (F.col("role") == F.lit("send")) & run_end())
    # one-to-many runs over the send run ends only, with their own neighbours
    ends = {"end": Stream("run_end", ("leg_us", "age_days"), ("leg_us",))}
    return stream_neighbors(x, keys, "leg_us", "mtcn", ends, first="next")


def customer_sequence_sql(spans=SPANS_FULL, burst_seconds: float = BURST_GAP_SECONDS) -> list[str]:
    """Aggregates over ``customer_neighbors``: repeat amounts, first time and
    interval stats per role, many-to-one and one-to-many bursts."""
    age, prev_age = _ages(spans)
    _, end_age = _ages(spans, "end_prev_")
    out = []
    for prefix, cut in spans:
        cur_in = span_sql(age, cut)
        prev_in = f"prev_leg_us IS NOT NULL AND {span_sql(prev_age, cut)}"
        gap = f"CASE WHEN {prev_in} THEN leg_us - prev_leg_us END"
        for role in ("send", "pay"):
            cond = f"{cur_in} AND role = '{role}'"
            g = f"CASE WHEN {cond} THEN {gap} END"
            out += [
                f"count_if({cond} AND {prev_in} AND prev_amount = amount) AS `{prefix}{role}_repeat_amount_txns`",
                f"min(CASE WHEN {cond} THEN leg_time END) AS `{prefix}min_{role}_time`",
                f"min({g}) / {dbl(_US)} AS `{prefix}min_interval_{role}_txns`",
                f"max({g}) / {dbl(_US)} AS `{prefix}max_interval_{role}_txns`",
                f"sum({g}) / nullif(count({g}), 0) / {dbl(_US)} AS `{prefix}avg_interval_{role}_txns`",
            ]
        out.append(
            f"count_if({cur_in} AND role = 'pay' AND ({burst_sql(prev_in, burst_seconds)}))"
            f" AS `{prefix}many_to_one_pay_count`"
        )
        out.append(
            f"count_if(run_end AND {cur_in} AND ({burst_sql(span_sql(end_age, cut), burst_seconds, 'end_prev_', 'end_next_')}))"
            f" AS `{prefix}one_to_many_send_count`"
        )
    return out


def customer_flip_sql(spans=SPANS_FULL, seconds: float = CUSTOMER_FLIP_SECONDS) -> list[str]:
    """Aggregates over ``customer_neighbors``: neighbouring distinct event times
    (sends and pays together) at most ``seconds`` apart.

    Repeated times are not removed first: in time order a repeated time has a
    zero gap to its twin, and the gap between two distinct times is the same
    with or without the repeats, so counting gaps in (0, seconds] is the count
    over distinct times.
    """
    age, prev_age = _ages(spans, "all_prev_")
    gap = "leg_us - all_prev_leg_us"
    return [
        f"count_if({span_sql(age, cut)} AND {span_sql(prev_age, cut)}"
        f" AND {gap} > 0 AND {gap} <= {int(seconds * _US)}) AS `{prefix}flipped_txns_count`"
        for prefix, cut in spans
    ]


def customer_sequences(
    legs: DataFrame,
    keys: Sequence[str] = KEYS,
    spans: Sequence[tuple[str, int | None]] = SPANS_FULL,
    burst_seconds: float = BURST_GAP_SECONDS,
    flip_seconds: float = CUSTOMER_FLIP_SECONDS,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """Per key and span: every ordered customer feature."""
    sql = customer_sequence_sql(spans, burst_seconds) + customer_flip_sql(spans, flip_seconds)
    return customer_neighbors(legs, keys, chunk_rows).groupBy(*keys).agg(*[F.expr(e) for e in sql])


# ---------------------------------------------------------------- locations


def location_bursts(
    legs: DataFrame, burst_seconds: float = BURST_GAP_SECONDS, chunk_rows: int = DEFAULT_CHUNK_ROWS
) -> DataFrame:
    """Per location: one-to-many (send legs by sender) and many-to-one (pay legs
    by payee) burst counts over the run ends of the counterparty.

    The ordered key is (location, own customer), so a busy location is already
    spread over its customers, and each customer over chunks.
    """
    keys = ["entity_id", "own_customer"]
    base = legs.filter(F.col("own_customer").isNotNull()).select(*keys, "role", "mtcn", "leg_us", "other_customer")
    x = deal(base, keys, "leg_us", "mtcn", chunk_rows)
    nxt = ("leg_us", "other_customer")
    x = stream_neighbors(x, keys, "leg_us", "mtcn", {r: Stream(f"role = '{r}'", next=nxt) for r in ("send", "pay")})
    x = x.select(*base.columns, CHUNK, *[_of_role("next", c) for c in nxt]).withColumn("run_end", run_end())
    ends = {f"{r}_end": Stream(f"run_end AND role = '{r}'", ("leg_us",), ("leg_us",)) for r in ("send", "pay")}
    x = stream_neighbors(x, keys, "leg_us", "mtcn", ends, first="next")
    x = x.select("entity_id", "role", "leg_us", "run_end", _of_role("prev", "leg_us", "_end"), _of_role("next", "leg_us", "_end"))
    member = f"run_end AND ({burst_sql('TRUE', burst_seconds, 'end_prev_', 'end_next_')})"
    return x.groupBy("entity_id").agg(
        F.expr(f"count_if({member} AND role = 'send') AS one_to_many_send_count"),
        F.expr(f"count_if({member} AND role = 'pay') AS many_to_one_pay_count"),
    )


def terminal_counts(
    legs: DataFrame, fire_seconds: float = RAPID_FIRE_SECONDS, chunk_rows: int = DEFAULT_CHUNK_ROWS
) -> DataFrame:
    """Per (location, terminal): legs whose amount equals that of the role's previous
    leg there, and distinct event times (sends and pays together) within
    ``fire_seconds`` of the previous or next one."""
    keys = ["entity_id", "own_terminal"]
    base = legs.filter(F.col("own_terminal").isNotNull()).select(*keys, "role", "mtcn", "leg_us", "amount")
    x = deal(base, keys, "leg_us", "mtcn", chunk_rows)
    streams = {r: Stream(f"role = '{r}'", ("leg_us", "amount")) for r in ("send", "pay")} | {"any": Stream(prev=("leg_us",))}
    x = stream_neighbors(x, keys, "leg_us", "mtcn", streams)
    x = x.select(*base.columns, CHUNK, "any_prev_leg_us", _of_role("prev", "leg_us"), _of_role("prev", "amount"))
    # the first row of every distinct time
    x = x.withColumn("opens", F.expr("leg_us IS NOT NULL AND (any_prev_leg_us IS NULL OR any_prev_leg_us < leg_us)"))
    x = stream_neighbors(x, keys, "leg_us", "mtcn", {"time": Stream("opens", ("leg_us",), ("leg_us",))})
    same = "prev_leg_us IS NOT NULL AND prev_amount = amount"
    fire = f"opens AND ({burst_sql('TRUE', fire_seconds, 'time_prev_', 'time_next_')})"
    return x.groupBy(*keys).agg(
        F.expr(f"count_if({same} AND role = 'send') AS send_repeat_amount_txns"),
        F.expr(f"count_if({same} AND role = 'pay') AS pay_repeat_amount_txns"),
        F.expr(f"count_if({fire}) AS rapid_fire_count"),
    )


def location_terminals(
    legs: DataFrame, fire_seconds: float = RAPID_FIRE_SECONDS, chunk_rows: int = DEFAULT_CHUNK_ROWS
) -> DataFrame:
    """Per location: the repeat and rapid-fire counts of its terminals, summed."""
    names = ("send_repeat_amount_txns", "pay_repeat_amount_txns", "rapid_fire_count")
    groups = terminal_counts(legs, fire_seconds, chunk_rows)
    return groups.groupBy("entity_id").agg(*[F.sum(n).cast("long").alias(n) for n in names])


def rapid_fire_groups(
    legs: DataFrame, fire_seconds: float = RAPID_FIRE_SECONDS, chunk_rows: int = DEFAULT_CHUNK_ROWS
) -> DataFrame:
    """Per (location, terminal) with a rapid-fire burst: its count."""
    counts = terminal_counts(legs, fire_seconds, chunk_rows)
    return counts.filter(F.col("rapid_fire_count") > 0).select("entity_id", "own_terminal", "rapid_fire_count")
