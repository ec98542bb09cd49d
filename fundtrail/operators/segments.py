"""Mergeable summaries of a stretch of a customer's time line.

A *segment* is one row that holds everything the span features need to know
about the legs of one stretch of a customer's history: a day, an age class, all
days before some date. Segments of stretches that follow each other merge into
the segment of both: counts and sums add up, and what happens across a border
(a gap, a repeated amount, a burst, a run of one counterparty) follows from the
last leg of the earlier and the first leg of the later segment, which each segment carries.
So features of any span come from its segments alone:

* ``segments``: legs -> one segment per key (legs of busy keys are cut into
  chunks, as everywhere);
* ``merge_segments``: one segment per key from the segments of its stretches;
* ``finish``: the features of a segment that nothing follows;
* ``span_features``: segments of days or age classes -> the features of every
  look-back span, by merging the stretches that each span covers.

Run ends: the last send of a segment ends a run only if the next send, in a later
segment, goes to someone else. A segment therefore counts the run ends before its last
send; merging decides about the last send of every segment but the last, and
``finish`` about that.

Merging is associative, and nothing here depends on how a history is split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundtrail.functions.columns import dbl, span_sql
from fundtrail.functions.params import (
    AMOUNT_BANDS,
    BURST_GAP_SECONDS,
    CUSTOMER_FLIP_SECONDS,
    DEFAULT_CHUNK_ROWS,
    RAPID_PAYOUT_SECONDS,
)
from fundtrail.operators.legs import ROLES
from fundtrail.operators.neighbors import CHUNK, Stream, stream_neighbors
from fundtrail.operators.sequences import role_neighbors, run_end
from fundtrail.session import as_written

_US = 1_000_000
BANDS = tuple(range(1, len(AMOUNT_BANDS) + 1))
ADDED = (
    "n_legs",
    *[
        f"{r}_{c}"
        for r in ROLES
        for c in ("n", "amount", "amounts", *[f"band{i}" for i in BANDS], "payout_sum", "payouts", "rapid", "hrj_amount")
    ],
)
LEAST = tuple(f"{r}_{c}" for r in ROLES for c in ("payout_min", "first_us", "first_time", "gap_min"))
MOST = tuple(f"{r}_{c}" for r in ROLES for c in ("payout_max", "last_us", "gap_max"))


def segment_columns() -> list[str]:
    """The columns of a segment, without its keys."""
    ordered = [f"{r}_{c}" for r in ROLES for c in ("first_amount", "last_amount", "gap_sum", "gaps", "repeats")]
    return [
        *ADDED, *LEAST, *MOST, *ordered,
        "pay_members", "pay_first_in", "pay_last_in",
        "any_first_us", "any_last_us", "flips",
        "send_first_to", "send_last_to",
        "ends", "ends_first_us", "ends_last_us", "end_members", "end_first_in", "end_last_in",
    ]


def segments(
    legs: DataFrame,
    keys: Sequence[str],
    bands: Sequence[tuple[float, float]] = AMOUNT_BANDS,
    rapid_seconds: float = RAPID_PAYOUT_SECONDS,
    burst_seconds: float = BURST_GAP_SECONDS,
    flip_seconds: float = CUSTOMER_FLIP_SECONDS,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """One segment per key; needs ``is_hrj``. Legs dealt by a prefix of the keys keep their chunks."""
    keys = list(keys)
    needed = ("role", "mtcn", "leg_time", "leg_us", "amount", "payout_seconds", "other_customer", "is_hrj")
    narrow = legs.select(*keys, *needed, *[c for c in (CHUNK,) if c in legs.columns])
    x = role_neighbors(as_written(narrow, legs), keys, chunk_rows)
    x = x.withColumn("inner_end", (F.col("role") == F.lit("send")) & F.col("next_leg_us").isNotNull() & run_end())
    ends = {"end": Stream("inner_end", ("leg_us",), ("leg_us",))}
    x = stream_neighbors(x, keys, "leg_us", "mtcn", ends, first="next")
    burst, flip = int(burst_seconds * _US), int(flip_seconds * _US)
    near_prev = f"(prev_leg_us IS NOT NULL AND leg_us - prev_leg_us <= {burst})"
    near_next = f"(next_leg_us IS NOT NULL AND next_leg_us - leg_us <= {burst})"
    end_prev = f"(end_prev_leg_us IS NOT NULL AND leg_us - end_prev_leg_us <= {burst})"
    end_next = f"(end_next_leg_us IS NOT NULL AND end_next_leg_us - leg_us <= {burst})"
    out = ["count(1) AS n_legs"]
    for r in ROLES:
        is_r, timed = f"role = '{r}'", f"role = '{r}' AND leg_us IS NOT NULL"
        first, last = f"{timed} AND prev_leg_us IS NULL", f"{timed} AND next_leg_us IS NULL"
        gap = f"CASE WHEN {timed} AND prev_leg_us IS NOT NULL THEN leg_us - prev_leg_us END"
        payout = f"CASE WHEN {is_r} THEN payout_seconds END"
        out += [
            f"count_if({is_r}) AS {r}_n",
            f"sum(CASE WHEN {is_r} THEN amount END) AS {r}_amount",
            f"count(CASE WHEN {is_r} THEN amount END) AS {r}_amounts",
            *[
                f"count_if({is_r} AND amount >= {dbl(lo)} AND amount < {dbl(hi)}) AS {r}_band{i}"
                for i, (lo, hi) in zip(BANDS, bands, strict=True)
            ],
            f"sum({payout}) AS {r}_payout_sum",
            f"count({payout}) AS {r}_payouts",
            f"min({payout}) AS {r}_payout_min",
            f"max({payout}) AS {r}_payout_max",
            f"count_if({is_r} AND payout_seconds <= {dbl(rapid_seconds)}) AS {r}_rapid",
            f"sum(CASE WHEN {is_r} AND is_hrj THEN amount END) AS {r}_hrj_amount",
            f"min(CASE WHEN {is_r} THEN leg_us END) AS {r}_first_us",
            f"max(CASE WHEN {is_r} THEN leg_us END) AS {r}_last_us",
            f"min(CASE WHEN {is_r} THEN leg_time END) AS {r}_first_time",
            f"max(CASE WHEN {first} THEN amount END) AS {r}_first_amount",
            f"max(CASE WHEN {last} THEN amount END) AS {r}_last_amount",
            f"min({gap}) AS {r}_gap_min",
            f"max({gap}) AS {r}_gap_max",
            f"sum({gap}) AS {r}_gap_sum",
            f"count({gap}) AS {r}_gaps",
            f"count_if({timed} AND prev_leg_us IS NOT NULL AND prev_amount = amount) AS {r}_repeats",
        ]
    pay_first, pay_last = ("role = 'pay' AND leg_us IS NOT NULL AND " + c for c in ("prev_leg_us IS NULL", "next_leg_us IS NULL"))
    send_first, send_last = ("role = 'send' AND leg_us IS NOT NULL AND " + c for c in ("prev_leg_us IS NULL", "next_leg_us IS NULL"))
    gap = "leg_us - all_prev_leg_us"
    out += [
        f"count_if(role = 'pay' AND ({near_prev} OR {near_next})) AS pay_members",
        f"coalesce(max(CASE WHEN {pay_first} THEN {near_next} END), FALSE) AS pay_first_in",
        f"coalesce(max(CASE WHEN {pay_last} THEN {near_prev} END), FALSE) AS pay_last_in",
        "min(leg_us) AS any_first_us",
        "max(leg_us) AS any_last_us",
        f"count_if({gap} > 0 AND {gap} <= {flip}) AS flips",
        f"max(CASE WHEN {send_first} THEN other_customer END) AS send_first_to",
        f"max(CASE WHEN {send_last} THEN other_customer END) AS send_last_to",
        "count_if(inner_end) AS ends",
        "min(CASE WHEN inner_end THEN leg_us END) AS ends_first_us",
        "max(CASE WHEN inner_end THEN leg_us END) AS ends_last_us",
        f"count_if(inner_end AND ({end_prev} OR {end_next})) AS end_members",
        f"coalesce(max(CASE WHEN inner_end AND end_prev_leg_us IS NULL THEN {end_next} END), FALSE) AS end_first_in",
        f"coalesce(max(CASE WHEN inner_end AND end_next_leg_us IS NULL THEN {end_prev} END), FALSE) AS end_last_in",
    ]
    return x.groupBy(*keys).agg(*[F.expr(e) for e in out]).select(*keys, *segment_columns())


def _take_last_send(rows: DataFrame, ends_here: str, burst: int) -> DataFrame:
    """Count the last send of a segment among its run ends where ``ends_here`` holds: s_* columns."""
    near = f"(ends > 0 AND send_last_us - ends_last_us <= {burst})"
    return rows.selectExpr(
        "*",
        f"ends + CASE WHEN {ends_here} THEN 1 ELSE 0 END AS s_ends",
        f"coalesce(ends_first_us, CASE WHEN {ends_here} THEN send_last_us END) AS s_first_us",
        f"CASE WHEN {ends_here} THEN send_last_us ELSE ends_last_us END AS s_last_us",
        f"end_members + CASE WHEN {ends_here} AND {near} THEN CASE WHEN end_last_in THEN 1 ELSE 2 END ELSE 0 END AS s_members",
        f"end_first_in OR ({ends_here} AND ends = 1 AND {near}) AS s_first_in",
        f"CASE WHEN {ends_here} THEN {near} ELSE end_last_in END AS s_last_in",
    )


def _gained(first_in: str, last_in: str, single: str, prev_ok: str, next_ok: str) -> str:
    """Members that a stretch gains from its neighbours: its first and its last row, or its only one."""
    return (
        f"CASE WHEN {single} THEN CASE WHEN {prev_ok} OR {next_ok} THEN 1 ELSE 0 END"
        f" ELSE CASE WHEN NOT {first_in} AND {prev_ok} THEN 1 ELSE 0 END"
        f" + CASE WHEN NOT {last_in} AND {next_ok} THEN 1 ELSE 0 END END"
    )


def merge_segments(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    burst_seconds: float = BURST_GAP_SECONDS,
    flip_seconds: float = CUSTOMER_FLIP_SECONDS,
) -> DataFrame:
    """One segment per key from the segments of its stretches, which follow each other by ``order``.

    A key has at most one row per stretch, so its rows are few.
    """
    keys = list(keys)
    burst, flip = int(burst_seconds * _US), int(flip_seconds * _US)
    all_rows = (Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy(F.col(order).asc()).rowsBetween(*all_rows)
    after = Window.partitionBy(*keys).orderBy(F.col(order).desc()).rowsBetween(*all_rows)

    def nearest(sql: str, side, name: str) -> Column:
        return F.last(F.expr(sql), ignorenulls=True).over(side).alias(name)

    x = rows.select(
        *keys, order, *segment_columns(),
        *[
            nearest(f"CASE WHEN {r}_last_us IS NOT NULL THEN struct({r}_last_us AS us, {r}_last_amount AS amount) END", before, f"p_{r}")
            for r in ROLES
        ],
        nearest("any_last_us", before, "p_any"),
        nearest("pay_first_us", after, "n_pay"),
        nearest("CASE WHEN send_first_us IS NOT NULL THEN struct(send_first_to AS to) END", after, "n_send"),
    )
    # the last send ends a run if another send follows, to someone else
    x = x.withColumn(
        "ends_here",
        F.expr(
            "send_last_us IS NOT NULL AND n_send IS NOT NULL"
            " AND (send_last_to IS NULL OR n_send.to IS NULL OR send_last_to <> n_send.to)"
        ),
    )
    x = _take_last_send(x, "ends_here", burst)
    x = x.select("*", nearest("s_last_us", before, "p_end"), nearest("s_first_us", after, "n_end"))
    pay_single, end_single = "(pay_gaps = 0)", "(s_ends = 1)"
    pay_prev, pay_next = (
        f"coalesce(pay_first_us - p_pay.us <= {burst}, FALSE)",
        f"coalesce(n_pay - pay_last_us <= {burst}, FALSE)",
    )
    end_prev, end_next = (
        f"coalesce(s_first_us - p_end <= {burst}, FALSE)",
        f"coalesce(n_end - s_last_us <= {burst}, FALSE)",
    )
    any_gap = "(any_first_us - p_any)"
    out = [f"sum({c}) AS {c}" for c in ADDED]
    for r in ROLES:
        gap = f"({r}_first_us - p_{r}.us)"
        here = f"FILTER (WHERE {r}_first_us IS NOT NULL)"
        out += [
            f"min({r}_payout_min) AS {r}_payout_min",
            f"max({r}_payout_max) AS {r}_payout_max",
            f"min({r}_first_us) AS {r}_first_us",
            f"max({r}_last_us) AS {r}_last_us",
            f"min({r}_first_time) AS {r}_first_time",
            f"min_by({r}_first_amount, {order}) {here} AS {r}_first_amount",
            f"max_by({r}_last_amount, {order}) {here} AS {r}_last_amount",
            f"min(least({r}_gap_min, {gap})) AS {r}_gap_min",
            f"max(greatest({r}_gap_max, {gap})) AS {r}_gap_max",
            f"sum(CASE WHEN {r}_gap_sum IS NULL AND {gap} IS NULL THEN NULL ELSE coalesce({r}_gap_sum, 0) + coalesce({gap}, 0) END) AS {r}_gap_sum",
            f"sum({r}_gaps + CASE WHEN {gap} IS NULL THEN 0 ELSE 1 END) AS {r}_gaps",
            f"sum({r}_repeats + CASE WHEN p_{r}.us IS NOT NULL AND {r}_first_us IS NOT NULL AND p_{r}.amount = {r}_first_amount"
            f" THEN 1 ELSE 0 END) AS {r}_repeats",
        ]
    pay_here, send_here = "FILTER (WHERE pay_first_us IS NOT NULL)", "FILTER (WHERE send_first_us IS NOT NULL)"
    end_here = "FILTER (WHERE s_ends > 0)"
    pay_gained = _gained("pay_first_in", "pay_last_in", pay_single, pay_prev, pay_next)
    end_gained = _gained("s_first_in", "s_last_in", end_single, end_prev, end_next)
    out += [
        f"sum(pay_members + CASE WHEN pay_first_us IS NULL THEN 0 ELSE {pay_gained} END) AS pay_members",
        f"coalesce(min_by(pay_first_in OR ({pay_single} AND {pay_next}), {order}) {pay_here}, FALSE) AS pay_first_in",
        f"coalesce(max_by(pay_last_in OR ({pay_single} AND {pay_prev}), {order}) {pay_here}, FALSE) AS pay_last_in",
        "min(any_first_us) AS any_first_us",
        "max(any_last_us) AS any_last_us",
        f"sum(flips + CASE WHEN {any_gap} > 0 AND {any_gap} <= {flip} THEN 1 ELSE 0 END) AS flips",
        f"min_by(send_first_to, {order}) {send_here} AS send_first_to",
        f"max_by(send_last_to, {order}) {send_here} AS send_last_to",
        "sum(s_ends) AS ends",
        "min(s_first_us) AS ends_first_us",
        "max(s_last_us) AS ends_last_us",
        f"sum(s_members + CASE WHEN s_ends = 0 THEN 0 ELSE {end_gained} END) AS end_members",
        f"coalesce(min_by(s_first_in OR ({end_single} AND {end_next}), {order}) {end_here}, FALSE) AS end_first_in",
        f"coalesce(max_by(s_last_in OR ({end_single} AND {end_prev}), {order}) {end_here}, FALSE) AS end_last_in",
    ]
    return x.groupBy(*keys).agg(*[F.expr(e) for e in out]).select(*keys, *segment_columns())


def finish(rows: DataFrame, keys: Sequence[str], burst_seconds: float = BURST_GAP_SECONDS) -> DataFrame:
    """The features of segments that nothing follows; ``_legs`` counts the legs."""
    burst = int(burst_seconds * _US)
    x = _take_last_send(rows, "(send_last_us IS NOT NULL)", burst)
    out = ["n_legs AS _legs"]
    for r in ROLES:
        out += [
            f"{r}_n AS {r}_txn_count",
            f"CAST({r}_amount AS DOUBLE) / nullif({r}_amounts, 0) AS avg_{r}_amount",
            *[f"{r}_band{i} AS {r}_banded_count_class{i}" for i in BANDS],
            f"{r}_payout_min AS min_{r}_payout_speed",
            f"{r}_payout_max AS max_{r}_payout_speed",
            f"{r}_payout_sum / nullif({r}_payouts, 0) AS avg_{r}_payout_speed",
            f"{r}_rapid AS {r}_rapid_pay_out_txns",
            f"{r}_hrj_amount AS hrj_{r}_amount",
            f"{r}_repeats AS {r}_repeat_amount_txns",
            f"{r}_first_time AS min_{r}_time",
            f"{r}_gap_min / {dbl(_US)} AS min_interval_{r}_txns",
            f"{r}_gap_max / {dbl(_US)} AS max_interval_{r}_txns",
            f"{r}_gap_sum / nullif({r}_gaps, 0) / {dbl(_US)} AS avg_interval_{r}_txns",
        ]
    out += [
        "pay_members AS many_to_one_pay_count",
        "s_members AS one_to_many_send_count",
        "flips AS flipped_txns_count",
    ]
    return x.selectExpr(*keys, *out)


def class_ages(spans: Sequence[tuple[str, int | None]]) -> list[int]:
    """The least age (in days) of each age class: the classes part where a span ends."""
    return [0, *sorted({c for _, c in spans if c is not None})]


def by_age_class(legs: DataFrame, spans: Sequence[tuple[str, int | None]], age: str = "age_days") -> DataFrame:
    """Add ``_age``, the least age of the leg's class: legs of equal ``_age`` are in the same spans."""
    ages = class_ages(spans)
    least = " ".join(f"WHEN {age} >= {c} THEN {c}" for c in reversed(ages))
    return as_written(legs.withColumn("_age", F.expr(f"CASE {least} ELSE 0 END")), legs)


def span_features(
    rows: DataFrame,
    keys: Sequence[str],
    age: str,
    spans: Sequence[tuple[str, int | None]],
    burst_seconds: float = BURST_GAP_SECONDS,
    flip_seconds: float = CUSTOMER_FLIP_SECONDS,
    dealt: bool = False,
) -> DataFrame:
    """Per key: ``{prefix}{feature}`` for every span, from segments whose column ``age`` (in days) tells their spans.

    A segment joins every span that its age is in; the segments of (key, span) are
    merged and finished, and the spans of a key put side by side. Segments are shuffled by key
    once, before each becomes one row per span; ``dealt``: they lie by key (or a part of it) already.
    """
    keys = list(keys)
    if all(cut is None for _, cut in spans) and len(spans) == 1:  # everything is in the one span
        merged = merge_segments(rows.withColumn("_order", -F.col(age)), keys, "_order", burst_seconds, flip_seconds)
        done = finish(merged, keys, burst_seconds)
        return done.select(*keys, *[F.col(c).alias(f"{spans[0][0]}{c}") for c in done.columns if c not in keys])
    if not dealt:
        rows = rows.repartition(*keys)
    held = ", ".join(f"CASE WHEN {span_sql(age, cut)} THEN {i} END" for i, (_, cut) in enumerate(spans))
    each = rows.select(
        *keys, (-F.col(age)).alias("_order"), *segment_columns(),
        F.explode(F.expr(f"filter(array({held}), x -> x IS NOT NULL)")).alias("_span"),
    )
    merged = merge_segments(each, [*keys, "_span"], "_order", burst_seconds, flip_seconds)
    done = finish(merged, [*keys, "_span"], burst_seconds)
    names = [c for c in done.columns if c not in (*keys, "_span")]
    wide = done.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_span", F.struct(*names)))).alias("_by_span")
    )
    return wide.select(
        *keys,
        *[
            F.col("_by_span")[i][n].alias(f"{prefix}{n}")
            for i, (prefix, _) in enumerate(spans)
            for n in names
        ],
    )
