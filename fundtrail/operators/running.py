"""The features of many as-of dates of a customer, from windows over its days.

A row per (as-of date, day before it, look-back span) grows with the square of the
days. Here a customer's days and as-of dates stand in one sequence, and the dates
read their spans from window frames over it, so there is one row per day:

* sums, minima and maxima come from the frame of the span (the days from
  ``as_of_date - cut + 1`` to the day before the as-of date);
* what happens across the border of two days (a gap, a repeated amount, a
  burst) is counted at the later day against the whole history before it. A span that
  begins inside the history has no legs before its first one, so what that one
  counted against earlier legs is taken back;
* ``running_counts``: a distinct value enters a span the day after a use that follows
  none in the span, and leaves it ``cut`` days after a use that is followed by none; the values
  of a span are those entered less those left, two running totals.

The columns of a day are those of ``operators.segments``; the results equal those of
``span_features`` over a row per date and day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from fundtrail.functions.columns import dbl
from fundtrail.functions.params import BURST_GAP_SECONDS, CUSTOMER_FLIP_SECONDS
from fundtrail.operators.distinct import CHANGES, ValueFamily, entered, left
from fundtrail.operators.legs import ROLES
from fundtrail.operators.segments import ADDED, BANDS, segment_columns

_US = 1_000_000
Spans = Sequence[tuple[str, int | None]]
# Whole numbers of a day: those of a span are those so far less those before the span.
WHOLE = (
    *[c for c in ADDED if not c.endswith(("amount", "payout_sum"))],
    *[f"{r}_{c}" for r in ROLES for c in ("gap_sum", "gaps", "repeats")],
    "members", "in_ends", "flips",
)
# Sums that may be doubles: a difference of totals would not be exact, so the days of the span are summed.
SUMMED = tuple(c for c in ADDED if c.endswith(("amount", "payout_sum")))


def days_and_dates(days: DataFrame, dates: DataFrame, key: str = "entity_id") -> DataFrame:
    """One row per day with legs (``day``) or as-of date (``as_of_date``) of a key; ``_n`` numbers the days.

    ``days`` are segments; their columns come as the struct ``_day``, as rows of many columns are slow to join and
    to sort, further columns as they are. ``dates`` holds (key, as_of_date), each once; a date without legs has nulls.
    """
    others = [c for c in days.columns if c not in (key, "day", *segment_columns())]
    packed = days.select(key, "day", F.struct(*segment_columns()).alias("_day"), *others)
    asked = dates.select(key, F.col("as_of_date").alias("day"), "as_of_date").hint("merge")
    return packed.join(asked, [key, "day"], "full_outer").withColumn("_n", F.unix_date("day"))


def _days_before(key: str, least: int | None, most: int = 1) -> WindowSpec:
    """The rows of the days from ``least`` (None: all) to ``most`` days before a row's day."""
    first = Window.unboundedPreceding if least is None else -least
    return Window.partitionBy(key).orderBy("_n").rangeBetween(first, -most)


def running_counts(rows: DataFrame, families: Sequence[ValueFamily], spans: Spans, key: str = "entity_id") -> DataFrame:
    """Replace the column of ``distinct.value_changes`` by the struct ``_counts``: ``{prefix}{output}``, the distinct values in the span."""
    so_far = _days_before(key, None)

    def total(column: str, frame: WindowSpec) -> Column:
        return F.coalesce(F.sum(f"{CHANGES}.{column}").over(frame), F.lit(0))

    counts = []
    for prefix, cut in spans:
        for name in (out.name for fam in families for out in fam.outputs):
            count = total(entered(prefix, name), so_far)
            if cut is not None:
                count = count - total(left(prefix, name), _days_before(key, None, max(int(cut), 1)))
            counts.append(count.alias(f"{prefix}{name}"))
    return rows.select(*[c for c in rows.columns if c != CHANGES], F.struct(*counts).alias("_counts"))


def _near(earlier: str, later: str, burst: int) -> str:
    return f"coalesce({later} - {earlier} <= {burst}, FALSE)"


def _unless(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 0 ELSE 1 END"


def _against_history(rows: DataFrame, key: str, kept: Sequence[str], burst: int, flip: int) -> DataFrame:
    """What each day counts against the legs of the days before it, whatever the span.

    A run end is known at the next send: the last send of an earlier day is counted at the
    next day with sends (``carry``), before the run ends of that day itself.
    """
    before = Window.partitionBy(key).orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)

    def nearest(sql: str) -> Column:
        return F.last(F.expr(sql), ignorenulls=True).over(before)

    used = [
        *[f"{r}_{c}" for r in ROLES for c in ("first_us", "last_us", "first_amount", "last_amount")],
        "pay_gaps", "pay_first_in", "pay_last_in", "any_first_us", "any_last_us", "send_first_to", "send_last_to",
        "ends", "ends_first_us", "ends_last_us", "end_members", "end_first_in", "end_last_in",
    ]
    x = rows.select(*kept, "_day", *[F.col(f"_day.{c}") for c in used])
    x = x.select(
        "*",
        nearest("CASE WHEN send_first_us IS NOT NULL THEN struct(send_last_us AS us, send_last_amount AS amount, send_last_to AS to) END")
        .alias("p_send"),
        nearest("CASE WHEN pay_first_us IS NOT NULL THEN struct(pay_last_us AS us, pay_last_amount AS amount) END").alias("p_pay"),
        nearest("any_last_us").alias("p_any"),
    )
    new_to = "(p_send.to IS NULL OR send_first_to IS NULL OR p_send.to <> send_first_to)"
    x = x.selectExpr(
        "*",
        *[f"{r}_first_us - p_{r}.us AS c_{r}" for r in ROLES],
        f"CASE WHEN p_send IS NOT NULL AND send_first_us IS NOT NULL AND {new_to} THEN p_send.us END AS carry",
    )
    x = x.selectExpr(
        "*",
        f"coalesce(c_pay <= {burst}, FALSE) AS pay_near",
        "coalesce(ends_last_us, carry) AS last_end",
    )
    x = x.selectExpr("*", "CASE WHEN pay_first_us IS NOT NULL THEN pay_last_in OR (pay_gaps = 0 AND pay_near) END AS pay_in")
    x = x.select("*", nearest("pay_in").alias("p_pay_in"), nearest("last_end").alias("p_end"))
    x = x.selectExpr("*", f"carry IS NOT NULL AND {_near('p_end', 'carry', burst)} AS carry_near", "coalesce(carry, p_end) AS old_end")
    x = x.selectExpr(
        "*",
        "CASE WHEN last_end IS NOT NULL THEN CASE WHEN ends > 1 THEN end_last_in"
        f" WHEN ends = 1 THEN {_near('old_end', 'ends_first_us', burst)} ELSE carry_near END END AS end_in",
    )
    x = x.select("*", nearest("end_in").alias("p_end_in"))
    x = x.selectExpr("*", "coalesce(CASE WHEN carry IS NOT NULL THEN carry_near ELSE p_end_in END, FALSE) AS old_in")
    own = (
        f"CASE WHEN ends > 0 THEN end_members + CASE WHEN {_near('old_end', 'ends_first_us', burst)}"
        f" THEN {_unless('old_in')} + {_unless('end_first_in')} ELSE 0 END ELSE 0 END"
    )
    here = "coalesce(CASE WHEN last_end IS NOT NULL THEN end_in ELSE p_end_in END, FALSE)"
    x = x.selectExpr(
        "*",
        f"{own} AS own_ends",
        # the last send of all ends a run
        f"CASE WHEN send_last_us IS NOT NULL AND {_near('coalesce(last_end, p_end)', 'send_last_us', burst)}"
        f" THEN CASE WHEN {here} THEN 1 ELSE 2 END ELSE 0 END AS closing",
        f"CASE WHEN pay_near THEN {_unless('coalesce(p_pay_in, FALSE)')} + {_unless('pay_first_in')} ELSE 0 END AS pay_gained",
        f"CASE WHEN any_first_us - p_any > 0 AND any_first_us - p_any <= {flip} THEN 1 ELSE 0 END AS flip",
        *[f"CASE WHEN {r}_first_us IS NOT NULL AND p_{r}.amount = {r}_first_amount THEN 1 ELSE 0 END AS rep_{r}" for r in ROLES],
    )
    x = x.selectExpr(
        *kept,
        *[f"_day.{c}" for c in ADDED],
        *[f"_day.{r}_{c}" for r in ROLES for c in ("payout_min", "payout_max", "first_time", "gap_min", "gap_max")],
        *[f"c_{r}" for r in ROLES],
        # of every day with legs of the role; the first one of a span is left out
        *[f"CASE WHEN {r}_first_us IS NOT NULL THEN coalesce(c_{r}, 0) END AS l_{r}" for r in ROLES],
        *[f"coalesce(_day.{r}_gap_sum, 0) + coalesce(c_{r}, 0) AS {r}_gap_sum" for r in ROLES],
        *[f"_day.{r}_gaps + CASE WHEN c_{r} IS NULL THEN 0 ELSE 1 END AS {r}_gaps" for r in ROLES],
        *[f"_day.{r}_repeats + rep_{r} AS {r}_repeats" for r in ROLES],
        "_day.pay_members + pay_gained AS members",
        "own_ends + CASE WHEN carry_near THEN CASE WHEN coalesce(p_end_in, FALSE) THEN 1 ELSE 2 END ELSE 0 END AS in_ends",
        "_day.flips + flip AS flips",
        # the first send, pay and leg of a span, with what they counted against earlier ones
        "CASE WHEN send_first_us IS NOT NULL THEN struct(_n, c_send AS c, rep_send AS rep, carry_near, coalesce(p_end_in, FALSE) AS p_end_in,"
        " old_end, old_in, CASE WHEN ends > 0 THEN ends_first_us END AS us, CASE WHEN ends > 1 THEN end_first_in END AS first_in) END"
        " AS send_row",
        "CASE WHEN pay_first_us IS NOT NULL THEN struct(_n, c_pay AS c, rep_pay AS rep, pay_gained AS gained,"
        " pay_near AND pay_gaps = 0 AS lone) END AS pay_row",
        "CASE WHEN any_first_us IS NOT NULL THEN struct(_n, flip) END AS any_row",
        "CASE WHEN send_last_us IS NOT NULL THEN struct(_n, send_last_us AS us, closing) END AS close_row",
        # the first run end that a day counts, and whether the one after it, if of that day too, is near
        "CASE WHEN last_end IS NOT NULL THEN struct(_n, coalesce(carry, ends_first_us) AS us,"
        f" CASE WHEN carry IS NULL THEN CASE WHEN ends > 1 THEN end_first_in END"
        f" WHEN ends > 0 THEN {_near('carry', 'ends_first_us', burst)} END AS first_in) END AS end_row",
    )
    # of each row the next ones after it: those of the last row before a span are the span's first
    rows_after = f"IGNORE NULLS OVER (PARTITION BY `{key}` ORDER BY _n)"
    ahead = [f"lead({c}_row, 1) {rows_after} AS a_{c}" for c in ("send", "pay", "any")]
    ahead += [f"lead(end_row, {k}) {rows_after} AS a_end{k}" for k in (1, 2, 3)]
    names = [a.rsplit(" ", 1)[1] for a in ahead]
    x = x.selectExpr(*[c for c in x.columns if c not in ("send_row", "pay_row", "any_row", "end_row")], *ahead)
    return x.select(*[c for c in x.columns if c not in names], F.struct(*names).alias("ahead"))


def span_features_at(
    rows: DataFrame,
    spans: Spans,
    burst_seconds: float = BURST_GAP_SECONDS,
    flip_seconds: float = CUSTOMER_FLIP_SECONDS,
    key: str = "entity_id",
) -> DataFrame:
    """``rows`` of ``days_and_dates`` with the struct ``_features`` (``{prefix}{feature}`` of every span) instead of ``_day``.

    ``_before`` counts the legs before the row's day. A span without legs has nulls or zeros.
    """
    burst, flip = int(burst_seconds * _US), int(flip_seconds * _US)
    kept = [c for c in rows.columns if c not in ("day", "_day")]
    x = _against_history(rows, key, kept, burst, flip)
    found = []

    def over(value: Column, frame: WindowSpec, name: str) -> None:
        found.append(value.over(frame).alias(name))

    so_far = _days_before(key, None)
    for c in WHOLE:
        over(F.sum(c), so_far, f"all_{c}")
    over(F.last("close_row", ignorenulls=True), so_far, "close")
    # the days of the finite spans in classes of age, so that a frame sums no day twice; None: the whole history
    ages = [1, *sorted({max(int(cut), 2) for _, cut in spans if cut is not None})]
    classes: list[int | None] = [*range(len(ages) - 1), *([None] if any(cut is None for _, cut in spans) else [])]
    for k in classes:
        frame = so_far if k is None else _days_before(key, ages[k + 1] - 1, ages[k])
        s = "s_" if k is None else f"s{k}_"
        for c in SUMMED:
            over(F.sum(c), frame, f"{s}{c}")
        for r in ROLES:
            for c, of in (("payout_min", F.min), ("payout_max", F.max), ("first_time", F.min)):
                over(of(f"{r}_{c}"), frame, f"{s}{r}_{c}")
            over(F.min(F.least(f"{r}_gap_min", f"c_{r}") if k is None else F.col(f"{r}_gap_min")), frame, f"{s}{r}_gap_min")
            over(F.max(F.greatest(f"{r}_gap_max", f"c_{r}") if k is None else F.col(f"{r}_gap_max")), frame, f"{s}{r}_gap_max")
            if k is not None:
                over(F.collect_list(f"l_{r}"), frame, f"{s}{r}_list")
    for i, (_, cut) in enumerate(spans):
        if cut is not None:
            earlier = _days_before(key, None, max(int(cut), 1))
            for c in WHOLE:
                over(F.sum(c), earlier, f"old{i}_{c}")
            over(F.last("ahead"), earlier, f"ahead{i}")
    x = x.select(*kept, *found)
    # of the rows ahead of a span only those before the as-of date are in it
    ahead = [f"CASE WHEN ahead{i}.a_{c}._n < _n THEN ahead{i}.a_{c} END AS t{i}_{c}"
             for i, (_, cut) in enumerate(spans) if cut is not None for c in ("send", "pay", "any", "end1", "end2", "end3")]
    closes = [f"CASE WHEN _n - close._n < {cut} THEN close END AS t{i}_close" for i, (_, cut) in enumerate(spans) if cut is not None]
    together = []
    for i, (_, cut) in enumerate(spans):
        if cut is None:
            continue
        parts = [f"s{k}_" for k in range(ages.index(max(int(cut), 2)))]
        together += [f"{' + '.join(f'coalesce({p}{c}, 0)' for p in parts)} AS t{i}_{c}" for c in SUMMED]
        for r in ROLES:
            for c, of in (("payout_min", "least"), ("payout_max", "greatest"), ("first_time", "least"), ("gap_min", "least"), ("gap_max", "greatest")):
                each = [f"{p}{r}_{c}" for p in parts]
                together.append(f"{each[0] if len(each) == 1 else f'{of}({", ".join(each)})'} AS t{i}_{r}_{c}")
            together.append(f"concat({', '.join(f'{p}{r}_list' for p in reversed(parts))}) AS t{i}_{r}_list")
    x = x.selectExpr("*", *ahead, *closes, *together)
    out = []
    for i, (prefix, cut) in enumerate(spans):
        for name, sql in _finished(i, cut, burst):
            out.append(f"{sql if cut is None or cut > 1 else f'CASE WHEN FALSE THEN {sql} END'} AS `{prefix}{name}`")
    done = x.selectExpr(*kept, "all_n_legs AS _before", *out)
    return done.select(*kept, "_before", F.struct(*done.columns[len(kept) + 1 :]).alias("_features"))


def _finished(i: int, cut: int | None, burst: int) -> list[tuple[str, str]]:
    """(feature, SQL) of the ``i``-th span from its frames; names as in ``segments.finish``."""
    s = "s_" if cut is None else f"t{i}_"

    def whole(c: str) -> str:
        return f"coalesce(all_{c}, 0)" if cut is None else f"(coalesce(all_{c}, 0) - coalesce(old{i}_{c}, 0))"

    out = [("_legs", whole("n_legs"))]
    for r in ROLES:
        gap_sum, gaps, repeats = (whole(f"{r}_{c}") for c in ("gap_sum", "gaps", "repeats"))
        gap_min, gap_max = f"{s}{r}_gap_min", f"{s}{r}_gap_max"
        if cut is not None:
            later = f"slice({s}{r}_list, 2, size({s}{r}_list))"
            gap_min, gap_max = f"least({gap_min}, array_min({later}))", f"greatest({gap_max}, array_max({later}))"
            gap_sum = f"({gap_sum} - coalesce({s}{r}.c, 0))"
            gaps = f"({gaps} - CASE WHEN {s}{r}.c IS NULL THEN 0 ELSE 1 END)"
            repeats = f"({repeats} - coalesce({s}{r}.rep, 0))"
        out += [
            (f"{r}_txn_count", whole(f"{r}_n")),
            (f"avg_{r}_amount", f"CAST({s}{r}_amount AS DOUBLE) / nullif({whole(f'{r}_amounts')}, 0)"),
            *[(f"{r}_banded_count_class{b}", whole(f"{r}_band{b}")) for b in BANDS],
            (f"min_{r}_payout_speed", f"{s}{r}_payout_min"),
            (f"max_{r}_payout_speed", f"{s}{r}_payout_max"),
            (f"avg_{r}_payout_speed", f"{s}{r}_payout_sum / nullif({whole(f'{r}_payouts')}, 0)"),
            (f"{r}_rapid_pay_out_txns", whole(f"{r}_rapid")),
            (f"hrj_{r}_amount", f"{s}{r}_hrj_amount"),
            (f"{r}_repeat_amount_txns", repeats),
            (f"min_{r}_time", f"{s}{r}_first_time"),
            (f"min_interval_{r}_txns", f"{gap_min} / {dbl(_US)}"),
            (f"max_interval_{r}_txns", f"{gap_max} / {dbl(_US)}"),
            (f"avg_interval_{r}_txns", f"{gap_sum} / nullif({gaps}, 0) / {dbl(_US)}"),
        ]
    members, in_ends, flips = whole("members"), whole("in_ends"), whole("flips")
    if cut is None:
        return [
            *out,
            ("many_to_one_pay_count", members),
            ("one_to_many_send_count", f"{in_ends} + coalesce(close.closing, 0)"),
            ("flipped_txns_count", flips),
        ]
    # a lone pay was in a burst by the pay before the span already; now it is by the next one
    second_near = f"coalesce(get({s}pay_list, 1) <= {burst}, FALSE)"
    pays = f"{members} - coalesce({s}pay.gained, 0) + CASE WHEN {s}pay.lone AND {second_near} THEN 1 ELSE 0 END"
    # the first two run ends of the span: that carried to its first day with sends lies before the span
    own = f"({s}end1._n = {s}send._n)"
    a, b = (f"(CASE WHEN {own} THEN {s}end{k + 1} ELSE {s}end{k} END)" for k in (1, 2))
    first = f"coalesce({s}send.us, {a}.us, {s}close.us)"
    second_near = (
        f"CASE WHEN {s}send.us IS NOT NULL THEN coalesce({s}send.first_in, {_near(f'{s}send.us', f'coalesce({a}.us, {s}close.us)', burst)})"
        f" WHEN {a}.us IS NOT NULL THEN coalesce({a}.first_in, {_near(f'{a}.us', f'coalesce({b}.us, {s}close.us)', burst)})"
        f" ELSE FALSE END"
    )
    carried = f"CASE WHEN {s}send.carry_near THEN CASE WHEN {s}send.p_end_in THEN 1 ELSE 2 END ELSE 0 END"
    over_border = f"CASE WHEN {_near(f'{s}send.old_end', first, burst)} THEN {_unless(f'{s}send.old_in')} + {_unless(second_near)} ELSE 0 END"
    return [
        *out,
        ("many_to_one_pay_count", pays),
        ("one_to_many_send_count", f"{in_ends} - {carried} + coalesce({s}close.closing, 0) - {over_border}"),
        ("flipped_txns_count", f"{flips} - coalesce({s}any.flip, 0)"),
    ]
