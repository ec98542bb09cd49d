"""Per-role counts, amounts, bands, payout speed, rapid payouts and risky-country sums.

All of these are conditional aggregates over legs, so every role and every
look-back span comes out of one ``groupBy`` with map-side combining. The
aggregates are written as SQL expression strings: one parse per aggregate
instead of one driver round trip per operator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundtrail.functions.columns import dbl, span_sql
from fundtrail.functions.params import AMOUNT_BANDS, RAPID_PAYOUT_SECONDS
from fundtrail.operators.legs import ROLES

SPANS_FULL = (("", None),)


def role_sql(
    role: str,
    prefix: str,
    cond: str,
    bands: Sequence[tuple[float, float]] = AMOUNT_BANDS,
    rapid_seconds: float = RAPID_PAYOUT_SECONDS,
) -> list[str]:
    """Aggregates of one role under the SQL condition ``cond`` (role and span test included)."""
    out = [
        f"count_if({cond}) AS `{prefix}{role}_txn_count`",
        # sum and count apart: the mean of decimals would be rounded to a decimal
        f"CAST(sum(CASE WHEN {cond} THEN amount END) AS DOUBLE)"
        f" / nullif(count(CASE WHEN {cond} THEN amount END), 0) AS `{prefix}avg_{role}_amount`",
    ]
    out += [
        f"count_if({cond} AND amount >= {dbl(lo)} AND amount < {dbl(hi)}) AS `{prefix}{role}_banded_count_class{i}`"
        for i, (lo, hi) in enumerate(bands, start=1)
    ]
    out += [
        f"{fn}(CASE WHEN {cond} THEN payout_seconds END) AS `{prefix}{fn}_{role}_payout_speed`"
        for fn in ("min", "max", "avg")
    ]
    # A missing payout has a null duration and is never rapid.
    out.append(f"count_if({cond} AND payout_seconds <= {dbl(rapid_seconds)}) AS `{prefix}{role}_rapid_pay_out_txns`")
    return out


def role_exprs(role: str, prefix: str, cond: str, bands=AMOUNT_BANDS, rapid_seconds=RAPID_PAYOUT_SECONDS) -> list[Column]:
    return [F.expr(e) for e in role_sql(role, prefix, cond, bands, rapid_seconds)]


def hrj_amount_exprs(prefix: str, span: str) -> list[Column]:
    """Summed amount of legs whose other side is a risky country (needs ``is_hrj``)."""
    return [
        F.expr(f"sum(CASE WHEN role = '{r}' AND {span} AND is_hrj THEN amount END) AS `{prefix}hrj_{r}_amount`")
        for r in ROLES
    ]


def basics(
    legs: DataFrame,
    keys: Sequence[str],
    spans: Sequence[tuple[str, int | None]] = SPANS_FULL,
    bands: Sequence[tuple[float, float]] = AMOUNT_BANDS,
    rapid_seconds: float = RAPID_PAYOUT_SECONDS,
    with_hrj: bool = False,
) -> DataFrame:
    """Per key: for each span and role the basic aggregates; ``{prefix}_legs`` counts legs in the span."""
    return legs.groupBy(*keys).agg(*basics_exprs(spans, bands, rapid_seconds, with_hrj))


def basics_exprs(
    spans: Sequence[tuple[str, int | None]] = SPANS_FULL,
    bands: Sequence[tuple[float, float]] = AMOUNT_BANDS,
    rapid_seconds: float = RAPID_PAYOUT_SECONDS,
    with_hrj: bool = False,
) -> list[Column]:
    """The aggregates of ``basics``, for use in a larger ``groupBy``."""
    exprs = []
    for prefix, cut in spans:
        span = span_sql("age_days", cut)
        exprs.append(F.expr(f"count_if({span}) AS `{prefix}_legs`"))
        for role in ROLES:
            exprs += role_exprs(role, prefix, f"role = '{role}' AND {span}", bands, rapid_seconds)
        if with_hrj:
            exprs += hrj_amount_exprs(prefix, span)
    return exprs
