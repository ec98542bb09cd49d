"""Location batch: 64 features per location over one inclusive date range.

``location_features`` takes range legs (``operators.legs.location_range_legs``).
Basics, risky-country sums and leading digits come from one ``groupBy``;
distinct counts from ``operators.distinct``; bursts, repeats and rapid fire
from neighbours keyed finer than the location (by customer or terminal) and cut
into chunks, so a busy location does not become one task; flips from running
counts (``operators.flips``). Outcomes are a left join; the time index is the
one row of a global aggregate. There is one plan for every batch, whatever its
size and skew; nothing is shuffled on the location alone before it is
aggregated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtrail.functions.params import (
    AMOUNT_BANDS,
    BURST_GAP_SECONDS,
    DEFAULT_CHUNK_ROWS,
    LOCATION_ID_TYPE,
    OUTCOME_FLAGS,
    PRODUCTION_SUBJECT_TYPES,
    RAPID_FIRE_SECONDS,
    RAPID_PAYOUT_SECONDS,
)
from fundtrail.operators import benford as B
from fundtrail.operators.basics import hrj_amount_exprs, role_exprs
from fundtrail.operators.countries import flag_high_risk
from fundtrail.operators.distinct import DistinctOut as O
from fundtrail.operators.distinct import ValueFamily, distinct_counts
from fundtrail.operators.flips import location_flips
from fundtrail.operators.outcomes import outcome_sums
from fundtrail.operators.sequences import location_bursts, location_terminals

KEYS = ("entity_id",)
# The leg columns that ``location_features`` reads.
LEGS_READ = (
    *KEYS, "role", "mtcn", "leg_us", "amount", "payout_seconds", "is_hrj", "own_customer", "other_customer",
    "other_location", "other_agent", "own_terminal", "own_phone", "own_channel", "other_channel", "own_id_number",
    "other_country", "product",
)


def location_distinct_families() -> list[ValueFamily]:
    S, P, A = ("send",), ("pay",), ("send", "pay")
    return [
        ValueFamily("other_agent", (O("pay_agent_count", S), O("send_agent_count", P))),
        ValueFamily(
            "other_country",
            (
                O("pay_country_count", S),
                O("send_country_count", P),
                O("hrj_send_country_count", S, hrj=True),
                O("hrj_pay_country_count", P, hrj=True),
            ),
        ),
        ValueFamily(
            "own_customer", (O("send_customer_count", S), O("pay_customer_count", P), O("total_customer_count", A))
        ),
        ValueFamily("own_phone", (O("send_phone_count", S), O("pay_phone_count", P), O("total_phone_count", A))),
        ValueFamily("other_channel", (O("pay_channel_count", S), O("send_channel_count", P))),
        ValueFamily("own_channel", (O("total_channel_count", A),)),
        ValueFamily("own_id_number", (O("send_id_count", S), O("pay_id_count", P), O("total_id_count", A))),
        ValueFamily("product", (O("send_product_count", S), O("pay_product_count", P))),
        # Distinct counterparty locations over both directions.
        ValueFamily("other_location", (O("total_agent_count", A),)),
    ]


def _role_block(role: str) -> list[str]:
    other = "pay" if role == "send" else "send"
    return [
        f"{role}_txn_count",
        f"{role}_customer_count",
        f"{other}_agent_count",
        f"{other}_country_count",
        f"{other}_channel_count",
        f"{role}_phone_count",
        f"{role}_id_count",
        f"{role}_product_count",
        f"avg_{role}_amount",
        *[f"{role}_banded_count_class{i}" for i in range(1, 6)],
        f"min_{role}_payout_speed",
        f"max_{role}_payout_speed",
        f"avg_{role}_payout_speed",
    ]


# The output columns after entity_id (64). Their order follows the operators.
FEATURES = (
    *_role_block("send"),
    *_role_block("pay"),
    "total_agent_count",
    "total_customer_count",
    "total_phone_count",
    "total_channel_count",
    "total_id_count",
    "one_to_many_send_count",
    "many_to_one_pay_count",
    "first_digit_send",
    "first_digit_pay",
    "flipped_txns_count",
    "flipped_customer_count",
    "rapid_fire_count",
    "send_repeat_amount_txns",
    "pay_repeat_amount_txns",
    "send_rapid_pay_out_txns",
    "pay_rapid_pay_out_txns",
    "hrj_send_amount",
    "hrj_send_country_count",
    "hrj_pay_amount",
    "hrj_pay_country_count",
    *OUTCOME_FLAGS,
    "id_type",
    "time_index",
)
DOUBLES = {
    f
    for f in FEATURES
    if f.startswith(("avg_", "min_send_payout", "max_send_payout", "min_pay_payout", "max_pay_payout", "first_digit"))
    or f.endswith("_amount")
}


def location_aggregates(
    legs: DataFrame,
    bands: Sequence[tuple[float, float]] = AMOUNT_BANDS,
    rapid_seconds: float = RAPID_PAYOUT_SECONDS,
    with_hrj: bool = True,
) -> DataFrame:
    """One ``groupBy``: per-role basics, risky-country sums (legs flagged by
    ``flag_high_risk``) and leading digits."""
    exprs = []
    for role in ("send", "pay"):
        exprs += role_exprs(role, "", f"role = '{role}'", bands, rapid_seconds)
        exprs += B.digit_count_exprs(role)
    if with_hrj:
        exprs += hrj_amount_exprs("", "TRUE")
    agg = B.with_digit(legs).groupBy(*KEYS).agg(*exprs)
    digits = [f"_d{d}_{r}" for r in ("send", "pay") for d in B.DIGITS]
    return agg.select(
        "*", B.deviation("send").alias("first_digit_send"), B.deviation("pay").alias("first_digit_pay")
    ).drop(*digits)


def time_index_value(time_index: DataFrame, date_from: dt.date | str, date_to: dt.date | str) -> DataFrame:
    """One row: the index whose (t1, t2) equals the range, or null."""
    lo, hi = F.lit(date_from).cast("date"), F.lit(date_to).cast("date")
    return time_index.filter((F.col("t1") == lo) & (F.col("t2") == hi)).agg(
        F.min("time_index").cast("long").alias("time_index")
    )


def location_features(
    legs: DataFrame,
    geo_risk: DataFrame,
    outcomes: DataFrame,
    time_index: DataFrame,
    date_from: dt.date | str,
    date_to: dt.date | str,
    subject_type: str = PRODUCTION_SUBJECT_TYPES["location"],
    bands: Sequence[tuple[float, float]] = AMOUNT_BANDS,
    rapid_seconds: float = RAPID_PAYOUT_SECONDS,
    burst_seconds: float = BURST_GAP_SECONDS,
    flip_seconds: float = BURST_GAP_SECONDS,
    fire_seconds: float = RAPID_FIRE_SECONDS,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """(entity_id, FEATURES): one row per location with a leg in the range."""
    keys = list(KEYS)
    if "is_hrj" not in legs.columns:
        legs = flag_high_risk(legs, geo_risk)
    blocks = location_aggregates(legs, bands, rapid_seconds)
    parts = [
        location_bursts(legs, burst_seconds, chunk_rows),
        location_terminals(legs, fire_seconds, chunk_rows),
        distinct_counts(legs, keys, location_distinct_families()),
        location_flips(legs, flip_seconds, chunk_rows),
        outcome_sums(outcomes, subject_type, date_from, date_to),
    ]
    for part in parts:
        blocks = blocks.join(part, keys, "left")
    # A global aggregate has exactly one row: a scalar subquery, run once.
    blocks = blocks.withColumn("time_index", time_index_value(time_index, date_from, date_to).scalar())
    blocks = blocks.withColumn("id_type", F.lit(LOCATION_ID_TYPE))
    out = ["entity_id"]
    for name in FEATURES:
        if name == "id_type":
            out.append(name)
        elif name in DOUBLES:
            out.append(f"coalesce(CAST({name} AS DOUBLE), CAST(0 AS DOUBLE)) AS {name}")
        else:
            out.append(f"coalesce(CAST({name} AS BIGINT), CAST(0 AS BIGINT)) AS {name}")
    return blocks.selectExpr(*out)
