"""Customer batch: 69 features per (customer, as-of date) and look-back span.

``customer_features`` takes history legs (``operators.legs.customer_history_legs``)
and computes every span from the same legs in one pass per feature family:

* basics, payout speed, rapid payouts, risky-country sums and all ordered
  features: one segment per key and age class (``operators.segments``), from the
  legs with their neighbours, which cuts busy customers into chunks; the spans
  are merged from the segments of a key, one per class;
* distinct counts of 21 attributes: ``operators.distinct`` (two aggregates);
* primary countries: two aggregates;
* outcomes: a join on (entity, as-of date).

There is one plan for every batch, whatever its size and skew. The blocks meet
in left joins on (entity_id, as_of_date), each one row per key and already
hash-partitioned on it by its last aggregate.

Rows: one per (entity_id, as_of_date) with at least one leg in the history.
Missing numbers become 0 (an entity with no leg in a span gets 0 for every
number of that span, outcomes included); countries and first times stay null.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundtrail.functions.params import (
    AMOUNT_BANDS,
    BURST_GAP_SECONDS,
    CUSTOMER_FLIP_SECONDS,
    DEFAULT_CHUNK_ROWS,
    LOOKBACK_SPANS,
    OUTCOME_FLAGS,
    PRODUCTION_SUBJECT_TYPES,
    RAPID_PAYOUT_SECONDS,
)
from fundtrail.operators.countries import flag_high_risk, primary_countries
from fundtrail.operators.distinct import DistinctOut as O
from fundtrail.operators.distinct import ValueFamily, distinct_counts
from fundtrail.operators.outcomes import outcomes_as_of
from fundtrail.operators.segments import by_age_class, finish, segments, span_features

KEYS = ("entity_id", "as_of_date")
# The leg columns that ``customer_features`` reads.
LEGS_READ = (
    *KEYS, "age_days", "role", "mtcn", "leg_time", "leg_us", "amount", "payout_seconds", "is_hrj",
    "other_customer", "own_agent", "own_phone", "own_channel", "other_channel", "own_id_number", "other_country", "product",
)


def customer_distinct_families() -> list[ValueFamily]:
    S, P, A = ("send",), ("pay",), ("send", "pay")
    return [
        ValueFamily("own_agent", (O("send_agent_count", S), O("pay_agent_count", P), O("total_agent_count", A))),
        ValueFamily(
            "other_customer", (O("pay_customer_count", S), O("send_customer_count", P), O("total_customer_count", A))
        ),
        ValueFamily(
            "other_country",
            (
                O("pay_country_count", S),
                O("send_country_count", P),
                O("hrj_send_country_count", S, hrj=True),
                O("hrj_pay_country_count", P, hrj=True),
            ),
        ),
        ValueFamily("own_phone", (O("send_phone_count", S), O("pay_phone_count", P), O("total_phone_count", A))),
        ValueFamily("other_channel", (O("pay_channel_count", S), O("send_channel_count", P))),
        ValueFamily("own_channel", (O("total_channel_count", A),)),
        ValueFamily("own_id_number", (O("send_id_count", S), O("pay_id_count", P), O("total_id_count", A))),
        ValueFamily("product", (O("send_product_count", S), O("pay_product_count", P))),
    ]


def _role_block(role: str) -> list[str]:
    other = "pay" if role == "send" else "send"
    return [
        f"{role}_txn_count",
        f"{other}_customer_count",
        f"{other}_country_count",
        f"{other}_channel_count",
        f"{role}_phone_count",
        f"{role}_id_count",
        f"{role}_agent_count",
        f"{role}_product_count",
        f"avg_{role}_amount",
        *[f"{role}_banded_count_class{i}" for i in range(1, 6)],
        f"min_{role}_payout_speed",
        f"max_{role}_payout_speed",
        f"avg_{role}_payout_speed",
    ]


# The output columns of one span (69). Their order follows the operators.
FEATURES = (
    *_role_block("send"),
    *_role_block("pay"),
    "total_customer_count",
    "total_agent_count",
    "total_phone_count",
    "total_channel_count",
    "total_id_count",
    "primary_send_country",
    "primary_pay_country",
    "primary_country",
    "hrj_send_amount",
    "hrj_send_country_count",
    "hrj_pay_amount",
    "hrj_pay_country_count",
    "flipped_txns_count",
    "send_rapid_pay_out_txns",
    "pay_rapid_pay_out_txns",
    "send_repeat_amount_txns",
    "pay_repeat_amount_txns",
    "one_to_many_send_count",
    "many_to_one_pay_count",
    "min_send_time",
    "min_interval_send_txns",
    "max_interval_send_txns",
    "avg_interval_send_txns",
    "min_pay_time",
    "min_interval_pay_txns",
    "max_interval_pay_txns",
    "avg_interval_pay_txns",
    *OUTCOME_FLAGS,
)
NOT_FILLED = {"primary_send_country", "primary_pay_country", "primary_country", "min_send_time", "min_pay_time"}
DOUBLES = {
    f
    for f in FEATURES
    if f.startswith(("avg_", "min_interval", "max_interval", "min_send_payout", "max_send_payout", "min_pay_payout", "max_pay_payout"))
    or f.endswith("_amount")
}


def customer_features(
    legs: DataFrame,
    geo_risk: DataFrame,
    outcomes: DataFrame,
    spans: Sequence[tuple[str, int | None]] = LOOKBACK_SPANS,
    subject_type: str = PRODUCTION_SUBJECT_TYPES["customer"],
    outcome_days: int = 0,
    bands: Sequence[tuple[float, float]] = AMOUNT_BANDS,
    rapid_seconds: float = RAPID_PAYOUT_SECONDS,
    burst_seconds: float = BURST_GAP_SECONDS,
    flip_seconds: float = CUSTOMER_FLIP_SECONDS,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    as_of_between: tuple[dt.date | str, dt.date | str] | None = None,
) -> DataFrame:
    """(entity_id, as_of_date, then FEATURES under each span prefix).

    ``as_of_between``: the first and last as-of date of the batch, where known,
    to read only the cases of those days.
    """
    keys = list(KEYS)
    if "is_hrj" not in legs.columns:
        legs = flag_high_risk(legs, geo_risk)
    limits = (bands, rapid_seconds, burst_seconds, flip_seconds, chunk_rows)
    if len(spans) == 1 and spans[0][1] is None:  # one stretch per key: nothing to merge
        whole = finish(segments(legs, keys, *limits), keys, burst_seconds)
        blocks = whole.select(*keys, *[F.col(c).alias(f"{spans[0][0]}{c}") for c in whole.columns if c not in keys])
    else:
        stretches = segments(by_age_class(legs, spans), [*keys, "_age"], *limits)
        blocks = span_features(stretches, keys, "_age", spans, burst_seconds, flip_seconds)
    parts = [
        distinct_counts(legs, keys, customer_distinct_families(), spans),
        primary_countries(legs, keys, spans),
        outcomes_as_of(outcomes, legs.select(*keys).distinct(), subject_type, outcome_days, keys, as_of_between),
    ]
    return assemble(blocks, parts, spans, keys)


def assemble(
    blocks: DataFrame, parts: Sequence[DataFrame], spans: Sequence[tuple[str, int | None]], keys: Sequence[str] = KEYS
) -> DataFrame:
    """The feature table: ``blocks`` (one row per key, with ``{prefix}_legs``) joined with ``parts``, filled and named.

    Columns may come in structs.
    """
    keys = list(keys)

    def packed(df: DataFrame, name: str) -> DataFrame:
        """The columns beside the keys as one struct: joins and sorts copy each column of a row by itself."""
        return df.select(*keys, F.struct(*[c for c in df.columns if c not in keys]).alias(name))

    sides = {f"_{i}": df for i, df in enumerate([blocks, *parts])}
    where = {}
    for name, df in sides.items():
        for f in df.schema.fields:
            inner = f.dataType.names if isinstance(f.dataType, T.StructType) else None
            where |= {f.name: name} if inner is None else {c: f"{name}.`{f.name}`" for c in inner}
    joined = packed(blocks, "_0")
    for name, part in list(sides.items())[1:]:
        # a part has as many rows as blocks: never broadcast by the bytes of the compressed files it came from
        joined = joined.join(packed(part, name).hint("merge"), keys, "left")
    out = list(keys)
    for prefix, _ in spans:
        for name in FEATURES:
            column = name if name in OUTCOME_FLAGS else f"{prefix}{name}"
            src = f"{where[column]}.`{column}`"
            if name in NOT_FILLED:
                col = src
            elif name in OUTCOME_FLAGS:
                col = f"CAST(CASE WHEN {where[f'{prefix}_legs']}.`{prefix}_legs` > 0 THEN coalesce({src}, 0) ELSE 0 END AS BIGINT)"
            elif name in DOUBLES:
                col = f"coalesce(CAST({src} AS DOUBLE), CAST(0 AS DOUBLE))"
            else:
                col = f"coalesce(CAST({src} AS BIGINT), CAST(0 AS BIGINT))"
            out.append(f"{col} AS `{prefix}{name}`")
    return joined.selectExpr(*out)
