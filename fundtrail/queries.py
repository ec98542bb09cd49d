"""The registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

They read the driver's tables (``sources.fixture``), run one operator or a
whole plan over the full data, and return the columns that the matching SQL
in ``fundtrail.oracle`` returns. The legs of the default batches are written to
the shared folder once per application and every feature family reads them.
Doubles are rounded to ``ROUND_DIGITS``.
Block queries return one row per entity with at least one leg, filled the
way the feature tables are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundtrail.functions.params import FIXTURE_SUBJECT_TYPES, LOOKBACK_SPANS
from fundtrail.operators import benford as B
from fundtrail.operators.basics import basics
from fundtrail.operators.countries import PRIMARY_FORMS, flag_high_risk, hrj_exposure, primary_countries
from fundtrail.operators.distinct import distinct_counts, select_outputs
from fundtrail.operators.flips import location_flips
from fundtrail.operators.legs import customer_history_legs, location_range_legs, transfer_legs
from fundtrail.operators.outcomes import outcome_sums, outcomes_as_of
from fundtrail.operators.queue import active_customers, active_locations, queue_remaining
from fundtrail.operators.sequences import (
    customer_neighbors,
    customer_sequences,
    location_bursts,
    location_terminals,
    rapid_fire_groups,
)
from fundtrail.oracle import AS_OF, MANY_DAYS, PREV_DAY, RANGE_FROM, RANGE_TO, ROUND_DIGITS, SHORT_CUTOFFS, THREE_DAYS
from fundtrail.plans import carried
from fundtrail.plans import customer as C
from fundtrail.plans import location as L
from fundtrail.plans import sinks
from fundtrail.session import LEGS_PER_FILE, app_key, materialize, scratch_path
from fundtrail.sources import schema as S
from fundtrail.sources.fixture import fixture_tables

Query = Callable[[SparkSession, str], DataFrame]
CKEYS = ["entity_id", "as_of_date"]
LKEYS = ["entity_id"]


def round_doubles(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    """Half up, by plain arithmetic: the oracle does the same on the same doubles, ties included."""
    scale = 10.0**digits
    return df.select(
        *[
            (F.floor(F.col(f"`{f.name}`") * scale + F.lit(0.5)) / F.lit(scale)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return fixture_tables(spark, sf_dir)


# Written legs of the default batches, per (application, sf_dir, kind): the
# registered queries are slices of one batch, which computes its legs once for
# all feature families.
_LEGS: dict[tuple[str, str, str], DataFrame] = {}


def _written(spark: SparkSession, sf_dir: str, kind: str, build) -> DataFrame:
    key = (app_key(spark), sf_dir, kind)
    if key not in _LEGS:
        _LEGS[key] = build()
    return _LEGS[key]


def _customer_legs(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    t = _tables(spark, sf_dir)

    def build():
        legs = customer_history_legs(t["transfers"], active_customers(t["transfers"], AS_OF), latest=AS_OF)
        return materialize(flag_high_risk(legs, t["geo_risk"]), "customer-legs", LEGS_PER_FILE)

    return t, _written(spark, sf_dir, "customer-legs", build)


def _location_legs(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    t = _tables(spark, sf_dir)
    # The batch is every location active in the range, which is exactly the set
    # the range legs cover, so no queue semi-join is needed (location_scan
    # applies an explicit queue).
    def build():
        legs = location_range_legs(t["transfers"], RANGE_FROM, RANGE_TO)
        return materialize(flag_high_risk(legs, t["geo_risk"]), "location-legs")

    return t, _written(spark, sf_dir, "location-legs", build)


def _fill(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        kind = kinds.get(f.name)
        c = F.col(f"`{f.name}`")
        if kind == "double":
            c = F.coalesce(c.cast("double"), F.lit(0.0))
        elif kind == "long":
            c = F.coalesce(c.cast("long"), F.lit(0))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _on_keys(legs: DataFrame, keys: Sequence[str], block: DataFrame, columns: Sequence[str], kind) -> DataFrame:
    """Block columns for every key with a leg, filled like the feature tables."""
    base = legs.select(*keys).distinct().join(block.select(*keys, *columns), list(keys), "left")
    return round_doubles(_fill(base, {c: kind(c) for c in columns}))


def _ckind(name: str) -> str:
    if name in C.NOT_FILLED:
        return "keep"
    return "double" if name in C.DOUBLES else "long"


def _lkind(name: str) -> str:
    if name == "id_type":
        return "keep"
    return "double" if name in L.DOUBLES else "long"


def _customer_attrs(names: Sequence[str]):
    return select_outputs(C.customer_distinct_families(), names)


def _location_attrs(names: Sequence[str]):
    return select_outputs(L.location_distinct_families(), names)


CUSTOMER_SEND_DISTINCT = [
    "send_agent_count", "pay_customer_count", "pay_country_count", "send_phone_count",
    "pay_channel_count", "send_id_count", "send_product_count",
]
CUSTOMER_PAY_DISTINCT = [
    "pay_agent_count", "send_customer_count", "send_country_count", "pay_phone_count",
    "send_channel_count", "pay_id_count", "pay_product_count",
]
LOCATION_SEND_DISTINCT = [
    "pay_agent_count", "pay_country_count", "send_customer_count", "send_phone_count",
    "pay_channel_count", "send_id_count", "send_product_count",
]
LOCATION_PAY_DISTINCT = [
    "send_agent_count", "send_country_count", "pay_customer_count", "pay_phone_count",
    "send_channel_count", "pay_id_count", "pay_product_count",
]
TOTALS = ["total_phone_count", "total_channel_count", "total_id_count"]
BANDS = [f"{r}_banded_count_class{i}" for r in ("send", "pay") for i in range(1, 6)]
SPEEDS = [f"{m}_{r}_payout_speed" for r in ("send", "pay") for m in ("min", "max", "avg")]
INTERVALS = [
    "min_send_time", "min_interval_send_txns", "max_interval_send_txns", "avg_interval_send_txns",
    "min_pay_time", "min_interval_pay_txns", "max_interval_pay_txns", "avg_interval_pay_txns",
]
HRJ = ["hrj_send_amount", "hrj_send_country_count", "hrj_pay_amount", "hrj_pay_country_count"]
OUTCOMES = list(C.OUTCOME_FLAGS)


# ---------------------------------------------------------------- customer blocks


def _customer_basics(columns: Sequence[str]) -> Query:
    def q(spark, sf_dir):
        _, legs = _customer_legs(spark, sf_dir)
        return _on_keys(legs, CKEYS, basics(legs, CKEYS), columns, _ckind)

    return q


def _customer_distinct(columns: Sequence[str]) -> Query:
    def q(spark, sf_dir):
        _, legs = _customer_legs(spark, sf_dir)
        return _on_keys(legs, CKEYS, distinct_counts(legs, CKEYS, _customer_attrs(columns)), columns, _ckind)

    return q


def _customer_primary(name: str) -> Query:
    def q(spark, sf_dir):
        _, legs = _customer_legs(spark, sf_dir)
        forms = [f for f in PRIMARY_FORMS if f[0] == name]
        return _on_keys(legs, CKEYS, primary_countries(legs, CKEYS, forms=forms), [name], _ckind)

    return q


def _customer_sequence(columns: Sequence[str]) -> Query:
    def q(spark, sf_dir):
        _, legs = _customer_legs(spark, sf_dir)
        return _on_keys(legs, CKEYS, customer_sequences(legs, CKEYS), columns, _ckind)

    return q


def hrj_customer(spark, sf_dir):
    t, legs = _customer_legs(spark, sf_dir)
    return _on_keys(legs, CKEYS, hrj_exposure(legs, CKEYS), HRJ, _ckind)


def outcomes_customer(spark, sf_dir):
    t, legs = _customer_legs(spark, sf_dir)
    keys = legs.select(*CKEYS).distinct()
    return _on_keys(legs, CKEYS, outcomes_as_of(t["outcomes"], keys, "customer", 0, CKEYS), OUTCOMES, _ckind)


def _spans(cutoffs) -> tuple[tuple[str, int | None], ...]:
    return (("", None), *cutoffs)


def _lookback_counts(spans) -> Query:
    def q(spark, sf_dir):
        _, legs = _customer_legs(spark, sf_dir)
        cols = [f"{p}{r}_txn_count" for p, _ in spans for r in ("send", "pay")]
        return _on_keys(legs, CKEYS, basics(legs, CKEYS, spans), cols, lambda c: "long")

    return q


def run_ends(spark, sf_dir):
    _, legs = _customer_legs(spark, sf_dir)
    return customer_neighbors(legs, CKEYS).filter("run_end").select(*CKEYS, "mtcn")


def _customer_features(spans) -> Query:
    def q(spark, sf_dir):
        t, legs = _customer_legs(spark, sf_dir)
        out = C.customer_features(
            legs, t["geo_risk"], t["outcomes"], spans, FIXTURE_SUBJECT_TYPES["customer"], as_of_between=(AS_OF, AS_OF)
        )
        return round_doubles(out)

    return q


def _carried(spans) -> Query:
    """Three daily batches running: each reads the state stored by the one before and its own day's legs."""

    def q(spark, sf_dir):
        t = _tables(spark, sf_dir)
        limits = carried.Limits(spans=spans)
        path = scratch_path(spark, "customer-state")
        history = str(dt.date.fromisoformat(THREE_DAYS[0]) - dt.timedelta(days=2))
        carried.write_state(carried.build_state(t["transfers"], t["geo_risk"], history, limits), path)
        days = []
        for as_of in THREE_DAYS:
            through = dt.date.fromisoformat(as_of) - dt.timedelta(days=1)
            before = carried.read_state(spark, path, through - dt.timedelta(days=1))
            carried.write_state(carried.advance(before, t["transfers"], t["geo_risk"], through, limits), path)
            days.append(
                carried.features_from_state(
                    carried.read_state(spark, path, through),
                    active_customers(t["transfers"], as_of),
                    t["outcomes"],
                    limits,
                    FIXTURE_SUBJECT_TYPES["customer"],
                )
            )
        return round_doubles(days[0].unionByName(days[1]).unionByName(days[2]))

    return q


def customer_features_many_dates(spark, sf_dir):
    """Every customer on every day of the data on which it was active: 29 as-of dates in one queue."""
    t = _tables(spark, sf_dir)
    queue = active_customers(t["transfers"], MANY_DAYS[0], MANY_DAYS[-1])
    out = carried.customer_features_at(
        t["transfers"], t["geo_risk"], t["outcomes"], queue, MANY_DAYS[-1],
        carried.Limits(spans=_spans(SHORT_CUTOFFS)), FIXTURE_SUBJECT_TYPES["customer"],
    )
    return round_doubles(out)


def customer_features_text_ids(spark, sf_dir):
    """The customer features of a transfer table whose identifiers are text and whose names are in capitals."""
    t = _tables(spark, sf_dir)

    def text_ids(df: DataFrame, schema) -> DataFrame:
        cast = [
            F.col(f.name).cast("string" if f.name in S.IDENTIFIERS and f.name != "mtcn" else f.dataType).alias(f.name.upper())
            for f in df.schema.fields
        ]
        return S.check_columns(df.select(*cast), schema, "text ids")

    transfers = text_ids(t["transfers"], S.TRANSFERS)
    outcomes = text_ids(t["outcomes"], S.OUTCOMES)
    legs = customer_history_legs(transfers, active_customers(transfers, AS_OF), latest=AS_OF)
    legs = materialize(flag_high_risk(legs, t["geo_risk"]), "customer-legs", LEGS_PER_FILE)
    out = C.customer_features(legs, t["geo_risk"], outcomes, (("", None),), FIXTURE_SUBJECT_TYPES["customer"])
    return round_doubles(out)


# ---------------------------------------------------------------- location blocks


def _location_aggregates(columns: Sequence[str]) -> Query:
    def q(spark, sf_dir):
        _, legs = _location_legs(spark, sf_dir)
        return _on_keys(legs, LKEYS, L.location_aggregates(legs), columns, _lkind)

    return q


def _location_distinct(columns: Sequence[str]) -> Query:
    def q(spark, sf_dir):
        _, legs = _location_legs(spark, sf_dir)
        return _on_keys(legs, LKEYS, distinct_counts(legs, LKEYS, _location_attrs(columns)), columns, _lkind)

    return q


def _location_block(fn, columns: Sequence[str]) -> Query:
    def q(spark, sf_dir):
        _, legs = _location_legs(spark, sf_dir)
        return _on_keys(legs, LKEYS, fn(legs), columns, _lkind)

    return q


def hrj_location(spark, sf_dir):
    t, legs = _location_legs(spark, sf_dir)
    return _on_keys(legs, LKEYS, hrj_exposure(legs, LKEYS), HRJ, _lkind)


def outcomes_location(spark, sf_dir):
    t, legs = _location_legs(spark, sf_dir)
    return _on_keys(legs, LKEYS, outcome_sums(t["outcomes"], "location", RANGE_FROM, RANGE_TO), OUTCOMES, _lkind)


def leading_digit_share(spark, sf_dir):
    _, legs = _location_legs(spark, sf_dir)
    return round_doubles(B.digit_shares(legs))


def burst_count(spark, sf_dir):
    _, legs = _location_legs(spark, sf_dir)
    return rapid_fire_groups(legs)


def time_index_tag(spark, sf_dir):
    t, legs = _location_legs(spark, sf_dir)
    keys = legs.select("entity_id").distinct()
    tagged = keys.select(
        "entity_id",
        F.lit(L.LOCATION_ID_TYPE).alias("id_type"),
        L.time_index_value(t["time_index"], RANGE_FROM, RANGE_TO).scalar().alias("time_index"),
    )
    return _fill(tagged, {"time_index": "long"})


def location_features(spark, sf_dir):
    t, legs = _location_legs(spark, sf_dir)
    return round_doubles(
        L.location_features(
            legs, t["geo_risk"], t["outcomes"], t["time_index"], RANGE_FROM, RANGE_TO, FIXTURE_SUBJECT_TYPES["location"]
        )
    )


# ---------------------------------------------------------------- scans and queues


def q_active_customers(spark, sf_dir):
    return active_customers(_tables(spark, sf_dir)["transfers"], AS_OF)


def q_active_locations(spark, sf_dir):
    return active_locations(_tables(spark, sf_dir)["transfers"], RANGE_FROM, RANGE_TO)


def q_queue_remaining(spark, sf_dir):
    tr = _tables(spark, sf_dir)["transfers"]
    return queue_remaining(active_customers(tr, AS_OF), active_customers(tr, PREV_DAY), ("entity_id",))


def _history(role: str) -> Query:
    def q(spark, sf_dir):
        _, legs = _customer_legs(spark, sf_dir)
        return round_doubles(
            legs.filter(F.col("role") == F.lit(role)).select(
                *CKEYS, "mtcn", "leg_time", "leg_date", "amount", "other_customer", "other_country", "payout_seconds"
            )
        )

    return q


def location_scan(spark, sf_dir):
    tr = _tables(spark, sf_dir)["transfers"]
    queue = active_locations(tr, RANGE_FROM, RANGE_TO)
    legs = location_range_legs(tr, RANGE_FROM, RANGE_TO, queue)
    return legs.select("entity_id", "role", "mtcn", "leg_time", "amount", "own_customer")


def q_legs(spark, sf_dir):
    tr = _tables(spark, sf_dir)["transfers"]
    both = transfer_legs(tr, "send").unionByName(transfer_legs(tr, "pay"))
    return both.select(
        "role", "mtcn", "own_customer", "other_customer", "own_location", "other_location",
        "leg_time", "leg_date", "amount", "other_country",
    )


def q_payout_seconds(spark, sf_dir):
    tr = _tables(spark, sf_dir)["transfers"]
    return round_doubles(transfer_legs(tr, "send").select("mtcn", "payout_seconds"))


# ---------------------------------------------------------------- sinks and queue tables


def _same_types(df: DataFrame, like: DataFrame) -> DataFrame:
    """Partition columns come back from folder names; give them their own type and place again."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in like.schema.fields])


def customer_queue_table(spark, sf_dir):
    """Write the queue, write it again, and read the table."""
    queue = active_customers(_tables(spark, sf_dir)["transfers"], AS_OF)
    path = scratch_path(spark, "customer-queue")
    for _ in range(2):
        sinks.write_customer_queue(queue, path)
    return _same_types(spark.read.parquet(path), queue)


def location_queue_table(spark, sf_dir):
    queue = active_locations(_tables(spark, sf_dir)["transfers"], RANGE_FROM, RANGE_TO)
    path = scratch_path(spark, "location-queue")
    for _ in range(2):
        sinks.write_location_queue(queue, path)
    return spark.read.parquet(path)


def customer_sink(spark, sf_dir):
    """Run the customer batch from a queue, run it again, and read the feature table."""
    t = _tables(spark, sf_dir)
    path = scratch_path(spark, "customer-features")
    queue = active_customers(t["transfers"], AS_OF)
    for _ in range(2):
        sinks.run_customer_batch(t, AS_OF, path, subject_type=FIXTURE_SUBJECT_TYPES["customer"], queue=queue)
    out = spark.read.parquet(path)
    first = [*CKEYS, *[c for c in out.columns if c not in CKEYS]]
    return round_doubles(out.withColumn("as_of_date", F.col("as_of_date").cast("date")).select(*first))


def customer_sink_done(spark, sf_dir):
    """Half of the queue, then all of it twice with the same finished keys; read the feature table."""
    t = _tables(spark, sf_dir)
    path = scratch_path(spark, "customer-features")
    queue = active_customers(t["transfers"], AS_OF)
    subject = FIXTURE_SUBJECT_TYPES["customer"]
    sinks.run_customer_batch(t, AS_OF, path, subject_type=subject, queue=queue.where("entity_id % 2 = 0"))
    done = materialize(spark.read.parquet(path).select(*CKEYS), "done")
    for _ in range(2):
        sinks.run_customer_batch(t, AS_OF, path, done=done, subject_type=subject, queue=queue)
    out = spark.read.parquet(path)
    first = [*CKEYS, *[c for c in out.columns if c not in CKEYS]]
    return round_doubles(out.withColumn("as_of_date", F.col("as_of_date").cast("date")).select(*first))


def location_sink(spark, sf_dir):
    """Run the location batch, run it again, and read the feature table."""
    t = _tables(spark, sf_dir)
    path = scratch_path(spark, "location-features")
    for _ in range(2):
        sinks.run_location_batch(t, RANGE_FROM, RANGE_TO, path, FIXTURE_SUBJECT_TYPES["location"])
    out = spark.read.parquet(path)
    return round_doubles(out.withColumns({c: F.col(c).cast("date") for c in ("date_from", "date_to")}))


QUERIES: dict[str, Query] = {
    "active_customers": q_active_customers,
    "active_locations": q_active_locations,
    "queue_remaining": q_queue_remaining,
    "history_send": _history("send"),
    "history_pay": _history("pay"),
    "location_scan": location_scan,
    "legs": q_legs,
    "payout_seconds": q_payout_seconds,
    "txn_count": _customer_basics(["send_txn_count", "pay_txn_count"]),
    "avg_amount": _customer_basics(["avg_send_amount", "avg_pay_amount"]),
    "banded_amounts_customer": _customer_basics(BANDS),
    "payout_speed_customer": _customer_basics(SPEEDS),
    "rapid_payout_customer": _customer_basics(["send_rapid_pay_out_txns", "pay_rapid_pay_out_txns"]),
    "distinct_customer_send": _customer_distinct(CUSTOMER_SEND_DISTINCT),
    "distinct_customer_pay": _customer_distinct(CUSTOMER_PAY_DISTINCT),
    "counterparties_customer": _customer_distinct(["total_customer_count"]),
    "totals_customer": _customer_distinct(["total_agent_count", *TOTALS]),
    "primary_send_country": _customer_primary("primary_send_country"),
    "primary_pay_country": _customer_primary("primary_pay_country"),
    "primary_country": _customer_primary("primary_country"),
    "hrj_customer": hrj_customer,
    "flipped_customer": _customer_sequence(["flipped_txns_count"]),
    "repeat_amount_customer": _customer_sequence(["send_repeat_amount_txns", "pay_repeat_amount_txns"]),
    "one_to_many_customer": _customer_sequence(["one_to_many_send_count"]),
    "many_to_one_customer": _customer_sequence(["many_to_one_pay_count"]),
    "interval_stats_customer": _customer_sequence(INTERVALS),
    "run_ends": run_ends,
    "outcomes_customer": outcomes_customer,
    "lookback_counts": _lookback_counts(LOOKBACK_SPANS),
    "lookback_counts_short": _lookback_counts(_spans(SHORT_CUTOFFS)),
    "customer_features": _customer_features((("", None),)),
    "customer_features_all_spans": _customer_features(LOOKBACK_SPANS),
    "customer_features_short_spans": _customer_features(_spans(SHORT_CUTOFFS)),
    "customer_features_carried": _carried(LOOKBACK_SPANS),
    "customer_features_carried_short_spans": _carried(_spans(SHORT_CUTOFFS)),
    "customer_features_many_dates": customer_features_many_dates,
    "customer_features_text_ids": customer_features_text_ids,
    "customer_queue_table": customer_queue_table,
    "location_queue_table": location_queue_table,
    "customer_sink": customer_sink,
    "customer_sink_done": customer_sink_done,
    "location_sink": location_sink,
    "banded_amounts_location": _location_aggregates(BANDS),
    "payout_speed_location": _location_aggregates(SPEEDS),
    "rapid_payout_location": _location_aggregates(["send_rapid_pay_out_txns", "pay_rapid_pay_out_txns"]),
    "distinct_location_send": _location_distinct(LOCATION_SEND_DISTINCT),
    "distinct_location_pay": _location_distinct(LOCATION_PAY_DISTINCT),
    "counterparties_location": _location_distinct(["total_agent_count"]),
    "totals_location": _location_distinct(["total_customer_count", *TOTALS]),
    "benford_send": _location_block(B.benford, ["first_digit_send"]),
    "benford_pay": _location_block(B.benford, ["first_digit_pay"]),
    "leading_digit_share": leading_digit_share,
    "one_to_many_location": _location_block(location_bursts, ["one_to_many_send_count"]),
    "many_to_one_location": _location_block(location_bursts, ["many_to_one_pay_count"]),
    "flipped_location": _location_block(location_flips, ["flipped_txns_count", "flipped_customer_count"]),
    "rapid_fire_location": _location_block(location_terminals, ["rapid_fire_count"]),
    "burst_count": burst_count,
    "repeat_amount_location": _location_block(location_terminals, ["send_repeat_amount_txns", "pay_repeat_amount_txns"]),
    "hrj_location": hrj_location,
    "outcomes_location": outcomes_location,
    "time_index_tag": time_index_tag,
    "location_features": location_features,
}
