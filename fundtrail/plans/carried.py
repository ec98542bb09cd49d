"""Customer features from carried state, and for many as-of dates at once.

A daily batch over the whole history reads all of it again every day. Here the
history is kept as partial results that the next day's legs are added to:

* ``segments``: one segment (``operators.segments``) per customer and recent day,
  and one for all days that are too old for every finite span;
* ``values``: per customer and value of each distinct-count family the day of
  its latest send leg and of its latest pay leg;
* ``amounts``: summed amounts per customer, role, country and recent day, and per
  country for the days before.

``advance`` reads the state and the legs of the days that it lacks, nothing else
(the dates reach the scan), and gives the next state; ``features_from_state``
gives the features of the day after the state's last. Old days are folded
together as they leave the longest span, so a customer's rows are bounded by the
length of that span, its distinct values and its countries, not by its history.

``customer_features_at`` uses the same day partials for a queue with many as-of
dates: a customer's dates stand among its days, and windows over them give each date's spans.

A leg counts as it was when its day was added: transfers that change or arrive
later (a payout recorded days after) are not seen; start again from a state
before that day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundtrail.functions.params import (
    AMOUNT_BANDS,
    BURST_GAP_SECONDS,
    CUSTOMER_FLIP_SECONDS,
    DEFAULT_CHUNK_ROWS,
    LOOKBACK_SPANS,
    PRODUCTION_SUBJECT_TYPES,
    RAPID_PAYOUT_SECONDS,
)
from fundtrail.operators.broadcast import sized_broadcast
from fundtrail.operators.countries import flag_high_risk, primary_countries
from fundtrail.operators.distinct import count_by_age, leg_values, value_changes
from fundtrail.operators.legs import customer_range_legs
from fundtrail.operators.neighbors import deal
from fundtrail.operators.outcomes import outcomes_as_of
from fundtrail.operators.running import days_and_dates, running_counts, span_features_at
from fundtrail.operators.segments import merge_segments, segment_columns, segments, span_features
from fundtrail.plans.customer import KEYS, assemble, customer_distinct_families
from fundtrail.session import path_exists

VALUE = ("f", "vl", "vs")
Spans = Sequence[tuple[str, int | None]]


@dataclass(frozen=True)
class Limits:
    """The thresholds of the features; a state must be carried on with those it was built with."""

    spans: Spans = LOOKBACK_SPANS
    bands: Sequence[tuple[float, float]] = AMOUNT_BANDS
    rapid_seconds: float = RAPID_PAYOUT_SECONDS
    burst_seconds: float = BURST_GAP_SECONDS
    flip_seconds: float = CUSTOMER_FLIP_SECONDS
    chunk_rows: int = DEFAULT_CHUNK_ROWS

    @property
    def longest(self) -> int:
        """Legs of this age in days or more are in no finite span."""
        return max((c for _, c in self.spans if c is not None), default=1)


@dataclass(frozen=True)
class CustomerState:
    """The history of every customer up to and including the day ``through``."""

    through: dt.date
    segments: DataFrame
    values: DataFrame
    amounts: DataFrame

    def parts(self) -> dict[str, DataFrame]:
        return {"values": self.values, "amounts": self.amounts, "segments": self.segments}


def _date(value: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def _dealt(legs: DataFrame, geo_risk: DataFrame, limits: Limits) -> DataFrame:
    return deal(flag_high_risk(legs, geo_risk), ["entity_id", "leg_date"], "leg_us", "mtcn", limits.chunk_rows)


def _day_segments(legs: DataFrame, limits: Limits) -> DataFrame:
    found = segments(
        legs, ["entity_id", "leg_date"], limits.bands, limits.rapid_seconds, limits.burst_seconds, limits.flip_seconds,
        limits.chunk_rows,
    )
    return found.withColumnRenamed("leg_date", "day")


def _day_values(legs: DataFrame, per: Sequence[str] = ("day",)) -> DataFrame:
    """Per customer, value and day: whether a send and a pay leg carried it; with no ``per``, the latest days."""
    rows = leg_values(legs.withColumn("day", F.col("leg_date")), customer_distinct_families(), ["entity_id", "day"])
    return rows.groupBy("entity_id", *VALUE, *per).agg(
        F.max(F.when(F.col("role") == F.lit("send"), F.col("day"))).alias("last_send"),
        F.max(F.when(F.col("role") == F.lit("pay"), F.col("day"))).alias("last_pay"),
        F.max("_hrj").alias("_hrj"),
    )


def _day_amounts(legs: DataFrame) -> DataFrame:
    return (
        legs.where(F.col("other_country").isNotNull())
        .groupBy("entity_id", "role", "other_country", F.col("leg_date").alias("day"))
        .agg(F.sum("amount").alias("amount"))
    )


def _latest(values: DataFrame) -> DataFrame:
    return values.groupBy("entity_id", *VALUE).agg(
        F.max("last_send").alias("last_send"), F.max("last_pay").alias("last_pay"), F.max("_hrj").alias("_hrj")
    )


def _fold(state: CustomerState, limits: Limits, latest: bool = False) -> CustomerState:
    """Days that are in no finite span any more become one; ``latest``: each value has one row already."""
    oldest = F.lit(state.through + dt.timedelta(days=1 - limits.longest)).cast("date")
    old = state.segments.where(F.col("day") <= oldest)
    merged = merge_segments(old, ["entity_id"], "day", limits.burst_seconds, limits.flip_seconds)
    folded = merged.select("entity_id", oldest.alias("day"), *segment_columns())
    kept = state.segments.where(F.col("day") > oldest)
    amounts = (
        state.amounts.withColumn("day", F.greatest("day", oldest))
        .groupBy("entity_id", "role", "other_country", "day")
        .agg(F.sum("amount").cast(state.amounts.schema["amount"].dataType).alias("amount"))
    )
    same = {f.name: f.dataType for f in state.segments.schema.fields}
    folded = folded.select(*[F.col(c).cast(same[c]) for c in kept.columns])
    return CustomerState(state.through, kept.unionByName(folded), state.values if latest else _latest(state.values), amounts)


def build_state(
    transfers: DataFrame, geo_risk: DataFrame, through: dt.date | str, limits: Limits | None = None
) -> CustomerState:
    """The state of the whole history up to the day ``through``."""
    limits = limits or Limits()
    legs = _dealt(customer_range_legs(transfers, None, through), geo_risk, limits)
    first = CustomerState(_date(through), _day_segments(legs, limits), _day_values(legs, ()), _day_amounts(legs))
    return _fold(first, limits, latest=True)


def advance(
    state: CustomerState,
    transfers: DataFrame,
    geo_risk: DataFrame,
    through: dt.date | str,
    limits: Limits | None = None,
) -> CustomerState:
    """The state up to ``through``, from ``state`` and the legs of the days after it alone."""
    limits = limits or Limits()
    through = _date(through)
    if through <= state.through:
        raise ValueError(f"the state already holds {state.through}")
    new = customer_range_legs(transfers, state.through + dt.timedelta(days=1), through)
    legs = _dealt(new, geo_risk, limits)
    like = {k: df.schema for k, df in state.parts().items()}

    def add(old: DataFrame, rows: DataFrame, name: str) -> DataFrame:
        return old.unionByName(rows.select(*[F.col(f.name).cast(f.dataType) for f in like[name].fields]))

    together = CustomerState(
        through,
        add(state.segments, _day_segments(legs, limits), "segments"),
        add(state.values, _day_values(legs, ()), "values"),
        add(state.amounts, _day_amounts(legs), "amounts"),
    )
    return _fold(together, limits)


def state_path(path: str, through: dt.date | str) -> str:
    return f"{path.rstrip('/')}/through={_date(through).isoformat()}"


def write_state(state: CustomerState, path: str) -> None:
    """Store the state in a folder of its last day, segments last; written again, it is replaced."""
    for name, part in state.parts().items():
        part.write.mode("overwrite").parquet(f"{state_path(path, state.through)}/{name}")


def has_state(spark: SparkSession, path: str, through: dt.date | str) -> bool:
    """Whether the state of the day was written whole: its segments are committed last."""
    return path_exists(spark, f"{state_path(path, through)}/segments/_SUCCESS")


def read_state(spark: SparkSession, path: str, through: dt.date | str) -> CustomerState:
    """The stored state of the day; a state that was not written whole has no segments and is refused by the reader."""
    folder = state_path(path, through)
    return CustomerState(_date(through), **{n: spark.read.parquet(f"{folder}/{n}") for n in ("segments", "values", "amounts")})


def _features(
    days: DataFrame, values: DataFrame, amounts: DataFrame, queue: DataFrame, outcomes: DataFrame, limits: Limits,
    subject_type: str, outcome_days: int, between: tuple[dt.date, dt.date] | None,
) -> DataFrame:
    """The feature table from day partials that carry ``as_of_date``; ``values`` has one row per key and value.

    ``queue`` holds every key of ``days``, each once; keys without days get no row.
    """
    keys = list(KEYS)
    age = F.datediff("as_of_date", "day")
    blocks = span_features(
        days.withColumn("_age", age), keys, "_age", limits.spans, limits.burst_seconds, limits.flip_seconds
    )
    aged = values.withColumns({f"_age_{r}": F.datediff("as_of_date", f"last_{r}") for r in ("send", "pay")})
    parts = [
        count_by_age(aged, keys, customer_distinct_families(), limits.spans),
        primary_countries(amounts.withColumn("age_days", age), keys, limits.spans),
        outcomes_as_of(outcomes, queue, subject_type, outcome_days, keys, between),
    ]
    return assemble(blocks, parts, limits.spans)


def features_from_state(
    state: CustomerState,
    queue: DataFrame,
    outcomes: DataFrame,
    limits: Limits | None = None,
    subject_type: str = PRODUCTION_SUBJECT_TYPES["customer"],
    outcome_days: int = 0,
) -> DataFrame:
    """Features of the queued customers as of the day after the state: the columns of ``customer_features``.

    Rows of ``queue`` (entity_id, as_of_date) with other dates are not computed.
    """
    limits = limits or Limits()
    as_of = state.through + dt.timedelta(days=1)
    day = F.lit(as_of).cast("date")
    q = queue.where(F.col("as_of_date") == day).select("entity_id", "as_of_date").distinct()
    small = sized_broadcast(q, name="customer queue")
    at = [part.join(small, "entity_id") for part in (state.segments, state.values, state.amounts)]
    return _features(*at, q, outcomes, limits, subject_type, outcome_days, (as_of, as_of))


def customer_features_at(
    transfers: DataFrame,
    geo_risk: DataFrame,
    outcomes: DataFrame,
    queue: DataFrame,
    latest: dt.date | str,
    limits: Limits | None = None,
    subject_type: str = PRODUCTION_SUBJECT_TYPES["customer"],
    outcome_days: int = 0,
) -> DataFrame:
    """Features of a queue (entity_id, as_of_date) with any number of as-of dates per customer, up to ``latest``.

    Legs become the partials of their day. Segments and distinct values do not meet the dates one by one:
    days and dates of a customer stand in one sequence, and windows over it give the spans of each date
    (``operators.running``), so the work grows with the days, not with dates x days. Only the amounts of
    countries join the later dates of their customer.
    These joins are merge joins: Spark reckons the partials by the bytes of compressed files and would
    broadcast them.
    """
    limits = limits or Limits()
    last = _date(latest) - dt.timedelta(days=1)
    legs = _dealt(customer_range_legs(transfers, None, last, queue), geo_risk, limits)
    q = queue.where(F.col("as_of_date") <= F.lit(latest).cast("date")).select("entity_id", "as_of_date").distinct()
    families = customer_distinct_families()
    used = _day_values(legs).select(
        "entity_id", *VALUE, "_hrj", "day", *[F.col(f"last_{r}").isNotNull().alias(r) for r in ("send", "pay")]
    )
    changes = value_changes(used, families, limits.spans)
    days = _day_segments(legs, limits).join(changes.hint("merge"), ["entity_id", "day"], "left")
    rows = span_features_at(days_and_dates(days, q), limits.spans, limits.burst_seconds, limits.flip_seconds)
    rows = running_counts(rows, families, limits.spans).where(F.col("as_of_date").isNotNull() & (F.col("_before") > 0))
    blocks = rows.select(*KEYS, "_features", "_counts")
    amounts = _day_amounts(legs).join(q.hint("merge"), "entity_id").where(F.col("as_of_date") > F.col("day"))
    parts = [
        primary_countries(amounts.withColumn("age_days", F.datediff("as_of_date", "day")), list(KEYS), limits.spans),
        outcomes_as_of(outcomes, q, subject_type, outcome_days, list(KEYS)),
    ]
    return assemble(blocks, parts, limits.spans)
