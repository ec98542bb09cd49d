"""Feature sinks, queue tables, and the batch runners that feed them.

Every write replaces the partitions it has rows for (the as-of date; the date
range for locations), so running a batch again leaves the same table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtrail.functions.params import LOOKBACK_SPANS, PRODUCTION_SUBJECT_TYPES
from fundtrail.operators.countries import flag_high_risk
from fundtrail.operators.legs import customer_history_legs, location_range_legs
from fundtrail.operators.queue import active_customers, queue_remaining
from fundtrail.plans import carried
from fundtrail.plans.customer import KEYS as CUSTOMER_KEYS
from fundtrail.plans.customer import LEGS_READ as CUSTOMER_LEGS
from fundtrail.plans.customer import customer_features
from fundtrail.plans.location import LEGS_READ as LOCATION_LEGS
from fundtrail.plans.location import location_features
from fundtrail.session import LEGS_PER_FILE, materialize, path_exists, scratch


def _replace(df: DataFrame, path: str, fmt: str, partitions: list[str]) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).format(fmt).save(path)


def write_customer_features(features: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One folder per as-of date; the dates of ``features`` are replaced."""
    _replace(features, path, fmt, ["as_of_date"])


def add_customer_features(features: DataFrame, path: str, as_of: dt.date | str, fmt: str = "parquet") -> None:
    """Add the rows of ``features`` (all of day ``as_of``) whose keys the table does not hold yet.

    What is there of the day is first copied to the shared folder; then the day's
    folder is replaced, in one commit, by the copy and the new rows. So a run that failed,
    or runs again, leaves each key once, and the rows that were there as they were.
    """
    spark = features.sparkSession
    if path_exists(spark, path):
        there = spark.read.format(fmt).load(path).where(F.col("as_of_date") == F.lit(as_of).cast("date"))
        there = there.select(*[F.col(f.name).cast(f.dataType) for f in features.schema.fields])
        kept = materialize(there, "already-there")
        features = kept.unionByName(features.join(kept.select(*CUSTOMER_KEYS), list(CUSTOMER_KEYS), "left_anti"))
    write_customer_features(features, path, fmt)


def write_location_features(
    features: DataFrame, path: str, date_from: dt.date | str, date_to: dt.date | str, fmt: str = "parquet"
) -> None:
    """One folder per date range (``date_from``, ``date_to`` are added); the range is replaced."""
    ranged = features.withColumn("date_from", F.lit(date_from).cast("date")).withColumn(
        "date_to", F.lit(date_to).cast("date")
    )
    _replace(ranged, path, fmt, ["date_from", "date_to"])


def write_customer_queue(queue: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Store a queue (entity_id, as_of_date), one folder per as-of date; those dates are replaced."""
    _replace(queue.select("entity_id", "as_of_date"), path, fmt, ["as_of_date"])


def write_location_queue(queue: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Store a queue of location ids, replacing what was there."""
    queue.select("entity_id").write.mode("overwrite").format(fmt).save(path)


def run_customer_batch(
    tables: dict[str, DataFrame],
    as_of: dt.date | str,
    out_path: str,
    done: DataFrame | None = None,
    subject_type: str = PRODUCTION_SUBJECT_TYPES["customer"],
    queue: DataFrame | None = None,
    fmt: str = "parquet",
) -> None:
    """Features of the queued customers for all look-back spans, written to ``out_path``.

    ``queue`` holds (entity_id, as_of_date); its rows of ``as_of`` are computed.
    Without it everyone active on ``as_of`` is. With ``done`` (keys already written,
    not a reader of the files that this run replaces) those are not computed, and what the
    table holds of the day stays (``add_customer_features``).

    The legs are written once to the shared folder, with the columns that the features
    read and cut into chunks, so each feature family reads them instead of re-running the history join, and a lost
    executor restarts from those files. They are deleted at the end, failed or
    not.
    """
    transfers = tables["transfers"]
    day = F.lit(as_of).cast("date")
    if queue is None:
        queue = active_customers(transfers, as_of)
    queue = queue.filter(F.col("as_of_date") == day)
    if done is not None:
        queue = queue_remaining(queue, done)
    with scratch(transfers.sparkSession):
        legs = customer_history_legs(transfers, queue, latest=as_of)
        legs = flag_high_risk(legs, tables["geo_risk"]).select(*CUSTOMER_LEGS)
        legs = materialize(legs, "customer-legs", LEGS_PER_FILE)
        features = customer_features(
            legs, tables["geo_risk"], tables["outcomes"], LOOKBACK_SPANS, subject_type, as_of_between=(as_of, as_of)
        )
        if done is None:
            write_customer_features(features, out_path, fmt)
        else:
            add_customer_features(features, out_path, as_of, fmt)


def run_customer_day(
    tables: dict[str, DataFrame],
    as_of: dt.date | str,
    state_path: str,
    out_path: str,
    subject_type: str = PRODUCTION_SUBJECT_TYPES["customer"],
    queue: DataFrame | None = None,
    fmt: str = "parquet",
    limits: carried.Limits | None = None,
) -> None:
    """One day of the daily batch from carried state (``plans.carried``), written to ``out_path``.

    Reads the state stored for two days before ``as_of`` and the legs of the day
    before it; stores the next state beside it, then writes the features. A state that
    is missing is built from the whole history. Run again, it leaves the same.
    """
    spark = tables["transfers"].sparkSession
    limits = limits or carried.Limits()
    as_of = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    last = as_of - dt.timedelta(days=1)
    if queue is None:
        queue = active_customers(tables["transfers"], as_of)
    with scratch(spark):
        before = last - dt.timedelta(days=1)
        if carried.has_state(spark, state_path, before):
            state = carried.read_state(spark, state_path, before)
            state = carried.advance(state, tables["transfers"], tables["geo_risk"], last, limits)
        else:
            state = carried.build_state(tables["transfers"], tables["geo_risk"], last, limits)
        carried.write_state(state, state_path)
        state = carried.read_state(spark, state_path, last)
        features = carried.features_from_state(state, queue, tables["outcomes"], limits, subject_type)
        write_customer_features(features, out_path, fmt)


def run_location_batch(
    tables: dict[str, DataFrame],
    date_from: dt.date | str,
    date_to: dt.date | str,
    out_path: str,
    subject_type: str = PRODUCTION_SUBJECT_TYPES["location"],
    queue: DataFrame | None = None,
) -> None:
    """Features of every location active in the range (or of the queued ones), written to ``out_path``.

    The range's legs are written once to the shared folder, as for customers.
    """
    with scratch(tables["transfers"].sparkSession):
        legs = location_range_legs(tables["transfers"], date_from, date_to, queue)
        legs = flag_high_risk(legs, tables["geo_risk"]).select(*LOCATION_LEGS)
        legs = materialize(legs, "location-legs")
        features = location_features(
            legs, tables["geo_risk"], tables["outcomes"], tables["time_index"], date_from, date_to, subject_type
        )
        write_location_features(features, out_path, date_from, date_to)
