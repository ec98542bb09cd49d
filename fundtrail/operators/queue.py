"""Work queues: the entities to compute, and what is left after a run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_DateLike = dt.date | str


def _lit_date(value: _DateLike):
    return F.lit(value).cast("date") if isinstance(value, str) else F.lit(value)


def active_customers(transfers: DataFrame, date_from: _DateLike, date_to: _DateLike | None = None) -> DataFrame:
    """(entity_id, as_of_date): customers who sent or were paid on a day in the range.

    With one date this is the customer batch queue: everyone active on the
    as-of date. Null customers are skipped; the union removes duplicates.
    """
    lo, hi = _lit_date(date_from), _lit_date(date_to if date_to is not None else date_from)
    send = transfers.filter(F.col("send_customer").isNotNull() & F.col("send_date").between(lo, hi)).select(
        F.col("send_customer").alias("entity_id"), F.col("send_date").alias("as_of_date")
    )
    pay = transfers.filter(F.col("pay_customer").isNotNull() & F.col("pay_date").between(lo, hi)).select(
        F.col("pay_customer").alias("entity_id"), F.col("pay_date").alias("as_of_date")
    )
    return send.union(pay).distinct()


def active_locations(transfers: DataFrame, date_from: _DateLike, date_to: _DateLike) -> DataFrame:
    """(entity_id): locations that sent or paid a transfer in the inclusive range."""
    lo, hi = _lit_date(date_from), _lit_date(date_to)
    send = transfers.filter(F.col("send_location_id").isNotNull() & F.col("send_date").between(lo, hi)).select(
        F.col("send_location_id").alias("entity_id")
    )
    pay = transfers.filter(F.col("pay_location_id").isNotNull() & F.col("pay_date").between(lo, hi)).select(
        F.col("pay_location_id").alias("entity_id")
    )
    return send.union(pay).distinct()


def queue_remaining(queue: DataFrame, done: DataFrame, keys: tuple[str, ...] = ("entity_id", "as_of_date")) -> DataFrame:
    """Queue rows whose keys are not yet in the finished feature table."""
    return queue.join(done.select(*keys).distinct(), list(keys), "left_anti")
