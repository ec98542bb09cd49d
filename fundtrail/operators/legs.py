"""The legs normal form.

Each transfer has a send side and a pay side. A *leg* is one side seen from
its own party: ``own_*`` columns come from that side, ``other_*`` from the
opposite one. Features of either role are then plain aggregates over legs,
with ``role`` as a condition, and the two roles share one scan per side and
one shuffle per feature family.

Columns of a leg frame::

    entity_id, [as_of_date, age_days,] role, mtcn, leg_time, leg_us, leg_date,
    amount, payout_seconds, own_customer, other_customer, own_location,
    other_location, own_agent, other_agent, own_terminal, own_phone,
    own_channel, other_channel, own_id_number, other_country, product

``age_days`` (customer legs) is ``as_of_date - leg_date`` in days, at least 1.
A side without a time stays a leg: it counts in every aggregate over legs and
only the ordered features skip it. Amounts keep their own type when it is a
decimal, so that sums are exact.
A send leg keeps its payout time even when the payout falls after the as-of
date: the history cut is on the leg's own date only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundtrail.functions.columns import epoch_micros, payout_seconds
from fundtrail.operators.broadcast import sized_broadcast

ROLES = ("send", "pay")
_OTHER = {"send": "pay", "pay": "send"}

LEG_COLUMNS = (
    "role",
    "mtcn",
    "leg_time",
    "leg_us",
    "leg_date",
    "amount",
    "payout_seconds",
    "own_customer",
    "other_customer",
    "own_location",
    "other_location",
    "own_agent",
    "other_agent",
    "own_terminal",
    "own_phone",
    "own_channel",
    "other_channel",
    "own_id_number",
    "other_country",
    "product",
)


def _money(col: str, dtype: T.DataType):
    return F.col(col) if isinstance(dtype, T.DecimalType) else F.col(col).cast("double")


def transfer_legs(transfers: DataFrame, role: str) -> DataFrame:
    """One leg per transfer for ``role`` (``send`` or ``pay``), all columns of LEG_COLUMNS."""
    own, other = role, _OTHER[role]
    dtypes = {f.name: f.dataType for f in transfers.schema.fields}
    send_us = epoch_micros("send_time", dtypes["send_time"])
    pay_us = epoch_micros("pay_time", dtypes["pay_time"])
    own_us = send_us if role == "send" else pay_us
    return transfers.select(
        F.lit(role).alias("role"),
        F.col("mtcn"),
        F.col(f"{own}_time").alias("leg_time"),
        own_us.alias("leg_us"),
        F.col(f"{own}_date").alias("leg_date"),
        _money(f"{own}_amount", dtypes[f"{own}_amount"]).alias("amount"),
        payout_seconds(send_us, pay_us).alias("payout_seconds"),
        F.col(f"{own}_customer").alias("own_customer"),
        F.col(f"{other}_customer").alias("other_customer"),
        F.col(f"{own}_location_id").alias("own_location"),
        F.col(f"{other}_location_id").alias("other_location"),
        F.col(f"{own}_agent").alias("own_agent"),
        F.col(f"{other}_agent").alias("other_agent"),
        F.col(f"{own}_terminal").alias("own_terminal"),
        F.col(f"{own}_phone").alias("own_phone"),
        F.col(f"{own}_channel").alias("own_channel"),
        F.col(f"{other}_channel").alias("other_channel"),
        F.col(f"{own}_id_number").alias("own_id_number"),
        F.col(f"{other}_country").alias("other_country"),
        F.col("product"),
    )


def customer_history_legs(
    transfers: DataFrame, queue: DataFrame, latest: dt.date | str | None = None
) -> DataFrame:
    """Legs of queued customers dated strictly before their as-of date.

    ``latest`` is the queue's last as-of date, where the caller knows it: legs of
    that day or later are then never read.

    ``queue`` holds (entity_id, as_of_date). It is de-duplicated first, so a
    queue row written twice cannot double the history. The join is an equi-join
    on the customer with the date test as a residual; the queue is broadcast
    when its size allows, else both sides shuffle on the customer.
    """
    q = sized_broadcast(queue.select("entity_id", "as_of_date").distinct(), name="customer queue")
    parts = []
    for role in ROLES:
        rows = transfers.filter(F.col(f"{role}_customer").isNotNull())
        if latest is not None:
            rows = rows.filter(F.col(f"{role}_date") < F.lit(latest).cast("date"))
        legs = transfer_legs(rows, role)
        joined = legs.join(
            q, (legs["own_customer"] == q["entity_id"]) & (legs["leg_date"] < q["as_of_date"]), "inner"
        )
        parts.append(joined)
    legs = parts[0].unionByName(parts[1])
    return legs.withColumn("age_days", F.datediff("as_of_date", "leg_date"))


def customer_range_legs(
    transfers: DataFrame,
    date_from: dt.date | str | None,
    date_to: dt.date | str,
    customers: DataFrame | None = None,
) -> DataFrame:
    """Legs of customers dated in the inclusive range (``date_from`` None: from the first on).

    The date filter and the not-null test reach the scan. ``customers`` (entity_id)
    keeps the legs of these only, by a semi-join on the distinct ids; a leg never comes twice.
    """
    parts = []
    for role in ROLES:
        rows = transfers.filter(
            F.col(f"{role}_customer").isNotNull() & (F.col(f"{role}_date") <= F.lit(date_to).cast("date"))
        )
        if date_from is not None:
            rows = rows.filter(F.col(f"{role}_date") >= F.lit(date_from).cast("date"))
        legs = transfer_legs(rows, role).withColumn("entity_id", F.col("own_customer"))
        if customers is not None:
            q = sized_broadcast(customers.select("entity_id").distinct(), name="customers")
            legs = legs.join(q, "entity_id", "left_semi")
        parts.append(legs)
    return parts[0].unionByName(parts[1])


def location_range_legs(
    transfers: DataFrame,
    date_from: dt.date | str,
    date_to: dt.date | str,
    queue: DataFrame | None = None,
) -> DataFrame:
    """Legs of locations dated in the inclusive range; optionally only queued ones.

    The date filter and the not-null test reach the scan, so a table partitioned
    by date is pruned. The queue is applied as a semi-join on distinct ids.
    """
    lo, hi = F.lit(date_from).cast("date"), F.lit(date_to).cast("date")
    parts = []
    for role in ROLES:
        rows = transfers.filter(
            F.col(f"{role}_location_id").isNotNull() & F.col(f"{role}_date").between(lo, hi)
        )
        legs = transfer_legs(rows, role).withColumn("entity_id", F.col("own_location"))
        if queue is not None:
            q = sized_broadcast(queue.select("entity_id").distinct(), name="location queue")
            legs = legs.join(q, "entity_id", "left_semi")
        parts.append(legs)
    return parts[0].unionByName(parts[1])
