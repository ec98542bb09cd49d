"""Small inline tables for edge-case tests."""

from __future__ import annotations

import datetime as dt

from fundtrail.sources import schema as S

T0 = dt.datetime(2024, 3, 1, 8, 0, 0)
AS_OF = dt.date(2024, 3, 10)

_DEFAULTS = {
    "send_location_id": 1,
    "pay_location_id": 2,
    "send_agent": 10,
    "pay_agent": 20,
    "send_terminal": 1,
    "pay_terminal": 1,
    "send_country": "AA",
    "pay_country": "BB",
    "send_channel": 1,
    "pay_channel": 2,
    "send_phone": 100,
    "pay_phone": 200,
    "send_id_number": 7,
    "pay_id_number": 8,
    "product": "p",
    "send_amount": 50.0,
    "pay_amount": 50.0,
}


def transfer(mtcn: int, sender: int | None, payee: int | None, send_time: dt.datetime, pay_seconds: float | None = 60, **kw):
    """One transfer row; ``pay_seconds=None`` leaves the pay side unpaid."""
    row = dict(_DEFAULTS)
    row.update(mtcn=mtcn, send_customer=sender, pay_customer=payee, send_time=send_time)
    if pay_seconds is None:
        row.update(pay_customer=None, pay_location_id=None, pay_agent=None, pay_terminal=None, pay_time=None)
    else:
        row["pay_time"] = send_time + dt.timedelta(seconds=pay_seconds)
    row.update(kw)
    row["send_date"] = row["send_time"].date()
    row["pay_date"] = row["pay_time"].date() if row.get("pay_time") else None
    return row


def transfers_df(spark, rows):
    names = [f.name for f in S.TRANSFERS.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], S.TRANSFERS)


def geo_df(spark, rows=(("AA", "Higher"), ("BB", "Lower"))):
    return spark.createDataFrame(list(rows), S.GEO_RISK)


def outcomes_df(spark, rows=()):
    return spark.createDataFrame(list(rows), S.OUTCOMES)


def queue_df(spark, ids, as_of=AS_OF):
    return spark.createDataFrame([(i, as_of) for i in ids], S.CUSTOMER_QUEUE)
