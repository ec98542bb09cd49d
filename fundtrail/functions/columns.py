"""Column expressions shared by the feature operators (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_micros(col: str, dtype: T.DataType) -> Column:
    """Microseconds since the epoch, independent of the session time zone.

    A ``timestamp_ntz`` is read as UTC wall-clock time; a ``timestamp`` is
    already an instant.
    """
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{col}`)")
    return F.unix_micros(F.col(col))


def payout_seconds(send_us: Column, pay_us: Column) -> Column:
    """Pay time minus send time in seconds; null when either side is missing."""
    return (pay_us - send_us) / F.lit(1_000_000.0)


def leading_digit(amount: Column) -> Column:
    """First digit of an amount of at least 1, else null.

    Amounts under 1, zero, negative and null amounts have no leading digit. The
    digits are those of a decimal, as the text of a double may be in E notation.
    """
    digits = amount.try_cast("decimal(38,2)").cast("string")
    return F.when(amount >= F.lit(1), F.substring(digits, 1, 1).cast("int"))


def span_sql(age: str, cutoff: int | None) -> str:
    """SQL test that a leg of age ``age`` (as_of_date - leg_date, in days) is
    in the span with this cut-off; ``None`` is the full history."""
    return "TRUE" if cutoff is None else f"({age} < {int(cutoff)})"


def dbl(value: float) -> str:
    """A double literal for expression strings."""
    return f"CAST({float(value)!r} AS DOUBLE)"
