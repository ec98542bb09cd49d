"""Leading-digit (Benford) deviation of amounts.

Per entity and role: the share of each leading digit 1-9 among the legs whose
amount has one, compared with the expected share log10(1 + 1/d); the feature
is the sum of absolute differences over the nine digits (a digit that never
occurs contributes its expected share). Amounts under 1, zero, negative or
null have no leading digit and stay out of the base; an entity with no such
amount gets null.

Digit counts are conditional aggregates, so the feature joins the entity's
other aggregates in one ``groupBy``. The digit is a column of the leg
(``with_digit``), taken once and not in each of its counts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundtrail.functions.columns import leading_digit

DIGITS = tuple(range(1, 10))
EXPECTED = {d: math.log10(1.0 + 1.0 / d) for d in DIGITS}


def with_digit(legs: DataFrame, amount: Column | None = None) -> DataFrame:
    """Add ``_digit``, the leading digit of the amount, for ``digit_count_exprs``."""
    return legs.withColumn("_digit", leading_digit(F.col("amount") if amount is None else amount))


def digit_count_exprs(role: str) -> list[Column]:
    is_role = F.col("role") == F.lit(role)
    return [F.count_if(is_role & (F.col("_digit") == F.lit(d))).alias(f"_d{d}_{role}") for d in DIGITS]


def deviation(role: str) -> Column:
    """Deviation from the digit counts made by ``digit_count_exprs``."""
    counts = {d: F.col(f"_d{d}_{role}") for d in DIGITS}
    total = sum(counts.values(), F.lit(0))
    dev = sum(
        (F.abs(counts[d] / total - F.lit(EXPECTED[d])) for d in DIGITS),
        F.lit(0.0),
    )
    return F.when(total > 0, dev)


def benford(legs: DataFrame, keys: Sequence[str] = ("entity_id",)) -> DataFrame:
    """Per key: first_digit_send and first_digit_pay."""
    counts = with_digit(legs).groupBy(*keys).agg(*digit_count_exprs("send"), *digit_count_exprs("pay"))
    return counts.select(*keys, deviation("send").alias("first_digit_send"), deviation("pay").alias("first_digit_pay"))


def digit_shares(legs: DataFrame, keys: Sequence[str] = ("entity_id",)) -> DataFrame:
    """Per key, role and digit: count and share among the legs with a leading digit."""
    rows = legs.select(*keys, "role", leading_digit(F.col("amount")).alias("digit")).filter(F.col("digit").isNotNull())
    counts = rows.groupBy(*keys, "role", "digit").agg(F.count(F.lit(1)).alias("digit_count"))
    totals = rows.groupBy(*keys, "role").agg(F.count(F.lit(1)).alias("_n"))
    return counts.join(totals, [*keys, "role"]).select(
        *keys, "role", "digit", "digit_count", (F.col("digit_count") / F.col("_n")).alias("share")
    )
