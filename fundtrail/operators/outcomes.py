"""Case outcomes: the eight flags summed per subject over a case-date window."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtrail.functions.params import OUTCOME_FLAGS
from fundtrail.operators.broadcast import sized_broadcast


def outcome_sums(
    outcomes: DataFrame, subject_type: str, date_from: dt.date | str, date_to: dt.date | str
) -> DataFrame:
    """(entity_id, flags...): sums over cases of ``subject_type`` created in the inclusive range."""
    lo, hi = F.lit(date_from).cast("date"), F.lit(date_to).cast("date")
    rows = outcomes.filter(
        (F.col("subject_type") == F.lit(subject_type))
        & F.col("subject_id").isNotNull()
        & F.col("case_creation_date").between(lo, hi)
    )
    return rows.groupBy(F.col("subject_id").alias("entity_id")).agg(
        *[F.sum(c).cast("long").alias(c) for c in OUTCOME_FLAGS]
    )


def outcomes_as_of(
    outcomes: DataFrame,
    keys_df: DataFrame,
    subject_type: str,
    days_before: int = 0,
    keys: Sequence[str] = ("entity_id", "as_of_date"),
    between: tuple[dt.date | str, dt.date | str] | None = None,
) -> DataFrame:
    """Per (entity_id, as_of_date) of ``keys_df``: flag sums over cases created
    from ``as_of_date - days_before`` to ``as_of_date``.

    ``between`` holds the first and last as-of date, where the caller knows them:
    cases outside of their windows are then never read.

    With the default 0 the window is the as-of day itself. The batch keys are
    broadcast when their size allows; otherwise the join shuffles on the entity.
    """
    rows = outcomes.filter((F.col("subject_type") == F.lit(subject_type)) & F.col("subject_id").isNotNull())
    if between is not None:
        first, last = (F.lit(d).cast("date") for d in between)
        rows = rows.filter(F.col("case_creation_date").between(F.date_sub(first, days_before), last))
    k = sized_broadcast(keys_df.select(*keys).distinct(), name="batch keys")
    joined = rows.join(
        k,
        (rows["subject_id"] == k["entity_id"])
        & (rows["case_creation_date"] <= k["as_of_date"])
        & (rows["case_creation_date"] >= F.date_sub(k["as_of_date"], days_before)),
    )
    return joined.groupBy(*keys).agg(*[F.sum(c).cast("long").alias(c) for c in OUTCOME_FLAGS])
