"""Country features: risky-country flag and the primary country by amount."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundtrail.functions.columns import span_sql
from fundtrail.operators.distinct import DistinctOut, ValueFamily, distinct_counts
from fundtrail.functions.params import HIGH_RISK_RATING
from fundtrail.operators.broadcast import sized_broadcast

SPANS_FULL = (("", None),)

# name -> role whose legs count (None: both roles stacked)
PRIMARY_FORMS = (("primary_send_country", "send"), ("primary_pay_country", "pay"), ("primary_country", None))


def flag_high_risk(legs: DataFrame, geo_risk: DataFrame, rating: str = HIGH_RISK_RATING) -> DataFrame:
    """Add ``is_hrj``: the other side's country is rated ``rating``.

    The lookup is reduced to its distinct risky codes first, so a code listed
    twice does not double a leg. It is broadcast when its size is checked small
    (a country list); otherwise the join shuffles.
    """
    risky = (
        geo_risk.filter(F.col("rating") == F.lit(rating))
        .select(F.col("country_code").alias("_hrj_code"))
        .distinct()
        .withColumn("is_hrj", F.lit(True))
    )
    risky = sized_broadcast(risky, name="geo risk")
    out = legs.join(risky, legs["other_country"] == risky["_hrj_code"], "left").drop("_hrj_code")
    return out.withColumn("is_hrj", F.coalesce(F.col("is_hrj"), F.lit(False)))


def primary_countries(
    legs: DataFrame,
    keys: Sequence[str],
    spans: Sequence[tuple[str, int | None]] = SPANS_FULL,
    forms=PRIMARY_FORMS,
) -> DataFrame:
    """Per key: the other-side country with the largest summed amount.

    Sends are grouped by the payee's country, pays by the sender's, and the
    stacked form uses both. Ties go to the lowest country code; decimal amounts
    are summed exactly, so equal sums are ties. Two aggregates:
    per (key, country) the latest leg of each role and its sum in every span, then per key the minimum
    of (-sum, country), which is the arg-max with that tie rule.
    """
    keys = list(keys)
    ages = [F.expr(f"min(CASE WHEN role = '{r}' THEN age_days END) AS `n|{r}`") for r in ("send", "pay")]
    sums = [
        F.expr(f"coalesce(sum(CASE WHEN {span_sql('age_days', cut)} AND role = '{r}' THEN amount END), 0) AS `s|{prefix}{r}`")
        for prefix, cut in spans
        for r in ("send", "pay")
    ]
    per_country = (
        legs.filter(F.col("other_country").isNotNull())
        .groupBy(*keys, F.col("other_country").alias("_country"))
        .agg(*ages, *sums)
    )

    def pick(name: str, role: str | None, prefix: str, cut: int | None) -> Column:
        roles = ("send", "pay") if role is None else (role,)
        # a country is in the span if its latest leg is
        some = " OR ".join(f"(`n|{r}` IS NOT NULL AND {span_sql(f'`n|{r}`', cut)})" for r in roles)
        total = " + ".join(f"`s|{prefix}{r}`" for r in roles)
        return F.expr(
            f"min(CASE WHEN {some} THEN struct(-CAST({total} AS DOUBLE) AS neg, _country AS c) END).c AS `{prefix}{name}`"
        )

    picks = [pick(name, role, prefix, cut) for prefix, cut in spans for name, role in forms]
    return per_country.groupBy(*keys).agg(*picks)


def hrj_exposure(flagged_legs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key and role: summed amount and distinct countries of legs whose other
    side is risky (needs ``is_hrj`` from ``flag_high_risk``)."""
    keys = list(keys)
    risky = flagged_legs.filter(F.col("is_hrj"))
    sums = risky.groupBy(*keys).agg(
        *[
            F.sum(F.when(F.col("role") == F.lit(r), F.col("amount"))).alias(f"hrj_{r}_amount")
            for r in ("send", "pay")
        ]
    )
    family = ValueFamily(
        "other_country", tuple(DistinctOut(f"hrj_{r}_country_count", (r,), hrj=True) for r in ("send", "pay"))
    )
    counts = distinct_counts(risky, keys, [family])
    return sums.join(counts, keys, "left")
