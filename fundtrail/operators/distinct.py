"""Distinct counts for many attributes, roles and look-back spans in two aggregates.

Attributes are grouped in value *families*: one leg column whose distinct
values several outputs count, each over send legs, pay legs, or both (and
optionally only risky-country legs). Each leg emits one row per family.

1. Per (key, family, value): the smallest age in days among the send legs
   and among the pay legs carrying it (and whether the value is risky). A
   value is in a span exactly when its most recent leg of the role is.
2. Per key: for each output and span, the count of values whose age for the
   output's roles lies in the span.

This replaces one ``count(DISTINCT ...)`` per output and span, which Spark
plans as an Expand with a copy of every row per distinct aggregate. Both
aggregates combine on the map side first, so a busy key sends at most one
row per distinct value and map task through the shuffle. Integers
are compared as longs, other types by their text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundtrail.functions.columns import span_sql

ROLES_ANY = ("send", "pay")
#: The column of ``value_changes``.
CHANGES = "_changes"


@dataclass(frozen=True)
class DistinctOut:
    """Output ``name``: distinct values seen on legs of ``roles`` (risky only if ``hrj``)."""

    name: str
    roles: tuple[str, ...]
    hrj: bool = False


@dataclass(frozen=True)
class ValueFamily:
    column: str
    outputs: tuple[DistinctOut, ...]


def select_outputs(families: Sequence[ValueFamily], names: Sequence[str]) -> list[ValueFamily]:
    """The families restricted to the outputs in ``names``."""
    wanted = set(names)
    out = []
    for fam in families:
        keep = tuple(o for o in fam.outputs if o.name in wanted)
        if keep:
            out.append(ValueFamily(fam.column, keep))
    return out


def _age_for(roles: tuple[str, ...]) -> str:
    if set(roles) == set(ROLES_ANY):
        return "least(_age_send, _age_pay)"
    return f"_age_{roles[0]}"


def leg_values(
    legs: DataFrame, families: Sequence[ValueFamily], columns: Sequence[str], with_hrj: bool | None = None
) -> DataFrame:
    """One row per leg and family with a value: ``columns``, role, ``_hrj``, and the value as (f, vl, vs)."""
    dtypes = {f.name: f.dataType for f in legs.schema.fields}
    if with_hrj is None:
        with_hrj = any(o.hrj for fam in families for o in fam.outputs)
    entries = []
    for i, fam in enumerate(families):
        # integers compare as longs, everything else by its exact text
        is_text = not isinstance(dtypes[fam.column], T.IntegralType)
        v = F.col(fam.column).cast("string") if is_text else F.col(fam.column)
        entries.append(
            F.struct(
                F.lit(i).alias("f"),
                (F.lit(None).cast("long") if is_text else v.cast("long")).alias("vl"),
                (v if is_text else F.lit(None).cast("string")).alias("vs"),
            )
        )
    exploded = legs.select(
        *columns,
        "role",
        (F.col("is_hrj") if with_hrj else F.lit(False)).alias("_hrj"),
        F.explode(F.array(*entries)).alias("_e"),
    ).select(*columns, "role", "_hrj", "_e.f", "_e.vl", "_e.vs")
    return exploded.filter(F.col("vl").isNotNull() | F.col("vs").isNotNull())


def count_by_age(
    per_value: DataFrame,
    keys: Sequence[str],
    families: Sequence[ValueFamily],
    spans: Sequence[tuple[str, int | None]] = (("", None),),
) -> DataFrame:
    """Per key: the values of each output and span, from one row per (key, f, value) with the
    age of its latest leg of each role (``_age_send``, ``_age_pay``) and ``_hrj``."""
    counts = []
    for prefix, cut in spans:
        for i, fam in enumerate(families):
            for out in fam.outputs:
                a = _age_for(out.roles)
                cond = f"f = {i} AND {a} IS NOT NULL AND {span_sql(a, cut)}" + (" AND _hrj" if out.hrj else "")
                counts.append(F.expr(f"count_if({cond}) AS `{prefix}{out.name}`"))
    return per_value.groupBy(*keys).agg(*counts)


def entered(prefix: str, name: str) -> str:
    """The column of the values that enter the span of the output the next day."""
    return f"_in_{prefix}{name}"


def left(prefix: str, name: str) -> str:
    """The column of the values that leave the span of the output when it ends on this day."""
    return f"_out_{prefix}{name}"


def value_changes(
    per_day: DataFrame,
    families: Sequence[ValueFamily],
    spans: Sequence[tuple[str, int | None]],
    key: str = "entity_id",
) -> DataFrame:
    """Per (key, day): how many values enter and leave the span of each output with their use on that day (``CHANGES``).

    ``per_day`` has one row per (key, f, vl, vs, day), with ``send`` and ``pay``, whether a leg of the role
    carried the value that day, and ``_hrj``. A value enters a span by a use whose last use before is no longer in the
    span, and leaves it by a use that is not followed by another in time. Rows are counted per family first,
    with a column for each kind of output, and the families of a day put side by side after.
    """
    uses = per_day.repartition(key)
    kinds = sorted({(tuple(sorted(out.roles)), out.hrj) for fam in families for out in fam.outputs})
    roles = sorted({r for r, _ in kinds})
    over = f"OVER (PARTITION BY `{key}`, f, vl, vs ORDER BY day)"
    used = {r: f"({' OR '.join(r)})" for r in roles}
    near = []
    for k, r in enumerate(roles):
        day = f"CASE WHEN {used[r]} THEN day END"
        near += [
            f"datediff(day, lag({day}) IGNORE NULLS {over}) AS _since{k}",
            f"datediff(lead({day}) IGNORE NULLS {over}, day) AS _until{k}",
        ]
    x = uses.selectExpr(key, "f", "day", "send", "pay", "_hrj", *near)
    cuts = sorted({c for _, c in spans if c is not None})
    # a use close to the one before and the one after, of every role, changes no span
    least = cuts[0] if cuts else None
    changed = [f"_since{k} IS NULL" + (f" OR _until{k} IS NULL OR _since{k} >= {least} OR _until{k} >= {least}" if cuts else "") for k in range(len(roles))]
    x = x.where(" OR ".join(changed))
    sums = []
    for k, (r, hrj) in enumerate(kinds):
        i, cond = roles.index(r), used[r] + (" AND _hrj" if hrj else "")
        sums.append(f"count_if({cond} AND _since{i} IS NULL) AS k{k}_in")
        for c in cuts:
            sums.append(f"count_if({cond} AND coalesce(_since{i} >= {c}, TRUE)) AS k{k}_in{c}")
            sums.append(f"count_if({cond} AND coalesce(_until{i} >= {c}, TRUE)) AS k{k}_out{c}")
    names = [s.rsplit(" ", 1)[1] for s in sums]
    per_family = x.groupBy(key, "f", "day").agg(*[F.expr(s) for s in sums])
    # the struct is made before it is collected: what an aggregate collects is not compiled
    entries = per_family.select(key, "day", F.struct("f", F.struct(*names).alias("n")).alias("_e"))
    wide = entries.groupBy(key, "day").agg(F.map_from_entries(F.collect_list("_e")).alias("_by_family"))
    out = []
    for prefix, cut in spans:
        for i, fam in enumerate(families):
            for o in fam.outputs:
                k = kinds.index((tuple(sorted(o.roles)), o.hrj))
                found = F.col("_by_family")[i]
                out.append(found[f"k{k}_in{'' if cut is None else cut}"].alias(entered(prefix, o.name)))
                if cut is not None:
                    out.append(found[f"k{k}_out{cut}"].alias(left(prefix, o.name)))
    return wide.select(key, "day", F.struct(*out).alias(CHANGES))


def distinct_counts(
    legs: DataFrame,
    keys: Sequence[str],
    families: Sequence[ValueFamily],
    spans: Sequence[tuple[str, int | None]] = (("", None),),
    age_col: str = "age_days",
) -> DataFrame:
    """One row per key with at least one value; columns ``{prefix}{output name}``."""
    keys = list(keys)
    with_age = any(cut is not None for _, cut in spans)
    aged = legs.withColumn("_age", F.col(age_col) if with_age else F.lit(0))
    per_value = leg_values(aged, families, [*keys, "_age"]).groupBy(*keys, "f", "vl", "vs").agg(
        F.min(F.when(F.col("role") == F.lit("send"), F.col("_age"))).alias("_age_send"),
        F.min(F.when(F.col("role") == F.lit("pay"), F.col("_age"))).alias("_age_pay"),
        F.max("_hrj").alias("_hrj"),
    )
    return count_by_age(per_value, keys, families, spans)
