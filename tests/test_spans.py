"""Look-back spans: the one-pass form against the per-span SQL and four runs.

The driver's data covers 30 days, so the 60- and 30-day spans equal the full
history; these tests use cut-offs 3, 8 and 15 days, which do differ.
"""

import pytest
from pyspark.sql import functions as F

from fundtrail import oracle as O
from fundtrail.plans.customer import FEATURES, customer_features
from fundtrail.queries import _customer_legs, round_doubles
from tests.conftest import SF_MID
from tests.oracle_check import digest, duck

SPANS = (("", None), ("15_", 15), ("8_", 8), ("3_", 3))


@pytest.fixture(scope="module")
def inputs(spark):
    return _customer_legs(spark, SF_MID)


@pytest.fixture(scope="module")
def all_spans(spark, inputs):
    t, legs = inputs
    return round_doubles(customer_features(legs, t["geo_risk"], t["outcomes"], SPANS, "customer"))


def test_all_spans_match_per_span_sql(all_spans):
    con = duck(SF_MID)
    res = con.execute(O.customer_features_sql(True, cutoffs=tuple((p, c) for p, c in SPANS if c)))
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    s_rows = [tuple(r) for r in all_spans.collect()]
    assert sorted(all_spans.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(all_spans.columns, s_rows) == digest(d_cols, d_rows)


def test_all_spans_equal_separate_runs(inputs, all_spans):
    t, legs = inputs
    keys = ["entity_id", "as_of_date"]
    base = all_spans.select(*keys)
    for prefix, cut in SPANS[1:]:
        narrowed = legs.filter(F.col("age_days") < cut)
        run = round_doubles(customer_features(narrowed, t["geo_risk"], t["outcomes"], (("", None),), "customer"))
        run = base.join(run, keys, "left")
        one = all_spans.select(*keys, *[F.col(f"`{prefix}{f}`").alias(f) for f in FEATURES])
        a = {tuple(r) for r in one.collect()}
        # entities without legs in the span: zero numbers, null text and times
        empty = [
            None if f.startswith("primary") or f.endswith("_time")
            else 0.0 if one.schema[f].dataType.simpleString() == "double" else 0
            for f in FEATURES
        ]
        b = {
            (r["entity_id"], r["as_of_date"], *empty) if r["send_txn_count"] is None else tuple(r)
            for r in run.collect()
        }
        assert a == b, prefix


def test_spans_are_nested(all_spans):
    cols = ["send_txn_count", "pay_txn_count", "total_customer_count", "send_banded_count_class1", "pay_agent_count"]
    for r in all_spans.collect():
        for c in cols:
            assert r[c] >= r[f"15_{c}"] >= r[f"8_{c}"] >= r[f"3_{c}"], (c, r["entity_id"])
    assert any(r["send_txn_count"] > r["8_send_txn_count"] for r in all_spans.collect())
