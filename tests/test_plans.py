"""Physical plans: no Python UDFs, bounded exchanges, pushdown to the scan."""

import re

import pytest

from pyspark.sql import functions as F

from fundtrail import registry
from fundtrail.operators.broadcast import sized_broadcast
from fundtrail.operators.legs import customer_history_legs
from fundtrail.operators.neighbors import CHUNK, deal
from fundtrail.operators.outcomes import outcomes_as_of
from fundtrail.operators.queue import active_customers
from fundtrail.plans import customer as C
from fundtrail.plans import location as L
from fundtrail.queries import _customer_legs, _location_legs
from fundtrail.session import materialize, release
from fundtrail.sources.fixture import fixture_tables
from tests.conftest import SF_MID, SF_SMALL

QUERIES = registry.spark_queries()

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plan(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert not any(p in plan for p in PY_NODES), name


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().executedPlan().toString()


@pytest.mark.parametrize(
    "kind,exchanges,reads", [("customer", 15, 6), ("location", 22, 3)]
)
def test_exchanges_and_reads_with_every_key_cut(spark, kind, exchanges, reads):
    """The one plan of a batch, with chunks of 20 rows: shuffles that run, and reads of the written legs."""
    t, legs = (_customer_legs if kind == "customer" else _location_legs)(spark, SF_MID)
    if kind == "customer":
        legs = materialize(deal(legs.drop(CHUNK), C.KEYS, "leg_us", "mtcn", 20), "customer-legs")
        df = C.customer_features(legs, t["geo_risk"], t["outcomes"])
    else:
        df = L.location_features(legs, t["geo_risk"], t["outcomes"], t["time_index"], "2024-01-01", "2024-01-30", chunk_rows=20)
    plan = _final_plan(df)
    ran = [x for x in plan.splitlines() if re.search(r"\bExchange (hash|range)partitioning", x)]
    assert 0 < len(ran) <= exchanges, len(ran)
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x and f"{kind}-legs" in x]
    assert 0 < len(scans) <= reads, len(scans)


def test_only_writes_run_while_a_plan_is_built(spark, monkeypatch):
    """No counts or checks: with dealt legs the customer plan is built without a job."""
    t, legs = _customer_legs(spark, SF_SMALL)
    legs = deal(legs, C.KEYS, "leg_us", "mtcn", written=True)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    C.customer_features(legs, t["geo_risk"], t["outcomes"])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(tracker.getJobIdsForGroup("building")) == []


def test_written_legs_run_the_history_join_once(spark):
    t = fixture_tables(spark, SF_SMALL)
    queue = active_customers(t["transfers"], "2024-01-30")
    legs = customer_history_legs(t["transfers"], queue)
    tracker = spark.sparkContext.statusTracker()

    def jobs(group, action):
        spark.sparkContext.setJobGroup(group, group)
        action()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(list(tracker.getJobIdsForGroup(group)))

    plain = jobs("plain", lambda: legs.write.format("noop").mode("overwrite").save())
    written = jobs("written", lambda: release(materialize(legs, "legs")))
    assert written <= plain


def test_dealing_runs_its_input_once(spark, tmp_path):
    """Counts, cells and chunks read what was written, not the plan behind it."""
    source = str(tmp_path / "source")
    spark.range(1000).selectExpr("id % 3 AS k", "id * 1000000 AS t", "id").write.parquet(source)
    dealt = deal(spark.read.parquet(source), ["k"], "t", "id", 50)
    assert source not in _plan(dealt) and "undealt-" in _plan(dealt)
    assert dealt.count() == 1000
    # the cuts are counted, not sampled: every run makes the same
    again = deal(spark.read.parquet(source).repartition(5), ["k"], "t", "id", 50)
    assert {tuple(r) for r in dealt.select("id", CHUNK).collect()} == {tuple(r) for r in again.select("id", CHUNK).collect()}


def test_broadcast_by_bytes(spark):
    def marked(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    wide = spark.range(20_000).select("id", *[F.sha2((F.col("id") + i).cast("string"), 512).alias(f"c{i}") for i in range(8)])
    assert not marked(sized_broadcast(wide, max_bytes=1 << 20))
    # the estimate is too large for the bound, the bytes are not
    few = spark.range(200_000).where("id % 1000 = 0")
    assert marked(sized_broadcast(few, max_bytes=1 << 20))
    assert marked(sized_broadcast(spark.range(10)))


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    t = fixture_tables(spark, SF_SMALL)
    path = str(tmp_path / "transfers")
    t["transfers"].write.parquet(path)
    tr = spark.read.parquet(path)
    legs = customer_history_legs(tr, active_customers(tr, "2024-01-30"), latest="2024-01-30").select("entity_id", "amount")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = _plan(legs)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for role in ("send", "pay"):
        assert re.search(rf"PushedFilters: \[[^\]]*IsNotNull\({role}_customer\)", plan)
        assert re.search(rf"PushedFilters: \[[^\]]*LessThan\({role}_date,2024-01-30\)", plan)
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert scans and all(len(s.split(",")) <= 4 for s in scans), scans


def test_case_dates_reach_the_scan(spark):
    t = fixture_tables(spark, SF_SMALL)
    keys = active_customers(t["transfers"], "2024-01-30")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = _plan(outcomes_as_of(t["outcomes"], keys, "customer", 3, between=("2024-01-30", "2024-01-30")))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(case_creation_date,2024-01-27)" in plan
    assert "LessThanOrEqual(case_creation_date,2024-01-30)" in plan


def test_a_leading_digit_is_taken_once(spark):
    """Not in each of the counts of the digits and roles; and the written legs have the columns that the features read."""
    t, legs = _location_legs(spark, SF_SMALL)
    plan = L.location_aggregates(legs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("substring(") == 1
    narrow = (legs.select(*L.LEGS_READ), t["geo_risk"], t["outcomes"], t["time_index"], "2024-01-01", "2024-01-30")
    assert L.location_features(*narrow).columns == ["entity_id", *L.FEATURES]
    _, legs = _customer_legs(spark, SF_SMALL)
    assert C.customer_features(legs.select(*C.LEGS_READ), t["geo_risk"], t["outcomes"]).columns[:2] == list(C.KEYS)
