"""Segments merge to what the whole history gives; carried state; many as-of dates."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from fundtrail.functions.params import FIXTURE_SUBJECT_TYPES
from fundtrail.operators.basics import basics_exprs
from fundtrail.operators.broadcast import sized_broadcast
from fundtrail.operators.countries import flag_high_risk
from fundtrail.operators.legs import customer_history_legs, customer_range_legs
from fundtrail.operators.queue import active_customers
from fundtrail.operators.running import days_and_dates, span_features_at
from fundtrail.operators.segments import by_age_class, finish, merge_segments, segments, span_features
from fundtrail.operators.sequences import customer_flip_sql, customer_neighbors, customer_sequence_sql
from fundtrail.plans import carried, sinks
from fundtrail.plans.customer import customer_features
from fundtrail.queries import round_doubles
from fundtrail.session import materialize, release
from fundtrail.sources.fixture import fixture_tables
from tests.conftest import SF_SMALL

KEYS = ["entity_id", "as_of_date"]
SPANS = (("", None), ("9_", 9), ("4_", 4), ("2_", 2))
SUBJECT = FIXTURE_SUBJECT_TYPES["customer"]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def odd_legs(spark):
    """Ties, days with one leg, missing times, missing counterparties and amounts, bursts over midnight."""
    rnd = random.Random(11)
    start, as_of = dt.datetime(2024, 3, 1), dt.date(2024, 3, 15)
    rows = []
    for i in range(700):
        day = rnd.choice([0, 0, 1, 2, 3, 5, 6, 6, 6, 7, 9, 10, 11, 12, 13])
        when = start + dt.timedelta(days=day, seconds=rnd.choice([0, 0, 60, 300, 40_000, 86_000, 86_399, rnd.randrange(86_400)]))
        timed = rnd.random() > 0.1
        us = int((when - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000
        rows.append(
            (
                rnd.choice([1, 1, 1, 2, 3, 4]) if i < 690 else 100 + i, as_of, when.date(), (as_of - when.date()).days,
                rnd.choice(["send", "pay"]), i, when if timed else None, us if timed else None,
                rnd.choice([None, 950.0, 20.0, 20.0, 2600.5]), rnd.choice([None, 30.0, 700.0]), rnd.choice([None, 7, 7, 8]),
                rnd.random() < 0.3,
            )
        )
    schema = (
        "entity_id long, as_of_date date, leg_date date, age_days int, role string, mtcn long, leg_time timestamp_ntz, leg_us long,"
        " amount double, payout_seconds double, other_customer long, is_hrj boolean"
    )
    return materialize(spark.createDataFrame(rows, schema).repartition(3), "odd-legs")


@pytest.fixture(scope="module")
def expected(odd_legs):
    exprs = basics_exprs(SPANS, with_hrj=True) + [F.expr(e) for e in customer_sequence_sql(SPANS) + customer_flip_sql(SPANS)]
    return customer_neighbors(odd_legs).groupBy(*KEYS).agg(*exprs)


def _same(got, want):
    """Equal by name; a span without legs has no row to merge, so its counts may be null instead of 0."""
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns

    def plain(df):
        filled = df.select(*columns).fillna(0)
        return _rows(filled.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in filled.dtypes]))

    assert plain(got) == plain(want)


@pytest.mark.parametrize("chunk_rows", [3, 100_000])
def test_days_merge_to_the_whole(odd_legs, expected, chunk_rows):
    days = segments(odd_legs, [*KEYS, "leg_date"], chunk_rows=chunk_rows)
    _same(span_features(days.withColumn("_age", F.datediff("as_of_date", "leg_date")), KEYS, "_age", SPANS), expected)


def test_age_classes_merge_to_the_whole(odd_legs, expected):
    classes = segments(by_age_class(odd_legs, SPANS), [*KEYS, "_age"])
    assert classes.groupBy(*KEYS).count().agg(F.max("count")).first()[0] <= len(SPANS)
    _same(span_features(classes, KEYS, "_age", SPANS), expected)


def test_merging_is_associative(odd_legs):
    days = materialize(segments(odd_legs, ["entity_id", "leg_date"]), "days")
    whole = segments(odd_legs, ["entity_id"])
    want = _rows(finish(whole, ["entity_id"]))
    assert _rows(finish(merge_segments(days, ["entity_id"], "leg_date"), ["entity_id"])) == want
    assert _rows(merge_segments(days, ["entity_id"], "leg_date")) == _rows(whole)
    for borders in (["2024-03-02"], ["2024-03-03", "2024-03-07", "2024-03-08"]):
        part = F.lit(0)
        for b in borders:
            part = part + (F.col("leg_date") >= F.lit(b).cast("date")).cast("int")
        parts = merge_segments(days.withColumn("part", part), ["entity_id", "part"], "leg_date")
        assert _rows(merge_segments(parts, ["entity_id"], "part")) == _rows(whole)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("spans", [SPANS, (("12_", 12), ("", None), ("3_", 3), ("1_", 1))])
def test_windows_over_the_days_equal_the_spans_of_each_date(spark, odd_legs, spans, seed):
    """Dates with and without legs, before the first and after the last one; counterparties and gaps by chance."""
    legs = odd_legs.withColumn("other_customer", F.when(F.rand(seed) < 0.9, F.floor(F.rand(seed + 9) * 3)).cast("long"))
    legs = materialize(legs.where(F.rand(seed + 5) < 0.3).drop("as_of_date", "age_days"), "fewer-legs")
    days = materialize(segments(legs, ["entity_id", "leg_date"]).withColumnRenamed("leg_date", "day"), "days")
    dates = spark.range(-2, 20).selectExpr("date_add(DATE'2024-03-01', CAST(id AS INT)) AS as_of_date")
    dates = dates.crossJoin(spark.createDataFrame([(1,), (2,), (3,), (999,)], "entity_id long").union(legs.select("entity_id").distinct()))
    dates = dates.distinct().where("entity_id <> 3 OR dayofmonth(as_of_date) % 4 = 0")
    pairs = days.join(dates, "entity_id").where("as_of_date > day").withColumn("_age", F.datediff("as_of_date", "day"))
    want = span_features(pairs, KEYS, "_age", spans)
    got = span_features_at(days_and_dates(days, dates), spans).where("as_of_date IS NOT NULL AND _before > 0")
    _same(got.select(*KEYS, "_features.*"), want)
    assert want.where("one_to_many_send_count > 1 AND many_to_one_pay_count > 1").count() > 20


LIMITS = carried.Limits(spans=(("", None), ("8_", 8), ("3_", 3)), chunk_rows=50)


def _whole(t, as_of):
    """The day's features from the whole history."""
    legs = customer_history_legs(t["transfers"], active_customers(t["transfers"], as_of), latest=as_of)
    legs = materialize(flag_high_risk(legs, t["geo_risk"]), "customer-legs")
    return round_doubles(customer_features(legs, t["geo_risk"], t["outcomes"], LIMITS.spans, SUBJECT))


def test_each_day_needs_the_state_and_its_own_legs_only(spark, tmp_path):
    t = fixture_tables(spark, SF_SMALL)
    path = str(tmp_path / "state")
    day = dt.date(2024, 1, 20)
    carried.write_state(carried.build_state(t["transfers"], t["geo_risk"], day, LIMITS), path)
    for _ in range(3):
        day += dt.timedelta(days=1)
        alone = t["transfers"].where((F.col("send_date") == F.lit(day)) | (F.col("pay_date") == F.lit(day)))
        before = carried.read_state(spark, path, day - dt.timedelta(days=1))
        carried.write_state(carried.advance(before, alone, t["geo_risk"], day, LIMITS), path)
        state = carried.read_state(spark, path, day)
        as_of = day + dt.timedelta(days=1)
        got = carried.features_from_state(state, active_customers(t["transfers"], as_of), t["outcomes"], LIMITS, SUBJECT)
        assert _rows(round_doubles(got)) == _rows(_whole(t, as_of)) != []
        # what a customer has does not grow with its history
        assert state.segments.groupBy("entity_id").count().agg(F.max("count")).first()[0] <= LIMITS.longest
        assert state.values.groupBy("entity_id", *carried.VALUE).count().where("count > 1").isEmpty()
    # days may also be taken together
    later = carried.advance(carried.read_state(spark, path, "2024-01-20"), t["transfers"], t["geo_risk"], day, LIMITS)
    for name, part in later.parts().items():
        stored = carried.read_state(spark, path, day).parts()[name]
        assert _rows(round_doubles(part.select(*stored.columns))) == _rows(round_doubles(stored)), name
    with pytest.raises(ValueError):
        carried.advance(later, t["transfers"], t["geo_risk"], day, LIMITS)


def test_the_day_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "transfers")
    fixture_tables(spark, SF_SMALL)["transfers"].write.parquet(path)
    legs = customer_range_legs(spark.read.parquet(path), "2024-01-21", "2024-01-21")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = legs._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for role in ("send", "pay"):
        assert f"LessThanOrEqual({role}_date,2024-01-21)" in plan and f"GreaterThanOrEqual({role}_date,2024-01-21)" in plan


def test_daily_runner_equals_the_batch_and_can_run_again(spark, tmp_path):
    t = fixture_tables(spark, SF_SMALL)
    state, out, batch = (str(tmp_path / n) for n in ("state", "out", "batch"))
    days = ["2024-01-25", "2024-01-26", "2024-01-27"]
    for as_of in (*days, days[-1]):
        sinks.run_customer_day(t, as_of, state, out, SUBJECT)
    for as_of in days:
        sinks.run_customer_batch(t, as_of, batch, subject_type=SUBJECT)
    read = lambda p: _rows(round_doubles(spark.read.parquet(p)))
    assert read(out) == read(batch) != []


def test_many_dates_equal_one_by_one(spark):
    t = fixture_tables(spark, SF_SMALL)
    days = ["2024-01-05", "2024-01-06", "2024-01-20", "2024-01-30"]
    queue = active_customers(t["transfers"], days[0], days[-1]).where(F.col("as_of_date").isin(days))
    got = carried.customer_features_at(t["transfers"], t["geo_risk"], t["outcomes"], queue, days[-1], LIMITS, SUBJECT)
    want = [r for d in days for r in _rows(_whole(t, d))]
    assert _rows(round_doubles(got)) == sorted(want, key=repr)
    # a leg comes once, however many dates its customer has
    legs = customer_range_legs(t["transfers"], None, "2024-01-29", queue)
    assert legs.count() == legs.select("mtcn", "role").distinct().count()


def test_no_row_per_date_and_day(spark):
    """With a date for each of its days, a customer's day segments and values do not meet its dates one by one."""
    t = fixture_tables(spark, SF_SMALL)
    queue = active_customers(t["transfers"], "2024-01-02", "2024-01-30")
    got = carried.customer_features_at(t["transfers"], t["geo_risk"], t["outcomes"], queue, "2024-01-30", LIMITS, SUBJECT)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # amounts of countries only
    assert len(re.findall(r"Join Inner, .*\(as_of_date#\d+ > (?:day|leg_date)#", plan)) <= 1
    assert "_span#" not in plan


def test_partials_of_many_dates_are_not_broadcast(spark):
    """Partials and dates grow alike: their joins are merge joins, however few the compressed bytes."""
    t = fixture_tables(spark, SF_SMALL)
    queue = active_customers(t["transfers"], "2024-01-05", "2024-01-30")
    got = carried.customer_features_at(t["transfers"], t["geo_risk"], t["outcomes"], queue, "2024-01-30", LIMITS, SUBJECT)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [entity_id" in plan
    assert not [x for x in plan.splitlines() if "BroadcastHashJoin [entity_id" in x and "LeftSemi" not in x]
    assert "SortMergeJoin [entity_id#" in plan and ", as_of_date#" in plan


def test_side_of_few_bytes_and_many_rows_is_not_broadcast(spark):
    """Two million equal rows are a few kB of file; in memory they are not."""
    many = spark.range(2_000_000).selectExpr("CAST(id % 2 AS BIGINT) AS k")
    side = sized_broadcast(many, max_bytes=1 << 20)
    assert "ResolvedHint" not in side._jdf.queryExecution().analyzed().toString()
    release(side)


def test_values_of_a_state_are_shuffled_once(spark):
    """Whole histories become the latest day of each value in one aggregate, not by day first."""
    t = fixture_tables(spark, SF_SMALL)
    state = carried.build_state(t["transfers"], t["geo_risk"], "2024-01-20", LIMITS)
    plan = state.values._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "vl" in x]) == 1


def test_segments_are_shuffled_before_they_meet_their_spans(spark):
    t = fixture_tables(spark, SF_SMALL)
    legs = customer_history_legs(t["transfers"], active_customers(t["transfers"], "2024-01-30"))
    legs = by_age_class(flag_high_risk(legs, t["geo_risk"]), SPANS)
    rows = materialize(segments(legs, [*KEYS, "_age"]), "segments")
    wide = span_features(rows, KEYS, "_age", SPANS)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(shuffles) == 1 and "_span" not in shuffles[0]


def test_files_of_legs_are_bounded(spark):
    out = materialize(spark.range(100).coalesce(1), "legs", 20)
    assert [r["count"] for r in out.groupBy(F.input_file_name()).count().collect()] == [20] * 5
    release(out)
