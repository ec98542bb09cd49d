"""Chunked neighbours and running counts give the same answers as plain windows and joins, at any chunk size."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fundtrail.functions.params import FIXTURE_SUBJECT_TYPES
from fundtrail.operators.flips import pair_counts
from fundtrail.operators.neighbors import CHUNK, Stream, deal, stream_neighbors
from fundtrail.operators.sequences import customer_neighbors, location_bursts, location_terminals
from tests.conftest import SF_SMALL

DAY = 86_400 * 1_000_000


def _rows(n=600, seed=7):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = rnd.choice([1, 1, 1, 1, 2, 3])  # key 1 is the busy one
        t = rnd.choice([None, rnd.randrange(0, 5 * 86_400) * 1_000_000, 7, 7, 999_999])
        out.append((key, rnd.choice(["a", "b"]), t, i, rnd.choice([None, 1, 2, 3])))
    return out


def _plain(rows, marked):
    """id -> (previous, next) marked row among the timed rows of the key, by Python."""
    out = {}
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    for group in by_key.values():
        timed = sorted((r for r in group if r[2] is not None), key=lambda r: (r[2], r[3]))
        for k, r in enumerate(timed):
            before = [x for x in timed[:k] if marked(x)]
            after = [x for x in timed[k + 1 :] if marked(x)]
            out[r[3]] = (before[-1] if before else None, after[0] if after else None)
        for r in group:
            out.setdefault(r[3], (None, None))
    return out


def test_cuts_are_the_same_for_every_read(spark):
    """Several ranges and several reads of different columns: neighbours never come from the wrong side."""
    rnd = random.Random(1)
    rows = [(rnd.choice([1, 2, 3]), t, t) for t in rnd.sample(range(10**9), 20_000)]
    df = spark.createDataFrame(rows, "k long, t long, id long").repartition(7)
    x = deal(df.withColumn("wide", F.lit("x" * 50)), ["k"], "t", "id", 3000)
    y = stream_neighbors(x, ["k"], "t", "id", {"a": Stream(prev=("t",), next=("t",))})
    y = stream_neighbors(y.withColumn("even", F.expr("a_prev_t % 2 = 0")), ["k"], "t", "id", {"e": Stream("even", ("t",), ("t",))})
    assert y.where("a_prev_t >= t or a_next_t <= t or e_prev_t >= t or e_next_t <= t").count() == 0
    assert y.where("a_prev_t is null").count() == 3 and y.where("a_next_t is null").count() == 3


@pytest.mark.parametrize("chunk_rows", [1, 7, 50, 100_000])
def test_streams_equal_plain_python(spark, chunk_rows):
    rows = _rows()
    df = spark.createDataFrame(rows, "k long, r string, t long, id long, v long")
    x = deal(df, ["k"], "t", "id", chunk_rows)
    got = stream_neighbors(
        x, ["k"], "t", "id", {"any": Stream(prev=("id",), next=("id", "v")), "m": Stream("r = 'a' AND v = 2", ("id", "t"), ("id",))}
    ).collect()
    assert len(got) == len(rows)
    every = _plain(rows, lambda r: True)
    marked = _plain(rows, lambda r: r[1] == "a" and r[4] == 2)
    pick = lambda r, k: r[k] if r else None
    for g in got:
        p, n = every[g["id"]]
        assert (g["any_prev_id"], g["any_next_id"], g["any_next_v"]) == (pick(p, 3), pick(n, 3), pick(n, 4))
        p, n = marked[g["id"]]
        assert (g["m_prev_id"], g["m_prev_t"], g["m_next_id"]) == (pick(p, 3), pick(p, 2), pick(n, 3))


def test_chunks_are_small_and_in_order(spark):
    """Many rows of one instant, and a burst inside a burst: no window sees more than ``chunk_rows`` rows."""
    rows = [(1, 20 * DAY, i) for i in range(5000)]  # one microsecond
    rows += [(2, d * DAY, 10_000 + d) for d in range(40)]
    rows += [(2, 20 * DAY + i * 300, 20_000 + i) for i in range(3000)]
    rows += [(2, 20 * DAY + 900_000 + i, 30_000 + i) for i in range(2800)]
    df = spark.createDataFrame(rows, "k long, t long, id long")
    x = deal(df, ["k"], "t", "id", chunk_rows=400)
    sizes = x.groupBy("k", CHUNK).count()
    assert sizes.agg(F.max("count")).first()[0] <= 400
    assert x.count() == len(rows)
    ordered = x.groupBy("k", CHUNK).agg(F.min(F.struct("t", "id")).alias("lo"), F.max(F.struct("t", "id")).alias("hi"))
    w = Window.partitionBy("k").orderBy(CHUNK)
    assert ordered.withColumn("before", F.lag("hi").over(w)).where("before >= lo").count() == 0


@pytest.mark.parametrize("chunk_rows", [1, 20, 100_000])
def test_pair_counts_equal_self_join(spark, chunk_rows):
    rnd = random.Random(3)
    legs = [("send", rnd.choice([1, 2, None]), rnd.randrange(0, 3 * 86_400) * 1_000_000) for _ in range(300)]
    legs += [("pay", rnd.choice([1, 2, 3]), rnd.randrange(0, 3 * 86_400) * 1_000_000) for _ in range(300)]
    # exact boundary cases: a pay exactly T after a send, and T + 1 microsecond; a missing time
    legs += [("send", 5, 0), ("send", 5, 10 * DAY), ("send", 5, None), ("pay", 5, None)]
    legs += [("pay", 5, 36_000 * 1_000_000), ("pay", 5, 10 * DAY + 36_000 * 1_000_000 + 1)]
    df = spark.createDataFrame(legs, "role string, c long, leg_us long")
    got = {r["c"]: r["pairs"] for r in pair_counts(df, ["c"], 36_000, chunk_rows).collect()}
    want = {}
    for role, c, t in legs:
        for role2, c2, t2 in legs:
            if role == "send" and role2 == "pay" and c is not None and c == c2 and None not in (t, t2):
                want[c] = want.get(c, 0) + (abs(t - t2) <= 36_000 * 1_000_000)
    assert got[5] == 1
    assert got == {c: want.get(c, 0) for c in got} and set(want) <= set(got)


def test_many_legs_of_one_instant_are_weighed(spark):
    """Equal instants become one row each before anything is ordered."""
    legs = spark.range(40_000).selectExpr("if(id % 2 = 0, 'send', 'pay') AS role", "1L AS c", f"id % 4 * {DAY} AS leg_us")
    df = pair_counts(legs, ["c"], 36_000, chunk_rows=10)
    # sends at days 0 and 2, pays at days 1 and 3: none within ten hours; then all at one instant
    assert df.collect()[0]["pairs"] == 0
    assert pair_counts(legs.withColumn("leg_us", F.lit(5)), ["c"], 36_000, chunk_rows=10).collect()[0]["pairs"] == 20_000**2


def _rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("chunk_rows", [3, 20])
def test_features_do_not_depend_on_the_chunk_size(spark, chunk_rows):
    """The same features with every key cut, legs without a time, customer or terminal included."""
    from fundtrail.plans.customer import customer_features
    from fundtrail.plans.location import location_features
    from fundtrail.queries import _customer_legs, _location_legs, round_doubles

    t, legs = _customer_legs(spark, SF_SMALL)
    assert legs.where("leg_us is null").count() > 0
    legs = legs.drop(CHUNK)
    args = (legs, t["geo_risk"], t["outcomes"], (("", None), ("8_", 8), ("3_", 3)), FIXTURE_SUBJECT_TYPES["customer"])
    plain = customer_features(*args)
    assert _rows_of(round_doubles(plain)) == _rows_of(round_doubles(customer_features(*args, chunk_rows=chunk_rows)))

    t, legs = _location_legs(spark, SF_SMALL)
    legs = legs.withColumn("own_terminal", F.expr("CASE WHEN mtcn % 5 <> 0 THEN own_terminal END")).withColumn(
        "own_customer", F.expr("CASE WHEN mtcn % 7 <> 0 THEN own_customer END")
    )
    args = (legs, t["geo_risk"], t["outcomes"], t["time_index"], "2024-01-01", "2024-01-30")
    plain = location_features(*args)
    assert _rows_of(round_doubles(plain)) == _rows_of(round_doubles(location_features(*args, chunk_rows=chunk_rows)))


def test_burst_counts_are_zero_or_at_least_two(spark):
    from fundtrail.queries import _location_legs

    _, legs = _location_legs(spark, SF_SMALL)
    one = legs.withColumn("entity_id", F.struct("entity_id", "own_customer").cast("string"))
    counts = location_bursts(one)
    assert counts.where("one_to_many_send_count = 1 OR many_to_one_pay_count = 1").count() == 0
    assert counts.where("one_to_many_send_count >= 2").count() > 0
    assert location_terminals(one).where("rapid_fire_count = 1").count() == 0


def test_all_legs_stay_in_the_ordered_frame(spark):
    from fundtrail.queries import _customer_legs

    _, legs = _customer_legs(spark, SF_SMALL)
    y = customer_neighbors(legs.drop(CHUNK), chunk_rows=10)
    assert y.count() == legs.count()
    assert y.where("leg_us is null and (prev_leg_us is not null or run_end)").count() == 0


def test_only_keys_in_chunks_are_summarised(spark):
    """Rows of keys that are not cut have nothing to carry: what is summarised per chunk has met the cells of busy keys
    in an inner join before its windows, also in a second call."""
    rows = [r for r in _rows() if r[2] is not None]
    df = spark.createDataFrame(rows, "k long, r string, t long, id long, v long")

    def found(chunk_rows):
        x = stream_neighbors(deal(df, ["k"], "t", "id", chunk_rows), ["k"], "t", "id", {"a": Stream("r = 'a'", ("t",), ("t",))})
        y = stream_neighbors(x.withColumn("m", F.expr("a_prev_t < t")), ["k"], "t", "id", {"b": Stream("m", ("t",), ("id",))})
        plan = y._jdf.queryExecution().optimizedPlan().toString().splitlines()
        return {r["id"]: (r["a_prev_t"], r["a_next_t"], r["b_prev_t"], r["b_next_id"]) for r in y.collect()}, plan

    whole, plan = found(100_000)
    depth = [re.search(r"\w", line).start() for line in plan]
    summaries = [i for i, line in enumerate(plan) if re.search(r"\bAggregate \[", line)]
    assert len(summaries) >= 2
    for i in summaries:
        below = next((j for j in range(i + 1, len(plan)) if depth[j] <= depth[i]), len(plan))
        joins = [line for line in plan[i + 1 : below] if "Join" in line and "_cell" in line]
        assert joins and all("Join Inner" in line for line in joins)
    cut, _ = found(20)
    assert whole == cut and len(whole) == len(rows)
