"""Edge rows written inline: band ends, gap thresholds, ties, nulls, lookups."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from fundtrail.operators.legs import customer_history_legs, location_range_legs
from fundtrail.plans.customer import customer_features
from fundtrail.plans.location import location_features
from fundtrail.sources.schema import GEO_RISK, TRANSFERS, check_columns
from tests.helpers import AS_OF, T0, geo_df, outcomes_df, queue_df, transfer, transfers_df

H = dt.timedelta(hours=1)
FULL = (("", None),)


def _customers(spark, rows, ids, geo=None):
    tr = transfers_df(spark, rows)
    legs = customer_history_legs(tr, queue_df(spark, ids))
    out = customer_features(legs, geo or geo_df(spark), outcomes_df(spark), spans=FULL)
    return {r["entity_id"]: r.asDict() for r in out.collect()}


@pytest.fixture(scope="module")
def cust(spark):
    rows = [
        # 1: band ends
        *[
            transfer(100 + i, 1, 50 + i, T0 + i * H, send_amount=a)
            for i, a in enumerate([899.99, 900.0, 999.99, 1000.0, 9998.99, 9999.0])
        ],
        # 2: two sends exactly 10 h apart; 3: 10 h and one microsecond apart
        transfer(200, 2, 60, T0),
        transfer(201, 2, 61, T0 + dt.timedelta(seconds=36_000)),
        transfer(300, 3, 60, T0),
        transfer(301, 3, 61, T0 + dt.timedelta(seconds=36_000, microseconds=1)),
        # 4: a single transfer
        transfer(400, 4, 60, T0),
        # 5: unpaid
        transfer(500, 5, None, T0, pay_seconds=None),
        transfer(501, 5, None, T0 + H, pay_seconds=None),
        # 6: payout recorded before the send
        transfer(600, 6, 61, T0, pay_seconds=-100),
        # 7: tied times, order decided by the id: payees A, B, then A
        transfer(702, 7, 71, T0),
        transfer(701, 7, 70, T0),
        transfer(703, 7, 70, T0 + H),
        # 8: equal totals to two countries; the lower code wins
        transfer(800, 8, 60, T0, send_amount=100.0, pay_country="BB"),
        transfer(801, 8, 61, T0 + H, send_amount=100.0, pay_country="AA"),
        # 9: only ever paid
        transfer(900, 60, 9, T0),
    ]
    return _customers(spark, rows, [1, 2, 3, 4, 5, 6, 7, 8, 9])


def test_band_ends(cust):
    r = cust[1]
    assert r["send_banded_count_class1"] == 2
    assert r["send_banded_count_class5"] == 1
    assert sum(r[f"send_banded_count_class{i}"] for i in range(1, 6)) == 3


def test_gap_threshold_inclusive(cust):
    assert cust[2]["one_to_many_send_count"] == 2
    assert cust[3]["one_to_many_send_count"] == 0


def test_single_transfer_has_no_interval(cust):
    r = cust[4]
    assert r["send_txn_count"] == 1
    assert r["min_interval_send_txns"] == 0.0 and r["avg_interval_send_txns"] == 0.0
    assert r["min_send_time"] == T0
    assert r["one_to_many_send_count"] == 0


def test_unpaid_has_no_payout(cust):
    r = cust[5]
    assert r["send_txn_count"] == 2
    assert r["min_send_payout_speed"] == 0.0 and r["send_rapid_pay_out_txns"] == 0
    assert r["pay_customer_count"] == 0 and r["total_customer_count"] == 0


def test_negative_payout_is_rapid(cust):
    r = cust[6]
    assert r["min_send_payout_speed"] == -100.0
    assert r["send_rapid_pay_out_txns"] == 1


def test_ties_broken_by_id(cust):
    # order 701 (A), 702 (B), 703 (A): every row ends a run, all within 10 h
    assert cust[7]["one_to_many_send_count"] == 3


def test_tied_country_totals(cust):
    r = cust[8]
    assert r["primary_send_country"] == "AA"
    assert r["primary_country"] == "AA"


def test_one_sided_customer(cust):
    r = cust[9]
    assert r["send_txn_count"] == 0 and r["pay_txn_count"] == 1
    assert r["primary_send_country"] is None and r["primary_pay_country"] == "AA"
    assert r["min_send_time"] is None


def test_duplicated_geo_code_counts_once(spark):
    rows = [transfer(1, 8, 60, T0, send_amount=100.0, pay_country="AA")]
    geo = geo_df(spark, [("AA", "Higher"), ("AA", "Higher"), ("BB", "Lower")])
    r = _customers(spark, rows, [8], geo)[8]
    assert r["hrj_send_amount"] == 100.0 and r["hrj_send_country_count"] == 1


def test_history_is_strictly_before_as_of(spark):
    rows = [transfer(1, 8, 60, T0), transfer(2, 8, 60, dt.datetime.combine(AS_OF, dt.time(1)))]
    assert _customers(spark, rows, [8])[8]["send_txn_count"] == 1


def _locations(spark, rows):
    tr = transfers_df(spark, rows)
    legs = location_range_legs(tr, "2024-03-01", "2024-03-09")
    ti = spark.createDataFrame([(dt.date(2024, 3, 1), dt.date(2024, 3, 9), 4)], "t1 date, t2 date, time_index int")
    out = location_features(legs, geo_df(spark), outcomes_df(spark), ti, "2024-03-01", "2024-03-09")
    return {r["entity_id"]: r.asDict() for r in out.collect()}


def test_leading_digit_skips_non_digits(spark):
    amounts = [0.0, 0.5, -5.0, None, 123.0]
    rows = [
        transfer(10 + i, 60 + i, 70 + i, T0 + i * H, send_amount=a, send_location_id=41, pay_location_id=42)
        for i, a in enumerate(amounts)
    ]
    r = _locations(spark, rows)[41]
    expected = abs(1 - math.log10(2)) + sum(math.log10(1 + 1 / d) for d in range(2, 10))
    assert r["first_digit_send"] == pytest.approx(expected)
    assert r["send_txn_count"] == 5
    assert r["time_index"] == 4 and r["id_type"] == "Location_ID"


def test_equal_locations_both_kept(spark):
    rows = [
        transfer(1, 60, 70, T0, send_location_id=51, pay_location_id=61),
        transfer(2, 60, 70, T0, send_location_id=52, pay_location_id=61),
    ]
    out = _locations(spark, rows)
    assert {51, 52} <= set(out)
    a, b = dict(out[51]), dict(out[52])
    a.pop("entity_id"), b.pop("entity_id")
    assert a == b


def test_location_flips_pairs_and_customers(spark):
    # customer 60 sends at location 41 and is paid there 2 h later; also 11 h later
    rows = [
        transfer(1, 60, 80, T0, send_location_id=41, pay_location_id=42),
        transfer(2, 81, 60, T0 + 2 * H, send_location_id=43, pay_location_id=41),
        transfer(3, 82, 60, T0 + 11 * H, send_location_id=43, pay_location_id=41),
    ]
    r = _locations(spark, rows)[41]
    assert r["flipped_txns_count"] == 1 and r["flipped_customer_count"] == 1


def test_fixture_dates_agree_with_times(spark):
    from fundtrail.sources.fixture import fixture_tables
    from fundtrail.sources.schema import date_time_mismatches
    from tests.conftest import SF_SMALL

    tr = fixture_tables(spark, SF_SMALL)["transfers"]
    check_columns(tr, TRANSFERS, "transfers")
    r = date_time_mismatches(tr).collect()[0]
    assert r["send_mismatches"] == 0 and r["pay_mismatches"] == 0


def test_check_columns_rejects_missing_and_mistyped(spark):
    with pytest.raises(ValueError):
        check_columns(spark.createDataFrame([("A",)], "country_code string"), GEO_RISK, "geo_risk")
    with pytest.raises(TypeError):
        check_columns(spark.createDataFrame([("A", 1)], "country_code string, rating int"), GEO_RISK, "geo_risk")


def test_legs_without_a_time_count(spark):
    rows = [transfer(k, 8, 60, T0 + k * H) for k in range(6)]
    for k in (2, 4):
        rows[k]["send_time"] = None
    r = _customers(spark, rows, [8])[8]
    assert r["send_txn_count"] == 6 and r["avg_send_amount"] == 50.0 and r["send_agent_count"] == 1
    # the ordered features see the four timed sends
    assert r["max_interval_send_txns"] == 7200.0 and r["send_repeat_amount_txns"] == 3
    assert r["min_send_time"] == T0 and r["one_to_many_send_count"] == 0  # one payee: one run end


def _typed(spark, rows, types):
    df = transfers_df(spark, rows)
    return df.select(*[F.col(f.name).cast(types.get(f.name, f.dataType)).alias(f.name) for f in df.schema.fields])


def test_decimal_sums_tie(spark):
    rows = [
        transfer(1, 8, 60, T0, send_amount=0.10, pay_country="BB"),
        transfer(2, 8, 60, T0 + H, send_amount=0.20, pay_country="BB"),
        transfer(3, 8, 60, T0 + 2 * H, send_amount=0.30, pay_country="AA"),
    ]
    tr = _typed(spark, rows, {"send_amount": "decimal(18,2)", "pay_amount": "decimal(18,2)"})
    legs = customer_history_legs(check_columns(tr, TRANSFERS, "transfers"), queue_df(spark, [8]))
    r = customer_features(legs, geo_df(spark), outcomes_df(spark), spans=FULL).first()
    assert r["primary_send_country"] == "AA" and r["avg_send_amount"] == pytest.approx(0.2)


def test_text_and_wide_identifiers(spark):
    rows = [transfer(k, 8, 60 + k, T0 + k * H, send_phone=1, send_id_number=2) for k in range(3)]
    text = {f"{s}_{n}": "string" for s in ("send", "pay") for n in ("customer", "agent", "channel", "terminal")}
    wide = {f"{s}_{n}": "decimal(20,0)" for s in ("send", "pay") for n in ("phone", "id_number")}
    tr = _typed(spark, rows, text | wide)
    big = F.lit("18446744073709551615").cast("decimal(20,0)")
    tr = tr.withColumn("send_phone", F.when(F.col("mtcn") == 0, big).otherwise(F.col("send_phone"))).withColumnRenamed("mtcn", "MTCN")
    tr = check_columns(tr, TRANSFERS, "transfers")
    assert "mtcn" in tr.columns
    queue = spark.createDataFrame([("8", AS_OF)], "entity_id string, as_of_date date")
    outcomes = outcomes_df(spark).withColumn("subject_id", F.col("subject_id").cast("string"))
    r = customer_features(customer_history_legs(tr, queue), geo_df(spark), outcomes, spans=FULL).first()
    assert r["entity_id"] == "8" and r["send_phone_count"] == 2 and r["pay_customer_count"] == 3 and r["send_id_count"] == 1


def test_leading_digit(spark):
    from fundtrail.functions.columns import leading_digit

    values = [0.0001, 0.00052, 0.5, 0.99, 1.0, 9.99, 1e8, 1.2e7, 3e15, -4.0, None]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double")
    got = [r[0] for r in df.orderBy("k").select(leading_digit(F.col("v"))).collect()]
    assert got == [None, None, None, None, 1, 9, 1, 1, 3, None, None]


def test_columns_that_differ_in_case_only(spark):
    df = spark.createDataFrame([("A", "x", "y")], "country_code string, rating string, RATING2 string")
    assert check_columns(df, GEO_RISK, "geo").columns == ["country_code", "rating", "RATING2"]
