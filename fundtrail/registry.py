"""Registry of query names -> Spark callables and -> oracle SQL."""

from __future__ import annotations

from fundtrail import oracle as O
from fundtrail import queries as Q


def spark_queries() -> dict[str, Q.Query]:
    return dict(Q.QUERIES)


def oracle_sql() -> dict[str, str]:
    cb, lb = O.customer_block_sql, O.location_block_sql
    return {
        "active_customers": O.active_customers_sql(),
        "active_locations": O.active_locations_sql(),
        "queue_remaining": O.queue_remaining_sql(),
        "history_send": O.history_sql("send"),
        "history_pay": O.history_sql("pay"),
        "location_scan": O.location_scan_sql(),
        "legs": O.legs_sql(),
        "payout_seconds": O.payout_seconds_sql(),
        "txn_count": cb(["send_txn_count", "pay_txn_count"]),
        "avg_amount": cb(["avg_send_amount", "avg_pay_amount"]),
        "banded_amounts_customer": cb(Q.BANDS),
        "payout_speed_customer": cb(Q.SPEEDS),
        "rapid_payout_customer": cb(["send_rapid_pay_out_txns", "pay_rapid_pay_out_txns"]),
        "distinct_customer_send": cb(Q.CUSTOMER_SEND_DISTINCT),
        "distinct_customer_pay": cb(Q.CUSTOMER_PAY_DISTINCT),
        "counterparties_customer": cb(["total_customer_count"]),
        "totals_customer": cb(["total_agent_count", *Q.TOTALS]),
        "primary_send_country": cb(["primary_send_country"]),
        "primary_pay_country": cb(["primary_pay_country"]),
        "primary_country": cb(["primary_country"]),
        "hrj_customer": cb(Q.HRJ),
        "flipped_customer": cb(["flipped_txns_count"]),
        "repeat_amount_customer": cb(["send_repeat_amount_txns", "pay_repeat_amount_txns"]),
        "one_to_many_customer": cb(["one_to_many_send_count"]),
        "many_to_one_customer": cb(["many_to_one_pay_count"]),
        "interval_stats_customer": cb(Q.INTERVALS),
        "run_ends": O.run_ends_sql(),
        "outcomes_customer": cb(Q.OUTCOMES),
        "lookback_counts": O.lookback_counts_sql(),
        "lookback_counts_short": O.lookback_counts_sql(O.SHORT_CUTOFFS),
        "customer_features_short_spans": O.customer_features_sql(all_spans=True, cutoffs=O.SHORT_CUTOFFS),
        "customer_features_carried": O.customer_features_sql(as_of=O.THREE_DAYS),
        "customer_features_carried_short_spans": O.customer_features_sql(cutoffs=O.SHORT_CUTOFFS, as_of=O.THREE_DAYS),
        "customer_features_many_dates": O.customer_features_sql(cutoffs=O.SHORT_CUTOFFS, as_of=O.MANY_DAYS),
        "customer_features_text_ids": O.customer_features_text_ids_sql(),
        "customer_queue_table": O.active_customers_sql(),
        "location_queue_table": O.active_locations_sql(),
        "customer_sink": O.customer_sink_sql(),
        "customer_sink_done": O.customer_sink_sql(),
        "location_sink": O.location_sink_sql(),
        "customer_features": O.customer_features_sql(all_spans=False),
        "customer_features_all_spans": O.customer_features_sql(all_spans=True),
        "banded_amounts_location": lb(Q.BANDS),
        "payout_speed_location": lb(Q.SPEEDS),
        "rapid_payout_location": lb(["send_rapid_pay_out_txns", "pay_rapid_pay_out_txns"]),
        "distinct_location_send": lb(Q.LOCATION_SEND_DISTINCT),
        "distinct_location_pay": lb(Q.LOCATION_PAY_DISTINCT),
        "counterparties_location": lb(["total_agent_count"]),
        "totals_location": lb(["total_customer_count", *Q.TOTALS]),
        "benford_send": lb(["first_digit_send"]),
        "benford_pay": lb(["first_digit_pay"]),
        "leading_digit_share": O.leading_digit_share_sql(),
        "one_to_many_location": lb(["one_to_many_send_count"]),
        "many_to_one_location": lb(["many_to_one_pay_count"]),
        "flipped_location": lb(["flipped_txns_count", "flipped_customer_count"]),
        "rapid_fire_location": lb(["rapid_fire_count"]),
        "burst_count": O.burst_count_sql(),
        "repeat_amount_location": lb(["send_repeat_amount_txns", "pay_repeat_amount_txns"]),
        "hrj_location": lb(Q.HRJ),
        "outcomes_location": lb(Q.OUTCOMES),
        "time_index_tag": O.time_index_tag_sql(),
        "location_features": O.location_features_sql(),
    }
