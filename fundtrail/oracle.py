"""Plain SQL for every registered query, run by DuckDB as the correctness oracle.

The SQL follows the definitions directly: per-span filters rerun for each
look-back, window ``lag``/``lead`` over the whole key, the send/pay self-join
for location flips, ``count(DISTINCT ...)``. It shares no formulation with the
Spark code (one pass for all spans, chunked neighbours, running counts).

Doubles are rounded to 6 places on both sides (see ``ROUND_DIGITS``), by the same
arithmetic (the two engines' own ``round`` treat ties apart), so that summation order and
libm differences do not change a hash.
"""

from __future__ import annotations

from fundtrail.functions.params import OUTCOME_FLAGS

# Stated again here, so that the oracle does not take them from the code that it checks.
AMOUNT_BANDS = ((900, 1000), (1800, 2000), (2500, 3000), (7400, 7500), (9900, 9999))

ROUND_DIGITS = 6
AS_OF = "2024-01-30"
PREV_DAY = "2024-01-29"
THREE_DAYS = ("2024-01-28", "2024-01-29", "2024-01-30")
# Every day of the test data that has a day before it.
MANY_DAYS = tuple(f"2024-01-{d:02d}" for d in range(2, 31))
RANGE_FROM, RANGE_TO = "2024-01-01", "2024-01-30"
SPAN_CUTOFFS = (("60_", 61), ("30_", 31), ("7_", 8))
# The test data cover 30 days; these spans differ from each other and from the full history.
SHORT_CUTOFFS = (("15_", 15), ("8_", 8), ("3_", 3))

BASE = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
),
nu AS (SELECT max(user_id) + 1 AS n_users FROM events),
tr AS (
  SELECT e.event_id AS mtcn,
    e.user_id AS send_customer,
    CASE WHEN e.event_type <> 'error' THEN (e.event_id * 13 + e.k) % nu.n_users END AS pay_customer,
    e.k % 20 AS send_location_id,
    CASE WHEN e.event_type <> 'error' THEN (e.k * 3 + e.user_id) % 20 END AS pay_location_id,
    e.k % 5 AS send_agent,
    CASE WHEN e.event_type <> 'error' THEN (e.k * 3 + e.user_id) % 7 END AS pay_agent,
    e.event_id % 4 AS send_terminal,
    CASE WHEN e.event_type <> 'error' THEN e.user_id % 3 END AS pay_terminal,
    sn.n_name AS send_country,
    pn.n_name AS pay_country,
    e.k % 3 AS send_channel,
    e.user_id % 4 AS pay_channel,
    e.event_id % 11 AS send_phone,
    e.event_id % 13 AS pay_phone,
    e.k % 9 AS send_id_number,
    e.k % 6 AS pay_id_number,
    e.event_type AS product,
    coalesce(odd.amount, floor(e.value) * CAST(20.25 AS DOUBLE)) AS send_amount,
    coalesce(odd.amount, greatest(floor(e.value) * CAST(20.25 AS DOUBLE) - 2.5, 0.0)) AS pay_amount,
    CAST(e.ts AS DATE) AS send_date,
    CASE WHEN e.event_type <> 'error'
         THEN CAST(e.ts + to_seconds(CAST(round(e.value * 100) AS BIGINT) % 7200) AS DATE) END AS pay_date,
    CASE WHEN e.event_id % 97 <> 5 THEN e.ts END AS send_time,
    CASE WHEN e.event_type <> 'error' AND e.event_id % 101 <> 7
         THEN e.ts + to_seconds(CAST(round(e.value * 100) AS BIGINT) % 7200) END AS pay_time
  FROM ev e CROSS JOIN nu
  LEFT JOIN nation sn ON sn.n_nationkey = e.user_id % 25
  LEFT JOIN nation pn ON pn.n_nationkey = (e.event_id + e.k) % 25
  LEFT JOIN (VALUES (4, CAST(0.0001220703125 AS DOUBLE)), (229, 0.00048828125), (454, 0.5), (679, 1e8)) odd(r, amount)
    ON odd.r = e.event_id % 900
),
t AS (
  SELECT *, epoch_us(pay_time) - epoch_us(send_time) AS payout_us
  FROM tr
),
geo AS (
  SELECT n_name AS country_code,
         CASE WHEN n_regionkey IN (1, 3) THEN 'Higher' ELSE 'Lower' END AS rating
  FROM nation
),
hr AS (SELECT DISTINCT country_code FROM geo WHERE rating = 'Higher'),
outc AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN 'customer' ELSE 'location' END AS subject_type,
         CASE WHEN event_id % 2 = 0 THEN user_id ELSE k % 20 END AS subject_id,
         CAST(ts AS DATE) AS case_creation_date,
         {", ".join(f"CASE WHEN k % 8 = {i} THEN 1 ELSE 0 END AS {f}" for i, f in enumerate(OUTCOME_FLAGS))}
  FROM ev WHERE event_type = 'signup'
),
tix AS (SELECT min(CAST(ts AS DATE)) AS t1, max(CAST(ts AS DATE)) AS t2, 1 AS time_index FROM events)
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in (BASE,) + ctes if c.strip())


def _big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _dbl(expr: str) -> str:
    return f"floor(CAST({expr} AS DOUBLE) * {10.0**ROUND_DIGITS} + CAST(0.5 AS DOUBLE)) / {10.0**ROUND_DIGITS}"


# ---------------------------------------------------------------- customer legs

# The legs that have a place in time order.
TIMED = (
    "st AS (SELECT * FROM s WHERE send_time IS NOT NULL)",
    "pt AS (SELECT * FROM p WHERE pay_time IS NOT NULL)",
)


def _dates(as_of: str | tuple[str, ...]) -> str:
    return ", ".join(f"DATE '{d}'" for d in ((as_of,) if isinstance(as_of, str) else as_of))


def customer_legs_ctes(cutoff: int | None = None, as_of: str | tuple[str, ...] = AS_OF) -> list[str]:
    """q (queue), s (send legs), p (pay legs), optionally narrowed to a span."""
    span_s = f" AND t.send_date > q.as_of_date - {cutoff}" if cutoff else ""
    span_p = f" AND t.pay_date > q.as_of_date - {cutoff}" if cutoff else ""
    return [
        f"""q AS (
  SELECT send_customer AS entity_id, send_date AS as_of_date FROM t
  WHERE send_customer IS NOT NULL AND send_date IN ({_dates(as_of)})
  UNION
  SELECT pay_customer, pay_date FROM t WHERE pay_customer IS NOT NULL AND pay_date IN ({_dates(as_of)})
)""",
        f"""s AS (SELECT q.entity_id, q.as_of_date, t.* FROM t JOIN q
  ON t.send_customer = q.entity_id AND t.send_date < q.as_of_date{span_s})""",
        f"""p AS (SELECT q.entity_id, q.as_of_date, t.* FROM t JOIN q
  ON t.pay_customer = q.entity_id AND t.pay_date < q.as_of_date{span_p})""",
        *TIMED,
        "ck AS (SELECT entity_id, as_of_date FROM s UNION SELECT entity_id, as_of_date FROM p)",
    ]


def location_legs_ctes(date_from: str = RANGE_FROM, date_to: str = RANGE_TO) -> list[str]:
    rng = f"BETWEEN DATE '{date_from}' AND DATE '{date_to}'"
    return [
        f"""lq AS (
  SELECT send_location_id AS entity_id FROM t WHERE send_location_id IS NOT NULL AND send_date {rng}
  UNION
  SELECT pay_location_id FROM t WHERE pay_location_id IS NOT NULL AND pay_date {rng}
)""",
        f"""s AS (SELECT send_location_id AS entity_id, t.* FROM t
  WHERE send_location_id IN (SELECT entity_id FROM lq) AND send_date {rng})""",
        f"""p AS (SELECT pay_location_id AS entity_id, t.* FROM t
  WHERE pay_location_id IN (SELECT entity_id FROM lq) AND pay_date {rng})""",
        *TIMED,
        "ck AS (SELECT entity_id FROM s UNION SELECT entity_id FROM p)",
    ]


# ---------------------------------------------------------------- role blocks


def _role_basics(role: str, src: str, keys: str, distinct: dict[str, str]) -> str:
    amount = f"{role}_amount"
    bands = ",\n    ".join(
        f"{_big(f'count(*) FILTER (WHERE {amount} >= {lo} AND {amount} < {hi})')} AS {role}_banded_count_class{i}"
        for i, (lo, hi) in enumerate(AMOUNT_BANDS, start=1)
    )
    dist = ",\n    ".join(f"{_big(f'count(DISTINCT {col})')} AS {name}" for name, col in distinct.items())
    return f"""b_{role} AS (
  SELECT {keys},
    {_big('count(*)')} AS {role}_txn_count,
    {dist},
    avg({amount}) AS avg_{role}_amount,
    {bands},
    min(payout_us / 1e6) AS min_{role}_payout_speed,
    max(payout_us / 1e6) AS max_{role}_payout_speed,
    avg(payout_us / 1e6) AS avg_{role}_payout_speed,
    {_big('count(*) FILTER (WHERE payout_us <= 600000000)')} AS {role}_rapid_pay_out_txns
  FROM {src} GROUP BY {keys}
)"""


CUSTOMER_DISTINCT = {
    "send": {
        "send_agent_count": "send_agent",
        "pay_customer_count": "pay_customer",
        "pay_country_count": "pay_country",
        "send_phone_count": "send_phone",
        "pay_channel_count": "pay_channel",
        "send_id_count": "send_id_number",
        "send_product_count": "product",
    },
    "pay": {
        "pay_agent_count": "pay_agent",
        "send_customer_count": "send_customer",
        "send_country_count": "send_country",
        "pay_phone_count": "pay_phone",
        "send_channel_count": "send_channel",
        "pay_id_count": "pay_id_number",
        "pay_product_count": "product",
    },
}
LOCATION_DISTINCT = {
    "send": {
        "pay_agent_count": "pay_agent",
        "pay_country_count": "pay_country",
        "send_customer_count": "send_customer",
        "send_phone_count": "send_phone",
        "pay_channel_count": "pay_channel",
        "send_id_count": "send_id_number",
        "send_product_count": "product",
    },
    "pay": {
        "send_agent_count": "send_agent",
        "send_country_count": "send_country",
        "pay_customer_count": "pay_customer",
        "pay_phone_count": "pay_phone",
        "send_channel_count": "send_channel",
        "pay_id_count": "pay_id_number",
        "pay_product_count": "product",
    },
}


def _degree(keys: str, send_cp: str, pay_cp: str, name: str) -> str:
    return f"""dg AS (
  SELECT {keys}, {_big('count(DISTINCT cp)')} AS {name} FROM (
    SELECT {keys}, {send_cp} AS cp FROM s UNION ALL SELECT {keys}, {pay_cp} FROM p
  ) GROUP BY {keys}
)"""


def _totals(keys: str, first: str, first_name: str) -> str:
    return f"""tt AS (
  SELECT {keys},
    {_big('count(DISTINCT a)')} AS {first_name},
    {_big('count(DISTINCT ph)')} AS total_phone_count,
    {_big('count(DISTINCT ch)')} AS total_channel_count,
    {_big('count(DISTINCT idn)')} AS total_id_count
  FROM (
    SELECT {keys}, send_{first} AS a, send_phone AS ph, send_channel AS ch, send_id_number AS idn FROM s
    UNION ALL
    SELECT {keys}, pay_{first}, pay_phone, pay_channel, pay_id_number FROM p
  ) GROUP BY {keys}
)"""


def _primary(keys: str, name: str, rows: str) -> str:
    return f"""{name} AS (
  SELECT {keys}, country AS {name} FROM (
    SELECT {keys}, country,
      row_number() OVER (PARTITION BY {keys} ORDER BY sum(amount) DESC, country ASC) AS rn
    FROM ({rows}) WHERE country IS NOT NULL GROUP BY {keys}, country
  ) WHERE rn = 1
)"""


def _hrj(keys: str) -> str:
    return f"""hrj AS (
  SELECT k.*, hs.hrj_send_amount, hs.hrj_send_country_count, hp.hrj_pay_amount, hp.hrj_pay_country_count
  FROM ck k
  LEFT JOIN (SELECT {keys}, sum(send_amount) AS hrj_send_amount,
                    {_big('count(DISTINCT pay_country)')} AS hrj_send_country_count
             FROM s WHERE pay_country IN (SELECT country_code FROM hr) GROUP BY {keys}) hs USING ({keys})
  LEFT JOIN (SELECT {keys}, sum(pay_amount) AS hrj_pay_amount,
                    {_big('count(DISTINCT send_country)')} AS hrj_pay_country_count
             FROM p WHERE send_country IN (SELECT country_code FROM hr) GROUP BY {keys}) hp USING ({keys})
)"""


def _burst(name: str, src: str, part: str, time: str, cp: str | None, own: str | None, seconds: int) -> str:
    """Plain form: optional run-end filter, gap flag, count of flags plus count
    of false flags followed by a true one, per partition."""
    w = f"PARTITION BY {part} ORDER BY {time}, mtcn"
    own_filter = f"WHERE {own} IS NOT NULL" if own else ""
    if cp:
        kept = f"""SELECT * FROM (
      SELECT {part}, {time}, mtcn, {cp} AS cp, lead({cp}) OVER ({w}) AS nxt_cp, lead(mtcn) OVER ({w}) AS nxt_id
      FROM {src} {own_filter}
    ) WHERE nxt_id IS NULL OR cp IS NULL OR nxt_cp IS NULL OR nxt_cp <> cp"""
    else:
        kept = f"SELECT {part}, {time}, mtcn FROM {src} {own_filter}"
    return f"""{name} AS (
  SELECT {part},
    {_big('count(*) FILTER (WHERE g)')} + {_big('count(*) FILTER (WHERE NOT g AND g_next)')} AS burst
  FROM (
    SELECT {part}, g, lead(g) OVER ({w}) AS g_next, {time}, mtcn FROM (
      SELECT {part}, {time}, mtcn,
        coalesce(epoch_us({time}) - epoch_us(lag({time}) OVER ({w})) <= {seconds * 1_000_000}, false) AS g
      FROM ({kept})
    )
  ) GROUP BY {part}
)"""


# ---------------------------------------------------------------- customer span


def _customer_span_ctes(keys: str = "entity_id, as_of_date", as_of: str | tuple[str, ...] = AS_OF) -> list[str]:
    """All customer blocks over s/p; ``cs`` holds one row per key of ck."""
    w_s = f"PARTITION BY {keys} ORDER BY send_time, mtcn"
    w_p = f"PARTITION BY {keys} ORDER BY pay_time, mtcn"
    return [
        _role_basics("send", "s", keys, CUSTOMER_DISTINCT["send"]),
        _role_basics("pay", "p", keys, CUSTOMER_DISTINCT["pay"]),
        _degree(keys, "pay_customer", "send_customer", "total_customer_count"),
        _totals(keys, "agent", "total_agent_count"),
        _primary(keys, "primary_send_country", f"SELECT {keys}, pay_country AS country, send_amount AS amount FROM s"),
        _primary(keys, "primary_pay_country", f"SELECT {keys}, send_country AS country, pay_amount AS amount FROM p"),
        _primary(
            keys,
            "primary_country",
            f"SELECT {keys}, pay_country AS country, send_amount AS amount FROM s "
            f"UNION ALL SELECT {keys}, send_country, pay_amount FROM p",
        ),
        _hrj(keys),
        f"""fl AS (
  SELECT {keys}, {_big('count(*) FILTER (WHERE epoch_us(tm) - epoch_us(prev_tm) <= 600000000)')} AS flipped_txns_count
  FROM (
    SELECT {keys}, tm, lag(tm) OVER (PARTITION BY {keys} ORDER BY tm) AS prev_tm FROM (
      SELECT {keys}, send_time AS tm FROM s UNION SELECT {keys}, pay_time FROM p
    ) WHERE tm IS NOT NULL
  ) GROUP BY {keys}
)""",
        f"""rp AS (
  SELECT {keys}, {_big('count(*) FILTER (WHERE prev_amt = send_amount)')} AS send_repeat_amount_txns
  FROM (SELECT {keys}, send_amount, lag(send_amount) OVER ({w_s}) AS prev_amt FROM st) GROUP BY {keys}
)""",
        f"""rq AS (
  SELECT {keys}, {_big('count(*) FILTER (WHERE prev_amt = pay_amount)')} AS pay_repeat_amount_txns
  FROM (SELECT {keys}, pay_amount, lag(pay_amount) OVER ({w_p}) AS prev_amt FROM pt) GROUP BY {keys}
)""",
        _burst("otm", "st", keys, "send_time", "pay_customer", None, 36000),
        _burst("mto", "pt", keys, "pay_time", None, None, 36000),
        f"""iv_s AS (
  SELECT {keys}, min(send_time) AS min_send_time, min(d) / 1e6 AS min_interval_send_txns,
         max(d) / 1e6 AS max_interval_send_txns, avg(d) / 1e6 AS avg_interval_send_txns
  FROM (SELECT {keys}, send_time, epoch_us(send_time) - epoch_us(lag(send_time) OVER ({w_s})) AS d FROM st)
  GROUP BY {keys}
)""",
        f"""iv_p AS (
  SELECT {keys}, min(pay_time) AS min_pay_time, min(d) / 1e6 AS min_interval_pay_txns,
         max(d) / 1e6 AS max_interval_pay_txns, avg(d) / 1e6 AS avg_interval_pay_txns
  FROM (SELECT {keys}, pay_time, epoch_us(pay_time) - epoch_us(lag(pay_time) OVER ({w_p})) AS d FROM pt)
  GROUP BY {keys}
)""",
        f"""oc AS (
  SELECT subject_id AS entity_id, case_creation_date AS as_of_date,
    {", ".join(f"{_big(f'sum({f})')} AS {f}" for f in OUTCOME_FLAGS)}
  FROM outc WHERE subject_type = 'customer' AND case_creation_date IN ({_dates(as_of)})
  GROUP BY subject_id, case_creation_date
)""",
        f"""cs AS (
  SELECT ck.entity_id, ck.as_of_date,
    b_send.* EXCLUDE (entity_id, as_of_date), b_pay.* EXCLUDE (entity_id, as_of_date),
    dg.total_customer_count, tt.* EXCLUDE (entity_id, as_of_date),
    primary_send_country.primary_send_country, primary_pay_country.primary_pay_country,
    primary_country.primary_country,
    hrj.* EXCLUDE (entity_id, as_of_date), fl.flipped_txns_count,
    rp.send_repeat_amount_txns, rq.pay_repeat_amount_txns,
    otm.burst AS one_to_many_send_count, mto.burst AS many_to_one_pay_count,
    iv_s.* EXCLUDE (entity_id, as_of_date), iv_p.* EXCLUDE (entity_id, as_of_date),
    oc.* EXCLUDE (entity_id, as_of_date)
  FROM ck
  LEFT JOIN b_send USING ({keys}) LEFT JOIN b_pay USING ({keys})
  LEFT JOIN dg USING ({keys}) LEFT JOIN tt USING ({keys})
  LEFT JOIN primary_send_country USING ({keys}) LEFT JOIN primary_pay_country USING ({keys})
  LEFT JOIN primary_country USING ({keys}) LEFT JOIN hrj USING ({keys}) LEFT JOIN fl USING ({keys})
  LEFT JOIN rp USING ({keys}) LEFT JOIN rq USING ({keys}) LEFT JOIN otm USING ({keys})
  LEFT JOIN mto USING ({keys}) LEFT JOIN iv_s USING ({keys}) LEFT JOIN iv_p USING ({keys})
  LEFT JOIN oc ON oc.entity_id = ck.entity_id AND oc.as_of_date = ck.as_of_date
)""",
    ]


def customer_span_sql(cutoff: int | None = None, as_of: str | tuple[str, ...] = AS_OF) -> str:
    """One row per customer with legs in the span; raw (unfilled) features."""
    return _with(*customer_legs_ctes(cutoff, as_of), *_customer_span_ctes(as_of=as_of)) + "\nSELECT * FROM cs"


def _filled(alias: str, name: str, out: str, kind: str) -> str:
    col = f'{alias}."{name}"'
    if kind == "keep":
        return f'{col} AS "{out}"'
    if kind == "double":
        return f'{_dbl(f"coalesce({col}, 0.0)")} AS "{out}"'
    return f'{_big(f"coalesce({col}, 0)")} AS "{out}"'


def _customer_kind(name: str) -> str:
    from fundtrail.plans.customer import DOUBLES, NOT_FILLED

    if name in NOT_FILLED:
        return "keep"
    return "double" if name in DOUBLES else "long"


def customer_features_sql(
    all_spans: bool = True, cutoffs=SPAN_CUTOFFS, as_of: str | tuple[str, ...] = AS_OF
) -> str:
    from fundtrail.plans.customer import FEATURES

    spans = [("", None)] + (list(cutoffs) if all_spans else [])
    subs, cols, joins = [], ["f0.entity_id", "f0.as_of_date"], []
    for i, (prefix, cut) in enumerate(spans):
        subs.append(f"f{i}")
        for name in FEATURES:
            cols.append(_filled(f"f{i}", name, f"{prefix}{name}", _customer_kind(name)))
        if i:
            joins.append(f"LEFT JOIN ({customer_span_sql(cut, as_of)}) f{i} USING (entity_id, as_of_date)")
    return (
        f"SELECT {', '.join(cols)}\nFROM ({customer_span_sql(None, as_of)}) f0\n" + "\n".join(joins)
    )


def customer_block_sql(columns: list[str], kinds: dict[str, str] | None = None) -> str:
    """Some full-history customer columns, filled, one row per customer with legs."""
    kinds = kinds or {}
    cols = ["entity_id", "as_of_date"] + [
        _filled("cs", c, c, kinds.get(c, _customer_kind(c))) for c in columns
    ]
    return _with(*customer_legs_ctes(None), *_customer_span_ctes()) + f"\nSELECT {', '.join(cols)} FROM cs"


def lookback_counts_sql(cutoffs=SPAN_CUTOFFS) -> str:
    parts = [("", None)] + list(cutoffs)
    cols = ["f0.entity_id", "f0.as_of_date"]
    joins = []
    for i, (prefix, cut) in enumerate(parts):
        for name in ("send_txn_count", "pay_txn_count"):
            cols.append(_filled(f"f{i}", name, f"{prefix}{name}", "long"))
        if i:
            joins.append(f"LEFT JOIN ({customer_span_sql(cut)}) f{i} USING (entity_id, as_of_date)")
    return f"SELECT {', '.join(cols)}\nFROM ({customer_span_sql(None)}) f0\n" + "\n".join(joins)


# ---------------------------------------------------------------- location


def _location_ctes() -> list[str]:
    keys = "entity_id"
    return [
        _role_basics("send", "s", keys, LOCATION_DISTINCT["send"]),
        _role_basics("pay", "p", keys, LOCATION_DISTINCT["pay"]),
        _degree(keys, "pay_location_id", "send_location_id", "total_agent_count"),
        _totals(keys, "customer", "total_customer_count"),
        _burst("otm_g", "st", "entity_id, send_customer", "send_time", "pay_customer", "send_customer", 36000),
        _burst("mto_g", "pt", "entity_id, pay_customer", "pay_time", "send_customer", "pay_customer", 36000),
        "otm AS (SELECT entity_id, CAST(sum(burst) AS BIGINT) AS one_to_many_send_count FROM otm_g WHERE burst > 0 GROUP BY entity_id)",
        "mto AS (SELECT entity_id, CAST(sum(burst) AS BIGINT) AS many_to_one_pay_count FROM mto_g WHERE burst > 0 GROUP BY entity_id)",
        _benford("send", "s"),
        _benford("pay", "p"),
        """fp AS (
  SELECT s.entity_id, CAST(count(*) AS BIGINT) AS flipped_txns_count,
         CAST(count(DISTINCT s.send_customer) AS BIGINT) AS flipped_customer_count
  FROM s JOIN p ON s.entity_id = p.entity_id AND s.send_customer = p.pay_customer
  WHERE abs(epoch_us(s.send_time) - epoch_us(p.pay_time)) <= 36000000000
  GROUP BY s.entity_id
)""",
        """rf_t AS (
  SELECT entity_id, terminal, tm AS rf_time, 0 AS mtcn FROM (
    SELECT entity_id, send_terminal AS terminal, send_time AS tm FROM s
    UNION SELECT entity_id, pay_terminal, pay_time FROM p
  ) WHERE terminal IS NOT NULL AND tm IS NOT NULL
)""",
        _burst("rf_g", "rf_t", "entity_id, terminal", "rf_time", None, None, 60),
        "rf AS (SELECT entity_id, CAST(sum(burst) AS BIGINT) AS rapid_fire_count FROM rf_g WHERE burst > 0 GROUP BY entity_id)",
        """rp_g AS (
  SELECT entity_id, send_terminal, count(*) FILTER (WHERE nxt = send_amount) AS c FROM (
    SELECT entity_id, send_terminal, send_amount,
      lead(send_amount) OVER (PARTITION BY entity_id, send_terminal ORDER BY send_time, mtcn) AS nxt
    FROM st WHERE send_terminal IS NOT NULL
  ) GROUP BY entity_id, send_terminal
)""",
        "rp AS (SELECT entity_id, CAST(sum(c) AS BIGINT) AS send_repeat_amount_txns FROM rp_g WHERE c >= 1 GROUP BY entity_id)",
        """rq_g AS (
  SELECT entity_id, pay_terminal, count(*) FILTER (WHERE nxt = pay_amount) AS c FROM (
    SELECT entity_id, pay_terminal, pay_amount,
      lead(pay_amount) OVER (PARTITION BY entity_id, pay_terminal ORDER BY pay_time, mtcn) AS nxt
    FROM pt WHERE pay_terminal IS NOT NULL
  ) GROUP BY entity_id, pay_terminal
)""",
        "rq AS (SELECT entity_id, CAST(sum(c) AS BIGINT) AS pay_repeat_amount_txns FROM rq_g WHERE c >= 1 GROUP BY entity_id)",
        _hrj("entity_id"),
        f"""oc AS (
  SELECT subject_id AS entity_id, {", ".join(f"{_big(f'sum({f})')} AS {f}" for f in OUTCOME_FLAGS)}
  FROM outc WHERE subject_type = 'location'
    AND case_creation_date BETWEEN DATE '{RANGE_FROM}' AND DATE '{RANGE_TO}'
  GROUP BY subject_id
)""",
        f"""ti AS (SELECT min(time_index) AS time_index FROM tix
  WHERE t1 = DATE '{RANGE_FROM}' AND t2 = DATE '{RANGE_TO}')""",
        """ls AS (
  SELECT ck.entity_id,
    b_send.* EXCLUDE (entity_id), b_pay.* EXCLUDE (entity_id), dg.total_agent_count,
    tt.* EXCLUDE (entity_id), otm.one_to_many_send_count, mto.many_to_one_pay_count,
    bf_send.first_digit_send, bf_pay.first_digit_pay, fp.flipped_txns_count, fp.flipped_customer_count,
    rf.rapid_fire_count, rp.send_repeat_amount_txns, rq.pay_repeat_amount_txns,
    hrj.* EXCLUDE (entity_id), oc.* EXCLUDE (entity_id), 'Location_ID' AS id_type, ti.time_index
  FROM ck
  LEFT JOIN b_send USING (entity_id) LEFT JOIN b_pay USING (entity_id) LEFT JOIN dg USING (entity_id)
  LEFT JOIN tt USING (entity_id) LEFT JOIN otm USING (entity_id) LEFT JOIN mto USING (entity_id)
  LEFT JOIN bf_send USING (entity_id) LEFT JOIN bf_pay USING (entity_id) LEFT JOIN fp USING (entity_id)
  LEFT JOIN rf USING (entity_id) LEFT JOIN rp USING (entity_id) LEFT JOIN rq USING (entity_id)
  LEFT JOIN hrj USING (entity_id) LEFT JOIN oc USING (entity_id) CROSS JOIN ti
)""",
    ]


def _benford(role: str, src: str) -> str:
    return f"""bf_{role} AS (
  SELECT tot.entity_id,
    sum(abs(coalesce(c.n, 0) / tot.n - log10(1 + CAST(1 AS DOUBLE) / dg.d))) AS first_digit_{role}
  FROM (SELECT entity_id, count(*) AS n FROM (
          SELECT entity_id, substr(CAST({role}_amount AS VARCHAR), 1, 1) AS ch FROM {src} WHERE {role}_amount >= 1)
        WHERE ch IN ('1','2','3','4','5','6','7','8','9') GROUP BY entity_id) tot
  CROSS JOIN (SELECT range AS d FROM range(1, 10)) dg
  LEFT JOIN (SELECT entity_id, CAST(ch AS INTEGER) AS d, count(*) AS n FROM (
          SELECT entity_id, substr(CAST({role}_amount AS VARCHAR), 1, 1) AS ch FROM {src} WHERE {role}_amount >= 1)
        WHERE ch IN ('1','2','3','4','5','6','7','8','9') GROUP BY entity_id, ch) c
    ON c.entity_id = tot.entity_id AND c.d = dg.d
  GROUP BY tot.entity_id
)"""


def _location_kind(name: str) -> str:
    from fundtrail.plans.location import DOUBLES

    if name == "id_type":
        return "keep"
    return "double" if name in DOUBLES else "long"


def location_block_sql(columns: list[str]) -> str:
    cols = ["entity_id"] + [_filled("ls", c, c, _location_kind(c)) for c in columns]
    return _with(*location_legs_ctes(), *_location_ctes()) + f"\nSELECT {', '.join(cols)} FROM ls"


def location_features_sql() -> str:
    from fundtrail.plans.location import FEATURES

    return location_block_sql(list(FEATURES))


# ---------------------------------------------------------------- small queries


def active_customers_sql() -> str:
    return _with(*customer_legs_ctes()) + "\nSELECT entity_id, as_of_date FROM q"


def active_locations_sql() -> str:
    return _with(*location_legs_ctes()) + "\nSELECT entity_id FROM lq"


def queue_remaining_sql() -> str:
    return _with(*customer_legs_ctes()) + f"""
SELECT entity_id, as_of_date FROM q WHERE entity_id NOT IN (
  SELECT send_customer FROM t WHERE send_customer IS NOT NULL AND send_date = DATE '{PREV_DAY}'
  UNION SELECT pay_customer FROM t WHERE pay_customer IS NOT NULL AND pay_date = DATE '{PREV_DAY}')"""


def history_sql(role: str) -> str:
    src, other = ("s", "pay") if role == "send" else ("p", "send")
    return _with(*customer_legs_ctes()) + f"""
SELECT entity_id, as_of_date, mtcn, {role}_time AS leg_time, {role}_date AS leg_date,
  {_dbl(f'{role}_amount')} AS amount, {other}_customer AS other_customer, {other}_country AS other_country,
  {_dbl('payout_us / 1e6')} AS payout_seconds
FROM {src}"""


def location_scan_sql() -> str:
    return _with(*location_legs_ctes()) + """
SELECT entity_id, 'send' AS role, mtcn, send_time AS leg_time, send_amount AS amount, send_customer AS own_customer FROM s
UNION ALL
SELECT entity_id, 'pay', mtcn, pay_time, pay_amount, pay_customer FROM p"""


def legs_sql() -> str:
    return _with() + """
SELECT 'send' AS role, mtcn, send_customer AS own_customer, pay_customer AS other_customer,
  send_location_id AS own_location, pay_location_id AS other_location, send_time AS leg_time,
  send_date AS leg_date, send_amount AS amount, pay_country AS other_country FROM t
UNION ALL
SELECT 'pay', mtcn, pay_customer, send_customer, pay_location_id, send_location_id, pay_time,
  pay_date, pay_amount, send_country FROM t"""


def payout_seconds_sql() -> str:
    return _with() + f"\nSELECT mtcn, {_dbl('payout_us / 1e6')} AS payout_seconds FROM t"


def run_ends_sql() -> str:
    w = "PARTITION BY entity_id, as_of_date ORDER BY send_time, mtcn"
    return _with(*customer_legs_ctes()) + f"""
SELECT entity_id, as_of_date, mtcn FROM (
  SELECT entity_id, as_of_date, mtcn, pay_customer AS cp,
    lead(pay_customer) OVER ({w}) AS nxt_cp, lead(mtcn) OVER ({w}) AS nxt_id FROM st
) WHERE nxt_id IS NULL OR cp IS NULL OR nxt_cp IS NULL OR nxt_cp <> cp"""


def burst_count_sql() -> str:
    return _with(*location_legs_ctes(), *_location_ctes()) + """
SELECT entity_id, terminal AS own_terminal, burst AS rapid_fire_count FROM rf_g WHERE burst > 0"""


def leading_digit_share_sql() -> str:
    return _with(*location_legs_ctes()) + f"""
SELECT entity_id, role, CAST(ch AS INTEGER) AS digit, CAST(count(*) AS BIGINT) AS digit_count,
  {_dbl('count(*) / sum(count(*)) OVER (PARTITION BY entity_id, role)')} AS share
FROM (
  SELECT * FROM (
    SELECT entity_id, 'send' AS role, substr(CAST(send_amount AS VARCHAR), 1, 1) AS ch FROM s WHERE send_amount >= 1
    UNION ALL SELECT entity_id, 'pay', substr(CAST(pay_amount AS VARCHAR), 1, 1) FROM p WHERE pay_amount >= 1
  ) WHERE ch IN ('1','2','3','4','5','6','7','8','9')
)
GROUP BY entity_id, role, ch"""


def time_index_tag_sql() -> str:
    return location_block_sql(["id_type", "time_index"])


def customer_features_text_ids_sql() -> str:
    return f"SELECT * REPLACE (CAST(entity_id AS VARCHAR) AS entity_id) FROM ({customer_features_sql(all_spans=False)})"


def customer_sink_sql() -> str:
    return customer_features_sql(all_spans=True)


def location_sink_sql() -> str:
    return (
        f"SELECT *, DATE '{RANGE_FROM}' AS date_from, DATE '{RANGE_TO}' AS date_to FROM ({location_features_sql()})"
    )
