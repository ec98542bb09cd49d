"""Fixed values and default parameters of the feature definitions.

Everything a caller may want to tune is a plain argument of the feature
functions; the defaults live here so that one place states them.
"""

from __future__ import annotations

# --- fixed values: these must equal the original definitions -----------------
# Amount bands, low end included, high end excluded. The top band stops at
# 9999 (not 10000) on purpose.
AMOUNT_BANDS: tuple[tuple[float, float], ...] = (
    (900.0, 1000.0),
    (1800.0, 2000.0),
    (2500.0, 3000.0),
    (7400.0, 7500.0),
    (9900.0, 9999.0),
)
# Rating value that marks a risky country in the geo-risk lookup.
HIGH_RISK_RATING = "Higher"
# Seconds: payout counted as rapid at or under this duration.
RAPID_PAYOUT_SECONDS = 600
# Seconds: neighbouring transfers closer than this form a burst (one-to-many,
# many-to-one) and a send/pay pair at one location counts as a flip.
BURST_GAP_SECONDS = 36000
# Seconds: a customer's send and pay events this close count as a flip.
CUSTOMER_FLIP_SECONDS = 600
# Seconds: gap between terminal events that counts as rapid fire.
RAPID_FIRE_SECONDS = 60
# Look-back spans of the customer batch: (column prefix, cut-off in days). A
# leg is in a span when its date is later than as_of_date - cut-off, which with
# the strict "before as_of_date" history gives 60, 30 and 7 days.
LOOKBACK_SPANS: tuple[tuple[str, int | None], ...] = (
    ("", None),
    ("60_", 61),
    ("30_", 31),
    ("7_", 8),
)
# Outcome flag columns, in this order.
OUTCOME_FLAGS: tuple[str, ...] = (
    "fiu_risk_level_1",
    "fiu_risk_level_2",
    "fiu_risk_level_3",
    "fiu_risk_level_4",
    "fiu_risk_level_5",
    "high_risk_gfo",
    "medium_risk_gfo",
    "no_risk_gfo",
)
# Subject types of the outcomes table in the production data.
PRODUCTION_SUBJECT_TYPES = {"customer": "Consumer by Galactic ID", "location": "AgentLocation"}
# Identifier tag written on every location feature row.
LOCATION_ID_TYPE = "Location_ID"
# --- end of fixed values -------------------------------------------------------

# Subject types used by the derived test tables.
FIXTURE_SUBJECT_TYPES = {"customer": "customer", "location": "location"}

# Most rows of one key that a window sees at once; a key with more is cut into
# chunks (see operators/neighbors.py). It sets the work of a task, not the result.
DEFAULT_CHUNK_ROWS = 100_000

# Most bytes in memory that a broadcast side may take (see operators/broadcast.py).
BROADCAST_MAX_BYTES = 256 * 1024 * 1024
