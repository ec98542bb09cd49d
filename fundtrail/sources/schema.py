"""Declared schemas of the input tables and a check at the edge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_L, _S, _D, _DT = T.LongType(), T.StringType(), T.DoubleType(), T.DateType()

# Time columns may be ``timestamp`` or ``timestamp_ntz`` (read as UTC).
TRANSFERS = T.StructType(
    [
        T.StructField("mtcn", _L, False),
        T.StructField("send_customer", _L, True),
        T.StructField("pay_customer", _L, True),
        T.StructField("send_location_id", _L, True),
        T.StructField("pay_location_id", _L, True),
        T.StructField("send_agent", _L, True),
        T.StructField("pay_agent", _L, True),
        T.StructField("send_terminal", _L, True),
        T.StructField("pay_terminal", _L, True),
        T.StructField("send_country", _S, True),
        T.StructField("pay_country", _S, True),
        T.StructField("send_channel", _L, True),
        T.StructField("pay_channel", _L, True),
        T.StructField("send_phone", _L, True),
        T.StructField("pay_phone", _L, True),
        T.StructField("send_id_number", _L, True),
        T.StructField("pay_id_number", _L, True),
        T.StructField("product", _S, True),
        T.StructField("send_amount", _D, True),
        T.StructField("pay_amount", _D, True),
        T.StructField("send_time", T.TimestampNTZType(), True),
        T.StructField("pay_time", T.TimestampNTZType(), True),
        T.StructField("send_date", _DT, True),
        T.StructField("pay_date", _DT, True),
    ]
)

CUSTOMER_QUEUE = T.StructType(
    [T.StructField("entity_id", _L, False), T.StructField("as_of_date", _DT, False)]
)
LOCATION_QUEUE = T.StructType([T.StructField("entity_id", _L, False)])
GEO_RISK = T.StructType([T.StructField("country_code", _S, True), T.StructField("rating", _S, True)])
OUTCOMES = T.StructType(
    [
        T.StructField("subject_type", _S, True),
        T.StructField("subject_id", _L, True),
        T.StructField("case_creation_date", _DT, True),
    ]
    + [
        T.StructField(c, T.IntegerType(), True)
        for c in (
            "fiu_risk_level_1",
            "fiu_risk_level_2",
            "fiu_risk_level_3",
            "fiu_risk_level_4",
            "fiu_risk_level_5",
            "high_risk_gfo",
            "medium_risk_gfo",
            "no_risk_gfo",
        )
    ]
)
TIME_INDEX = T.StructType(
    [T.StructField("t1", _DT, True), T.StructField("t2", _DT, True), T.StructField("time_index", T.IntegerType(), True)]
)

_TIME_TYPES = (T.TimestampType, T.TimestampNTZType)


# Identifiers may be text or integers; they are only compared.
IDENTIFIERS = {
    "mtcn", "entity_id", "subject_id",
    *(f"{side}_{name}" for side in ("send", "pay") for name in ("customer", "location_id", "agent", "terminal", "channel", "phone", "id_number")),
}


def check_columns(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """``df`` with the declared column names; fails early on a missing column or an unusable type.

    Names match without case. Identifiers may be text, integers or decimals
    without a fraction; other integral and fractional widths may differ from the
    declared ones (amounts may be decimals); time columns may be either timestamp
    flavour.
    """
    have: dict[str, T.StructField] = {}
    for f in df.schema.fields:
        if f.name.lower() in have and f.name.lower() in {x.name for x in schema.fields}:
            raise ValueError(f"{name}: two columns named {f.name!r} but for case")
        have[f.name.lower()] = f
    renamed = {}
    for field in schema.fields:
        if field.name not in have:
            raise ValueError(f"{name}: missing column {field.name!r}")
        got, want = have[field.name].dataType, field.dataType
        if field.name in IDENTIFIERS:
            ok = isinstance(got, (T.StringType, T.IntegralType)) or (isinstance(got, T.DecimalType) and got.scale == 0)
        elif isinstance(want, _TIME_TYPES):
            ok = isinstance(got, _TIME_TYPES)
        elif isinstance(want, T.NumericType):
            ok = isinstance(got, T.NumericType)
        else:
            ok = type(got) is type(want)
        if not ok:
            raise TypeError(f"{name}.{field.name}: expected {want.simpleString()}, got {got.simpleString()}")
        if have[field.name].name != field.name:
            renamed[have[field.name].name] = field.name
    return df.withColumnsRenamed(renamed) if renamed else df


def date_time_mismatches(transfers: DataFrame) -> DataFrame:
    """One row: transfers whose send or pay date is not the date of its time.

    The one-pass look-backs assume each leg's date is the calendar date of its
    time (UTC wall clock for ``timestamp_ntz``), so that a look-back span is a
    suffix of the time order. Run this check on new sources; it should be 0.
    """
    def bad(side: str):
        return F.col(f"{side}_time").isNotNull() & (F.col(f"{side}_date") != F.to_date(F.col(f"{side}_time")))

    return transfers.agg(
        F.count_if(bad("send")).alias("send_mismatches"),
        F.count_if(bad("pay")).alias("pay_mismatches"),
    )
