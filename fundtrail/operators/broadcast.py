"""Broadcast behind a check of bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundtrail.functions.params import BROADCAST_MAX_BYTES
from fundtrail.session import materialize

#: Rows in memory may take so many times the bytes of their compressed columns: runs and repeats pack well.
EXPANSION = 64
#: Bytes of a row in the driver while a broadcast is built, beside its values.
ROW_OVERHEAD = 64


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (no job runs), if known.

    Without column statistics Spark estimates from the sizes of compressed files.
    """
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # e.g. a connect session without the JVM handle
        return None


def sized_broadcast(df: DataFrame, name: str = "side", max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only when its bytes are known to be few.

    First the plan's size estimate (free). When that is not small enough, the side
    is written once to the shared folder, and its rows, counted there, and their width (or the
    bytes of their files, where more) decide. A larger side is returned unmarked and read
    from there, so the join shuffles both sides (and AQE may still switch to a broadcast at run time).
    """
    size = estimated_bytes(df)
    if size is not None and size * EXPANSION <= max_bytes:
        return F.broadcast(df)
    side = materialize(df, name.replace(" ", "-"))
    width = ROW_OVERHEAD + 2 * sum(24 if isinstance(f.dataType, T.StringType) else 8 for f in side.schema.fields)
    rows = side.count()
    size = max(rows * width, 4 * (estimated_bytes(side) or 0))
    return F.broadcast(side) if size <= max_bytes else side
