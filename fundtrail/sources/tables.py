"""Readers for the production tables.

Any Spark data source works (parquet, ORC, Delta if on the classpath, JDBC);
the transfer table is checked against the declared schema at the edge. Column
pruning and filter pushdown are left to Catalyst, so pass whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundtrail.sources import schema as S

_SCHEMAS = {
    "transfers": S.TRANSFERS,
    "customer_queue": S.CUSTOMER_QUEUE,
    "location_queue": S.LOCATION_QUEUE,
    "geo_risk": S.GEO_RISK,
    "outcomes": S.OUTCOMES,
    "time_index": S.TIME_INDEX,
}


def read_table(
    spark: SparkSession,
    name: str,
    path: str | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read one input table and check its columns.

    ``fmt="jdbc"`` with ``options={"url": ..., "dbtable": ...}`` reads from a
    database; set ``partitionColumn``/``numPartitions`` there for parallel reads.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    df = reader.load(path) if path is not None else reader.load()
    return S.check_columns(df, _SCHEMAS[name], name)


def read_tables(spark: SparkSession, base: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Read the tables stored as ``{base}/{name}`` folders."""
    return {name: read_table(spark, name, f"{base}/{name}", fmt) for name in ("transfers", "geo_risk", "outcomes", "time_index")}
