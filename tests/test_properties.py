"""Properties: partitioning and row order do not matter."""

from pyspark.sql import functions as F

from fundtrail.plans.location import location_features
from fundtrail.queries import _location_legs, round_doubles
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_partitioning_and_order_do_not_matter(spark):
    t, legs = _location_legs(spark, SF_SMALL)
    args = (t["geo_risk"], t["outcomes"], t["time_index"], "2024-01-01", "2024-01-30")
    base = _rows(round_doubles(location_features(legs, *args)))
    shuffled = legs.repartition(7).orderBy(F.rand(11))
    assert _rows(round_doubles(location_features(shuffled, *args))) == base
    single = legs.coalesce(1).orderBy(F.col("mtcn").desc())
    assert _rows(round_doubles(location_features(single, *args))) == base
