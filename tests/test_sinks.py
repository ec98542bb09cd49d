"""Batch runners: queue, legs written once, sinks that can be written again."""

import datetime as dt

import pytest

from fundtrail.operators.queue import active_customers
from fundtrail.plans import customer as C
from fundtrail.plans import location as L
from fundtrail.plans.sinks import run_customer_batch, run_location_batch
from fundtrail.sources.fixture import fixture_tables
from tests.conftest import SF_SMALL


AS_OF = dt.date(2024, 1, 30)


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_customer_batch_twice_gives_the_same_table(spark, tmp_path):
    tables = fixture_tables(spark, SF_SMALL)
    out = str(tmp_path / "customer_features")
    queue = active_customers(tables["transfers"], AS_OF).union(active_customers(tables["transfers"], "2024-01-29"))
    run_customer_batch(tables, AS_OF, out, queue=queue)
    first = spark.read.parquet(out)
    rows, n = _sorted(first), first.count()
    assert n > 0 and len(first.columns) == 2 + 4 * len(C.FEATURES)
    assert [r[0] for r in first.select("as_of_date").distinct().collect()] == [AS_OF]
    run_customer_batch(tables, AS_OF, out)
    assert _sorted(spark.read.parquet(out)) == rows
    # another day leaves this one alone
    run_customer_batch(tables, "2024-01-29", out)
    assert _sorted(spark.read.parquet(out).where(f"as_of_date = '{AS_OF}'")) == rows
    # with the written table as "done", the rest of the queue is added and nothing else
    run_customer_batch(tables, AS_OF, out, done=spark.read.parquet(out))
    assert _sorted(spark.read.parquet(out).where(f"as_of_date = '{AS_OF}'")) == rows


def test_location_batch_twice_gives_the_same_table(spark, tmp_path):
    tables = fixture_tables(spark, SF_SMALL)
    out = str(tmp_path / "location_features")
    for _ in range(2):
        run_location_batch(tables, dt.date(2024, 1, 1), AS_OF, out)
    run_location_batch(tables, dt.date(2024, 1, 1), dt.date(2024, 1, 15), out)
    df = spark.read.parquet(out)
    whole = df.where("date_to = '2024-01-30'")
    assert whole.count() == whole.select("entity_id").distinct().count() > 0
    assert df.select("date_from", "date_to").distinct().count() == 2
    assert len(df.columns) == 3 + len(L.FEATURES)


def test_production_subject_types_are_the_default(spark, tmp_path):
    tables = dict(fixture_tables(spark, SF_SMALL))
    one = tables["transfers"].where(f"send_date = '{AS_OF}'").select("send_customer").first()[0]
    flags = ", ".join(f"1 AS {c}" for c in C.OUTCOME_FLAGS)
    tables["outcomes"] = spark.sql(
        f"SELECT 'Consumer by Galactic ID' AS subject_type, {one}L AS subject_id, DATE'{AS_OF}' AS case_creation_date, {flags}"
    )
    out = str(tmp_path / "features")
    run_customer_batch(tables, AS_OF, out)
    assert spark.read.parquet(out).where(f"entity_id = {one}").first()["fiu_risk_level_1"] == 1


def test_legs_go_even_when_the_write_fails(spark, tmp_path):
    from fundtrail import session

    tables = fixture_tables(spark, SF_SMALL)
    blocked = tmp_path / "file"
    blocked.write_text("not a folder")
    before = set(session._written)
    with pytest.raises(Exception):
        run_location_batch(tables, AS_OF, AS_OF, str(blocked / "features"))
    assert session._written == before


def test_materialize_and_release(spark):
    from fundtrail.session import checkpoint_dir, materialize, release

    df = materialize(spark.range(100).withColumnRenamed("id", "x"), "probe")
    path = df._fundtrail_path
    assert path.startswith(checkpoint_dir(spark).rstrip("/"))
    assert df.count() == 100
    release(df)
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    assert not hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hp)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from fundtrail import session

    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

    monkeypatch.setattr(session, "checkpoint_dir", lambda s: None)
    with pytest.raises(ValueError):
        session.shared_dir(Session())
