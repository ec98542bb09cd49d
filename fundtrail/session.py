"""Spark session settings and the shared folder for materialized results."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Folders written by materialize() and not yet released.
_written: set[str] = set()


def build_session(master: str | None = None, app: str = "fundtrail", conf: dict[str, str] | None = None) -> SparkSession:
    """Session with AQE on and UTC as the session time zone.

    On a cluster pass ``master=None`` and let the launcher decide; size
    ``spark.sql.shuffle.partitions`` to the data there (about 128-256 MB of
    shuffle output per partition) and let AQE coalesce.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir``, if any."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext (e.g. a Spark Connect session)
        return None


def app_key(spark: SparkSession) -> str:
    """An id of the running application, for per-application caches."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return f"session-{id(spark)}"


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the cluster's checkpoint folder; set ``fallback`` only when unset (tests)."""
    current = checkpoint_dir(spark)
    if current:
        return current
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables.

    ``spark.checkpoint.dir`` on every cluster. Only a plain local master (one
    process, so every folder is shared) gets a temporary folder when the
    setting is missing; a cluster without it is refused.
    """
    current = checkpoint_dir(spark)
    if current:
        return current
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="fundtrail-checkpoint-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, deleted at the end of the application."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.add(path)
    return path


#: Rows of a file of legs. Spark packs files into read tasks by bytes, 4 MB for each beside its
#: own, so at most 32 of them: legs that pack well do not make a task of millions.
LEGS_PER_FILE = 20_000


def materialize(df: DataFrame, name: str, file_rows: int = 0) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and read it back.

    Cuts the lineage so later stages (and retries after a lost executor) start
    from the written files instead of recomputing the inputs. The plan runs
    once; a failed write fails. The folder is deleted by ``release`` or at the
    end of the application. ``file_rows`` bounds the rows of a file (0: no bound).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._fundtrail_path = path  # for release()
    out._fundtrail_written = True
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, asked of its own (Hadoop) file system."""
    context = spark.sparkContext
    hpath = context._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(context._jsc.hadoopConfiguration()).exists(hpath)


def is_written(df: DataFrame) -> bool:
    """Whether the frame only reads files of ``materialize``, so that running it again is cheap."""
    return getattr(df, "_fundtrail_written", False)


def as_written(df: DataFrame, source: DataFrame) -> DataFrame:
    """Mark ``df``, a projection or filter of ``source``, as written if ``source`` is."""
    df._fundtrail_written = is_written(source)
    return df


def _delete(context: SparkContext, path: str) -> None:
    hpath = context._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(context._jsc.hadoopConfiguration()).delete(hpath, True)


def release(df: DataFrame) -> None:
    """Delete the files behind a frame returned by ``materialize`` (no-op otherwise).

    Call it only after every job that reads the frame has finished. Uses the
    Hadoop file system of the path, so it works on shared storage too.
    """
    path = getattr(df, "_fundtrail_path", None)
    if path:
        _delete(df.sparkSession.sparkContext, path)
        _written.discard(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete at the end, failed or not, what was written to the shared folder inside the block.

    The block gets a function that excepts a frame of ``materialize`` and returns it.
    """
    before, kept = set(_written), set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._fundtrail_path)
        return df

    try:
        yield keep
    finally:
        for path in sorted(_written - before - kept):
            _delete(spark.sparkContext, path)
            _written.discard(path)


@atexit.register
def _release_all() -> None:
    context = SparkContext._active_spark_context
    if context is None:
        return
    for path in sorted(_written):
        try:
            _delete(context, path)
        except Exception:  # the JVM is already gone; nothing left to ask
            return
