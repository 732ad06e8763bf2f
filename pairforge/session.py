"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "pairforge", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}  # by application, for local sessions without the setting


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on a cluster a
    machine-local folder would be unreadable from the other executors, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="pairforge-")
    return _local_dirs[app]


_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{shared_dir(spark)}/pairforge/{label}-{uuid.uuid4().hex}"
    if (inside := _scope.get()) is not None:
        inside.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Drop the intermediate tables written inside the block when it ends.

    For jobs that finish their own output: nothing lazy that reads the tables may leave the block.
    """
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark keeps it; one that is gone already is no error."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage with a table that outlives lost executors, and it gives Catalyst the
    table's real size: a join against the result is broadcast only when that size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and stays a shuffle join otherwise.
    """
    return written_at(df, label)[0]


def written_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As :func:`written`, with the path: for tables that their maker drops, such as those of finished rounds."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with _shuffle_files_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffle_files_dropped(spark: SparkSession):
    """Queries started inside the block drop their shuffle files when they end: nothing reads those of a finished
    intermediate table again, and they would stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by ``keys`` into one partition more than the session's shuffles have.

    For narrow rows that are about to be multiplied: their own size says nothing about the work that
    follows, so the partitions must not be merged by size. With just as many partitions Spark would leave this exchange
    out where ``df`` comes from one by the same keys (a distinct, a grouping), whose partitions are merged.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1, *keys)
