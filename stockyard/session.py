"""Session helpers: a local session for tests/bench and the shared scratch folder.

Library code never creates a session; it takes the caller's.  The shared
folder for materialised tables is the cluster's ``spark.checkpoint.dir``.
Only when that is unset (tests, a laptop) do we fall back to a private
temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.errors import PySparkAttributeError
from pyspark.sql import SparkSession

# Rows a dimension may have and still be broadcast.  Dimensions are counted
# when they are materialised, so the check costs nothing at join time.
BROADCAST_MAX_ROWS_CONF = "stockyard.broadcast.maxRows"
BROADCAST_MAX_ROWS_DEFAULT = 1_000_000
# And the bytes its columns may have in a join, where they are known.
BROADCAST_MAX_BYTES_CONF = "stockyard.broadcast.maxBytes"
BROADCAST_MAX_BYTES_DEFAULT = 128 << 20


def local_session(
    cores: int | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "stockyard",
    driver_memory: str = "16g",
    event_log_dir: str | None = None,
) -> SparkSession:
    """Local-mode session with the settings we rely on (AQE, UTC, no UI)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if event_log_dir:
        builder = (
            builder.config("spark.eventLog.enabled", "true")
            .config("spark.eventLog.dir", event_log_dir)
            .config("spark.eventLog.compress", "false")
            .config("spark.eventLog.rolling.enabled", "false")
        )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def spark_context(spark: SparkSession):
    """The session's SparkContext, or None where there is none (Spark Connect)."""
    try:
        return spark.sparkContext
    except PySparkAttributeError:  # what a remote session raises
        return None


def session_key(spark: SparkSession) -> str:
    """An id that changes when the application (or remote session) changes."""
    sc = spark_context(spark)
    return sc.applicationId if sc is not None else f"session-{id(spark)}"


@contextmanager
def job_label(spark: SparkSession, text: str):
    """Label the jobs started inside the block (shown in event logs)."""
    sc = spark_context(spark)
    if sc is not None:
        sc.setJobDescription(text)
    try:
        yield
    finally:
        if sc is not None:
            sc.setJobDescription(None)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and materialised tables.

    Read from the session (``spark.checkpoint.dir`` / the context's checkpoint
    dir).  If neither is set on a local master (a test, a laptop) a private
    temporary folder becomes the checkpoint dir; on a cluster every executor
    would write to its own disk, so that is refused.
    """
    sc = spark_context(spark)
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if sc is None:  # remote session: the server's checkpoint folder is used
        return conf or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    if not conf and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not conf:
        conf = tempfile.mkdtemp(prefix="stockyard-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path below this application's own folder in the shared folder."""
    return "/".join([scratch_root(spark), *parts, uuid.uuid4().hex])


def scratch_root(spark: SparkSession) -> str:
    """The folder that holds all tables this application materialises."""
    return "/".join([shared_dir(spark).rstrip("/"), "stockyard", session_key(spark)])


def drop_scratch(spark: SparkSession) -> None:
    """Delete everything this application has materialised (its lazy results with it).

    Call it when the results are saved; nothing is deleted by itself, since
    results that are still lazy read these tables."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_max_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_MAX_ROWS_CONF, str(BROADCAST_MAX_ROWS_DEFAULT)))


def broadcast_max_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_MAX_BYTES_CONF, str(BROADCAST_MAX_BYTES_DEFAULT)))
