"""Session helpers: the runtime settings the pull relies on."""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings.  AQE re-plans joins from real shuffle sizes, merges
# small partitions and splits skewed ones.  forceOptimizeSkewedJoin lets it
# split a hot key even when that costs one more shuffle downstream: a hot
# household or e-mail must never land whole in one task.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Coalesce small shuffle partitions to the advisory size rather than
    # keeping the maximum task count (Spark's advice for busy clusters).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to a live session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def sibling_session(spark: SparkSession, conf: dict[str, str]) -> SparkSession:
    """A session beside ``spark`` with the same settings and catalog, but for ``conf``:
    plans of one session can be made under a setting that the others do not get."""
    own = spark.newSession()
    for row in spark.sql("SET").collect():          # the settings made, not all there are
        if spark.conf.isModifiable(row["key"]):
            own.conf.set(row["key"], row["value"])
    for key, value in conf.items():
        own.conf.set(key, value)
    return own


#: While it is on, a query that has ended leaves no shuffle files on the executors' disks.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANUP_LOCK = threading.Lock()
#: For each session that writes now: how many writes, and the setting before the first.
_WRITES: dict[str, tuple[int, str | None]] = {}


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The queries run inside remove their shuffle files when they end.

    Without it they lie on the executors' disks until the driver collects its
    garbage, so those of a pull's stages add up.  For writes whose rows are read
    back from the files: a frame that is run again would make its shuffles anew.
    Writes of one session may overlap; the last to end puts the setting back.
    """
    try:
        session = spark._jsparkSession.sessionUUID()
    except Exception:  # e.g. a Spark Connect session
        session = str(id(spark))
    with _CLEANUP_LOCK:
        writes, before = _WRITES.get(session) or (0, spark.conf.get(CLEANUP_CONF, None))
        _WRITES[session] = writes + 1, before
        spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        with _CLEANUP_LOCK:
            writes, before = _WRITES.pop(session)
            if writes > 1:
                _WRITES[session] = writes - 1, before
            elif before is None:
                spark.conf.unset(CLEANUP_CONF)
            else:
                spark.conf.set(CLEANUP_CONF, before)


def app_id(spark: SparkSession) -> str:
    """The application id (also for sessions without a SparkContext handle)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # e.g. a Spark Connect session
        return spark.conf.get("spark.app.id", None) or spark.conf.get("spark.app.name", "spark")


def _is_local(spark: SparkSession) -> bool:
    try:
        master = spark.sparkContext.master
    except Exception:
        master = spark.conf.get("spark.master", "")
    return master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only a local-mode session (tests) without one gets a fresh
    scratch folder; a cluster session without one is an error, since a
    machine-local folder would scatter stage files over the executors' disks.
    """
    try:
        current = spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext handle: the conf is all there is
        current = None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS or S3)")
    path = conf_dir or tempfile.mkdtemp(prefix="canvass-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    try:
        spark.sparkContext.setCheckpointDir(path)
        return spark.sparkContext.getCheckpointDir()
    except Exception:
        return path


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "canvass",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
