"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings that matter at scale: adaptive execution re-plans joins from runtime
# sizes (broadcast only when the measured side is small), coalesces small
# shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def _submitted(key: str) -> bool:
    """Whether a running context, spark-submit or spark-defaults sets ``key``."""
    if SparkContext._active_spark_context is not None:
        return SparkContext._active_spark_context.getConf().contains(key)
    return SparkConf().contains(key)


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "panelkit", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session. On a cluster pass ``master=None`` and let
    spark-submit decide. The defaults above never replace a submitted setting;
    ``shuffle_partitions`` and ``extra`` are the caller's own and always hold
    (size a partition for ~128-256 MB of shuffle data)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    asked = dict(extra or {})
    if shuffle_partitions is not None:
        asked["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in DEFAULT_CONF.items():
        if k not in asked and not _submitted(k):
            builder = builder.config(k, v)
    for k, v in asked.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if _context(spark) is not None:
        spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def _configured_dir(spark: SparkSession) -> str | None:
    sc = _context(spark)
    if sc is not None:
        return sc.getConf().get("spark.checkpoint.dir", None)
    try:
        return spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system; it is read from the
    session. Only when nothing is configured and the master is local (tests) a
    temporary folder is made; elsewhere a missing setting is an error, since
    executors could not read a folder of the driver's machine."""
    sc = _context(spark)
    if sc is None:
        configured = _configured_dir(spark)
        if not configured:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = _configured_dir(spark)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="panelkit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SCOPE: ContextVar[str | None] = ContextVar("panelkit_scratch_scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession):
    """All scratch folders made inside this scope lie in one folder of the
    shared checkpoint folder, which is deleted when the scope ends."""
    parent = scratch_dir(spark, "job")
    token = _SCOPE.set(parent)
    try:
        yield parent
    finally:
        _SCOPE.reset(token)
        delete_path(spark, parent)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage (not under Spark Connect, which
    gives no access to it)."""
    if _context(spark) is not None:
        found = spark._jvm.org.apache.hadoop.fs.Path(path)
        found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def scratch_dir(spark: SparkSession, label: str = "scratch") -> str:
    """A new, unique folder below the shared checkpoint folder."""
    base = _SCOPE.get() or _configured_dir(spark) or ensure_checkpoint_dir(spark)
    if "://" not in base:
        base = os.path.abspath(base)
    return f"{base.rstrip('/')}/panelkit-{label}-{uuid.uuid4().hex[:12]}"
