"""Spark session construction and the shared scratch area.

Jobs never pick a machine-local temporary folder on a cluster: every
intermediate write (lineage cuts, staged partition rewrites, the
checkpointed DataFrames) goes below ``spark.checkpoint.dir``, which a
cluster points at shared storage.  Only when that setting is absent
(local tests, the bench) do we create one.
"""

from __future__ import annotations

import contextlib
import contextvars
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every session of this library relies on.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A task sorts and aggregates some thirty times its shuffled (compressed)
    # bytes: small ones, so that its memory does not follow the input
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Business timestamps are zone-less; keep derived values stable.
    "spark.sql.session.timeZone": "UTC",
    # replace-by-key writes only rewrite the partitions present in the update
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "martwright",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Local/test session.  On a cluster use the provided session and call
    :func:`configure` instead."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf.setdefault("spark.driver.memory", "8g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings this library depends on to an existing
    session (they are all session-scoped, so this is safe on a shared cluster)."""
    for k in (
        "spark.sql.adaptive.enabled",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.session.timeZone",
        "spark.sql.sources.partitionOverwriteMode",
    ):
        spark.conf.set(k, BASE_CONF[k])
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the session; only when it is unset in local mode (tests, the
    local bench) a private folder is created and registered.  On a cluster an
    unset folder is an error: a driver-local path is invisible to executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not re.match(r"local(\[|$)", sc.master or ""):
            # a driver-local folder is invisible to executors on a cluster
            # (local-cluster starts executors of its own, too)
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        configured = tempfile.mkdtemp(prefix="martwright-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique directory path below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/scratch/{label}-{uuid.uuid4().hex[:12]}"
    own = _scope.get()
    if own is not None:
        own.append(path)
    return path


#: Scratch folders of the job that runs in this context (a thread, or the
#: threads that it hands its context to).
_scope: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


#: Whether Spark deletes a statement's shuffle files when it has ended (else when
#: the driver's garbage collector finds them, so a job's shuffles pile up).
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Deletes the scratch folders made inside when it ends, and the shuffle files
    of each statement inside when that ends: for a job whose results are written
    tables, so that nothing reads its scratch or its shuffles later."""
    own: list[str] = []
    token = _scope.set(own)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
        _scope.reset(token)
        jvm = spark.sparkContext._jvm
        for path in own:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for the few local-filesystem helpers (tests)."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


def expire_scratch(spark: SparkSession, older_than_seconds: float) -> list[str]:
    """Delete scratch folders (staged rewrites, lineage cuts) older than the
    given age from the shared checkpoint folder; returns what was removed.
    Jobs never read a scratch folder after they finish, so anything older
    than the longest job is garbage.  Uses the Hadoop FileSystem API, so it
    works on any shared store the cluster names."""
    import time

    sc = spark.sparkContext
    root = checkpoint_root(spark).rstrip("/") + "/scratch"
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    cutoff_ms = (time.time() - older_than_seconds) * 1000
    removed = []
    for st in fs.listStatus(path):
        if st.getModificationTime() < cutoff_ms:
            fs.delete(st.getPath(), True)
            removed.append(st.getPath().toString())
    return removed
