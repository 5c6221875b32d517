"""Session settings and the shared working folder.

Scratch output (round-trip tables, lineage cuts) goes under the cluster's
shared checkpoint folder, read from the session (``spark.checkpoint.dir`` or
the SparkContext's checkpoint dir). When neither is set, a private folder is
created and registered for a local master (tests); any other master is an error.
"""

from __future__ import annotations

import contextlib
import tempfile
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "fareline", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder (checkpoint dir); set a private one only if unset."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext; keep a session-level setting
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir is not set; on a cluster scratch data needs a folder that all executors share")
    local = tempfile.mkdtemp(prefix="fareline-ckpt-")  # one machine only (local runs, tests)
    if sc is not None:
        sc.setCheckpointDir(local)
        return (sc.getCheckpointDir() or local).rstrip("/")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared dir for one run of ``name``."""
    return f"{shared_dir(spark)}/fareline/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession, older_than_hours: float = 24.0) -> int:
    """Delete scratch folders that nothing has touched for so long; returns how many went.

    Registered queries leave their files for the frame they return, so they cannot delete them
    themselves; a scheduled call of this releases the storage.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/fareline")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return 0
    limit = (time.time() - older_than_hours * 3600) * 1000
    old = [f.getPath() for f in fs.listStatus(path) if f.getModificationTime() < limit]
    for p in old:
        fs.delete(p, True)
    return len(old)


def together(*steps: Callable[[], object]) -> list:
    """Results of steps that need nothing of each other, their Spark jobs side by side; the first error is raised."""
    carry = inheritable_thread_target(SparkSession.active())  # job descriptions and other local properties
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        return [f.result() for f in [pool.submit(carry(s)) for s in steps]]


@contextlib.contextmanager
def job_description(spark: SparkSession, text: str):
    """Label the Spark jobs started inside the block (shown in event logs and history UIs)."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, nothing to label
        sc = None
    if sc is not None:
        sc.setJobDescription(text)
    try:
        yield
    finally:
        if sc is not None:
            sc.setJobDescription(None)
