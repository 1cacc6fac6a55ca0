"""Session settings every job relies on.

The driver owns the ``SparkSession``; jobs only set the SQL options their
semantics depend on (UTC wall clock, adaptive execution) and read the shared
checkpoint folder from the session.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

_SQL_CONF = {
    # Timestamps without a zone are UTC (reference: naive = UTC).
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed join partitions,
    # turn sort-merge joins into broadcast joins when a side proves small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL options the library's semantics need; returns ``spark``."""
    for key, value in _SQL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the SparkContext's
    directory). Only a local-mode session without either setting (tests) gets a
    private folder; a cluster session must name a shared one.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a JVM handle: configuration only
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="tallyline-ckpt-")  # a local session only
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def temp_path(spark: SparkSession, name: str) -> str:
    """A ``scratch_path`` that the running ``scratch_scope``, if any, deletes."""
    path = scratch_path(spark, name)
    if _scopes():
        _scopes()[-1].append(path)
    return path


_LOCAL = threading.local()  # scratch scopes are per thread


def _scopes() -> list[list[str]]:
    if not hasattr(_LOCAL, "scopes"):
        _LOCAL.scopes = []
    return _LOCAL.scopes


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the intermediate tables written by ``materialize`` inside the block
    once it ends (used around a fit whose result is written elsewhere)."""
    paths: list[str] = []
    _scopes().append(paths)
    try:
        yield paths
    finally:
        _scopes().pop()
        try:
            jvm = spark.sparkContext._jvm
            conf = spark.sparkContext._jsc.hadoopConfiguration()
        except Exception:  # noqa: BLE001 - no JVM handle: leave the files to the folder's retention
            paths = []
        for p in paths:
            hp = jvm.org.apache.hadoop.fs.Path(p)
            hp.getFileSystem(conf).delete(hp, True)


def materialize(df, name: str, observe: list | None = None, keep: bool = False):
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage (a re-run after an executor loss starts from the written
    files) and lets every later branch read the result instead of
    recomputing it. One job; no second pass as with an unpersisted
    ``checkpoint()``. With ``observe`` (aggregate columns) the metrics are
    computed during the same write and returned as a dict:
    ``(frame, metrics)``. Inside a ``scratch_scope`` the table is deleted when
    the scope ends, unless ``keep``.
    """
    from pyspark.sql import Observation

    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = None
    if observe:
        obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        df = df.observe(obs, *observe)
    df.write.mode("overwrite").parquet(path)
    if _scopes() and not keep:
        _scopes()[-1].append(path)
    back = spark.read.parquet(path)
    if observe:
        return back, obs.get
    return back
