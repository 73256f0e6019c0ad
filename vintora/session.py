"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile
import threading
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join keys even where the join feeds an aggregation on the same key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows go to Python workers in batches of bounded bytes, as texts differ in length.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings the library's results and plans rely on."""
    for key, value in _RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class _Uses:
    """The setting of a session while jobs of several threads, such as streams, need it: the first
    one sets it, the last one puts back what was there."""

    def __init__(self):
        self._lock, self._open = threading.Lock(), {}

    def begin(self, spark: SparkSession) -> None:
        with self._lock:
            jobs, before = self._open.get(spark._jsparkSession.sessionUUID(), (0, None))
            if not jobs:
                before = spark.conf.get(_CLEANUP, None)
                spark.conf.set(_CLEANUP, "true")
            self._open[spark._jsparkSession.sessionUUID()] = (jobs + 1, before)

    def end(self, spark: SparkSession) -> None:
        with self._lock:
            jobs, before = self._open.pop(spark._jsparkSession.sessionUUID())
            if jobs > 1:
                self._open[spark._jsparkSession.sessionUUID()] = (jobs - 1, before)
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)


_USES = _Uses()


def freeing_shuffles(spark: SparkSession, job: Callable[[], Any]) -> Any:
    """What ``job`` returns; the shuffle files of a query planned in it go when the query has ended.

    Otherwise they stay until the driver happens to collect its garbage, and a build of many tables
    holds those of all of them. For queries whose plan nobody runs again, such as writes.
    """
    _USES.begin(spark)
    try:
        return job()
    finally:
        _USES.end(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        current = tempfile.mkdtemp(prefix="vintora-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(current)
    return current
