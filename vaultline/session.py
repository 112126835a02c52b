"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DEFAULTS = {
    # ISO timestamps carry no zone, so every reader has to agree on one.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # First-arrival dedup never forgets a key, so its state must live outside the heap.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.ui.enabled": "false",
}

_local_roots: dict[str, str] = {}


def build_session(app: str = "vaultline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="vaultline-")
    return _local_roots[context.applicationId]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
