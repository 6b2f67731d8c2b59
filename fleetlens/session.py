"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Zone-less window bounds and ISO text are only right when everything is UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # State grows with devices x open windows: keep it off the JVM heap and
    # checkpoint only what changed.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "fleetlens", master: str | None = None,
                  **extra: str) -> SparkSession:
    """A session with SETTINGS. Shuffle partitions stay the cluster's choice;
    pass ``**{"spark.sql.shuffle.partitions": "8"}`` for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below ``spark.checkpoint.dir``.

    All executors must see it, so a machine-local temporary folder is used
    only when the setting is absent and the master is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="fleetlens-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
