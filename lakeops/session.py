"""Session defaults and the shared folder long-running work writes to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Wide projections make methods the JVM would not compile; above this size Spark splits them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Rows of one session are put together before they are shuffled.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Window state can outgrow the heap when a stream keeps every window.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's defaults; ``conf`` overrides them (dots as ``__``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, below the folder the cluster shares.

    ``spark.checkpoint.dir`` names that folder. Where it is unset the warehouse, which a cluster's
    machines share too, takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
