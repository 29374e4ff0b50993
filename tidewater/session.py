"""Spark session defaults and shared-folder helpers.

All report times are UTC, so every session pins the SQL time zone to UTC.
Lineage cuts and streaming checkpoints go under ``spark.checkpoint.dir``,
which on a cluster names a shared folder; it is only filled in here when it
is unset (tests, local benches).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "tidewater",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Report times are UTC instants; format and cast them in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Read from the session. Only when it is unset (a local test run) a fresh
    scratch folder is taken and registered, so jobs on a cluster always use
    the folder the cluster names.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (no classic context, e.g. Spark Connect)
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is None or not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the cluster shares")
        root = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
