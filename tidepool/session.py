"""Session settings the operators rely on.

Only settings that change results are forced (time zone, ANSI, the
legacy charset switch that lets the CSV reader decode Shift-JIS). Sizing
knobs are left to the cluster; ``build_session`` sets them for local runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Shift-JIS / CP932 are rejected by the CSV reader unless this is on.
    "spark.sql.legacy.javaCharsets": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on (idempotent)."""
    for key, value in _RESULT_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    may leave it unset and gets a private temporary folder; elsewhere
    executors could not see each other's files, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if sc is None or not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidepool-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(root)
    return root


def build_session(
    cores: int | str = "*",
    app: str = "tidepool",
    shuffle_partitions: int | None = None,
    driver_memory: str = "16g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and the bench; clusters bring their own."""
    n = (os.cpu_count() or 8) if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for key, value in {**_RESULT_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark
