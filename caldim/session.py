"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so that timestamp arithmetic is zone
# free; ANSI so that bad financial text raises instead of turning NULL; AQE
# so that shuffles are re-planned from real sizes (partition coalescing,
# skew-join splitting, broadcast promotion).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def build_session(
    master: str = "local[*]", shuffle_partitions: int = 8, app: str = "caldim", extra_conf: dict | None = None
) -> SparkSession:
    """A session for tests, benchmarks and local runs (the UI stays off)."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CALDIM_DRIVER_MEMORY", "8g"))
    )
    for k, v in {**SESSION_CONF, **(extra_conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_conf(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime settings above to an existing session."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only on a ``local`` master (tests), where driver and executors are one
    process, is one created here if none is configured; anywhere else the
    executors could not read what others wrote to it, so that raises."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
        d = sc.getCheckpointDir() or d
    except Exception:  # noqa: BLE001 - no SparkContext on a Spark Connect client
        sc = None
    if not d:
        if spark.conf.get("spark.master", "").split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="caldim-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
        else:
            spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def work_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh folder below the shared checkpoint folder for one run's
    tables (versioned dimensions, logs, stream outputs)."""
    return f"{checkpoint_dir(spark)}/caldim-{name}-{uuid.uuid4().hex[:12]}"
