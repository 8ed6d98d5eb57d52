"""Session helpers.

The engine never needs special planner rules; it only needs a session whose
clock is UTC (site timestamps carry fixed offsets) and whose ANSI mode is on
(bad casts must be explicit ``try_cast``).  A cluster passes its own session;
``get_session`` is for tests, benches and scripts.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "pagelake",
                shuffle_partitions: int | None = None) -> SparkSession:
    master = master or os.environ.get("PAGELAKE_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PAGELAKE_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    pin_utc(spark)
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Site times are fixed-offset instants; every output is read in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints.

    It is ``spark.checkpoint.dir`` (a path every executor sees) or what
    ``setCheckpointDir`` was given.  Where neither is set, a local master gets
    a fresh local folder; on a cluster that would scatter files over machines,
    so it raises.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if path:
        return path
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="pagelake-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared work dir (never reused)."""
    import uuid

    base = work_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
