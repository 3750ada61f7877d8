"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(cpus: int | str = 8, app: str = "evalframe", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Local session with the settings the library assumes (UTC, AQE, no UI).

    On a cluster, build the session there and pass it in; every operator
    takes the session or DataFrames and never builds its own.
    """
    parts = shuffle_partitions or max(int(cpus) if str(cpus).isdigit() else 8, 1)
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("EVALFRAME_DRIVER_MEMORY", "16g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local tests) is a
    private folder created and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="evalframe-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001 - core confs may be read-only at runtime
            pass
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for tables a plan writes."""
    return f"{checkpoint_root(spark)}/evalframe/{name}-{uuid.uuid4().hex[:12]}"
