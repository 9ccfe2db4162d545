"""Session helpers: local session for tests/bench, checkpoint directory."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "jobsheet") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("JOBSHEET_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_CHECKPOINT_DIRS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``), registered once per application.

    On a cluster this must already be set to shared storage.  Only a local
    master (one machine, one process) gets a scratch folder where it is unset.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _CHECKPOINT_DIRS:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not re.match(r"local(\[|$)", sc.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            d = tempfile.mkdtemp(prefix="jobsheet-ckpt-")
        sc.setCheckpointDir(d)
        _CHECKPOINT_DIRS[sc.applicationId] = d
    return _CHECKPOINT_DIRS[sc.applicationId]
