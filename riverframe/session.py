"""Session defaults. A cluster brings its own session; this one is for local use and tests."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "riverframe", shuffle_partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Recording the call site of every column costs more than planning on small data.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RIVERFRAME_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where none is set, a session in one process (``local`` or ``local[n]``) gets a private one; anywhere
    else, ``local-cluster`` included, that is an error, as executors could not see a folder of the driver's machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    named = tempfile.mkdtemp(prefix="riverframe-checkpoint-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named
