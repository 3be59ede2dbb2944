"""One place that builds the session used by tests and the bench."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A new folder for files between steps, below spark.checkpoint.dir, which all executors share. Where that is unset: a
    temporary folder on a local master, an error on a cluster."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/ledgerline-{uuid.uuid4().hex}"


def local_session(cpus: str = "8", shuffle_partitions: int = 8, memory: str = "8g", app: str = "ledgerline") -> SparkSession:
    """A local session with UTC time, AQE and Arrow; on a cluster use the session that spark-submit made."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
