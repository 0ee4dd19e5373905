"""Session helper for tests and benchmarks; on a cluster the session comes from the caller."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


# Runtime settings worth having on any cluster: re-planning at run time, and methods beyond the
# JIT's limit compiled per operator instead of being interpreted.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    with_stage_folder(spark)
    return spark


def with_stage_folder(spark: SparkSession, folder: str | None = None) -> SparkSession:
    """Give a local session without ``spark.checkpoint.dir`` a folder for its staged tables.

    On a cluster the setting has to name a shared folder; there nothing is chosen here.
    """
    context = spark.sparkContext
    known = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not known and (folder or context.master.startswith("local")):
        context.setCheckpointDir(folder or os.path.join(tempfile.gettempdir(), f"plumbline-{context.applicationId}"))
    return spark


def local_session(cpus: str | int = "*", app: str = "plumbline") -> SparkSession:
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
