"""Tables written once between passes, in the shared folder of the cluster.

A written table cuts the lineage, keeps the columnar layout (so later passes still prune
columns) and survives lost executors.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, or the folder given to ``setCheckpointDir``."""
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or context.getConf().get(SETTING, None) or context.getCheckpointDir()
    if not folder:
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), "plumbline", f"{name}-{uuid.uuid4().hex}")


def staged(df: DataFrame, name: str = "stage", compression: str | None = None) -> DataFrame:
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
