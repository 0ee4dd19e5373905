"""Validate dataset versions as their files arrive.

Each micro-batch reduces its rows to parts of the suite per dataset: counters, states of measures
and counts per value. They are written under the batch's number, so a batch that runs twice
overwrites itself. ``compact`` folds all batches up to a number into one part; reading takes the
last fold and the batches after it. A dataset is decided on once all files that its manifest
expects have been counted.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plumbline.functions.cleaning import nan_to_null
from plumbline.operators.expectations import Suite
from plumbline.operators.expectations.run import MergeableSuite
from plumbline.plans.flows import gate
from plumbline.sources.staging import staged

KEYS = ["dataset_id"]
TABLES = ("counters", "values", "files")
BATCH, FOLD = "batch", "fold"


def validate_arrivals(spark: SparkSession, source: str, schema: T.StructType, suite: Suite, sink: str,
                      checkpoint: str, files_per_batch: int | None = None, available_now: bool = True):
    """Start the stream over a layer's folder; with ``available_now`` it stops once caught up."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(source).select("*", F.col("_metadata.file_path").alias("_file"))

    def count(batch: DataFrame, number: int) -> None:
        batch = nan_to_null(batch)
        made = MergeableSuite(batch.drop("_file"), suite)
        parts = {"counters": made.partial(batch, KEYS), "values": made.values(batch, KEYS),
                 "files": batch.groupBy(*KEYS).agg(F.count_distinct("_file").alias("n_files"))}  # a file is never cut by a batch
        # side by side: a batch of few files leaves most cores free
        with ThreadPoolExecutor(len(TABLES)) as pool:
            for job in [pool.submit(inheritable_thread_target(batch.sparkSession)(_write), parts[name], sink, name, BATCH, number) for name in TABLES]:
                job.result()

    writer = rows.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _write(df: DataFrame, sink: str, name: str, kind: str, number: int) -> None:
    df.write.mode("overwrite").parquet(os.path.join(sink, name, f"kind={kind}", f"seq={number}"))


def _current(spark: SparkSession, sink: str, name: str) -> DataFrame:
    """The last fold and the batches after it."""
    rows = spark.read.option("basePath", os.path.join(sink, name)).parquet(os.path.join(sink, name))
    rows = rows.withColumn("dataset_id", F.col("dataset_id").cast("string"))
    fold = rows.where(F.col("kind") == FOLD).agg(F.max("seq")).first()[0]
    if fold is None:
        return rows.drop("kind", "seq")
    keep = (F.col("kind") == FOLD) & (F.col("seq") == fold) | (F.col("kind") == BATCH) & (F.col("seq") > fold)
    return rows.where(keep).drop("kind", "seq")


def compact(spark: SparkSession, schema: T.StructType, suite: Suite, sink: str, upto: int) -> None:
    """Fold the batches up to ``upto``, all of which must have ended.

    The counters are folded last: until they are there, a reader of any table still sees the fold before.
    Batches that are run again after their fold are not read."""
    made = MergeableSuite(spark.createDataFrame([], schema), suite)
    folds = {"values": lambda rows: made.merged_values(rows, KEYS), "files": lambda rows: rows.groupBy(*KEYS).agg(F.sum("n_files").alias("n_files")),
             "counters": lambda rows: made.merged(rows, KEYS)}
    for name, fold in folds.items():
        rows = spark.read.option("basePath", os.path.join(sink, name)).parquet(os.path.join(sink, name))
        last = rows.where((F.col("kind") == FOLD) & (F.col("seq") < upto)).agg(F.max("seq")).first()[0]
        last = -1 if last is None else last
        old = (F.col("kind") == FOLD) & (F.col("seq") == last) | (F.col("kind") == BATCH) & (F.col("seq") > last) & (F.col("seq") <= upto)
        _write(fold(rows.where(old)), sink, name, FOLD, upto)


def arrived_results(spark: SparkSession, schema: T.StructType, suite: Suite, sink: str) -> DataFrame:
    """Result rows per dataset from all batches so far, written once: a batch that runs again replaces the files read here."""
    made = MergeableSuite(spark.createDataFrame([], schema), suite)
    counters, values = _current(spark, sink, "counters"), _current(spark, sink, "values")
    return staged(made.judged(made.merged(counters, KEYS), made.merged_values(values, KEYS), KEYS), "arrived")


def arrived_decisions(spark: SparkSession, schema: T.StructType, suite: Suite, sink: str, manifest: DataFrame,
                      threshold: float = 90.0) -> DataFrame:
    """The gate's decision for every dataset of ``manifest(dataset_id, n_files)`` that is complete: one per version."""
    files = _current(spark, sink, "files").groupBy(*KEYS).agg(F.sum("n_files").alias("arrived"))
    done = manifest.join(files, KEYS).where("arrived >= n_files").select(*KEYS)
    return gate(arrived_results(spark, schema, suite, sink).join(done, KEYS, "left_semi"), threshold, KEYS)
