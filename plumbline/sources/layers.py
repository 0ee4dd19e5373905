"""Versioned layers: raw, corrupted and remediated tables as Parquet, one folder per dataset.

Dataset version and run are partition values, so reading one version opens only its files, and
a run that is repeated replaces its own rows. Rows keep the key of their first layer. Metadata
is an append log whose current state is the latest entry per dataset.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plumbline.domain import CREDIT, Domain
from plumbline.functions.cleaning import text_nulls, truncated_int

LAYERS = ("raw", "corrupted", "remediated")
VERSION = ("dataset_id", "run_id")  # partition columns of a layer
METADATA_SCHEMA = (
    "dataset_name string, dataset_type string, description string, row_count bigint, column_count bigint, "
    "data_quality_score double, created_at timestamp, updated_at timestamp, is_active boolean, current_version string"
)


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project to the contract's columns in its order; missing ones are an error, others are dropped."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(*columns)


def dataset_id(prefix: str, at: Column) -> Column:
    """``il_`` or ``corrupt_`` plus the minute of the run."""
    return F.concat(F.lit(f"{prefix}_"), F.date_format(at, "yyMMdd_HHmm"))


def remediated_id(corrupted: Column) -> Column:
    return F.replace(corrupted, F.lit("corrupt"), F.lit("remed"))


def _number(column: Column, kind: str) -> Column:
    """In the stored type; NaN is missing."""
    value = column.cast(kind)
    return F.when(~F.isnan(value), value) if kind in ("double", "float") else value


def _stored(df: DataFrame, domain: Domain) -> list[Column]:
    """Data columns in their stored type; whole numbers are cut toward zero."""
    return [
        (truncated_int(F.col(c), t) if t in ("int", "bigint") else _number(F.col(c), t)).alias(c)
        for c, t in domain.columns.items()
    ]


def raw_rows(df: DataFrame, dataset: str | Column, source: str, run_id: str | Column, domain: Domain = CREDIT,
             *, key: str = "id", loaded_at: Column | None = None) -> DataFrame:
    require(df, [key, *domain.columns])
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.select(
        F.col(key).cast("bigint").alias("id"), *_stored(df, domain), F.lit(source).alias("data_source"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("loaded_at"),
        as_column(run_id).alias("run_id"), as_column(dataset).alias("dataset_id"),
    )


def derived_rows(df: DataFrame, dataset: str | Column, corruption_type: str, scenario: str, run_id: str | Column,
                 domain: Domain = CREDIT, *, key: str = "id", loaded_at: Column | None = None) -> DataFrame:
    require(df, [key, *domain.columns])
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    first_key = "original_row_id" if "original_row_id" in df.columns else key
    return df.select(
        F.col(key).cast("bigint").alias("id"), F.col(first_key).cast("bigint").alias("original_row_id"),
        *_stored(df, domain), F.lit(corruption_type).alias("corruption_type"),
        F.lit(scenario).alias("corruption_scenario"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("loaded_at"),
        as_column(run_id).alias("run_id"), as_column(dataset).alias("dataset_id"),
    )


@dataclass(frozen=True)
class LayerStore:
    """The layers of one base table below a root folder."""

    spark: SparkSession
    root: str
    base: str = "applications"
    domain: Domain = CREDIT

    def path(self, layer: str) -> str:
        if layer not in (*LAYERS, "metadata", "dq_results", "ml_results"):
            raise ValueError(f"unknown layer: {layer}")
        return os.path.join(self.root, f"{layer}_{self.base}" if layer in LAYERS else f"{self.base}_{layer}")

    def append(self, layer: str, rows: DataFrame) -> None:
        """Add rows; in a data layer those of the same dataset and run are replaced, so a retry changes nothing."""
        if layer in LAYERS:
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*VERSION).parquet(self.path(layer))
        else:
            rows.write.mode("append").parquet(self.path(layer))

    def exists(self, layer: str) -> bool:
        try:
            self.spark.read.parquet(self.path(layer))
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return False
        return True

    def save_raw(self, df: DataFrame, dataset: str, source: str, run_id: str, key: str = "id") -> None:
        self.append("raw", raw_rows(df, dataset, source, run_id, self.domain, key=key))

    def save_derived(self, layer: str, df: DataFrame, dataset: str, corruption_type: str, scenario: str, run_id: str,
                     key: str = "id") -> None:
        self.append(layer, derived_rows(df, dataset, corruption_type, scenario, run_id, self.domain, key=key))

    def read(self, layer: str) -> DataFrame:
        """The whole layer. Ids of datasets and runs stay text whatever they look like."""
        return self.spark.read.schema(self.schema(layer)).parquet(self.path(layer))

    def schema(self, layer: str) -> T.StructType:
        found = self.spark.read.parquet(self.path(layer)).schema
        return T.StructType([
            T.StructField(f.name, T.StringType() if f.name in VERSION else f.dataType) for f in found.fields])

    def load(self, layer: str, **filters) -> DataFrame:
        return load_rows(self.read(layer), **filters)

    def load_features(self, layer: str, limit: int | None = None, **filters) -> DataFrame:
        return load_features(self.read(layer), list(self.domain.columns), limit, **filters)

    def latest(self, layer: str) -> str | None:
        """The most recently loaded dataset; the highest id if two were loaded at once."""
        row = self.read(layer).agg(F.max(F.struct("loaded_at", "dataset_id")).alias("last")).first()
        return row["last"]["dataset_id"] if row["last"] else None

    def record(self, layer: str, version: str, row_count: int, column_count: int) -> None:
        self.append("metadata", metadata_entry(self.spark, layer, version, row_count, column_count))

    def metadata(self) -> DataFrame:
        return current_metadata(self.read_log("metadata"))

    def read_log(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def filtered(df: DataFrame, *, dataset_id: str | None = None, run_id: str | None = None,
             data_source: str | None = None, corruption_scenario: str | None = None,
             corruption_type: str | None = None) -> DataFrame:
    """Any of five equality filters; a filter on the dataset prunes partitions."""
    wanted = {"dataset_id": dataset_id, "run_id": run_id, "data_source": data_source,
              "corruption_scenario": corruption_scenario, "corruption_type": corruption_type}
    for name, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def load_rows(layer: DataFrame, ordered: bool = False, **filters) -> DataFrame:
    df = text_nulls(filtered(layer, **filters))
    return df.orderBy("id") if ordered else df


def load_features(layer: DataFrame, columns: Sequence[str], limit: int | None = None, **filters) -> DataFrame:
    """Key and data columns, newest first where ``limit`` asks for the newest rows only."""
    df = filtered(layer, **filters)
    if limit is not None:
        ties = [c for c in ("loaded_at", "dataset_id") if c in df.columns]  # derived layers repeat keys
        df = df.orderBy(F.desc("id"), *[F.desc(c) for c in ties]).limit(limit)
    return text_nulls(df.select("id", *columns))


def metadata_entry(spark: SparkSession, layer: str, version: str, row_count: int, column_count: int) -> DataFrame:
    kind = layer if layer in LAYERS else "unknown"
    one = spark.createDataFrame([(f"{kind}_{version}", kind, row_count, column_count, version)],
                                "dataset_name string, dataset_type string, row_count bigint, column_count bigint, "
                                "current_version string")
    return _metadata(one.withColumns({"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()}))


def metadata_of(rows: DataFrame, layer: str, column_count: int) -> DataFrame:
    """One metadata entry per dataset in a layer's rows."""
    kind = layer if layer in LAYERS else "unknown"
    return _metadata(rows.groupBy(F.col("dataset_id").alias("current_version")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min("loaded_at").alias("created_at"), F.max("loaded_at").alias("updated_at"),
    ).select(F.concat(F.lit(f"{kind}_"), "current_version").alias("dataset_name"), F.lit(kind).alias("dataset_type"),
             "row_count", F.lit(column_count).alias("column_count"), "created_at", "updated_at", "current_version"))


def _metadata(df: DataFrame) -> DataFrame:
    defaults = {"description": F.lit(None), "data_quality_score": F.lit(None), "is_active": F.lit(True)}
    df = df.withColumns({n: v for n, v in defaults.items() if n not in df.columns})
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in (p.split() for p in METADATA_SCHEMA.split(", "))])


def current_metadata(log: DataFrame) -> DataFrame:
    """The log folded entry by entry as ``upsert_metadata`` does: counts and time of the latest entry,
    all else of the first. One shuffle."""
    latest = ("row_count", "column_count", "updated_at")
    first, last = F.struct("created_at", "updated_at", "row_count"), F.struct("updated_at", "created_at", "row_count")
    return log.groupBy("dataset_name").agg(*[
        (F.max_by(c, last) if c in latest else F.min_by(c, first)).alias(c) for c in log.columns if c != "dataset_name"
    ]).select(*log.columns)


def upsert_metadata(current: DataFrame, entries: DataFrame) -> DataFrame:
    """Merge new entries into the metadata: known datasets keep their creation time and their
    description, score and activity, new ones are added."""
    sides = current.withColumn("_new", F.lit(0)).unionByName(entries.withColumn("_new", F.lit(1)))
    newest = lambda c: F.max_by(c, "_new")
    oldest = lambda c: F.min_by(c, "_new")
    return sides.groupBy("dataset_name").agg(
        oldest("dataset_type").alias("dataset_type"), oldest("description").alias("description"),
        newest("row_count").alias("row_count"), newest("column_count").alias("column_count"),
        oldest("data_quality_score").alias("data_quality_score"), oldest("created_at").alias("created_at"),
        newest("updated_at").alias("updated_at"), oldest("is_active").alias("is_active"),
        oldest("current_version").alias("current_version"),
    )


def lineage(raw: DataFrame, corrupted: DataFrame, remediated: DataFrame) -> DataFrame:
    """Rows and load times of every dataset and run in the three layers, with a single shuffle."""
    sides = [df.select(F.lit(name).alias("data_type"), "dataset_id", "run_id", "loaded_at")
             for name, df in zip(LAYERS, (raw, corrupted, remediated))]
    return sides[0].unionByName(sides[1]).unionByName(sides[2]).groupBy("data_type", "dataset_id", "run_id").agg(
        F.count(F.lit(1)).alias("record_count"), F.min("loaded_at").alias("first_load"),
        F.max("loaded_at").alias("last_load"))


def dataset_overview(metadata: DataFrame) -> DataFrame:
    return metadata.filter("is_active").select(
        "dataset_name", "dataset_type", "row_count", "column_count", "data_quality_score", "created_at", "updated_at",
        "is_active").orderBy("dataset_type", F.desc("created_at"), "dataset_name")
