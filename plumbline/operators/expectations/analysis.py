"""What a gate and a report need from the result rows of a suite.

The inputs hold one row per expectation (per dataset, when ``keys`` are given).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


NOT_NULL = "expect_column_values_to_not_be_null"
IN_SET = "expect_column_values_to_be_in_set"


def _grouped(results: DataFrame, keys: Sequence[str]):
    return results.groupBy(*keys)


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0))


def statistics(results: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    total, good = F.count(F.lit(1)), F.count_if(F.col("success"))
    return _grouped(results, keys).agg(
        total.alias("evaluated_expectations"), good.alias("successful_expectations"),
        (total - good).alias("unsuccessful_expectations"), _percent(good, total).alias("success_percent"),
    )


def record_count(results: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    counted = F.when(F.col("element_count").isNotNull(), F.col("idx"))
    return _grouped(results, keys).agg(F.min_by("element_count", counted).alias("record_count"))


def adjusted_success_rate(results: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Share of examined cells that were as expected, in percent."""
    counted = F.when(F.col("element_count").isNotNull(), F.col("idx"))
    return (
        _grouped(results, keys)
        .agg(F.count(F.lit(1)).alias("expectations"),
             F.coalesce(F.min_by("element_count", counted), F.lit(0)).alias("records"),
             F.coalesce(F.sum("unexpected_count"), F.lit(0)).alias("unexpected"))
        .withColumn("examined", F.col("expectations") * F.when(F.col("records") > 0, F.col("records")).otherwise(1))
        .withColumn("adjusted_success_rate", _percent(F.col("examined") - F.col("unexpected"), F.col("examined")))
        .drop("expectations", "records")
    )


def analyze(results: DataFrame, key_columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Failure analysis; arrays and maps hold at most one entry per column of the suite."""
    failed = ~F.col("success")
    critical = F.col("severity") == "critical"
    in_column = failed & F.col("column").isNotNull()
    of_type = lambda t: F.every(F.when(F.col("expectation_type").contains(t), F.col("success")))
    detail = F.struct(F.col("expectation_type"), F.col("success"), F.col("severity"))
    key_failures = F.collect_list(F.when(
        in_column & F.col("column").isin(list(key_columns)),
        F.struct("column", "idx", detail.alias("detail")),
    ))
    last_of_each = F.filter(
        F.array_sort("key_failures"),
        lambda x: ~F.exists(F.col("key_failures"), lambda y: (y["column"] == x["column"]) & (y["idx"] > x["idx"])),
    )
    total, good = F.count(F.lit(1)), F.count_if(F.col("success"))
    counted = F.when(F.col("element_count").isNotNull(), F.col("idx"))
    return (
        _grouped(results, keys)
        .agg(
            total.alias("total_expectations"), good.alias("successful_expectations"),
            (total - good).alias("failed_expectations"), _percent(good, total).alias("success_rate"),
            (total == good).alias("overall_success"),
            F.coalesce(of_type(NOT_NULL), F.lit(True)).alias("completeness_ok"),
            F.coalesce(of_type(IN_SET), F.lit(True)).alias("consistency_ok"),
            F.sort_array(F.collect_set(F.when(in_column, F.col("column")))).alias("failed_columns"),
            F.count_if(failed & critical).alias("critical_failures"),
            F.count_if(failed & ~critical).alias("warning_failures"),
            key_failures.alias("key_failures"),
            F.min_by("element_count", counted).alias("records_processed"),
        )
        .withColumn("key_columns_validation", F.map_from_entries(F.transform(
            last_of_each, lambda x: F.struct(x["column"], x["detail"]))))
        .drop("key_failures")
    )


def failed_expectations(results: DataFrame, include_pairs: bool = False) -> DataFrame:
    """{type, column} of each failure; rules over several columns name none and are left out,
    unless ``include_pairs`` asks for them with their column list."""
    failed = results.filter(~F.col("success"))
    if include_pairs:
        return failed.select(F.col("expectation_type").alias("type"), F.coalesce("column", "column_b").alias("column"))
    return failed.filter(F.col("column").isNotNull()).select(F.col("expectation_type").alias("type"), "column")


@dataclass(frozen=True)
class QualityThreshold:
    """Acceptance limits of a dataset before it may feed a model (fixed default values)."""

    min_success_rate: float = 90.0
    max_null_percentage: float = 5.0
    min_data_volume: float = 0.8
    allowed_invalid_categories: int = 0

    def check(self, results: DataFrame, baseline_rows: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
        """Four verdicts, all from the result rows: success rate, worst not-null rule, invalid
        categories, and rows against ``baseline_rows`` (true where no baseline is given)."""
        of_type = lambda t, c: F.when(F.col("expectation_type") == t, F.col(c))
        rows = F.max("element_count")
        volume = F.lit(True) if not baseline_rows else rows / F.lit(baseline_rows) >= F.lit(self.min_data_volume)
        nulls = F.coalesce(F.max(of_type(NOT_NULL, "unexpected_percent")), F.lit(0.0))
        invalid = F.coalesce(F.sum(of_type(IN_SET, "unexpected_count")), F.lit(0))
        rate = _percent(F.count_if("success"), F.count(F.lit(1)))
        return _grouped(results, keys).agg(
            (rate >= F.lit(self.min_success_rate)).alias("success_rate_ok"),
            (nulls <= F.lit(self.max_null_percentage)).alias("completeness_ok"),
            (invalid <= F.lit(self.allowed_invalid_categories)).alias("consistency_ok"),
            volume.alias("volume_ok"),
        )
