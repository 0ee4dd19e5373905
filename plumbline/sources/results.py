"""Result tables of validations and models, and the questions asked of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.operators.evaluate import METRICS
from plumbline.operators.expectations import analyze

DQ_RESULTS_SCHEMA = (
    "dataset_id string, run_id string, expectation_suite_name string, total_expectations int, "
    "successful_expectations int, failed_expectations int, success_rate decimal(5,2), overall_success boolean, "
    "completeness_ok boolean, consistency_ok boolean, failed_columns array<string>, critical_failures int, "
    "warning_failures int, key_columns_validation "
    "map<string,struct<expectation_type:string,success:boolean,severity:string>>, "
    "validation_duration_seconds decimal(10,3), records_processed bigint, created_at timestamp"
)
ML_RESULTS_SCHEMA = (
    "dataset_id string, model_name string, run_id string, accuracy decimal(5,4), precision decimal(5,4), "
    "recall decimal(5,4), f1_score decimal(5,4), roc_auc decimal(5,4), cv_accuracy_mean decimal(5,4), "
    "cv_accuracy_std decimal(5,4), cv_precision_mean decimal(5,4), cv_precision_std decimal(5,4), "
    "cv_recall_mean decimal(5,4), cv_recall_std decimal(5,4), cv_f1_mean decimal(5,4), cv_f1_std decimal(5,4), "
    "cv_roc_auc_mean decimal(5,4), cv_roc_auc_std decimal(5,4), confusion_matrix array<array<bigint>>, "
    "classification_report string, is_best_model boolean, test_size decimal(3,2), cv_folds int, random_state int, "
    "created_at timestamp"
)


def _fields(schema: str) -> list[tuple[str, str]]:
    """Name and type of each field; commas inside types belong to the type."""
    out, depth, part = [], 0, ""
    for ch in schema + ",":
        depth += ch in "<(" 
        depth -= ch in ">)"
        if ch == "," and depth == 0:
            name, kind = part.strip().split(" ", 1)
            out.append((name, kind))
            part = ""
        else:
            part += ch
    return out


def _conform(df: DataFrame, schema: str) -> DataFrame:
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in _fields(schema)])


def dq_result_rows(results: DataFrame, suite_name: str, key_columns: Sequence[str], *, dataset_id: str | None = None,
                   run_id: str | None = None, duration: float | None = None,
                   created_at: Column | None = None) -> DataFrame:
    """One summary row per validation. Without ``dataset_id`` and ``run_id`` the result rows carry
    both, one validation per pair."""
    keys = ["dataset_id", "run_id"] if dataset_id is None else []
    summary = analyze(results, key_columns, keys)
    if dataset_id is not None:
        summary = summary.withColumns({"dataset_id": F.lit(dataset_id), "run_id": F.lit(run_id)})
    return _conform(summary.withColumns({
        "expectation_suite_name": F.lit(suite_name), "validation_duration_seconds": F.lit(duration),
        "created_at": F.current_timestamp() if created_at is None else created_at,
    }), DQ_RESULTS_SCHEMA)


def ml_result_rows(metrics: DataFrame, summary: DataFrame, *, dataset_id: str, run_id: str, test_size: float,
                   folds: int, seed: int, created_at: Column | None = None) -> DataFrame:
    """One row per model: test metrics with its cross-validation, which counts as 0 where absent.

    ``metrics`` has model, the metrics, confusion_matrix, is_best_model and may have the lines of
    classification_report, which are stored as JSON by class; ``summary`` has model, metric, mean, std."""
    cv = summary.groupBy("model").pivot("metric", list(METRICS)).agg(
        F.first("mean").alias("mean"), F.first("std").alias("std"))
    joined = metrics.join(cv, "model", "left")
    zero = {f"cv_{m}_{s}": F.coalesce(F.col(f"{m}_{s}"), F.lit(0.0)) for m in METRICS for s in ("mean", "std")}
    out = joined.withColumns({
        **zero, "dataset_id": F.lit(dataset_id), "run_id": F.lit(run_id), "model_name": F.col("model"),
        "f1_score": F.col("f1"), "test_size": F.lit(test_size), "cv_folds": F.lit(folds), "random_state": F.lit(seed),
        "created_at": F.current_timestamp() if created_at is None else created_at,
    })
    if "classification_report" not in out.columns:
        out = out.withColumn("classification_report", F.lit(None))
    elif out.schema["classification_report"].dataType.typeName() == "array":
        by_class = F.map_from_entries(F.transform("classification_report", lambda x: F.struct(
            x["class"], F.struct(*[x[n].alias(n) for n in ("precision", "recall", "f1", "support")]))))
        out = out.withColumn("classification_report", F.to_json(by_class))
    return _conform(out, ML_RESULTS_SCHEMA)


def recent_failures(dq_results: DataFrame, dataset_id: str, limit: int = 10) -> DataFrame:
    return dq_results.filter((F.col("dataset_id") == dataset_id) & ~F.col("overall_success")).select(
        "run_id", "expectation_suite_name", "failed_columns", "critical_failures", "success_rate", "created_at",
    ).orderBy(F.desc("created_at"), F.desc("run_id")).limit(limit)


def all_best_models(ml_results: DataFrame) -> DataFrame:
    return ml_results.filter("is_best_model").select("dataset_id", "model_name", "accuracy", "roc_auc", "created_at").orderBy(
        "dataset_id", F.desc("created_at"), "model_name")


def best_models(ml_results: DataFrame, dataset_id: str, limit: int = 10) -> DataFrame:
    return ml_results.filter((F.col("dataset_id") == dataset_id) & F.col("is_best_model")).select(
        "model_name", "accuracy", "roc_auc", "created_at").orderBy(F.desc("created_at"), "model_name").limit(limit)


def model_comparison(ml_results: DataFrame, dataset_id: str, run_id: str) -> DataFrame:
    return ml_results.filter((F.col("dataset_id") == dataset_id) & (F.col("run_id") == run_id)).select(
        "model_name", "accuracy", "precision", "recall", "f1_score", "roc_auc", "is_best_model",
    ).orderBy(F.desc("accuracy"), "model_name")


def performance_history(ml_results: DataFrame, dataset_id: str, model_name: str, limit: int = 20) -> DataFrame:
    return ml_results.filter((F.col("dataset_id") == dataset_id) & (F.col("model_name") == model_name)).select(
        "run_id", "accuracy", "roc_auc", "created_at").orderBy(F.desc("created_at"), F.desc("run_id")).limit(limit)
