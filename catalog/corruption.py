"""Corruptors at every level, over the applications view."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sqltext as q
from catalog.common import DOMAIN, SUITE, apps, rounded, shown
from catalog.registry import query
from plumbline.domain import LEVELS
from plumbline.operators import corrupt
from plumbline.operators.expectations import statistics
from plumbline.plans import flows
from plumbline.sources.layers import LayerStore
from plumbline.sources.staging import fresh_path

STEPS = {
    "c1_missing_values": (corrupt.missing_values, q.missing), "c2_outliers": (corrupt.outliers, q.outliers),
    "c3_categorical_errors": (corrupt.categorical_errors, q.categories), "c4_label_errors": (corrupt.label_errors, q.labels),
    "c5_relationship_violations": (corrupt.relationship_violations, q.relation),
    "c6_conjoined": (corrupt.conjoined, q.conjoined),
}

for _name, (_step, _sql) in STEPS.items():
    for _level in LEVELS:
        _ctes = _sql("corrupted", "applications", _level)
        query(f"{_name}_{_level}", q.with_ctes(*([_ctes] if isinstance(_ctes, str) else _ctes), select=q.shown("corrupted")))(
            lambda spark, folder, step=_step, level=_level: shown(step(apps(spark, folder), level, DOMAIN)))


@query("c1_missing_fraction", q.with_ctes(q.step("corrupted", "applications", {
    c: f"CASE WHEN {q.u(f'missing:{c}:u')} < 0.05 THEN NULL ELSE {c} END" for c in DOMAIN.missing_counts["severe"]}),
    select=q.shown("corrupted")))
def c1_fraction(spark, folder):
    return shown(corrupt.missing_values(apps(spark, folder), "severe", DOMAIN, fraction=0.05))


@query("c7_experiment", q.with_ctes(
    *q.conjoined("corrupted", "applications", "medium"), q.suite_results("results", "corrupted", SUITE), select="""
SELECT 'conjoined_corruption' AS corruption, 'medium' AS scenario, bool_and(success) AS overall_success,
       count(*) AS evaluated_expectations, count(*) FILTER (WHERE success) AS successful_expectations,
       count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations,
       round(count(*) FILTER (WHERE success) / CAST(count(*) AS DOUBLE) * 100, 6) AS success_percent,
       (SELECT count(*) FROM corrupted) AS saved_rows FROM results"""))
def c7(spark, folder):
    store = LayerStore(spark, fresh_path(spark, "c7"), domain=DOMAIN)
    store.save_raw(apps(spark, folder), "il_240101_0000", flows.ORIGINAL, "run")
    results = flows.run_experiment(store, "conjoined_corruption", "medium", SUITE, dataset_id="corrupt_240101_0000", run_id="run")
    saved = store.load("corrupted", ordered=False, dataset_id="corrupt_240101_0000").agg(F.count(F.lit(1)).alias("saved_rows"))
    overall = results.agg(F.every("success").alias("overall_success"))
    return rounded(statistics(results).crossJoin(overall).crossJoin(saved).select(  # one row each
        F.lit("conjoined_corruption").alias("corruption"), F.lit("medium").alias("scenario"), "*"))
