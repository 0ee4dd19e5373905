"""Whole flows: load, corrupt, gate, remediate, train, and validation of arriving files."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sqltext as q
from catalog.common import DOMAIN, SUITE, apps, corrupted, rounded
from catalog.registry import query
from catalog.repairs import BOTH, CORRUPTED, RATE, REPAIRED
from plumbline.operators import corrupt
from plumbline.operators.expectations import Expectation, Suite, run_suite
from plumbline.plans import flows, training
from plumbline.sources.layers import LayerStore
from plumbline.sources.staging import fresh_path, staged
from plumbline.streaming import gate as arrivals

COLUMNS = ["id", *DOMAIN.columns]


def _store(spark) -> LayerStore:
    return LayerStore(spark, fresh_path(spark, "store"), domain=DOMAIN)


@query("f1_initial_load", """
SELECT 'il_240101_0000' AS dataset_id, 'r1' AS run_id, 'original_csv' AS data_source, count(*) AS rows_loaded FROM orders""")
def f1(spark, folder):
    path = fresh_path(spark, "csv")
    apps(spark, folder).select(*COLUMNS).toDF(*[c.upper().replace("_", " ") for c in COLUMNS]).write.option(
        "sep", ";").option("header", True).csv(path)
    schema = "id bigint, " + ", ".join(f"{c} {t}" for c, t in DOMAIN.columns.items())
    return flows.initial_load(_store(spark), path, schema, dataset_id="il_240101_0000", run_id="r1", key="id")


def _files(spark) -> int:
    """Five files at least, and as many as the cluster writes at once."""
    return max(5, spark.sparkContext.defaultParallelism)


@query("f1_two_loads", """
SELECT 'il_240101_000' || n AS dataset_id, count(*) AS n_rows, count(*) AS n_ids, (n - 1) * count(*) AS first_id, n * count(*) - 1 AS last_id
FROM orders, (SELECT unnest([1, 2]) AS n) GROUP BY n""")
def f1_two(spark, folder):
    """Files without a key: two loads, the first of them repeated. Keys stay distinct and the same."""
    path = fresh_path(spark, "csv")
    apps(spark, folder).select(*COLUMNS[1:]).repartition(_files(spark)).write.option("sep", ";").option("header", True).csv(path)
    store, schema = _store(spark), ", ".join(f"{c} {t}" for c, t in DOMAIN.columns.items())
    for n in (1, 2, 1):
        flows.initial_load(store, path, schema, dataset_id=f"il_240101_000{n}", run_id="r1")
    return store.read("raw").groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query("f2_corrupt", q.with_ctes(*CORRUPTED, BOTH[0], select=f"SELECT {q.SHOW_RESULTS} FROM initial"))
def f2(spark, folder):
    store = _store(spark)
    store.save_raw(apps(spark, folder), "il_240101_0000", flows.ORIGINAL, "r1")
    return rounded(flows.run_experiment(store, "conjoined_corruption", "severe", SUITE, dataset_id="corrupt_240101_0000", run_id="r1"))


def _gate_sql(threshold: float, ctes, source: str) -> str:
    return q.with_ctes(*ctes, select=f"""
SELECT round({RATE}, 6) AS success_rate, CASE WHEN {RATE} >= {threshold} THEN 'ml' ELSE 'remediate' END AS decision,
       coalesce(string_agg(expectation_type || ':' || "column", ',' ORDER BY expectation_type, "column")
                FILTER (WHERE NOT success AND "column" IS NOT NULL), '') AS failed FROM {source}""")


def _gated(results, threshold):
    return rounded(flows.gate(results, threshold).withColumn("failed", F.array_join(F.transform(
        "failed", lambda f: F.concat(f["type"], F.lit(":"), f["column"])), ",")))


@query("f3_gate_clean", _gate_sql(85, [q.suite_results("found", "applications", SUITE)], "found"))
def f3_clean(spark, folder):
    return _gated(run_suite(apps(spark, folder), SUITE), 85)


@query("f3_gate_corrupted", _gate_sql(90, [*CORRUPTED, BOTH[0]], "initial"))
def f3_corrupted(spark, folder):
    return _gated(run_suite(corrupted(spark, folder), SUITE), 90)


@query("f4_remediate", q.with_ctes(*CORRUPTED, *REPAIRED, *BOTH, select=f"""
SELECT round(f.rate, 6) AS success_rate, f.rate >= 90 AS passed, round(f.rate - i.rate, 6) AS improvement,
       i.bad - f.bad AS failures_fixed, (SELECT count(*) FROM repaired) AS saved_rows
FROM (SELECT {RATE} AS rate, count(*) FILTER (WHERE NOT success) AS bad FROM final) f,
     (SELECT {RATE} AS rate, count(*) FILTER (WHERE NOT success) AS bad FROM initial) i"""))
def f4(spark, folder):
    store = _store(spark)
    store.save_raw(apps(spark, folder), "il_240101_0000", flows.ORIGINAL, "r1")
    initial = flows.run_experiment(store, "conjoined_corruption", "severe", SUITE, dataset_id="corrupt_240101_0000", run_id="r1")
    out = flows.remediate_and_gate(store, SUITE, dataset_id="corrupt_240101_0000", run_id="r1", initial=initial, advanced=False)
    saved = store.read("remediated").filter("dataset_id = 'remed_240101_0000'").agg(F.count(F.lit(1)).alias("saved_rows"))
    gained = out["improvement"].select("improvement", "failures_fixed")
    return rounded(out["verdict"].crossJoin(gained).crossJoin(saved))  # one row each


@query("f5_train")
def f5(spark, folder):
    store = _store(spark)
    store.save_raw(apps(spark, folder), "il_240101_0000", flows.ORIGINAL, "r1")
    training.train_and_score(store, dataset_id="il_240101_0000", run_id="r1", layer="raw")
    return store.read_log("ml_results").select(
        "dataset_id", "model_name", *[F.col(c).cast("double").alias(c) for c in ("accuracy", "roc_auc", "cv_accuracy_mean")], "is_best_model")


@query("f6_arrivals", q.with_ctes(
    *CORRUPTED, *q.conjoined("lighter", "applications", "light"),
    q.step("kept_1", "corrupted", {"n_lines": "trunc(n_lines)"}), q.step("kept_2", "lighter", {"n_lines": "trunc(n_lines)"}),
    f"arrived AS ({q.shown('kept_1').replace('SELECT', '''SELECT 'corrupt_1' AS dataset_id,''', 1)} UNION ALL "
    f"{q.shown('kept_2').replace('SELECT', '''SELECT 'corrupt_2' AS dataset_id,''', 1)})",
    q.suite_results("found", "arrived", SUITE, ("dataset_id",)), select=f"SELECT dataset_id, {q.SHOW_RESULTS} FROM found"))
def f6(spark, folder):
    store = _store(spark)
    sink, checkpoint = fresh_path(spark, "sink"), fresh_path(spark, "stream")
    clean = staged(apps(spark, folder).select(*COLUMNS), "applications")  # for both versions
    store.save_derived("corrupted", corrupt.conjoined(clean, "severe", DOMAIN), "corrupt_1", "conjoined_corruption", "severe", "r1")
    schema = store.schema("corrupted")
    watch = lambda: arrivals.validate_arrivals(
        spark, store.path("corrupted"), schema, SUITE, sink, checkpoint, files_per_batch=4).awaitTermination()
    watch()
    store.save_derived("corrupted", corrupt.conjoined(clean, "light", DOMAIN), "corrupt_2", "conjoined_corruption", "light", "r2")
    watch()  # goes on where it stopped
    return rounded(arrivals.arrived_results(spark, schema, SUITE, sink))


MEASURED = Suite(tuple(Expectation(t, k) for t, k in (
    ("expect_column_values_to_be_unique", {"column": "amount"}), ("expect_column_mean_to_be_between", {"column": "amount", "min_value": 1000}),
    ("expect_column_stdev_to_be_between", {"column": "amount", "max_value": 1e9}), ("expect_column_sum_to_be_between", {"column": "total_qty", "min_value": 1e6}),
    ("expect_column_min_to_be_between", {"column": "n_lines", "min_value": 1}), ("expect_column_max_to_be_between", {"column": "n_lines", "max_value": 7}),
    ("expect_column_unique_value_count_to_be_between", {"column": "segment", "max_value": 5}),
    ("expect_column_distinct_values_to_contain_set", {"column": "priority", "value_set": ["1-URGENT", "2-HIGH", "none"]}),
    ("expect_column_most_common_value_to_be_in_set", {"column": "status", "value_set": ["F", "O"]}), ("expect_table_row_count_to_be_between", {"min_value": 10}),
    ("expect_column_value_z_scores_to_be_less_than", {"column": "amount", "threshold": 2}))), name="measures")
PER_DATASET = """
per AS (SELECT dataset_id, count(*) AS n, count(*) - count(amount) AS gaps, avg(amount) AS am, stddev_samp(amount) AS sd, sum(total_qty) AS qty, min(n_lines) AS low, max(n_lines) AS high,
        count(DISTINCT segment) AS kinds, count(DISTINCT priority) FILTER (WHERE priority IN ('1-URGENT', '2-HIGH', 'none')) AS hits FROM arrived GROUP BY 1),
repeats AS (SELECT dataset_id, sum(c) FILTER (WHERE c > 1) AS n FROM (SELECT dataset_id, amount, count(*) AS c FROM arrived WHERE amount IS NOT NULL GROUP BY ALL) GROUP BY 1),
common AS (SELECT dataset_id, count(*) AS tied, count(*) FILTER (WHERE status IN ('F', 'O')) AS hits FROM (
             SELECT dataset_id, status, rank() OVER (PARTITION BY dataset_id ORDER BY count(*) DESC) AS place FROM arrived WHERE status IS NOT NULL GROUP BY 1, 2)
           WHERE place = 1 GROUP BY 1),
far AS (SELECT dataset_id, count(*) FILTER (WHERE abs(amount - am) / sd >= 2) AS n FROM arrived JOIN per USING (dataset_id) GROUP BY 1),
told AS (
  SELECT dataset_id, 0 AS idx, coalesce(r.n, 0) = 0 AS success, coalesce(r.n, 0) AS unexpected, NULL AS value FROM per LEFT JOIN repeats r USING (dataset_id)
  UNION ALL SELECT dataset_id, 1, coalesce(am >= 1000, false), 0, am FROM per UNION ALL SELECT dataset_id, 2, coalesce(sd <= 1e9, false), 0, sd FROM per
  UNION ALL SELECT dataset_id, 3, coalesce(qty >= 1e6, false), 0, qty FROM per UNION ALL SELECT dataset_id, 4, coalesce(low >= 1, false), 0, low FROM per
  UNION ALL SELECT dataset_id, 5, coalesce(high <= 7, false), 0, high FROM per UNION ALL SELECT dataset_id, 6, coalesce(kinds <= 5, false), 0, kinds FROM per
  UNION ALL SELECT dataset_id, 7, hits = 3, 0, NULL FROM per UNION ALL SELECT dataset_id, 8, hits = 1 AND tied = 1, 0, NULL FROM common
  UNION ALL SELECT dataset_id, 9, n >= 10, 0, n FROM per UNION ALL SELECT dataset_id, 10, f.n = 0, f.n, NULL FROM per JOIN far f USING (dataset_id))"""
ARRIVED = (
    *CORRUPTED, *q.conjoined("lighter", "applications", "light"),
    q.step("kept_1", "corrupted", {"n_lines": "trunc(n_lines)"}), q.step("kept_2", "lighter", {"n_lines": "trunc(n_lines)"}),
    f"arrived AS ({q.shown('kept_1').replace('SELECT', 'SELECT ' + repr('corrupt_1') + ' AS dataset_id,', 1)} UNION ALL "
    f"{q.shown('kept_2').replace('SELECT', 'SELECT ' + repr('corrupt_2') + ' AS dataset_id,', 1)})", PER_DATASET)
TOLD = """SELECT dataset_id, CAST(idx AS INTEGER) AS idx, success, CAST(unexpected AS BIGINT) AS unexpected_count, round(CAST(value AS DOUBLE), 2) AS value FROM told"""


def _told(df):
    value = F.when(F.col("idx").isin(1, 2, 3, 4, 5, 6, 9), F.round(F.col("observed_value").try_cast("double"), 2))
    return df.select("dataset_id", "idx", "success", "unexpected_count", value.alias("value"))


@query("f6_measures", q.with_ctes(*ARRIVED, select=TOLD))
def f6_measures(spark, folder):
    """Measures, uniqueness, distinct counts, the most common value and z-scores over files as they arrive, folded half way."""
    store = _store(spark)
    sink, checkpoint = fresh_path(spark, "sink"), fresh_path(spark, "stream")
    clean = staged(apps(spark, folder).select(*COLUMNS), "applications")  # for both versions
    store.save_derived("corrupted", corrupt.conjoined(clean, "severe", DOMAIN).repartition(3), "corrupt_1", "conjoined_corruption", "severe", "r1")
    schema = store.schema("corrupted")
    watch = lambda: arrivals.validate_arrivals(
        spark, store.path("corrupted"), schema, MEASURED, sink, checkpoint, files_per_batch=2).awaitTermination()
    watch()
    arrivals.compact(spark, schema, MEASURED, sink, 0)
    store.save_derived("corrupted", corrupt.conjoined(clean, "light", DOMAIN), "corrupt_2", "conjoined_corruption", "light", "r2")
    watch()
    return _told(arrivals.arrived_results(spark, schema, MEASURED, sink))


@query("e8_measures_by_group", q.with_ctes(*ARRIVED, select=TOLD))
def e8_measures(spark, folder):
    """The same rules per dataset of one table."""
    store = _store(spark)
    clean = staged(apps(spark, folder).select(*COLUMNS), "applications")  # for both versions
    for i, scenario in enumerate(("severe", "light"), 1):
        store.save_derived("corrupted", corrupt.conjoined(clean, scenario, DOMAIN), f"corrupt_{i}", "conjoined_corruption", scenario, f"r{i}")
    return _told(run_suite(store.read("corrupted"), MEASURED, ["dataset_id"]))
