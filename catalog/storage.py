"""Files, layers, result tables and the questions asked of them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Window, functions as F

from catalog import sqltext as q
from catalog.common import DOMAIN, SUITE, apps, corrupted, shown, staged, table
from catalog.registry import query
from catalog.scores import metrics_sql, scored
from plumbline.functions.cleaning import normalize_names, text_nulls
from plumbline.operators import evaluate
from plumbline.operators.expectations import run_suite
from plumbline.sources import layers, results
from plumbline.sources.csv import read_csv
from plumbline.sources.staging import fresh_path

HEADERS = {" Cust Key ": "bigint", "Market-Segment": "string", "Acct/Bal (EUR)": "double", "Nation\tKey__": "int"}


def _write_customers(spark, folder) -> str:
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    path = fresh_path(spark, "csv")
    table(spark, folder, "customer").select(
        F.col("c_custkey").alias(" Cust Key "),
        F.when(segment == "BUILDING", "NA").when(segment == "MACHINERY", "missing").otherwise(segment).alias("Market-Segment"),
        F.when(balance < 0, "n/a").otherwise(balance.cast("string")).alias("Acct/Bal (EUR)"),
        F.when(balance > 9000, None).otherwise(F.col("c_nationkey")).alias("Nation\tKey__"),
    ).write.option("sep", ";").option("header", True).csv(path)
    return path


@query("s1_csv_scan", """
SELECT c_custkey AS cust_key, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END AS market_segment,
       CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acctbal_eur_text,
       CAST(CASE WHEN c_acctbal <= 9000 THEN c_nationkey END AS DOUBLE) AS nation_key
FROM customer""".replace("acctbal_eur_text", "acct_bal_eur"))
def s1(spark, folder):
    schema = ", ".join(f"`{n}` {t}" for n, t in HEADERS.items())
    return read_csv(spark, _write_customers(spark, folder), schema, na_values=["missing"]).withColumn(
        "nation_key", F.col("nation_key").cast("double"))


@query("s2_normalized_names", """
SELECT s_suppkey AS supp_key_no, s_name AS name_of_supplier, s_nationkey AS nation, s_acctbal AS acct_bal FROM supplier""")
def s2(spark, folder):
    return normalize_names(table(spark, folder, "supplier").toDF("  Supp/Key -- No. ", "Name of\tSupplier", "__Nation__", "ACCT\\BAL!"))


@query("s3_contract", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def s3(spark, folder):
    return layers.require(table(spark, folder, "orders"), ["o_orderkey", "o_orderstatus", "o_totalprice"])


def _store(spark, domain=DOMAIN) -> layers.LayerStore:
    return layers.LayerStore(spark, fresh_path(spark, "store"), domain=domain)


STAMPS = ["data_source", "run_id", "dataset_id"]


@query("s4_raw_append", q.with_ctes(select=q.shown("applications").replace(
    " FROM applications", ", 'original_csv' AS data_source, 'first' AS run_id, 'il_240101_0000' AS dataset_id FROM applications")))
def s4(spark, folder):
    store = _store(spark)
    store.save_raw(apps(spark, folder), "il_240101_0000", "original_csv", "first")
    saved = store.read("raw")
    return shown(saved).join(saved.select("id", *STAMPS), "id")


@query("s4_repeated_run", """
SELECT dataset_id, run_id, count(*) AS n_rows FROM orders, (VALUES ('il_240101_0000', 'r1'), ('il_240101_0000', 'r2'), ('il_240101_0001', 'r1')) AS v(dataset_id, run_id)
GROUP BY ALL""")
def s4_repeated(spark, folder):
    """A run that is repeated replaces its rows; other runs and datasets keep theirs."""
    store = _store(spark)
    for dataset, run in (("il_240101_0000", "r1"), ("il_240101_0000", "r2"), ("il_240101_0001", "r1"), ("il_240101_0000", "r1")):
        store.save_raw(apps(spark, folder), dataset, "original_csv", run)
    return store.read("raw").groupBy("dataset_id", "run_id").agg(F.count(F.lit(1)).alias("n_rows"))


WHOLE = replace(DOMAIN, columns={**DOMAIN.columns, "amount": "int", "total_qty": "int", "avg_qty": "int"})


@query("s5_derived_append", q.with_ctes(*q.conjoined("corrupted", "applications", "severe"), select=f"""
SELECT id, id AS original_row_id, status, priority, segment, region, {', '.join(
    f"CAST(trunc(CAST({c} AS DOUBLE)) AS DOUBLE) AS {c}" for c in ("amount", "total_qty", "avg_qty", "n_lines", "category"))},
       avg_discount, 'conjoined_corruption' AS corruption_type, 'severe' AS corruption_scenario, 'r1' AS run_id,
       'corrupt_240101_0000' AS dataset_id FROM corrupted"""))
def s5(spark, folder):
    store = _store(spark, WHOLE)
    store.save_derived("corrupted", corrupted(spark, folder), "corrupt_240101_0000", "conjoined_corruption", "severe", "r1")
    saved = store.read("corrupted").drop("loaded_at")
    return saved.withColumns({c: F.col(c).cast("double") for c, t in WHOLE.columns.items() if t == "int"})


YEAR, QUARTER = "strftime(ordered_at, '%Y')", "CAST(quarter(ordered_at) AS VARCHAR)"


def _raw_by_year(spark, folder):
    """A raw layer with one dataset per year of order and one run per quarter."""
    df = apps(spark, folder)
    year = F.concat(F.lit("il_"), F.date_format("ordered_at", "yyyy"))
    run = F.concat(F.lit("q"), F.quarter("ordered_at").cast("string"))
    return layers.raw_rows(df, year, "original_csv", run, DOMAIN, loaded_at=F.col("ordered_at"))


RAW = f"""raw AS (SELECT *, 'il_' || {YEAR} AS dataset_id, 'q' || {QUARTER} AS run_id, ordered_at AS loaded_at FROM applications)"""


@query("s6_load_filtered", q.with_ctes(RAW, select=q.shown("raw") + " WHERE dataset_id = 'il_1996' AND run_id = 'q2'"))
def s6(spark, folder):
    store = _store(spark)
    store.append("raw", _raw_by_year(spark, folder))
    return shown(store.load("raw", dataset_id="il_1996", run_id="q2", data_source="original_csv"))


@query("s7_newest_features", q.with_ctes(RAW, select=q.shown(
    "(SELECT * FROM raw WHERE run_id = 'q3' ORDER BY id DESC LIMIT 1000)")))
def s7(spark, folder):
    store = _store(spark)
    store.append("raw", _raw_by_year(spark, folder))
    return shown(store.load_features("raw", limit=1000, run_id="q3"))


@query("s8_text_nulls", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS o_orderpriority FROM orders""")
def s8(spark, folder):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return text_nulls(table(spark, folder, "orders").select(
        "o_orderkey", F.when(status == "P", "[null]").otherwise(status).alias("o_orderstatus"),
        F.when(priority == "4-NOT SPECIFIED", "NaN").otherwise(priority).alias("o_orderpriority")))


def _stamped(df, *columns):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


@query("s9_metadata_upsert", q.with_ctes(RAW, """
old AS (SELECT dataset_id, count(*) AS n, min(loaded_at) AS c, max(loaded_at) AS u FROM raw WHERE dataset_id <= 'il_1997' GROUP BY 1)""", """
new AS (SELECT dataset_id, count(*) AS n, min(loaded_at) AS c, max(loaded_at) AS u FROM raw
        WHERE dataset_id >= 'il_1996' AND run_id <> 'q1' GROUP BY 1)""", select="""
SELECT 'raw_' || coalesce(new.dataset_id, old.dataset_id) AS dataset_name, 'raw' AS dataset_type,
       coalesce(new.n, old.n) AS row_count, CAST(10 AS BIGINT) AS column_count,
       strftime(coalesce(old.c, new.c), '%Y-%m-%d %H:%M:%S') AS created_at,
       strftime(coalesce(new.u, old.u), '%Y-%m-%d %H:%M:%S') AS updated_at, true AS is_active,
       coalesce(new.dataset_id, old.dataset_id) AS current_version
FROM old FULL JOIN new ON old.dataset_id = new.dataset_id"""))
def s9(spark, folder):
    raw = _raw_by_year(spark, folder)
    old = layers.metadata_of(raw.filter("dataset_id <= 'il_1997'"), "raw", len(DOMAIN.columns))
    new = layers.metadata_of(raw.filter("dataset_id >= 'il_1996' and run_id <> 'q1'"), "raw", len(DOMAIN.columns))
    return _stamped(layers.upsert_metadata(old, new), "created_at", "updated_at").drop("description", "data_quality_score")


GROUPS = ("dataset_id", "run_id")
DQ_LOG = [RAW, q.suite_results("found", "raw", SUITE, GROUPS), f"""
dq AS (SELECT f.dataset_id, f.run_id, count(*) AS total, count(*) FILTER (WHERE success) AS good,
       bool_and(success) AS overall_success,
       coalesce(bool_and(success) FILTER (WHERE expectation_type LIKE '%to_not_be_null%'), true) AS completeness_ok,
       coalesce(bool_and(success) FILTER (WHERE expectation_type LIKE '%to_be_in_set%'), true) AS consistency_ok,
       coalesce(string_agg(DISTINCT "column", ',' ORDER BY "column") FILTER (WHERE NOT success), '') AS failed_columns,
       count(*) FILTER (WHERE NOT success AND severity = 'critical') AS critical,
       count(*) FILTER (WHERE NOT success AND severity <> 'critical') AS warning, max(element_count) AS records,
       max(t.at) AS created_at
       FROM found f JOIN (SELECT dataset_id, run_id, max(loaded_at) AS at FROM raw GROUP BY 1, 2) t
       ON f.dataset_id = t.dataset_id AND f.run_id = t.run_id GROUP BY 1, 2)"""]


def _dq_log(spark, folder):
    """One validation per dataset and run of the raw layer, in a written log."""
    raw = staged(_raw_by_year(spark, folder), "raw")
    at = raw.groupBy(*GROUPS).agg(F.max("loaded_at").alias("at"))
    rows = results.dq_result_rows(run_suite(raw, SUITE, GROUPS), SUITE.name, DOMAIN.key_columns, created_at=F.lit(None))
    store = _store(spark)
    store.append("dq_results", rows.join(at, list(GROUPS)).withColumn("created_at", F.col("at")).drop("at").select(rows.columns))
    return store.read_log("dq_results")


@query("s10_dq_results", q.with_ctes(*DQ_LOG, select="""
SELECT dataset_id, run_id, 'order_applications' AS expectation_suite_name, CAST(total AS INTEGER) AS total_expectations,
       CAST(good AS INTEGER) AS successful_expectations, CAST(total - good AS INTEGER) AS failed_expectations,
       round(good / CAST(total AS DOUBLE) * 100, 2) AS success_rate, overall_success, completeness_ok, consistency_ok,
       failed_columns, CAST(critical AS INTEGER) AS critical_failures, CAST(warning AS INTEGER) AS warning_failures,
       records AS records_processed, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM dq"""))
def s10(spark, folder):
    return _stamped(_dq_log(spark, folder), "created_at").withColumns({
        "success_rate": F.col("success_rate").cast("double"), "failed_columns": F.array_join("failed_columns", ","),
    }).drop("key_columns_validation", "validation_duration_seconds")


@query("q4_recent_failures", q.with_ctes(*DQ_LOG, select="""
SELECT run_id, failed_columns, CAST(critical AS INTEGER) AS critical_failures,
       round(good / CAST(total AS DOUBLE) * 100, 2) AS success_rate, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
FROM dq WHERE dataset_id = 'il_1997' AND NOT overall_success ORDER BY dq.created_at DESC, run_id DESC LIMIT 3"""))
def q4(spark, folder):
    found = results.recent_failures(_dq_log(spark, folder), "il_1997", 3)
    return _stamped(found, "created_at").withColumns({
        "success_rate": F.col("success_rate").cast("double"), "failed_columns": F.array_join("failed_columns", ","),
    }).drop("expectation_suite_name")


@query("s13_dataset_ids", """
SELECT o_orderkey, 'il_' || strftime(o_orderdate, '%y%m%d_%H%M') AS loaded, 'corrupt_' || strftime(o_orderdate, '%y%m%d_%H%M') AS corrupted,
       'remed_' || strftime(o_orderdate, '%y%m%d_%H%M') AS remediated FROM orders""")
def s13(spark, folder):
    at = F.col("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey", layers.dataset_id("il", at).alias("loaded"), layers.dataset_id("corrupt", at).alias("corrupted"),
        layers.remediated_id(layers.dataset_id("corrupt", at)).alias("remediated"))


# --- lineage and overview -------------------------------------------------------------

@query("q1_lineage", q.with_ctes(RAW, select=" UNION ALL ".join(
    f"""SELECT '{n}' AS data_type, dataset_id, run_id, count(*) AS record_count,
        strftime(min(loaded_at), '%Y-%m-%d %H:%M:%S') AS first_load, strftime(max(loaded_at), '%Y-%m-%d %H:%M:%S') AS last_load
        FROM raw WHERE {w} GROUP BY 2, 3""" for n, w in (("raw", "true"), ("corrupted", "status <> 'P'"), ("remediated", "status = 'F'")))))
def q1(spark, folder):
    raw = _raw_by_year(spark, folder)
    return _stamped(layers.lineage(raw, raw.filter("status <> 'P'"), raw.filter("status = 'F'")), "first_load", "last_load")


@query("q2_dataset_overview", q.with_ctes(RAW, select="""
SELECT 'raw_' || dataset_id AS dataset_name, 'raw' AS dataset_type, count(*) AS row_count, CAST(10 AS BIGINT) AS column_count,
       strftime(min(loaded_at), '%Y-%m-%d %H:%M:%S') AS created_at, strftime(max(loaded_at), '%Y-%m-%d %H:%M:%S') AS updated_at,
       true AS is_active FROM raw GROUP BY dataset_id HAVING max(loaded_at) >= TIMESTAMP '1995-06-01'"""))
def q2(spark, folder):
    found = layers.metadata_of(_raw_by_year(spark, folder), "raw", len(DOMAIN.columns))
    found = found.withColumn("is_active", F.col("updated_at") >= F.lit("1995-06-01").cast("timestamp"))
    return _stamped(layers.dataset_overview(found), "created_at", "updated_at").drop("data_quality_score")


# --- model log ------------------------------------------------------------------------

ML_LOG = [RAW, *metrics_sql("raw", GROUPS), """
ml AS (SELECT m.*, row_number() OVER (PARTITION BY m.dataset_id, m.run_id ORDER BY accuracy DESC, model) = 1 AS is_best_model, t.loaded
       FROM metrics m JOIN (SELECT dataset_id, run_id, max(loaded_at) AS loaded FROM raw GROUP BY 1, 2) t
       ON m.dataset_id = t.dataset_id AND m.run_id = t.run_id)"""]


def _ml_log(spark, folder):
    """Metrics of two scores per dataset and run, as rows of the model log."""
    raw = staged(_raw_by_year(spark, folder), "raw")
    keys = [*GROUPS, "model"]
    measured = evaluate.test_metrics(scored(raw, GROUPS), keys).join(evaluate.roc_auc(scored(raw, GROUPS), keys), keys)
    at = raw.groupBy(*GROUPS).agg(F.max("loaded_at").alias("created_at"))
    place = F.row_number().over(Window.partitionBy(*GROUPS).orderBy(F.desc("accuracy"), "model"))
    four = {c: F.round(c, 4) for c in ("accuracy", "precision", "recall", "roc_auc")}
    return measured.withColumn("is_best_model", place == 1).join(at, list(GROUPS)).withColumns(
        four | {"f1_score": F.round("f1", 4), "model_name": F.col("model")}).drop("f1", "model")


AT = "strftime(loaded, '%Y-%m-%d %H:%M:%S') AS created_at"
SHORT = f"model AS model_name, round(accuracy, 4) AS accuracy, round(roc_auc, 4) AS roc_auc, {AT}"


@query("q3_all_best_models", q.with_ctes(*ML_LOG, select=f"SELECT dataset_id, {SHORT} FROM ml WHERE is_best_model"))
def q3(spark, folder):
    return _stamped(results.all_best_models(_ml_log(spark, folder)), "created_at")


@query("q5_best_models", q.with_ctes(*ML_LOG, select=f"""
SELECT {SHORT} FROM ml WHERE dataset_id = 'il_1995' AND is_best_model ORDER BY loaded DESC, model LIMIT 3"""))
def q5(spark, folder):
    return _stamped(results.best_models(_ml_log(spark, folder), "il_1995", 3), "created_at")


@query("q6_model_comparison", q.with_ctes(*ML_LOG, select="""
SELECT model AS model_name, round(accuracy, 4) AS accuracy, round(precision, 4) AS precision, round(recall, 4) AS recall,
       round(f1, 4) AS f1_score, round(roc_auc, 4) AS roc_auc, is_best_model FROM ml WHERE dataset_id = 'il_1996' AND run_id = 'q2'"""))
def q6(spark, folder):
    return results.model_comparison(_ml_log(spark, folder), "il_1996", "q2")


@query("q7_performance_history", q.with_ctes(*ML_LOG, select=f"""
SELECT run_id, round(accuracy, 4) AS accuracy, round(roc_auc, 4) AS roc_auc, {AT} FROM ml
WHERE dataset_id = 'il_1996' AND model = 'by_quantity' ORDER BY loaded DESC, run_id DESC LIMIT 3"""))
def q7(spark, folder):
    return _stamped(results.performance_history(_ml_log(spark, folder), "il_1996", "by_quantity", 3), "created_at")
