"""Feature preparation, splits, evaluation and the two classifiers."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog import sqltext as q
from catalog.common import DOMAIN, apps, rounded, shown, staged
from catalog.registry import query
from catalog.scores import MODELS, metrics_sql, scored
from plumbline.functions.cleaning import printed
from plumbline.operators import corrupt, evaluate, features, models
from plumbline.plans import training

FEATURES = DOMAIN.features


def _gaps(spark, folder):
    return staged(corrupt.missing_values(apps(spark, folder).select("id", *q.NAMES), "severe", DOMAIN), "gaps")


@query("m1_target", q.with_ctes(select="SELECT id, category - 1 AS label FROM applications"))
def m1(spark, folder):
    return features.prepare_target(apps(spark, folder)).select("id", "label")


@query("m2_simple_imputation", q.with_ctes(q.missing("m", "applications", "severe"), q.step("filled", "m", {
    **{c: f"coalesce(CAST({c} AS DOUBLE), {q.quantile(c, 0.5, 'm')})" for c in q.NUMBERS if c != "category"},
    **{c: f"coalesce({c}, {q.mode_of(c, 'm')}, 'UNKNOWN')" for c in q.TEXTS}}), select=q.shown("filled", 4)))
def m2(spark, folder):
    return shown(features.basic_imputation(_gaps(spark, folder), FEATURES), 4)


SCALED = ["amount", "total_qty", "n_lines"]


@query("m4_scaling", q.with_ctes(select="SELECT id, " + ", ".join(
    f"round((CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM applications)) / (SELECT stddev_pop({c}) FROM applications), 6) AS {c}"
    for c in SCALED) + " FROM applications"))
def m4_scaled(spark, folder):
    return rounded(features.scaled(apps(spark, folder), SCALED).select("id", *SCALED))


@query("m4_vectors")
def m4_vectors(spark, folder):
    filled = staged(features.basic_imputation(apps(spark, folder).select("id", *FEATURES), FEATURES), "filled")
    vectors, = features.vectorize(filled, [], FEATURES, ["id"])
    return vectors.select("id", F.transform(vector_to_array("features"), lambda v: F.round(v, 6)).alias("features"))


@query("m5_split", q.with_ctes(select=f"""
SELECT id, row_number() OVER (PARTITION BY category ORDER BY {q.ticket('split')}, id)
       <= round(0.2 * count(*) OVER (PARTITION BY category)) AS is_test FROM applications"""))
def m5(spark, folder):
    return features.stratified_split(features.prepare_target(staged(apps(spark, folder), "applications"))).select("id", "is_test")


def _cells_sql() -> str:
    """Every cell of the vectors: scaled numbers in order, then one place per category, in alphabetical order within each column."""
    parts, numbers, texts = [], [c for c in FEATURES if c in q.NUMBERS], [c for c in FEATURES if c in q.TEXTS]
    for i, c in enumerate(numbers):
        parts.append(f"SELECT id, {i} AS place, ({c} - (SELECT avg({c}) FROM n)) / coalesce(nullif((SELECT stddev_pop({c}) FROM n), 0), 1) AS value FROM n")
    for c in texts:
        ahead = " + ".join([str(len(numbers)), *[f"(SELECT count(DISTINCT {t}) FROM n)" for t in texts[:texts.index(c)]]])
        parts.append(f"SELECT id, CAST({ahead} + k AS INTEGER), CAST({c} = v AS DOUBLE) FROM n, (SELECT v, row_number() OVER (ORDER BY v) - 1 AS k FROM (SELECT DISTINCT {c} AS v FROM n))")
    return " UNION ALL ".join(parts)


@query("m4_vector_cells", q.with_ctes(
    q.step("filled", "applications", {**{c: f"coalesce(CAST({c} AS DOUBLE), {q.quantile(c, 0.5, 'applications')})" for c in q.NUMBERS if c != "category"},
                                      **{c: f"coalesce({c}, {q.mode_of(c, 'applications')}, 'UNKNOWN')" for c in q.TEXTS}}),
    "n AS (SELECT * FROM filled)", f"cells AS ({_cells_sql()})", select="SELECT id, CAST(place AS INTEGER) AS place, round(value, 6) + 0.0 AS value FROM cells"))
def m4_cells(spark, folder):
    return m4_vectors(spark, folder).select("id", F.posexplode("features").alias("place", "value")).withColumn("value", F.col("value") + 0.0)


NEWTON_STEPS = 8


def _newton_sql() -> list[str]:
    """Logistic regression of the label on two scaled columns by unrolled Newton steps: weights by class, L2 of strength 1 but for the intercept."""
    ctes = ["""base AS (
  SELECT id, is_test, CAST(category = 2 AS DOUBLE) AS y, (amount - (SELECT avg(amount) FROM split WHERE NOT is_test)) / (SELECT stddev_pop(amount) FROM split WHERE NOT is_test) AS x1,
         (n_lines - (SELECT avg(n_lines) FROM split WHERE NOT is_test)) / (SELECT stddev_pop(n_lines) FROM split WHERE NOT is_test) AS x2,
         (SELECT count(*) FROM split WHERE NOT is_test) / (2.0 * (SELECT count(*) FROM split s WHERE NOT s.is_test AND s.category = split.category)) AS w
  FROM split)""", "b0 AS (SELECT CAST(0 AS DOUBLE) AS b1, CAST(0 AS DOUBLE) AS b2, CAST(0 AS DOUBLE) AS c)"]
    for i in range(NEWTON_STEPS):
        ctes.append(f"""g{i} AS (
  SELECT any_value(b1) AS b1, any_value(b2) AS b2, any_value(c) AS c, sum(w * (p - y) * x1) + any_value(b1) AS g1, sum(w * (p - y) * x2) + any_value(b2) AS g2, sum(w * (p - y)) AS g3,
         sum(w * p * (1 - p) * x1 * x1) + 1 AS a, sum(w * p * (1 - p) * x1 * x2) AS b, sum(w * p * (1 - p) * x1) AS d, sum(w * p * (1 - p) * x2 * x2) + 1 AS e,
         sum(w * p * (1 - p) * x2) AS f, sum(w * p * (1 - p)) AS h
  FROM (SELECT base.*, b{i}.*, 1 / (1 + exp(-(b1 * x1 + b2 * x2 + c))) AS p FROM base, b{i} WHERE NOT is_test))""")
        # the solution of the symmetric system [[a, b, d], [b, e, f], [d, f, h]] by cofactors
        det = "(a * (e * h - f * f) - b * (b * h - f * d) + d * (b * f - e * d))"
        ctes.append(f"""b{i + 1} AS (
  SELECT b1 - ((e * h - f * f) * g1 + (d * f - b * h) * g2 + (b * f - d * e) * g3) / {det} AS b1,
         b2 - ((d * f - b * h) * g1 + (a * h - d * d) * g2 + (b * d - a * f) * g3) / {det} AS b2,
         c - ((b * f - d * e) * g1 + (b * d - a * f) * g2 + (a * e - b * b) * g3) / {det} AS c FROM g{i})""")
    return ctes


@query("m6_two_features", q.with_ctes(f"""split AS (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY {q.ticket('split')}, id) <= round(0.2 * count(*) OVER (PARTITION BY category)) AS is_test FROM applications
  WHERE amount IS NOT NULL AND n_lines IS NOT NULL)""", *_newton_sql(), select=f"""
SELECT id, CAST(y AS INTEGER) AS label, round(1 / (1 + exp(-(b1 * x1 + b2 * x2 + c))), 6) AS score FROM base, b{NEWTON_STEPS} WHERE is_test"""))
def m6_two(spark, folder):
    kept = apps(spark, folder).where("amount IS NOT NULL AND n_lines IS NOT NULL").select("id", "amount", "n_lines", "category")
    ready = staged(features.stratified_split(features.prepare_target(staged(kept, "kept"))), "split")
    found = training.fit_and_score(ready, [training.held_out()], ["logistic_regression"], ["amount", "n_lines"], ["id"])
    return found.select("id", "label", F.round("score", 6).alias("score"))


def _ready(spark, folder):
    return training.prepare(apps(spark, folder), DOMAIN)


def _trained(name):
    def run(spark, folder):
        ready = _ready(spark, folder)
        found = training.fit_and_score(ready, [training.held_out()], [name], FEATURES, ["id"])
        return found.select("id", "model", "label", "prediction", F.round("score", 6).alias("score"))
    return run


query("m6_logistic_regression")(_trained("logistic_regression"))
query("m7_random_forest")(_trained("random_forest"))

METRICS = metrics_sql("applications")
MEASURES = ", ".join(f"round({m}, 6) AS {m}" for m in ("accuracy", "precision", "recall", "f1"))


@query("m9_test_metrics", q.with_ctes(*METRICS, select=f"SELECT model, {MEASURES} FROM metrics"))
def m9(spark, folder):
    return rounded(evaluate.test_metrics(scored(apps(spark, folder)), ["model"]))


@query("m10_roc_auc", q.with_ctes(*METRICS, select="SELECT model, round(roc_auc, 6) AS roc_auc FROM metrics"))
def m10(spark, folder):
    return rounded(evaluate.roc_auc(staged(scored(apps(spark, folder)), "scored"), ["model"]))


@query("m11_confusion", q.with_ctes(*METRICS, select="SELECT model, n00 AS n_00, n01 AS n_01, n10 AS n_10, n11 AS n_11 FROM metrics"))
def m11(spark, folder):
    return evaluate.confusion(scored(apps(spark, folder)), ["model"])


@query("m11_class_report", q.with_ctes(*METRICS, select="""
SELECT model, 'good(0)' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, s0 AS support FROM parts2
UNION ALL SELECT model, 'bad(1)', round(p1, 6), round(r1, 6), round(f1_1, 6), s1 FROM parts2
UNION ALL SELECT model, 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1_1) / 2, 6), s0 + s1 FROM parts2
UNION ALL SELECT model, 'weighted avg', round((p0 * s0 + p1 * s1) / (s0 + s1), 6), round((r0 * s0 + r1 * s1) / (s0 + s1), 6),
       round((f0 * s0 + f1_1 * s1) / (s0 + s1), 6), s0 + s1 FROM parts2"""))
def m11_report(spark, folder):
    return rounded(evaluate.class_report(scored(apps(spark, folder)), ["model"]))


FOLDED = f"""folded AS (SELECT *, CAST(ntile(5) OVER (PARTITION BY category ORDER BY {q.ticket('fold')}, id) - 1 AS INTEGER) AS fold
  FROM applications)"""


@query("m12_folds", q.with_ctes(FOLDED, select="SELECT id, fold FROM folded"))
def m12(spark, folder):
    return features.stratified_folds(features.prepare_target(staged(apps(spark, folder), "applications"))).select("id", "fold")


@query("m12_cv_summary", q.with_ctes(FOLDED, *metrics_sql("folded", ("fold",)), select=" UNION ALL ".join(f"""
SELECT model, '{m}' AS metric, round(avg({m}), 6) AS mean, round(stddev_pop({m}), 6) AS std,
       string_agg(printf('%.4f', {m}), ',' ORDER BY fold) AS all_scores FROM metrics GROUP BY model""" for m in evaluate.METRICS)))
def m12_summary(spark, folder):
    folded = features.stratified_folds(apps(spark, folder).withColumn("label", F.col("category")))
    summary = evaluate.cv_summary(evaluate.fold_scores(staged(scored(folded, ["fold"]), "scored")))
    shown_scores = F.array_join(F.transform("all_scores", lambda v: printed(v, 4)), ",")
    return rounded(summary.withColumn("all_scores", shown_scores))


@query("m13_comparison", q.with_ctes(*METRICS, select=f"""
SELECT model, {MEASURES}, row_number() OVER (ORDER BY accuracy DESC, model DESC) = 1 AS is_best_model FROM metrics"""))
def m13(spark, folder):
    return rounded(evaluate.compare(evaluate.test_metrics(scored(apps(spark, folder)), ["model"]), MODELS))


@query("s11_ml_results", q.with_ctes(*METRICS, "best AS (SELECT *, row_number() OVER (ORDER BY accuracy DESC, model DESC) = 1 AS is_best_model FROM metrics)",
                                     FOLDED.replace("folded AS", "folds AS"),
                                     *[c.replace("scored AS", "f_scored AS").replace("FROM scored", "FROM f_scored")
                                       .replace("cells AS", "f_cells AS").replace("FROM cells", "FROM f_cells")
                                       .replace("parts AS", "f_parts AS").replace("FROM parts)", "FROM f_parts)")
                                       .replace("parts2 AS", "f_parts2 AS").replace("FROM parts2 JOIN auc", "FROM f_parts2 JOIN f_auc")
                                       .replace("auc AS", "f_auc AS").replace("roc_f_auc AS", "roc_auc AS").replace("metrics AS", "f_metrics AS")
                                       for c in metrics_sql("folds", ("fold",))], select="""
SELECT 'remed_240101_0000' AS dataset_id, 'r1' AS run_id, b.model AS model_name, round(b.accuracy, 4) AS accuracy,
       round(b.roc_auc, 4) AS roc_auc, round(coalesce(c.am, 0), 4) AS cv_accuracy_mean, round(coalesce(c.ad, 0), 4) AS cv_accuracy_std,
       '[[' || n00 || ',' || n01 || '],[' || n10 || ',' || n11 || ']]' AS confusion_matrix, is_best_model
FROM best b LEFT JOIN (SELECT model, avg(accuracy) AS am, stddev_pop(accuracy) AS ad FROM f_metrics
                       WHERE model = 'by_lines' GROUP BY 1) c ON b.model = c.model"""))
def s11(spark, folder):
    from plumbline.sources import results
    from plumbline.sources.layers import LayerStore
    from plumbline.sources.staging import fresh_path
    folded = features.stratified_folds(apps(spark, folder).withColumn("label", F.col("category")))
    rows = staged(scored(folded, ["id", "fold"]), "scored")
    metrics = evaluate.compare(evaluate.evaluate(rows, ["model"]), MODELS)
    summary = evaluate.cv_summary(evaluate.fold_scores(rows.filter("model = 'by_lines'")))  # the other has no cross-validation
    store = LayerStore(spark, fresh_path(spark, "store"), domain=DOMAIN)
    store.append("ml_results", results.ml_result_rows(
        metrics, summary, dataset_id="remed_240101_0000", run_id="r1", test_size=0.2, folds=5, seed=42))
    four = ("accuracy", "roc_auc", "cv_accuracy_mean", "cv_accuracy_std")
    return store.read_log("ml_results").select(
        "dataset_id", "run_id", "model_name", *[F.col(c).cast("double").alias(c) for c in four],
        F.to_json("confusion_matrix").alias("confusion_matrix"), "is_best_model")


@query("m14_training_run")
def m14(spark, folder):
    rows = staged(apps(spark, folder), "applications")
    found = training.run_training(rows, DOMAIN, baseline=rows)
    return rounded(found.metrics.drop("confusion_matrix"))
