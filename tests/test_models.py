"""Targets, splits, folds, evaluation and the training run."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import evaluate, features


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(1003).select("id", F.when(F.col("id") % 4 == 0, 1).otherwise(0).alias("label")).cache()


def test_target(spark):
    df = spark.createDataFrame([(1, 1), (2, 2)], "id bigint, category int")
    assert [r["label"] for r in features.prepare_target(df).orderBy("id").collect()] == [0, 1]
    for bad in (3, None):
        with pytest.raises(ValueError):
            features.prepare_target(df.union(df.sparkSession.createDataFrame([(3, bad)], df.schema)))
    with pytest.raises(ValueError):
        features.prepare_target(df.drop("category"))


def test_split_and_folds_are_exact_per_class(labelled):
    split = features.stratified_split(labelled)
    got = {r["label"]: r["t"] for r in split.groupBy("label").agg(F.count_if("is_test").alias("t")).collect()}
    assert got == {1: 50, 0: 150}
    folds = features.stratified_folds(labelled, folds=5)
    sizes = {(r["label"], r["fold"]): r["count"] for r in folds.groupBy("label", "fold").count().collect()}
    assert sorted(v for (label, _), v in sizes.items() if label == 1) == [50, 50, 50, 50, 51]
    assert sorted(v for (label, _), v in sizes.items() if label == 0) == [150, 150, 150, 151, 151]
    assert folds.count() == 1003 and folds.filter("fold is null").count() == 0
    share = features.stratified_split(labelled, exact=False).filter("is_test").count() / 1003
    assert abs(share - 0.2) < 0.05


def test_no_window_over_a_class(labelled):
    plan = features.stratified_folds(labelled)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_scaling_and_unseen_categories(spark):
    train = spark.createDataFrame([(1, 1.0, 5.0, "a"), (2, 3.0, 5.0, "b")], "id bigint, x double, flat double, s string")
    test = spark.createDataFrame([(3, 5.0, 5.0, "zzz")], train.schema)
    a, b = features.vectorize(train, [test], ["x", "flat", "s"], ["id"])
    assert [r["features"].toArray().tolist() for r in a.orderBy("id").collect()] == [[-1, 0, 1, 0], [1, 0, 0, 1]]
    assert b.first()["features"].toArray().tolist() == [3, 0, 0, 0]


@pytest.mark.parametrize("spread", ["ties", "tiny", "huge"])
def test_auc_with_ties_matches_pair_counting(spark, spread):
    rng = np.random.default_rng(1)
    y, s = rng.integers(0, 2, 600), np.round(rng.random(600), 2)
    s[:200] = 0.5  # a third of the rows share one score
    s = {"ties": s, "tiny": 1 + s * 1e-9, "huge": np.exp(600 * (s - 0.5))}[spread]
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    pos, neg = s[y == 1][:, None], s[y == 0][None, :]
    want = ((pos > neg).sum() + 0.5 * (pos == neg).sum()) / (pos.size * neg.size)
    assert evaluate.roc_auc(df).first()["roc_auc"] == pytest.approx(want, abs=1e-12)


def test_ranges_of_any_scores_are_bounded(spark):
    """Nearly all scores within a hair of each other: no window holds more than its bits allow, and most hold few."""
    df = spark.range(50_000).select(F.lit(0).alias("m"), (1 + F.col("id") * 2.0 ** -50).alias("score"))
    keyed = evaluate.stats.with_ordered_key(df, "score", "key")
    largest = keyed.groupBy(F.shiftright("key", 20)).count().agg(F.max("count")).first()[0]
    assert keyed.select("key").distinct().count() == 50_000 and largest <= 1 << 20


def test_one_sided_predictions_give_zero_not_an_error(spark):
    df = spark.createDataFrame([("m", 0, 0, 0.1), ("m", 0, 0, 0.2)], "model string, label int, prediction int, score double")
    got = evaluate.test_metrics(df, ["model"]).first()
    assert (got["accuracy"], got["precision"], got["recall"], got["f1"]) == (1.0, 1.0, 1.0, 1.0)
    assert evaluate.roc_auc(df, ["model"]).first()["roc_auc"] is None
    assert evaluate.confusion(df, ["model"]).first().asDict() == {"model": "m", "n_00": 2, "n_01": 0, "n_10": 0, "n_11": 0}
    report = {r["class"]: r for r in evaluate.class_report(df, ["model"]).collect()}
    assert report["bad(1)"]["support"] == 0 and report["bad(1)"]["f1"] == 0 and report["macro avg"]["f1"] == 0.5


def test_comparison_keeps_the_given_order_on_ties(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.4)], "model string, accuracy double")
    got = evaluate.compare(df, ["b", "a", "c"]).collect()
    assert [(r["model"], r["is_best_model"]) for r in got] == [("b", True), ("a", False), ("c", False)]


def test_summary_uses_the_population_deviation(spark):
    df = spark.createDataFrame([("m", 1, 0.4, 0.4, 0.4, 0.4, 0.4), ("m", 0, 0.6, 0.6, 0.6, 0.6, 0.6)],
                               "model string, fold int, " + ", ".join(f"{m} double" for m in evaluate.METRICS))
    got = evaluate.cv_summary(df).filter("metric = 'f1'").first()
    assert got["mean"] == pytest.approx(0.5) and got["std"] == pytest.approx(0.1) and got["all_scores"] == [0.6, 0.4]


def test_imputation_from_training_rows_only(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, None), (3, 100.0, "b"), (4, 100.0, "b")], "id bigint, x double, s string")
    out = features.basic_imputation(df, ["x", "s"], df.filter("id = 1")).filter("id = 2").first()
    assert (out["x"], out["s"]) == (1.0, "a")
    out = features.basic_imputation(df, ["x", "s"]).filter("id = 2").first()
    assert (out["x"], out["s"]) == (100.0, "b")
    empty = features.basic_imputation(df.withColumn("s", F.lit(None).cast("string")), ["s"])
    assert {r["s"] for r in empty.collect()} == {"UNKNOWN"}
