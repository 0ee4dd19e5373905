"""Model metrics from a scored frame (label, prediction, score), per any keys.

Every metric comes from one count per (keys, label, prediction), the ROC area from counts
per distinct score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.operators import stats

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")
CLASS_NAMES = {0: "good(0)", 1: "bad(1)"}


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return _ratio(2 * p * r, p + r)


def confusion(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per key with the four cells n_<label><prediction>; absent cells are 0."""
    cell = lambda y, p: F.count_if((F.col("label") == y) & (F.col("prediction") == p))
    return scored.groupBy(*keys).agg(*[cell(y, p).alias(f"n_{y}{p}") for y in (0, 1) for p in (0, 1)])


def _class_metrics(counts: DataFrame) -> DataFrame:
    hit = {0: F.col("n_00"), 1: F.col("n_11")}
    support = {0: F.col("n_00") + F.col("n_01"), 1: F.col("n_10") + F.col("n_11")}
    told = {0: F.col("n_00") + F.col("n_10"), 1: F.col("n_01") + F.col("n_11")}
    out = counts.withColumns({f"support_{c}": support[c] for c in (0, 1)} | {
        f"precision_{c}": _ratio(hit[c], told[c]) for c in (0, 1)} | {
        f"recall_{c}": _ratio(hit[c], support[c]) for c in (0, 1)})
    out = out.withColumns({f"f1_{c}": _f1(F.col(f"precision_{c}"), F.col(f"recall_{c}")) for c in (0, 1)})
    return out.withColumn("total", F.col("support_0") + F.col("support_1"))


def _weighted(metric: str) -> Column:
    both = F.col(f"{metric}_0") * F.col("support_0") + F.col(f"{metric}_1") * F.col("support_1")
    return _ratio(both, F.col("total"))


def _scores() -> list[Column]:
    return [_ratio(F.col("n_00") + F.col("n_11"), F.col("total")).alias("accuracy"),
            *[_weighted(m).alias(m) for m in ("precision", "recall", "f1")]]


def test_metrics(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy and class-weighted precision, recall and F1."""
    return _class_metrics(confusion(scored, keys)).select(*keys, *_scores())


def roc_auc(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve with half credit for ties, exact.

    Scores become 64-bit keys of the same order, and counts per distinct score are summed over the
    keys' first bits and first two thirds. The running count that ranks need is taken over the first
    parts, within each over the second, and within these over the scores: no task orders more than
    2**22 rows of a key, however the scores are spread; a score that many rows share is one count.
    Keys without both classes give NULL."""
    counts = scored.withColumn("score", F.col("score").cast("double")).where(F.col("score").isNotNull() & ~F.isnan("score")).groupBy(*keys, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    counts = stats.with_ordered_key(counts, "score", "key").select(
        *keys, "pos", "neg", "key", F.shiftright("key", 42).alias("high"), F.shiftright("key", 20).alias("middle"))

    def before(rows, name, within, order):
        window = Window.partitionBy(*keys, *within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(name, F.coalesce(F.sum("neg").over(window), F.lit(0)))

    middle = counts.groupBy(*keys, "high", "middle").agg(F.sum("neg").alias("neg"))
    high = before(middle.groupBy(*keys, "high").agg(F.sum("neg").alias("neg")), "offset", [], "high").drop("neg")
    middle = before(middle, "within", ["high"], "middle").join(high, [*keys, "high"])
    middle = middle.select(*keys, "middle", (F.col("offset") + F.col("within")).alias("offset"))
    joined = before(counts, "below", ["middle"], "key").join(middle, [*keys, "middle"])
    won = F.sum(F.col("pos").cast("double") * (F.col("offset") + F.col("below") + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return joined.groupBy(*keys).agg(F.try_divide(won, pairs).alias("roc_auc"))


def evaluate(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All metrics, the confusion matrix as [[n00, n01], [n10, n11]] and the class report, one row per key.

    All but the ROC area come from one count."""
    cell = lambda y, p: F.col(f"n_{y}{p}")
    matrix = F.array(F.array(cell(0, 0), cell(0, 1)), F.array(cell(1, 0), cell(1, 1)))
    counted = _class_metrics(confusion(scored, keys))
    return counted.select(*keys, *_scores(), matrix.alias("confusion_matrix"), F.array(*_report_lines()).alias("classification_report")).join(
        roc_auc(scored, keys), list(keys))


def _report_lines() -> list[Column]:
    line = lambda name, p, r, f, s: F.struct(
        F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"), s.alias("support"))
    rows = [line(CLASS_NAMES[c], F.col(f"precision_{c}"), F.col(f"recall_{c}"), F.col(f"f1_{c}"), F.col(f"support_{c}"))
            for c in (0, 1)]
    macro = [(F.col(f"{m}_0") + F.col(f"{m}_1")) / 2 for m in ("precision", "recall", "f1")]
    rows.append(line("macro avg", *macro, F.col("total")))
    rows.append(line("weighted avg", *[_weighted(m) for m in ("precision", "recall", "f1")], F.col("total")))
    return rows


def class_report(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages."""
    return _class_metrics(confusion(scored, keys)).select(*keys, F.inline(F.array(*_report_lines())))


def fold_scores(scored: DataFrame, model: str = "model", fold: str = "fold") -> DataFrame:
    """The five scores of every model and fold."""
    keys = [model, fold]
    return test_metrics(scored, keys).join(roc_auc(scored, keys), keys)


def cv_summary(scores: DataFrame, keys: Sequence[str] = ("model",), fold: str = "fold") -> DataFrame:
    """Mean, population deviation and all scores by fold, one row per model and metric."""
    long = scores.select(*keys, fold, F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS])))
    return long.groupBy(*keys, "metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.transform(F.array_sort(F.collect_list(F.struct(fold, "value"))), lambda x: x["value"]).alias("all_scores"),
    )


def compare(metrics: DataFrame, order: Sequence[str], model: str = "model") -> DataFrame:
    """Models by accuracy, best first; equal ones keep the given order. Marks the best."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col(model))
    best = metrics.agg(F.min(F.struct((-F.col("accuracy")).alias("a"), place.alias("p"))).alias("best"))
    return (
        metrics.crossJoin(F.broadcast(best))  # one row
        .withColumn("is_best_model", (place == F.col("best.p")))
        .orderBy(F.desc("accuracy"), place).drop("best")
    )
