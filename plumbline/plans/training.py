"""Train and compare the classifiers on a table: prepare, split, fit, evaluate, cross-validate."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.domain import CREDIT, Domain
from plumbline.functions.cleaning import numeric_columns
from plumbline.operators import drift, evaluate, features, forest, models, stats
from plumbline.operators.logistic import Scale, matrix
from plumbline.sources import results as result_tables
from plumbline.sources.layers import LayerStore
from plumbline.sources.staging import staged

# Run parameters (fixed values).
TEST_SIZE, FOLDS, SEED = 0.2, 5, 42
SCORED_TOGETHER = 131_072  # rows that a task scores in one call


@dataclass(frozen=True)
class TrainingResult:
    test_scores: DataFrame
    metrics: DataFrame
    cv_scores: DataFrame
    cv_summary: DataFrame
    drift: DataFrame | None = None

    def alerts(self) -> DataFrame | None:
        return None if self.drift is None else drift.alerts(self.drift)


def prepare(df: DataFrame, domain: Domain = CREDIT, *, key: str = "id", seed: int = SEED, test_size: float = TEST_SIZE,
            folds: int = FOLDS, impute_on: str = "all") -> DataFrame:
    """Key, imputed features, label, is_test and fold, written once for all the fits.

    ``impute_on="all"`` takes the fill values from the whole table, "train" from its training rows."""
    if impute_on not in ("all", "train"):
        raise ValueError(f"impute_on must be 'all' or 'train': {impute_on}")
    kept = staged(df.select(key, *domain.features, domain.target), "kept")  # every count below is a pass of its own
    labelled = features.prepare_target(kept, domain.target)
    split = features.stratified_folds(
        features.stratified_split(labelled, test_size=test_size, key=key, seed=seed), folds=folds, key=key, seed=seed)
    split = staged(split, "split")
    source = split if impute_on == "all" else split.filter(~F.col("is_test"))
    return staged(features.basic_imputation(split, domain.features, source), "prepared")


@dataclass(frozen=True)
class Run:
    """Rows to fit on and rows to score, as conditions."""

    train: Column
    test: Column


def _scales(rows: DataFrame, runs: Sequence[Run], numbers: Sequence[str]) -> list[Scale]:
    """Means, deviations and balanced class weights of every run, in one aggregate."""
    wanted = {}
    for i, run in enumerate(runs):
        for c in numbers:
            value = F.when(run.train, F.col(c).cast("double"))
            wanted[i, c, "mean"], wanted[i, c, "sd"] = F.avg(value), F.stddev_pop(value)
        for v in (0, 1):
            wanted[i, v] = F.count_if(run.train & (F.col("label") == v))
    found = stats.scalars(rows, wanted)
    out = []
    for i in range(len(runs)):
        sizes = {v: found[i, v] for v in (0, 1)}
        classes = sum(n > 0 for n in sizes.values())
        if not classes:
            raise ValueError("no rows to fit on")
        out.append(Scale([found[i, c, "mean"] or 0.0 for c in numbers], [found[i, c, "sd"] or 1.0 for c in numbers],
                         {v: sum(sizes.values()) / (classes * n) if n else 0.0 for v, n in sizes.items()}))
    return out


def fit_and_score(ready: DataFrame, runs: Sequence[Run], names: Sequence[str], columns: Sequence[str], keep: Sequence[str],
                  params: Mapping[str, dict] | None = None, key: str = "id") -> DataFrame:
    """``(keep, run, model, label, prediction, score)``: every model fitted on every run's training rows, its test rows scored.

    The table is encoded and written once. All runs of a model are fitted together, and all rows are
    scored in one pass. ``keep`` holds the key.
    """
    params = params or {}
    numbers = numeric_columns(ready, columns)
    scales = _scales(ready, runs, numbers)
    vectors = features.encoder(ready, columns).transform(ready).select(
        *keep, F.col("label").cast("int").alias("label"), vector_to_array("features").alias("features"),
        F.array(*[r.train for r in runs]).alias("trains"), F.array(*[r.test for r in runs]).alias("tests"))
    settings = {name: models.MODELS[name](**params.get(name, {})) for name in names}
    settings = {name: replace(s, key=key) if hasattr(s, "key") else s for name, s in settings.items()}
    # forests grow with the table and score where they are grown; the other models are sent to the rows
    grown = [name for name in names if hasattr(settings[name], "score_all")]
    if grown:
        vectors, keep = forest.placed(vectors, key), [*keep, forest.PLACE]
    vectors = staged(vectors, "vectors")
    width = vectors.select(F.size("features")).first()[0]
    fitted = {name: settings[name].fit_all(vectors, scales, width) for name in names if name not in grown}
    if fitted:
        rows = _scored(vectors, fitted, list(fitted), keep, width)
    else:
        rows = vectors.select(*keep, "label", F.posexplode("tests").alias("run", "tested")).where("tested").drop("tested")
    scores = {name: F.col("scores")[j] for j, name in enumerate(fitted)}
    for name in grown:
        rows = rows.join(settings[name].score_all(vectors, scales, width).withColumnRenamed("score", f"_{name}"), [forest.PLACE, "run"])
        scores[name] = F.col(f"_{name}")
    keep = [c for c in keep if c != forest.PLACE]
    each = F.array(*[F.struct(F.lit(name).alias("model"), scores[name].alias("score")) for name in names])
    rows = rows.select(*keep, "run", "label", F.inline(each))
    return rows.select(*keep, "run", "model", "label", (F.col("score") > 0.5).cast("int").alias("prediction"), "score")


def _scored(vectors: DataFrame, fitted: Mapping[str, list], names: Sequence[str], keep: Sequence[str], width: int) -> DataFrame:
    """``(keep, run, label, scores)`` for every row and run that tests it. A task's rows of one run are scored
    ``SCORED_TOGETHER`` at a time, since a tree costs the same calls for one row and for many."""
    shared = vectors.sparkSession.sparkContext.broadcast(fitted)

    def score(i: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        x = matrix(rows["features"], width)
        scores = np.stack([shared.value[name][i].scores(x) for name in names], axis=1)
        ends = pa.array(np.arange(0, scores.size + 1, len(names), dtype=np.int32))
        return pa.RecordBatch.from_arrays(
            [*[rows[c] for c in keep], pa.array(np.full(len(x), i, np.int32)), rows["label"], pa.ListArray.from_arrays(ends, pa.array(scores.ravel()))],
            [*keep, "run", "label", "scores"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            tests = matrix(batch["tests"], len(batch["tests"][0]))
            for i in range(tests.shape[1]):
                mine = batch.filter(pa.array(tests[:, i]))
                if not mine.num_rows:
                    continue
                parts = waiting.setdefault(i, [])
                parts.append(mine)
                if sum(p.num_rows for p in parts) >= SCORED_TOGETHER:
                    yield score(i, waiting.pop(i))
        for i, parts in waiting.items():
            yield score(i, parts)

    rows = vectors.select(*keep, "label", "features", "tests")
    kept = T.StructType([rows.schema[c] for c in keep])
    out = kept.add("run", T.IntegerType()).add("label", T.IntegerType()).add("scores", T.ArrayType(T.DoubleType()))
    return rows.mapInArrow(run, out)


def held_out() -> Run:
    return Run(~F.col("is_test"), F.col("is_test"))


def cross_validation(folds: int) -> list[Run]:
    return [Run(F.col("fold") != i, F.col("fold") == i) for i in range(folds)]


def run_training(df: DataFrame, domain: Domain = CREDIT, *, key: str = "id", seed: int = SEED,
                 test_size: float = TEST_SIZE, folds: int = FOLDS, impute_on: str = "all",
                 params: Mapping[str, dict] | None = None, baseline: DataFrame | None = None,
                 bins: str = "shared") -> TrainingResult:
    """Both models on the split, cross-validated over the whole table, with drift against a baseline."""
    ready = prepare(df, domain, key=key, seed=seed, test_size=test_size, folds=folds, impute_on=impute_on)
    columns = domain.features
    order = list(models.MODELS)
    scored = staged(fit_and_score(ready, [held_out(), *cross_validation(folds)], order, columns, [key, "fold"], params, key), "scores")
    test_scores = scored.where("run = 0").drop("run", "fold")
    fold_rows = scored.where("run > 0").drop("run")
    metrics = evaluate.compare(evaluate.evaluate(test_scores, ["model"]), order)
    cv_scores = evaluate.fold_scores(fold_rows)
    report = drift.report(baseline, ready, columns, bins) if baseline is not None else None
    return TrainingResult(test_scores, metrics, cv_scores, evaluate.cv_summary(cv_scores), report)


def train_and_score(store: LayerStore, *, dataset_id: str, run_id: str, layer: str = "remediated",
                    limit: int | None = None, baseline_source: str | None = None, **options) -> TrainingResult:
    """Load the feature columns of a dataset, train on them and append the model log."""
    df = store.load_features(layer, limit, dataset_id=dataset_id)
    baseline = store.load("raw", ordered=False, data_source=baseline_source) if baseline_source else None
    result = run_training(df, store.domain, baseline=baseline, **options)
    store.append("ml_results", result_tables.ml_result_rows(
        result.metrics, result.cv_summary, dataset_id=dataset_id, run_id=run_id,
        test_size=options.get("test_size", TEST_SIZE), folds=options.get("folds", FOLDS), seed=options.get("seed", SEED)))
    return result
