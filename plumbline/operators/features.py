"""From a repaired table to training frames: target, imputation, split, folds, vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions.cleaning import numeric_columns, text_columns
from plumbline.functions.draws import key_of, ticket, with_key, without_key
from plumbline.operators import stats

UNKNOWN = "UNKNOWN"


def prepare_target(df: DataFrame, target: str = "category", label: str = "label") -> DataFrame:
    """Class 1 to 0 and class 2 to 1; anything else is an error, found in one counting pass."""
    if target not in df.columns:
        raise ValueError(f"no target column {target!r}")
    mapped = F.when(F.col(target) == 1, 0).when(F.col(target) == 2, 1)
    strange = df.agg(F.count_if(mapped.isNull()).alias("n")).first()["n"]
    if strange:
        raise ValueError(f"{strange} rows have a target other than 1 or 2")
    return df.withColumn(label, mapped).drop(target)


def basic_imputation(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Numbers to the median, categories to the most frequent value or UNKNOWN.

    Statistics come from ``fit_on``, by default the whole table."""
    source = df if fit_on is None else fit_on
    numbers, texts = numeric_columns(df, columns), text_columns(df, columns)
    medians = stats.quantiles(source, {c: (F.col(c), [0.5]) for c in numbers})
    tops = stats.top_values(source, {c: F.col(c) for c in texts})
    fills: dict[str, Column] = {}
    for c in numbers:
        if medians[c][0] is not None:
            fills[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(medians[c][0])))
    for c in texts:
        fills[c] = F.coalesce(F.col(c), F.lit(tops[c].value if c in tops else UNKNOWN))
    return df.withColumns(fills)


def scaled(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation; a constant column only loses its mean."""
    source = df if fit_on is None else fit_on
    about = stats.scalars(source, {(c, m): f(c) for c in columns for m, f in (("mean", F.avg), ("sd", F.stddev_pop))})
    return df.withColumns({
        c: (F.col(c).cast("double") - F.lit(about[c, "mean"])) / F.lit(about[c, "sd"] or 1.0) for c in columns
        if about[c, "mean"] is not None
    })


def encoder(df: DataFrame, columns: Sequence[str], output: str = "features") -> PipelineModel:
    """One-hot encode the categories and assemble all columns; categories that fitting did not
    see become all zeros. Numbers are expected to be scaled already."""
    numbers, texts = numeric_columns(df, columns), text_columns(df, columns)
    stages = []
    if texts:
        stages = [
            StringIndexer(inputCols=texts, outputCols=[f"{c}_index" for c in texts], handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=[f"{c}_index" for c in texts], outputCols=[f"{c}_hot" for c in texts], dropLast=True),
        ]
    stages.append(VectorAssembler(inputCols=[*numbers, *[f"{c}_hot" for c in texts]], outputCol=output))
    return Pipeline(stages=stages).fit(df)


def vectorize(train: DataFrame, others: Sequence[DataFrame], columns: Sequence[str], keep: Sequence[str]) -> list[DataFrame]:
    """Scaling and encoding fitted on ``train``, applied to it and to the others."""
    numbers = numeric_columns(train, columns)
    moved = [scaled(df, numbers, fit_on=train) for df in (train, *others)]
    model = encoder(moved[0], columns)
    return [model.transform(df).select(*keep, "features") for df in moved]


def _label_tickets(df: DataFrame, label: str, key: str, tag: str, seed: int):
    draw = ticket(tag, seed)
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per class
    return F.expr(key_of(df, key)), {value: (F.when(F.col(label) == F.lit(value), draw), n) for value, n in sizes.items() if value is not None}


def stratified_split(df: DataFrame, label: str = "label", *, test_size: float = 0.2, key: str = "id",
                     seed: int = 42, output: str = "is_test", exact: bool = True) -> DataFrame:
    """Mark ``test_size`` of every class, rounded, as test rows. The class sizes and one threshold
    per class decide it, so no class is ever sorted in one task. ``exact=False`` only draws."""
    if not exact:
        drawn = with_key(df, key).withColumn(output, ticket("split", seed) < F.lit(int(test_size * (1 << 53))))
        return without_key(drawn)
    df = with_key(df, key)
    k, classes = _label_tickets(df, label, key, "split", seed)
    cuts = stats.ticket_cuts(df, {str(v): (t, [int(test_size * n + 0.5)]) for v, (t, n) in classes.items()}, k)
    chosen = F.lit(False)
    for v in classes:
        chosen = chosen | cuts[str(v)][0]
    return without_key(df.withColumn(output, chosen))


def stratified_folds(df: DataFrame, label: str = "label", *, folds: int = 5, key: str = "id", seed: int = 42,
                     output: str = "fold") -> DataFrame:
    """Number every row 0..folds-1, evenly within each class: the shuffled class is cut into
    ``folds`` runs whose sizes differ by one at most."""
    df = with_key(df, key)
    k, classes = _label_tickets(df, label, key, "fold", seed)
    ends = {v: [i * (n // folds) + min(i, n % folds) for i in range(1, folds)] for v, (_, n) in classes.items()}
    cuts = stats.ticket_cuts(df, {str(v): (t, ends[v]) for v, (t, _) in classes.items()}, k)
    fold = F.lit(None).cast("int")
    for v in classes:
        inside = F.lit(folds - 1)
        for i in reversed(range(folds - 1)):
            inside = F.when(cuts[str(v)][i], F.lit(i)).otherwise(inside)
        fold = F.when(F.col(label) == F.lit(v), inside).otherwise(fold)
    return without_key(df.withColumn(output, fold))


def class_weights(df: DataFrame, label: str = "label", output: str = "weight") -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per class
    total = sum(sizes.values())
    weight = F.lit(None).cast("double")
    for v, n in sizes.items():
        weight = F.when(F.col(label) == F.lit(v), F.lit(total / (len(sizes) * n))).otherwise(weight)
    return df.withColumn(output, weight)
