"""Chained-equation imputation (van Buuren and Groothuis-Oudshoorn, 2011) from sums of products.

A linear regression needs only the sums of products of its columns. Rows that miss the same
columns share one affine completion of the missing cells, so the sums per pattern of missing
columns, taken once, are enough for all rounds: a regression adds up the completed sums of the
patterns that hold its column, and one join on the pattern writes the result. The rounds never
read the rows again.

Patterns are a table. Each is completed by the regressions so far, and their sums are added in the
tasks that hold them; up to ``HELD`` patterns, the driver holds them as well and adds the same sums
without a job for each regression.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from plumbline.operators import stats
from plumbline.sources.staging import staged

HELD = 4096  # patterns that the driver adds up itself
FLUSH = 512  # patterns a task sums at once


def bayesian_ridge(gram: np.ndarray, target: int, rounds: int = 300, tolerance: float = 1e-3) -> np.ndarray:
    """Coefficients [intercept, others...] of one column on the others, by evidence maximisation
    (MacKay, 1992), from the sums of products of [1, columns]."""
    n = gram[0, 0]
    others = [i for i in range(1, len(gram)) if i != target]
    mean = gram[0] / n
    centred = gram - n * np.outer(mean, mean)
    xx, xy, yy = centred[np.ix_(others, others)], centred[others, target], centred[target, target]
    values, vectors = np.linalg.eigh(xx)
    values = np.clip(values, 0.0, None)
    tiny = 1e-6  # shape and rate of the flat gamma priors
    noise, weight = 1.0 / (yy / n + np.finfo(float).eps), 1.0
    coef = np.zeros(len(others))
    projected = vectors.T @ xy
    for i in range(rounds):
        new = vectors @ (projected / (values + weight / noise))
        residual = max(yy - 2 * new @ xy + new @ xx @ new, 0.0)
        effective = np.sum(noise * values / (weight + noise * values))
        weight = (effective + 2 * tiny) / (new @ new + 2 * tiny)
        noise = (n - effective + 2 * tiny) / (residual + 2 * tiny)
        done = i > 0 and np.sum(np.abs(coef - new)) < tolerance
        coef = new
        if done:
            break
    coef = vectors @ (projected / (values + weight / noise))
    return _with_intercept(coef, others, mean, target, len(gram))


def least_squares(gram: np.ndarray, target: int, ridge: float = 0.0) -> np.ndarray:
    n = gram[0, 0]
    others = [i for i in range(1, len(gram)) if i != target]
    mean = gram[0] / n
    centred = gram - n * np.outer(mean, mean)
    xx = centred[np.ix_(others, others)] + ridge * np.eye(len(others))
    coef = np.linalg.lstsq(xx, centred[others, target], rcond=None)[0]
    return _with_intercept(coef, others, mean, target, len(gram))


def _with_intercept(coef, others, mean, target, size):
    out = np.zeros(size)
    out[others] = coef
    out[0] = mean[target] - coef @ mean[others]
    return out


def _pattern_sums(df: DataFrame, columns: Sequence[str], mean: Sequence[float], scale: Sequence[float]) -> DataFrame:
    """``(mask, sums)``: per pattern of missing columns ("1" where missing) the sums of products of [1, columns].

    Columns are taken around their mean and in units of their spread, so the sums stay accurate; a
    missing cell counts as the mean. Tasks add up their own rows, and a cell of a pattern is one row of the shuffle."""
    size = len(columns) + 1
    values = [(F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(s) for c, m, s in zip(columns, mean, scale)]
    rows = df.select(F.array(*values).alias("v"))

    def run(batches: Iterator) -> Iterator:
        held: dict = {}

        def rows_of():
            upper = np.triu_indices(size)
            for mask, gram in held.items():
                yield pd.DataFrame({"mask": mask, "cell": np.arange(len(upper[0])), "value": gram[upper]})

        for batch in batches:
            if not len(batch):
                continue
            v = np.array([np.asarray(x, float) for x in batch["v"]])
            gone = np.isnan(v)
            x = np.hstack([np.ones((len(v), 1)), np.where(gone, 0.0, v)])
            masks, which = np.unique(gone, axis=0, return_inverse=True)
            which = which.ravel()
            for k, mask in enumerate(masks):
                own = x[which == k]
                name = "".join("1" if g else "0" for g in mask)
                held[name] = held.get(name, 0.0) + own.T @ own
                if len(held) > FLUSH:
                    yield from rows_of()
                    held.clear()
        yield from rows_of()

    cells = rows.mapInPandas(run, "mask string, cell int, value double").groupBy("mask", "cell").agg(F.sum("value").alias("value"))
    sums = F.transform(F.array_sort(F.collect_list(F.struct("cell", "value"))), lambda c: c["value"])
    return cells.groupBy("mask").agg(sums.alias("sums"))


def _square(sums, units: np.ndarray) -> np.ndarray:
    size = len(units)
    out = np.zeros((size, size))
    out[np.triu_indices(size)] = np.asarray(sums, float)
    out = out + np.triu(out, 1).T
    return out * np.outer(units, units)


def _start(mask: str) -> np.ndarray:
    """The completion of a pattern before any regression: the mean, which is zero once centred."""
    out = np.eye(len(mask) + 1)
    for i, gone in enumerate(mask, 1):
        if gone == "1":
            out[i] = 0.0
    return out


def _apply(complete: np.ndarray, mask: str, column: int, coef: np.ndarray) -> None:
    if mask[column - 1] == "1":
        complete[column] = coef @ complete


def _completed(mask: str, steps) -> np.ndarray:
    out = _start(mask)
    for column, coef in steps:
        _apply(out, mask, column, coef)
    return out


class _Held:
    """Few patterns: sums and completions by the driver."""

    def __init__(self, patterns: DataFrame, units: np.ndarray):
        self.grams = {r["mask"]: _square(r["sums"], units) for r in patterns.orderBy("mask").collect()}
        self.complete = {mask: _start(mask) for mask in self.grams}

    def gram(self, column: int, steps) -> np.ndarray:
        return sum(self.complete[m] @ g @ self.complete[m].T for m, g in self.grams.items() if m[column - 1] == "0")

    def step(self, column: int, coef: np.ndarray) -> None:
        for mask, complete in self.complete.items():
            _apply(complete, mask, column, coef)


class _Spread:
    """Many patterns: the same sums by the tasks that hold them, one job for each regression."""

    def __init__(self, patterns: DataFrame, units: np.ndarray):
        self.patterns, self.units = patterns, units

    def gram(self, column: int, steps) -> np.ndarray:
        units, size = self.units, len(self.units)

        def run(batches: Iterator) -> Iterator:
            total = np.zeros((size, size))
            for batch in batches:
                for mask, sums in zip(batch["mask"], batch["sums"]):
                    if mask[column - 1] == "0":
                        complete = _completed(mask, steps)
                        total += complete @ _square(sums, units) @ complete.T
            yield pd.DataFrame({"cell": np.arange(size * size), "value": total.ravel()})

        cells = self.patterns.mapInPandas(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(size * size)
        for r in cells:  # size * size rows
            out[r["cell"]] = r["value"]
        return out.reshape(size, size)

    def step(self, column: int, coef: np.ndarray) -> None:
        pass


def iterative(df: DataFrame, columns: Sequence[str], max_iter: int = 10, ridge: float | None = None, held: int = HELD) -> DataFrame:
    """Fill NULLs of numeric columns: start at the mean, then ``max_iter`` rounds of one regression
    per column on all the others, columns with fewer gaps first.

    ``ridge`` fixes the penalty (0 is least squares); by default the penalty is estimated. Any number
    of columns and of patterns works.
    """
    columns = list(columns)
    about = stats.scalars(df, {
        (c, m): e for c in columns for m, e in (
            ("mean", F.avg(c)), ("sd", F.stddev_pop(c)), ("gaps", F.count_if(F.col(c).isNull())))
    })
    if any(about[c, "mean"] is None for c in columns):
        raise ValueError("a column without any value cannot be imputed")
    order = sorted((i for i, c in enumerate(columns, 1) if about[c, "gaps"]), key=lambda i: about[columns[i - 1], "gaps"])
    if not order or len(columns) < 2:
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(about[c, "mean"])) for c in columns})
    mean = [about[c, "mean"] for c in columns]
    scale = [about[c, "sd"] or 1.0 for c in columns]
    units = np.concatenate([[1.0], scale])
    fit = bayesian_ridge if ridge is None else lambda g, i: least_squares(g, i, ridge)

    patterns = staged(_pattern_sums(df, columns, mean, scale), "patterns")
    sums = (_Held if patterns.count() <= held else _Spread)(patterns, units)
    steps: list[tuple[int, np.ndarray]] = []
    for _ in range(max_iter):
        for i in order:
            coef = fit(sums.gram(i, steps), i)
            steps.append((i, coef))
            sums.step(i, coef)

    def rows_of(batches: Iterator) -> Iterator:
        for batch in batches:
            made = [_completed(mask, steps) for mask in batch["mask"]]
            yield pd.DataFrame({"_pattern": batch["mask"], **{f"_a{i}": [m[i] for m in made] for i in order}})

    schema = "_pattern string, " + ", ".join(f"_a{i} array<double>" for i in order)
    table = staged(patterns.where(F.contains("mask", F.lit("1"))).select("mask").mapInPandas(rows_of, schema), "completions")
    ones = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in columns])
    around = F.array(F.lit(1.0), *[F.coalesce(F.col(f"`{c}`").cast("double") - F.lit(float(m)), F.lit(0.0)) for c, m in zip(columns, mean)])

    def filled(i):
        value = F.aggregate(F.zip_with(f"_a{i}", "_x", lambda a, x: a * x), F.lit(0.0), lambda s, v: s + v)
        return F.coalesce(F.col(f"`{columns[i - 1]}`").cast("double"), value + F.lit(float(mean[i - 1])))

    joined = df.withColumns({"_p": ones, "_x": around}).join(table, F.col("_p") == F.col("_pattern"), "left")
    return joined.withColumns({columns[i - 1]: filled(i) for i in order}).select(*[F.col(f"`{c}`") for c in df.columns])
