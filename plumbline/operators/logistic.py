"""Logistic regression by Newton's method over sufficient statistics, many fits at once.

An iteration is one pass: every task sums loss, gradient and Hessian of all fits over its rows, the
sums are added up per cell in a grouped aggregate, and the driver solves one small system per fit.
What travels grows with the number of columns and fits, never with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


def matrix(column, width: int):
    """Rows of an Arrow column of number lists, all ``width`` long, as they lie in memory."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


@dataclass(frozen=True)
class Scale:
    """What a fit takes from its training rows: means and deviations of the leading columns, class weights."""

    mean: list[float]
    deviation: list[float]
    weight: dict[int, float]

    def apply(self, points):
        import numpy as np

        k = len(self.mean)
        return np.hstack([(points[:, :k] - np.array(self.mean)) / np.array(self.deviation), points[:, k:]])


@dataclass(frozen=True)
class LogisticModel:
    scale: Scale
    coefficients: object
    intercept: float

    def scores(self, points):
        import numpy as np

        z = self.scale.apply(points) @ self.coefficients + self.intercept
        return 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))


def _sums(points, label, weight, beta):
    """Loss, gradient and Hessian of one fit over some rows; the last coefficient is the intercept."""
    import numpy as np

    x = np.hstack([points, np.ones((len(points), 1))])
    z = x @ beta
    p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
    loss = (weight * (np.logaddexp(0.0, z) - label * z)).sum()
    return np.concatenate([[loss], x.T @ (weight * (p - label)), ((x * (weight * p * (1 - p))[:, None]).T @ x).ravel()])


@dataclass(frozen=True)
class LogisticRegression:
    """L2 of inverse strength ``c`` on all but the intercept; ends when a step changes nothing of note."""

    c: float = 1.0
    max_iter: int = 2000
    tol: float = 1e-10

    def fit_all(self, rows: DataFrame, scales: list[Scale], width: int) -> list[LogisticModel]:
        """A model per fit from ``rows(features array, label, trains array<boolean>)``."""
        import numpy as np

        spark, d = rows.sparkSession, width + 1
        betas = [np.zeros(d) for _ in scales]
        ridge = np.append(np.full(width, 1.0 / self.c), 0.0)
        step, best = [None] * len(scales), [np.inf] * len(scales)
        going = set(range(len(scales)))
        for _ in range(self.max_iter):
            if not going:
                break
            sums = self._pass(spark, rows, scales, {i: betas[i] for i in going}, d)
            for i in sorted(going):
                if i not in sums:
                    raise ValueError("no rows to fit on")
                loss = sums[i][0] + 0.5 * (ridge * betas[i] ** 2).sum()
                if loss > best[i] + 1e-12 * abs(best[i]):  # too far: halve the step
                    step[i] = step[i] / 2
                    betas[i] = betas[i] + step[i]
                    if np.abs(step[i]).max() < self.tol:
                        going.discard(i)
                    continue
                best[i] = loss
                gradient = sums[i][1:d + 1] + ridge * betas[i]
                hessian = sums[i][d + 1:].reshape(d, d) + np.diag(ridge)
                move = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
                if np.abs(move).max() < self.tol or gradient @ move < self.tol * max(1.0, abs(loss)) * 1e-3:
                    going.discard(i)
                    betas[i] = betas[i] - move
                    continue
                step[i] = move
                betas[i] = betas[i] - move
        return [LogisticModel(s, b[:-1], float(b[-1])) for s, b in zip(scales, betas)]

    @staticmethod
    def _pass(spark, rows: DataFrame, scales: list[Scale], betas: dict, d: int) -> dict:
        import numpy as np
        import pyarrow as pa

        shared = spark.sparkContext.broadcast((scales, betas))

        def run(batches: Iterator) -> Iterator:
            scales, betas = shared.value
            total: dict = {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                points, label = matrix(batch["features"], d - 1), batch["label"].to_numpy(zero_copy_only=False).astype(float)
                trains = matrix(batch["trains"], len(scales))
                for i, beta in betas.items():
                    mine = trains[:, i]
                    y = label[mine]
                    weight = np.where(y == 1, scales[i].weight[1], scales[i].weight[0])
                    total[i] = total.get(i, 0) + _sums(scales[i].apply(points[mine]), y, weight, beta)
            for i, values in total.items():
                yield pa.record_batch({"fit": pa.array(np.full(len(values), i, np.int32)), "cell": pa.array(np.arange(len(values), dtype=np.int32)), "value": pa.array(values)})

        parts = rows.select("features", "label", "trains").mapInArrow(run, "fit int, cell int, value double")
        added = parts.groupBy("fit", "cell").agg(F.sum("value").alias("value")).toPandas()  # fits x (1 + d + d * d) rows
        out = {}
        for i, cells in added.groupby("fit"):
            values = np.zeros(1 + d + d * d)
            values[cells["cell"].to_numpy()] = cells["value"].to_numpy()
            out[int(i)] = values
        shared.destroy()
        return out
