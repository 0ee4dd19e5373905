"""The two classifiers over balanced weights. Each fits all its runs together."""

from __future__ import annotations

from collections.abc import Callable

from plumbline.operators.forest import DEEPEST, Forest
from plumbline.operators.logistic import LogisticRegression

# Training defaults (fixed values).
MAX_ITER, TREES, SEED = 2000, 500, 42


def logistic_regression(c: float = 1.0, max_iter: int = MAX_ITER) -> LogisticRegression:
    return LogisticRegression(c, max_iter)


def random_forest(trees: int = TREES, max_depth: int = DEEPEST, seed: int = SEED, fit_rows: int | None = None) -> Forest:
    """Trees are grown on all training rows; ``fit_rows`` bounds them where it is given."""
    return Forest(trees, max_depth, seed, fit_rows)


MODELS: dict[str, Callable] = {"logistic_regression": logistic_regression, "random_forest": random_forest}
